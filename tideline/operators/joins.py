"""Joins: equi joins with named hot keys, keyed interval joins and dictionary lookups.

Dimension sides carry no broadcast hint.  Catalyst broadcasts a side whose
size it knows to be under ``spark.sql.autoBroadcastJoinThreshold`` and AQE
does the same with measured sizes, so a dimension that outgrows the threshold
turns into a shuffle join by itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Salts over which the rows of a named key are spread.
SALTS = 64


def is_hot(on: Sequence[str], hot: Sequence, df: DataFrame | None = None) -> Column:
    """Whether the row's key is one of the named ones; ``hot`` holds values, or tuples for several columns.

    Compared with ``=``, as the join compares the two sides, so the sides agree
    whatever the types of their key columns.  Whole numbers are looked up in a
    set where ``df`` shows the column to hold such: many comparisons make a
    method that the JVM does not compile.
    """
    rows = [h if isinstance(h, tuple) else (h,) for h in hot]
    if any(len(r) != len(on) for r in rows):
        raise ValueError(f"named keys need {len(on)} values: {', '.join(on)}")
    whole = df is not None and len(on) == 1 and isinstance(df.schema[on[0]].dataType, T.IntegralType)
    if whole and all(type(value) is int for value, in rows):
        return F.coalesce(F.col(on[0]).isin([value for value, in rows]), F.lit(False))
    named = F.lit(False)
    for row in rows:
        same = F.lit(True)
        for c, value in zip(on, row):
            same = same & (F.col(c) == F.lit(value))
        named = named | same
    return F.coalesce(named, F.lit(False))


def salted_joins(
    many: DataFrame,
    sides: Sequence[tuple[DataFrame, str]],
    on: Sequence[str],
    spread: Sequence[str] = (),
    hot: Sequence = (),
    salts: int = SALTS,
) -> DataFrame:
    """Equi joins on one key of a ``many`` side that may hold a very frequent key.

    ``sides`` are ``(table, how)`` with ``how`` one of ``inner``, ``left``,
    ``left_semi`` and ``left_anti``.  By itself this is the plain join: AQE
    measures the shuffled partitions and splits the skewed ones.  It cannot
    split where an aggregate needs the same partitioning; for that case the
    caller may name ``hot`` keys.  Their rows are spread over ``salts`` by a
    hash of their ``spread`` columns, which should tell the rows of one key
    apart, and the matching rows of a side are repeated once per salt.
    Building the plan starts no job.
    """
    for _, how in sides:
        if how not in ("inner", "left", "left_semi", "left_anti"):
            raise ValueError(f"unsupported join type: {how}")
    if not hot:
        for one, how in sides:
            many = many.join(one, list(on), how)
        return many
    if not spread:
        raise ValueError("salting needs columns to spread the rows by")
    joined = many.withColumn(
        "_salt", F.when(is_hot(on, hot, many), F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")).otherwise(0)
    )
    for one, how in sides:
        last = F.when(is_hot(on, hot, one), salts - 1).otherwise(0)
        repeated = one.withColumn("_salt", F.explode(F.sequence(F.lit(0), last)))
        joined = joined.join(repeated, [*on, "_salt"], how)
    return joined.drop("_salt")


def salted_join(
    many: DataFrame,
    one: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    spread: Sequence[str] = (),
    hot: Sequence = (),
    salts: int = SALTS,
) -> DataFrame:
    """:func:`salted_joins` with one side."""
    return salted_joins(many, [(one, how)], on, spread, hot, salts)


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_ms: str,
    right_ms: str,
    lower_ms: int,
    upper_ms: int,
    spread: Sequence[str] = (),
    hot: Sequence = (),
    salts: int = SALTS,
) -> DataFrame:
    """Pairs with equal keys and ``lower_ms <= right - left <= upper_ms``, both ends included.

    Time is cut into slices as wide as the interval and the slice joins the
    equi key: a right row lies in one slice, a left row looks into at most two,
    so a key with very many rows is spread over time instead of compared
    all-against-all.  AQE splits slices that are still skewed; ``hot`` names
    keys to salt by ``spread`` beforehand, as in :func:`salted_joins`.  Column
    names other than the keys must differ between the sides.
    """
    width = max(upper_ms - lower_ms, 1)

    def slice_of(ms: Column) -> Column:
        return F.floor(ms / width)

    first, last = slice_of(F.col(left_ms) + lower_ms), slice_of(F.col(left_ms) + upper_ms)
    probe = left.withColumn("_slice", F.explode(F.sequence(first, last)))
    build = right.withColumn("_slice", slice_of(F.col(right_ms)))
    if hot:
        salt = F.when(is_hot(on, hot, probe), F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")).otherwise(0)
        last_salt = F.when(is_hot(on, hot, build), salts - 1).otherwise(0)
        probe = probe.withColumn("_salt", salt)
        build = build.withColumn("_salt", F.explode(F.sequence(F.lit(0), last_salt)))
        pairs = probe.join(build, [*on, "_slice", "_salt"]).drop("_salt")
    else:
        pairs = probe.join(build, [*on, "_slice"])
    return pairs.where((F.col(right_ms) - F.col(left_ms)).between(lower_ms, upper_ms)).drop("_slice")


def merge_right_wins(pairs: DataFrame, left: Sequence[str], right: Sequence[str], prefix: str) -> DataFrame:
    """Merge two records after a join: on equal names the right value wins.

    Right columns carry ``prefix`` in ``pairs``; the result has plain names.
    """
    kept = [F.col(c) for c in left if c not in right]
    return pairs.select(*kept, *[F.col(prefix + c).alias(c) for c in right])


def nest(df: DataFrame, groups: dict[str, Sequence[str]]) -> DataFrame:
    """Gather flat columns into one struct per record."""
    return df.select([F.struct(*[F.col(c) for c in cols]).alias(name) for name, cols in groups.items()])


def lookup(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    dim_key: str,
    columns: dict[str, str],
    how: str = "left",
    default: str | None = None,
) -> DataFrame:
    """Add dimension ``columns`` (dimension name to output name) for ``key``.

    ``left`` leaves a row without a match as it is (or fills ``default``),
    ``inner`` drops it.  ``dim_key`` must be unique in ``dim``.
    """
    side = dim.select(F.col(dim_key).alias(key), *[F.col(c).alias(out) for c, out in columns.items()])
    joined = df.join(side, key, how)
    if default is not None:
        joined = joined.fillna(default, list(columns.values()))
    return joined


def lookup_chain(df: DataFrame, steps: Sequence[tuple], how: str = "left") -> DataFrame:
    """Follow a snowflake: each step is ``(dim, key, dim_key, columns)`` and may use columns of earlier steps."""
    for dim, key, dim_key, columns in steps:
        df = lookup(df, dim, key, dim_key, columns, how)
    return df


def missing_keys(df: DataFrame, dim: DataFrame, key: str, dim_key: str) -> DataFrame:
    """Keys of ``df`` without a dimension row, with their number of rows."""
    side = dim.select(F.col(dim_key).alias(key))
    return df.groupBy(key).agg(F.count("*").alias("rows")).join(side, key, "left_anti")


def member_flag(df: DataFrame, words: DataFrame, column: str, word: str, out: str) -> DataFrame:
    """1 when ``column`` is in the word set, else 0."""
    side = words.select(F.col(word).alias(column)).distinct().withColumn(out, F.lit(1))
    return df.join(side, column, "left").fillna(0, [out])


def members(df: DataFrame, words: DataFrame, column: str, word: str, negate: bool = False) -> DataFrame:
    """Rows whose ``column`` is (not) in the word set."""
    side = words.select(F.col(word).alias(column))
    return df.join(side, column, "left_anti" if negate else "left_semi")
