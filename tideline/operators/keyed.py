"""Per-key history: what a keyed stream job keeps in state, as batch plans.

A single key may own a large share of the rows.  Results that only need one
row per key or per key and day are aggregates (combined before the shuffle).
Results that need the neighbouring row or a running value use a window over
buckets of a key: how many follows from the measured rows of the key, so an
ordinary key has one, and one summary row per bucket of a large key carries
over.  Key columns must not be null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tideline.functions.times import local_date
from tideline.operators.joins import salted_join

#: Rows of a key that one bucket holds, if they lie evenly along the order.
ROWS_PER_BUCKET = 1_000_000


def _pick(cols: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in cols])


# ---- one row per key ------------------------------------------------------

def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Earliest row of each key, all columns kept."""
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(F.min_by(_pick(rest), _pick(order)).alias("_r"))
    return first.select(*keys, "_r.*").select(*df.columns)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last version of each key, all columns kept."""
    rest = [c for c in df.columns if c not in keys]
    last = df.groupBy(*keys).agg(F.max_by(_pick(rest), _pick(order)).alias("_r"))
    return last.select(*keys, "_r.*").select(*df.columns)


def distinct_pairs(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """Exact deduplication on a key tuple; with ``order`` the earliest row is kept."""
    return first_per_key(df, keys, order) if order else df.dropDuplicates(list(keys))


# ---- neighbours -----------------------------------------------------------

def _bucketed(df: DataFrame, keys: Sequence[str], along: str, rows_per_bucket: int) -> DataFrame:
    """Add ``_buckets``, the number of buckets of the key, and ``_bucket``, the row's one.

    The buckets cut the range of ``along`` into equal parts, so a bucket never
    decreases along it; nulls, which come first in an order, join the first.
    The counts are an aggregate of their own, combined before the shuffle, and
    are joined without a hint.
    """
    place = F.col(along).cast("double")
    sizes = df.groupBy(*keys).agg(
        F.ceil(F.count("*") / rows_per_bucket).alias("_buckets"), F.min(place).alias("_lo"), F.max(place).alias("_hi")
    )
    part = (place - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
    bucket = F.least(F.floor(part * F.col("_buckets")), F.col("_buckets") - 1)
    cut = (F.col("_buckets") > 1) & (F.col("_hi") > F.col("_lo")) & place.isNotNull()
    return df.join(sizes, list(keys)).withColumn(
        "_bucket", F.when(cut, bucket).otherwise(F.lit(0).cast("bigint"))
    ).drop("_lo", "_hi")


def neighbor(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    out: str,
    along: str | None = None,
    following: bool = False,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Add struct ``out`` with ``values`` of the previous (or following) row of the key.

    ``order`` must order the rows of a key completely.  ``along`` is a numeric
    or time column that does not decrease along it, usually the first of
    ``order``; it cuts a large key into buckets.  Without it every key is one
    window.  ``out`` is null when the key has no such row.
    """
    keys = list(keys)
    step = F.lead if following else F.lag
    if along is None:
        return df.withColumn(out, step(_pick(values)).over(Window.partitionBy(*keys).orderBy(*order)))
    rows = _bucketed(df, keys, along, rows_per_bucket)
    edge = F.min_by if following else F.max_by
    edges = (
        rows.where(F.col("_buckets") > 1)
        .groupBy(*keys, "_bucket")
        .agg(edge(_pick(values), _pick(order)).alias("_edge"))
    )
    # One row per large key and bucket.
    across = Window.partitionBy(*keys).orderBy("_bucket")
    carried = edges.select(*keys, "_bucket", step("_edge").over(across).alias("_far"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    near = rows.withColumn("_near", step(_pick(values)).over(inside))
    return near.join(carried, [*keys, "_bucket"], "left").select(*df.columns, F.coalesce("_near", "_far").alias(out))


# ---- daily unique, returning users, visitor repair -------------------------

def first_of_day(df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str], tz: str = "UTC") -> DataFrame:
    """First row of each key on each calendar day, with the day as ``visit_date``.

    For input whose event time does not go back this is the daily-unique flag
    of a keyed job: exactly these rows carry 1.
    """
    return first_per_key(df.withColumn("visit_date", local_date(F.col(ts), tz)), [*keys, "visit_date"], order)


def daily_unique_by_arrival(
    df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str], along: str | None = None, out: str = "uv_ct",
    tz: str = "UTC", rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Flag 1 when the previous row of the key, in arrival order, is of another day.

    Unlike :func:`first_of_day` a day that comes back after another day counts
    again, as it does for a job that remembers only the last date.
    """
    dated = df.withColumn("_date", local_date(F.col(ts), tz))
    seen = neighbor(dated, keys, order, ["_date"], "_prev", along, rows_per_bucket=rows_per_bucket)
    changed = F.col("_prev").isNull() | (F.col("_prev._date") != F.col("_date"))
    return seen.withColumn(out, changed.cast("bigint")).drop("_date", "_prev")


def returning_users(
    df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str], gap_days: int = 8, tz: str = "UTC"
) -> DataFrame:
    """First row of each user and day with ``uu_ct`` = 1 and ``back_ct``.

    ``back_ct`` is 1 when at least ``gap_days`` whole days lie between the
    midnight of the user's last active day and this row.
    """
    daily = first_of_day(df, keys, ts, order, tz)
    # One row per user and active day, so the window stays small for any user.
    last = F.lag("visit_date").over(Window.partitionBy(*keys).orderBy("visit_date"))
    # Whole days from a midnight to a later instant equal the calendar distance.
    gap = F.date_diff(F.col("visit_date"), last)
    return daily.withColumns({
        "uu_ct": F.lit(1).cast("bigint"),
        "back_ct": F.coalesce((gap >= gap_days).cast("bigint"), F.lit(0).cast("bigint")),
    })


def repair_new_visitors(
    df: DataFrame, key: str, ts: str, flag: str, order: Sequence[str], tz: str = "UTC", out: str | None = None,
    hot: Sequence = (),
) -> DataFrame:
    """Correct a claimed ``is_new`` = '1' on any day but the visitor's first.

    A visitor whose first row says '0' counts as first seen the day before.
    """
    origin = df.groupBy(key).agg(
        F.min_by(F.struct(F.col(ts).alias("t"), F.col(flag).alias("f")), _pick(order)).alias("_first")
    )
    first_day = local_date(F.col("_first.t"), tz)
    origin = origin.select(
        key,
        F.when(F.col("_first.f") == "1", first_day).otherwise(F.date_sub(first_day, 1)).alias("_first_day"),
    )
    wrong = (F.col(flag) == "1") & (local_date(F.col(ts), tz) != F.col("_first_day"))
    repaired = salted_join(df, origin, [key], "left", order, hot).withColumn(
        out or flag, F.when(wrong, "0").otherwise(F.col(flag))
    )
    names = df.columns + ([out] if out and out not in df.columns else [])
    return repaired.select(*names)


# ---- retraction -----------------------------------------------------------

def mark_superseded(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], ts_ms: str | None = None, ttl_ms: int | None = None,
    out: str = "superseded", rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Flag versions that a later version of the same key replaces.

    Without a time limit a version is replaced unless it is the last, so the
    last of each key, an aggregate, is joined back and no history is sorted.
    With ``ttl_ms`` a version is only replaced by one that follows within that
    time of ``ts_ms``, the first of ``order``; that takes the neighbouring row.
    """
    if ttl_ms is None:
        last = df.groupBy(*keys).agg(F.max(_pick(order)).alias("_last"))
        return df.join(last, list(keys)).withColumn(out, _pick(order) < F.col("_last")).drop("_last")
    if ts_ms is None or ts_ms != order[0]:
        raise ValueError("ttl_ms needs the name of the time column, which comes first in the order")
    rows = neighbor(df, keys, order, [ts_ms], "_next", ts_ms, following=True, rows_per_bucket=rows_per_bucket)
    replaced = F.col("_next").isNotNull() & (F.col(f"_next.{ts_ms}") - F.col(ts_ms) <= ttl_ms)
    return rows.withColumn(out, replaced).drop("_next")


def last_and_places(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], place: Sequence[str], measures: Sequence[str], out: str = "superseded",
) -> DataFrame:
    """For sums by ``place``: place and measures of the last version of each key, and each place of any version as a replaced row.

    Replaced versions add nothing to such sums but their place, so they are not
    joined back: both parts are aggregates, combined before the shuffle.  The
    measures of a replaced row are null.
    """
    last = df.groupBy(*keys).agg(F.max_by(_pick([*place, *measures]), _pick(order)).alias("_r")).select("_r.*", F.lit(False).alias(out))
    places = df.select(*place).distinct().withColumn(out, F.lit(True))
    return last.unionByName(places, allowMissingColumns=True)


def retract(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], measures: Sequence[str],
    ts_ms: str | None = None, ttl_ms: int | None = None, rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Every version, plus a negated copy of each replaced one at its own event time.

    ``row_kind`` is ``+`` or ``-``; summing the measures leaves the surviving
    versions only.
    """
    rows = mark_superseded(df, keys, order, ts_ms, ttl_ms, rows_per_bucket=rows_per_bucket)
    kinds = F.when(F.col("superseded"), F.array(F.lit("+"), F.lit("-"))).otherwise(F.array(F.lit("+")))
    both = rows.withColumn("row_kind", F.explode(kinds)).drop("superseded")
    return both.withColumns({m: F.when(F.col("row_kind") == "-", -F.col(m)).otherwise(F.col(m)) for m in measures})


# ---- running profile ------------------------------------------------------

def running_profile(
    df: DataFrame, key: str, order: Sequence[str], sets: Sequence[str], along: str | None = None, count: str = "pv",
    as_text: bool = True, rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Running row count and running distinct values of a key, for every row.

    Each set becomes a sorted comma list, or an array without ``as_text``;
    null values are not collected.  ``along`` cuts a large key into buckets, as
    in :func:`neighbor`; a bucket starts from the rows and the values of the
    buckets before, each value carried once.
    """
    kept = [c for c in df.columns if c not in sets]
    whole = along is None
    rows = df.withColumn("_bucket", F.lit(0)) if whole else _bucketed(df, [key], along, rows_per_bucket)
    inside = Window.partitionBy(key, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.select(
        "*", F.count("*").over(inside).alias("_c"), *[F.collect_set(s).over(inside).alias(f"_l_{s}") for s in sets]
    )
    if not whole:
        large = _bucketed(df, [key], along, rows_per_bucket).where(F.col("_buckets") > 1)
        carried = large.groupBy(key, "_bucket").agg(F.count("*").alias("_n"))
        for s in sets:
            first = large.where(F.col(s).isNotNull()).groupBy(key, s).agg(F.min("_bucket").alias("_bucket"))
            new = first.groupBy(key, "_bucket").agg(F.collect_list(s).alias(f"_v_{s}"))
            carried = carried.join(new, [key, "_bucket"], "left")
        before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        carried = carried.select(
            key, "_bucket", F.sum("_n").over(before).alias("_n0"),
            *[F.flatten(F.collect_list(f"_v_{s}").over(before)).alias(f"_s0_{s}") for s in sets],
        )
        rows = rows.join(carried, [key, "_bucket"], "left")

    def found(s: str) -> Column:
        values = F.col(f"_l_{s}")
        if not whole:
            values = F.array_union(F.coalesce(f"_s0_{s}", F.slice(f"_l_{s}", 1, 0)), values)
        values = F.array_sort(values)
        return (F.array_join(values, ",") if as_text else values).alias(s)

    total = F.col("_c") if whole else F.col("_c") + F.coalesce("_n0", F.lit(0))
    return rows.select(*kept, total.alias(count), *[found(s) for s in sets])
