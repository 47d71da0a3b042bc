"""Change records of business tables: decoding, routing by configuration and merging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tideline.schemas import CHANGE, LEGACY_CHANGE

# Operation codes of change records and the names the fact
# configuration uses for them.
SNAPSHOT, CREATE, UPDATE, DELETE = "r", "c", "u", "d"
SOURCE_TYPES = {"insert": ["c", "r"], "update": ["u"], "delete": ["d"]}
BOOTSTRAP_PREFIX = "bootstrap-"


# ---- decoding -------------------------------------------------------------

def parse_once(df: DataFrame, value: str, schema: T.StructType, options: dict[str, str] | None = None) -> DataFrame:
    """JSON text to the columns of ``schema``; rows with null text are dropped, other columns kept.

    The parsed record comes out of a generator, which keeps later filters on
    its fields from being pushed below it and parsing the text again.
    """
    rest = [c for c in df.columns if c != value]
    record = F.from_json(F.col(value).cast("string"), schema, options or {})
    return df.where(F.col(value).isNotNull()).select(*rest, F.inline(F.array(record)))


def decode_changes(df: DataFrame, value: str = "value", strict: bool = False) -> DataFrame:
    """JSON text to change columns.

    Null payloads and unreadable records are dropped; with ``strict`` an
    unreadable record fails the job instead.  Other columns are kept.
    """
    options = {"mode": "FAILFAST" if strict else "PERMISSIVE"}
    # A permissive parse turns a bad record into nulls.
    return parse_once(df, value, CHANGE, options).where(F.col("op").isNotNull())


def decode_legacy_changes(df: DataFrame, value: str = "value", database: str | None = None) -> DataFrame:
    """Records of the older layout, in the current one."""
    kind = F.col("type")
    op = (
        F.when(kind == "insert", CREATE)
        .when(kind == "update", UPDATE)
        .when(kind == "delete", DELETE)
        .when(kind.startswith(BOOTSTRAP_PREFIX), kind)
    )
    removed = kind == "delete"
    no_cells = F.create_map().cast("map<string,string>")
    old_cells = F.coalesce("old", no_cells)
    nothing = F.lit(None).cast("map<string,string>")
    # Updates list only the changed old cells; the rest of the old row is the new row.
    unchanged = F.map_filter("data", lambda k, v: ~F.map_contains_key(old_cells, k))
    old_row = F.when(kind == "update", F.map_concat(unchanged, old_cells))
    rest = [c for c in df.columns if c != value]
    changes = parse_once(df, value, LEGACY_CHANGE).where(kind.isNotNull()).select(
        *rest,
        F.when(removed, F.col("data")).otherwise(old_row).alias("before"),
        F.when(removed, nothing).otherwise(F.col("data")).alias("after"),
        F.create_map(F.lit("db"), F.col("database"), F.lit("table"), F.col("table")).alias("source"),
        op.alias("op"),
        (F.col("ts") * 1000).alias("ts_ms"),
    )
    return changes if database is None else changes.where(F.col("source")["db"] == database)


def drop_bootstrap(df: DataFrame) -> DataFrame:
    return df.where(~F.col("op").startswith(BOOTSTRAP_PREFIX))


def row_as_map(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """All columns of a row as a map of strings."""
    return F.create_map(*[x for c in columns or df.columns for x in (F.lit(c), F.col(c).cast("string"))])


def snapshot_changes(df: DataFrame, db: str, table: str, ts_ms: Column, columns: Sequence[str] | None = None) -> DataFrame:
    """The present rows of a table as snapshot change records."""
    return df.select(
        F.lit(None).cast("map<string,string>").alias("before"),
        row_as_map(df, columns).alias("after"),
        F.create_map(F.lit("db"), F.lit(db), F.lit("table"), F.lit(table)).alias("source"),
        F.lit(SNAPSHOT).alias("op"),
        ts_ms.cast("bigint").alias("ts_ms"),
    )


# ---- filters and projections ----------------------------------------------

def _size(image: str) -> Column:
    return F.coalesce(F.size(image), F.lit(0))


def keep_changes(
    df: DataFrame, db: str | None = None, tables: Sequence[str] | None = None,
    ops: Sequence[str] = (CREATE, UPDATE, DELETE, SNAPSHOT),
) -> DataFrame:
    """Changes of a database with a row image to work on.

    A delete has no new image, so its old one counts.
    """
    keep = F.col("op").isin(*ops)
    if db is not None:
        keep = keep & (F.col("source")["db"] == db)
    if tables is not None:
        keep = keep & F.col("source")["table"].isin(*tables)
    image = F.when(F.col("op") == DELETE, _size("before")).otherwise(_size("after"))
    return df.where(keep & (image > 0))


def of_table(df: DataFrame, table: str) -> DataFrame:
    return df.where(F.col("source")["table"] == table)


def row_image() -> Column:
    """Old image for a delete, else the new one, else the old one when the new one is empty."""
    new_or_old = F.when(_size("after") > 0, F.col("after")).otherwise(F.col("before"))
    return F.when(F.col("op") == DELETE, F.col("before")).otherwise(new_or_old)


def fields(df: DataFrame, columns: dict[str, str] | Sequence[str], image: str = "after", extra: Sequence = ()) -> DataFrame:
    """Map entries as string columns, with more columns after them."""
    names = columns if isinstance(columns, dict) else {c: c for c in columns}
    return df.select(*[F.col(image)[k].alias(out) for k, out in names.items()], *extra)


def keep_listed(image: Column, csv: Column) -> Column:
    """Only the map entries named in a comma list."""
    listed = F.transform(F.split(csv, ","), lambda c: F.trim(c))
    return F.map_filter(image, lambda k, v: F.array_contains(listed, k))


def put(image: Column, key: str, value: Column) -> Column:
    """Map with ``key`` set to ``value``, replacing an entry of that name."""
    return F.map_concat(
        F.map_filter(image, lambda k, v: k != key), F.create_map(F.lit(key), value.cast("string"))
    )


# ---- configuration-driven routing -----------------------------------------

def current_config(config: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """Latest configuration row per key, without the deleted ones."""
    from tideline.operators.keyed import latest_per_key

    latest = latest_per_key(config, keys, order) if order else config
    return latest.where(F.coalesce(F.col("op"), F.lit(SNAPSHOT)) != DELETE).drop(*(order or []))


def route_dimensions(changes: DataFrame, config: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Changes of configured tables as ``(sink_table, sink_family, row_key, op, ts_ms, data)``.

    ``data`` holds the configured columns and the operation.  Rows of other
    tables are dropped.
    """
    cfg = config.select("source_table", "sink_table", "sink_columns", "sink_family", "sink_row_key")
    rows = changes.withColumn("source_table", F.col("source")["table"]).join(cfg, "source_table")
    image = row_image()
    return rows.select(
        "sink_table",
        "sink_family",
        F.try_element_at(image, F.col("sink_row_key")).alias("row_key"),
        "op",
        "ts_ms",
        put(keep_listed(image, F.col("sink_columns")), "op", F.col("op")).alias("data"),
        *extra,
    )


def route_facts(changes: DataFrame, config: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Changes of a configured (table, operation) as ``(sink_table, op, ts_ms, data)``.

    ``source_type`` is a name (insert, update, delete) or an operation code.
    """
    named = F.create_map(*[
        x for name, ops in SOURCE_TYPES.items() for x in (F.lit(name), F.array(*[F.lit(o) for o in ops]))
    ])
    cfg = config.select(
        "source_table",
        F.explode(F.coalesce(F.try_element_at(named, F.col("source_type")), F.array("source_type"))).alias("op"),
        "sink_table",
        "sink_columns",
    ).distinct()
    rows = changes.withColumn("source_table", F.col("source")["table"]).join(cfg, ["source_table", "op"])
    return rows.select(
        "sink_table",
        "op",
        "ts_ms",
        put(keep_listed(row_image(), F.col("sink_columns")), "ts_ms", F.col("ts_ms")).alias("data"),
        *extra,
    )


# ---- merging --------------------------------------------------------------

def merge_cells(
    changes: DataFrame, keys: Sequence[str], data: str = "data", op: str = "op", seq: str = "seq",
    ignore: Sequence[str] = ("op",), columns: Sequence[str] | None = None,
) -> DataFrame:
    """Current cells ``(keys, column, cell)`` after upserts and deletes in ``seq`` order.

    An empty or null cell leaves the stored one as it is; a delete removes all
    cells written before it.  Cells are reduced before the shuffle, so a row
    that changes very often is no heavier than any other.  With ``columns``,
    known from the configuration, the changes are read and grouped once and
    cells are made of the merged rows; otherwise each change is one row per cell.
    """
    keys = list(keys)
    if columns is not None:
        merged = merge_columns(changes, keys, [c for c in columns if c not in ignore], data, op, seq)
        cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("cell")) for c in columns if c not in ignore])
        return merged.select(*keys, F.inline(cells)).where(F.col("cell").isNotNull())
    cells = (
        changes.where(F.col(op) != DELETE)
        .select(*keys, F.col(seq).alias("_seq"), F.explode(data).alias("column", "_cell"))
        .where((F.col("_cell") != "") & ~F.col("column").isin(*ignore))
        .groupBy(*keys, "column")
        .agg(F.max_by("_cell", "_seq").alias("cell"), F.max("_seq").alias("_seq"))
    )
    removed = changes.where(F.col(op) == DELETE).groupBy(*keys).agg(F.max(seq).alias("_gone"))
    return (
        cells.join(removed, keys, "left")
        .where(F.col("_gone").isNull() | (F.col("_seq") > F.col("_gone")))
        .select(*keys, "column", "cell")
    )


def merge_columns(
    changes: DataFrame, keys: Sequence[str], columns: Sequence[str], data: str = "data", op: str = "op",
    seq: str = "seq",
) -> DataFrame:
    """As :func:`merge_cells` for known columns, one row per key: no explode and a single aggregate."""
    keys = list(keys)
    written = {
        c: (F.col(op) != DELETE) & F.coalesce(F.col(data)[c] != "", F.lit(False)) for c in columns
    }
    winners = changes.groupBy(*keys).agg(
        F.max(F.when(F.col(op) == DELETE, F.col(seq))).alias("_gone"),
        *[
            F.max_by(F.struct(F.col(data)[c].alias("cell"), F.col(seq).alias("at")), F.when(w, F.col(seq))).alias(c)
            for c, w in written.items()
        ],
    )
    rows = winners.select(*keys, *[
        F.when(F.col("_gone").isNull() | (F.col(f"{c}.at") > F.col("_gone")), F.col(f"{c}.cell")).alias(c)
        for c in columns
    ])
    return rows.where(F.coalesce(*columns).isNotNull())


def cells_to_maps(cells: DataFrame, keys: Sequence[str], out: str = "data") -> DataFrame:
    """One row per key with its cells as a map; a row has as many cells as its table has columns."""
    return cells.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("column", "cell")))).alias(out))


def maps_to_columns(df: DataFrame, schema: T.StructType, data: str = "data") -> DataFrame:
    """Typed columns out of a map; text that does not fit its type becomes null."""
    return df.select(*[F.col(data)[f.name].try_cast(f.dataType).alias(f.name) for f in schema.fields])


def current_rows(changes: DataFrame, keys: Sequence[str], order: Sequence[str], op: str = "op") -> DataFrame:
    """Last version of each key; keys whose last change is a delete are gone."""
    from tideline.operators.keyed import latest_per_key

    return latest_per_key(changes, keys, order).where(F.col(op) != DELETE)
