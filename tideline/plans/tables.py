"""The sample tables in the shapes the warehouse operators work on."""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tideline.functions.times import to_millis
from tideline.operators.joins import salted_join
from tideline.session import grow_shuffle, prepare

DAY_MS = 86_400_000


def _zoned(df: DataFrame) -> DataFrame:
    """Zone-less timestamps read as UTC instants."""
    zoneless = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless}) if zoneless else df


@lru_cache(maxsize=128)
def _schema(path: str) -> T.StructType:
    """Schema of a sample file, read once: a query often reads a table several times."""
    return SparkSession.active().read.parquet(path).schema


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One sample table."""
    path = f"{folder}/{name}.parquet"
    grow_shuffle(spark, folder)
    return _zoned(prepare(spark).read.schema(_schema(path)).parquet(path))


def pick(index: Column, values: list[str]) -> Column:
    """Value at a position of a fixed list, counted from 0."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def as_page_log(events: DataFrame) -> DataFrame:
    """Events as a flat page log.  ``k`` out of ``props`` stands for everything the events do not have."""
    # Out of a generator, so that filters on columns made of ``k`` do not parse again.
    keyed = events.selectExpr(
        "event_id", "ts", "user_id", "event_type", "value",
        "explode(array(CAST(get_json_object(props, '$.k') AS INT))) AS k",
    )
    return keyed.selectExpr(
        "event_id AS seq",
        "ts",
        "unix_millis(ts) AS ts_ms",
        "user_id",
        "event_type",
        "k",
        "concat('mid_', user_id) AS mid",
        "CASE WHEN k % 10 <> 9 THEN CAST(user_id AS STRING) END AS uid",
        "concat('v2.', k % 5) AS vc",
        "concat('ch', k % 3) AS ch",
        "CAST(k % 7 AS STRING) AS ar",
        "CAST(k % 2 AS STRING) AS is_new",
        "concat('md', k % 9) AS md",
        "concat('ba', k % 4) AS ba",
        "element_at(array('Android 13.0', 'iOS 16.1', 'Harmony 4.0'), k % 3 + 1) AS os",
        "CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail' WHEN 'purchase' THEN 'cart' "
        "WHEN 'signup' THEN 'login' ELSE 'error' END AS page_id",
        "CASE k % 4 WHEN 1 THEN 'login' WHEN 2 THEN 'search' WHEN 3 THEN 'home' END AS last_page_id",
        "CASE WHEN k % 4 = 2 THEN 'keyword' ELSE 'sku_id' END AS item_type",
        "CASE WHEN k % 4 = 2 THEN concat('NATION_', k % 30) ELSE CAST(k AS STRING) END AS item",
        "CAST(round(value * 100) AS BIGINT) AS during_time",
    )


def page_log(spark: SparkSession, folder: str) -> DataFrame:
    return as_page_log(table(spark, folder, "events"))


def app_log_text(pages: DataFrame) -> DataFrame:
    """The page log as nested JSON log records ``(seq, value)``."""
    n = F.col("k") % 4
    record = F.struct(
        F.struct("ar", "uid", "os", "ch", "is_new", "md", "mid", "vc", "ba").alias("common"),
        F.struct("page_id", "item", "item_type", "during_time", "last_page_id").alias("page"),
        F.when(
            n > 0,
            F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(
                i.alias("pos_seq"), F.concat(F.lit("d"), i.cast("string")).alias("item")
            )),
        ).alias("displays"),
        F.when(
            n > 1,
            F.transform(F.sequence(F.lit(2), n), lambda i: F.create_map(
                F.lit("action_id"), F.concat(F.lit("a"), i.cast("string"))
            )),
        ).alias("actions"),
        F.when(F.col("event_type") == "signup", F.create_map(F.lit("entry"), F.col("ch"))).alias("start"),
        F.when(F.col("event_type") == "error", F.create_map(F.lit("code"), F.col("k").cast("string"))).alias("err"),
        F.col("ts_ms").alias("ts"),
    )
    return pages.select("seq", F.explode(F.array(F.to_json(record))).alias("value"))


def details(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines.  ``id`` repeats: the later rows are new versions of the line.

    ``ORDER`` orders the versions completely.
    """
    return as_details(table(spark, folder, "lineitem"))


_PRICE = "CAST(l_extendedprice AS DECIMAL(16,2))"
_DETAILS = {
    "id": "concat_ws('-', l_orderkey, l_linenumber)",
    "order_id": "l_orderkey",
    "sku_id": "l_partkey",
    "supplier_id": "l_suppkey",
    "line_number": "l_linenumber",
    "sku_num": "CAST(l_quantity AS INT)",
    "split_original_amount": _PRICE,
    "split_activity_amount": f"{_PRICE} * CAST(l_discount AS DECIMAL(4,2))",
    "split_coupon_amount": f"{_PRICE} * CAST(l_tax AS DECIMAL(4,2))",
    "split_total_amount": _PRICE,
    "return_flag": "l_returnflag",
    "line_status": "l_linestatus",
    "ts_ms": "unix_millis(l_shipdate)",
}


def as_details(lineitem: DataFrame, names: Sequence[str] = tuple(_DETAILS), keep: Sequence[str] = ()) -> DataFrame:
    """Order lines out of rows of the table; ``names`` of their columns need only what these are made of.

    ``keep`` names columns of the rows that go on behind them.
    """
    return lineitem.selectExpr(*[f"{_DETAILS[n]} AS {n}" for n in names], *keep)


ORDER = ["ts_ms", "sku_id", "supplier_id", "split_original_amount"]


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the province of their customer."""
    return as_orders(table(spark, folder, "orders"), table(spark, folder, "customer"))


def as_orders(placed: DataFrame, customers: DataFrame) -> DataFrame:
    rows = placed.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_totalprice").alias("total_amount"),
        F.col("o_orderpriority").alias("priority"),
        to_millis(F.col("o_orderdate")).alias("order_ms"),
    )
    people = customers.select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("province_id"))
    return salted_join(rows, people, ["user_id"], "left", ["order_id"])


def literal_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small configuration table written into the plan.

    As literals its size is known, so Catalyst broadcasts it.  Of a table of
    unknown size the other side is shuffled by its few keys, and one task gets
    all rows of a key.
    """
    fields = T._parse_datatype_string(schema).fields
    records = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*records)))


def as_double(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})
