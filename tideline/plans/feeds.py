"""Change feeds, application log and message forms over the sample tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tideline.operators import applog, cdc
from tideline.plans import sql
from tideline.plans.tables import ORDER, app_log_text, details, literal_rows, page_log, table
from tideline.schemas import COMMON, PAGE
from tideline.sinks.writers import snake_messages, to_messages
from tideline.sources.readers import first_rows, json_table, message_text

# ---- change feeds ---------------------------------------------------------

# The last column is the version of the entry.
DIM_CONFIG = [
    ("nation", "dim_replaced", "n_nationkey", "info", "n_nationkey", "c", 1),
    ("nation", "dim_base_province", "n_nationkey,n_name", "info", "n_nationkey", "u", 2),
    ("supplier", "dim_spu_info", "s_suppkey,s_name,s_nationkey", "info", "s_suppkey", "c", 1),
    ("part", "dim_sku_info", "p_partkey,p_name,p_brand", "info", "p_partkey", "u", 1),
    ("region", "dim_base_region", "r_regionkey,r_name", "info", "r_regionkey", "d", 1),
]
FACT_CONFIG = [
    ("orders", "insert", "dwd_order_insert", "o_orderkey,o_custkey,o_orderpriority", "r"),
    ("orders", "update", "dwd_order_update", "o_orderkey,o_orderstatus", "r"),
]


def dimension_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshot records of five tables, as messages decoded again."""
    at = F.lit(1_700_000_000_000)
    feeds = [
        cdc.snapshot_changes(table(spark, folder, name), "shop", name, at)
        for name in ("region", "nation", "supplier", "part", "customer")
    ]
    union = feeds[0]
    for feed in feeds[1:]:
        union = union.unionByName(feed)
    return cdc.decode_changes(to_messages(union))


def cdc_route_dim(spark: SparkSession, folder: str) -> DataFrame:
    config = cdc.current_config(
        literal_rows(
            spark, DIM_CONFIG,
            "source_table string, sink_table string, sink_columns string, sink_family string, sink_row_key string, "
            "op string, version int",
        ),
        ["source_table"], ["version"],
    )
    changes = cdc.keep_changes(dimension_feed(spark, folder), "shop")
    routed = cdc.route_dimensions(changes, config)
    return routed.select("sink_table", "sink_family", "row_key", "op", F.explode("data").alias("column", "cell"))


def order_changes(orders: DataFrame) -> DataFrame:
    """Orders as changes: open ones new, pending ones updated, finished ones deleted."""
    rows = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    image = cdc.row_as_map(rows)
    nothing = F.lit(None).cast("map<string,string>")
    op = F.when(F.col("o_orderstatus") == "O", "c").when(F.col("o_orderstatus") == "P", "u").otherwise("d")
    return rows.select(
        F.when(op != "c", image).otherwise(nothing).alias("before"),
        F.when(op != "d", image).otherwise(nothing).alias("after"),
        F.create_map(F.lit("db"), F.lit("shop"), F.lit("table"), F.lit("orders")).alias("source"),
        op.alias("op"),
        (F.col("o_orderkey") * 1000).alias("ts_ms"),
    )


def cdc_route_dwd(spark: SparkSession, folder: str) -> DataFrame:
    config = literal_rows(
        spark, FACT_CONFIG, "source_table string, source_type string, sink_table string, sink_columns string, op string"
    )
    routed = cdc.route_facts(cdc.keep_changes(order_changes(table(spark, folder, "orders")), "shop"), config)
    return routed.select(
        "sink_table", "op", F.col("data")["o_orderkey"].alias("row_key"), F.explode("data").alias("column", "cell")
    )


def cdc_image(spark: SparkSession, folder: str) -> DataFrame:
    """Row image of every change, deletes included, with mapped columns."""
    rows = cdc.drop_bootstrap(order_changes(table(spark, folder, "orders"))).withColumn("image", cdc.row_image())
    return cdc.fields(
        rows, {"o_orderkey": "id", "o_custkey": "user_id", "o_orderstatus": "status"}, "image", ["op", "ts_ms"]
    )


def _line_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Versions of order lines as dimension changes; some cells are empty, some versions delete."""
    rows = details(spark, folder)
    return rows.select(
        F.lit("dim_line").alias("sink_table"),
        F.col("id").alias("row_key"),
        F.when((F.col("line_status") == "F") & (F.col("sku_num") < 10), "d").otherwise("u").alias("op"),
        F.create_map(
            F.lit("sku_id"), F.col("sku_id").cast("string"),
            F.lit("flag"), F.when(F.col("return_flag") != "N", F.col("return_flag")).otherwise(""),
            F.lit("num"), F.when(F.col("sku_num") % 3 != 0, F.col("sku_num").cast("string")),
        ).alias("data"),
        F.struct(*ORDER).alias("seq"),
    )


def cdc_upsert(spark: SparkSession, folder: str) -> DataFrame:
    changes = _line_changes(spark, folder)
    return cdc.merge_cells(changes, ["sink_table", "row_key"], columns=["sku_id", "flag", "num"])


def cdc_upsert_columns(spark: SparkSession, folder: str) -> DataFrame:
    """The same merge with the columns known ahead, one row per key."""
    return cdc.merge_columns(_line_changes(spark, folder), ["row_key"], ["sku_id", "flag", "num"])


def cdc_delete(spark: SparkSession, folder: str) -> DataFrame:
    """Upsert view: the last version per line, lines whose last change is a delete are gone."""
    rows = _line_changes(spark, folder).select("row_key", "op", F.col("data")["sku_id"].alias("sku_id"), "seq")
    return cdc.current_rows(rows, ["row_key"], ["seq"]).drop("seq")


def dim_scan_limit(spark: SparkSession, folder: str) -> DataFrame:
    return first_rows(table(spark, folder, "part").select("p_partkey", "p_name"), 100, "p_partkey")


# ---- application log ------------------------------------------------------

def _log(spark: SparkSession, folder: str) -> DataFrame:
    return applog.clean(applog.parse_log(app_log_text(page_log(spark, folder))))


def _split(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    return applog.split_log(_log(spark, folder), keep=("seq",))[kind]


def log_split_page(spark: SparkSession, folder: str) -> DataFrame:
    return _split(spark, folder, "page").select(
        "seq", F.col("common.mid").alias("mid"), F.col("common.uid").alias("uid"), "page.page_id", "page.during_time",
        F.col("page.last_page_id").alias("last_page_id"), "ts",
    )


def log_split_err(spark: SparkSession, folder: str) -> DataFrame:
    return _split(spark, folder, "err").select("seq", F.col("err")["code"].alias("code"), "ts")


def log_split_start(spark: SparkSession, folder: str) -> DataFrame:
    return _split(spark, folder, "start").select("seq", F.col("start")["entry"].alias("entry"), "ts")


def log_split_display(spark: SparkSession, folder: str) -> DataFrame:
    return _split(spark, folder, "display").select("seq", "page.page_id", "display.pos_seq", "display.item", "ts")


def log_split_action(spark: SparkSession, folder: str) -> DataFrame:
    return _split(spark, folder, "action").select(
        "seq", "page.page_id", F.col("action")["action_id"].alias("action_id")
    )


def dirty_json(spark: SparkSession, folder: str) -> DataFrame:
    """Every seventh record is cut short; those come back as dirty text."""
    whole = F.concat(F.lit('{"ts":'), F.col("ts_ms").cast("string"), F.lit("}"))
    cut = F.concat(F.lit('{"ts":'), F.col("ts_ms").cast("string"))
    raw = page_log(spark, folder).select("seq", F.when(F.col("seq") % 7 == 0, cut).otherwise(whole).alias("value"))
    return applog.dirty(applog.parse_log(raw))


def json_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Messages, some null and some cut short, declared as a table and counted in SQL."""
    text = app_log_text(page_log(spark, folder)).select(
        F.when(F.col("seq") % 11 == 0, F.lit(None))
        .when(F.col("seq") % 7 == 0, F.substring("value", 1, 40))
        .otherwise(F.col("value"))
        .alias("value")
    )
    schema = T.StructType([
        T.StructField("common", COMMON), T.StructField("page", PAGE), T.StructField("ts", T.LongType())
    ])
    json_table(message_text(text), schema, "tideline_page_log")
    return spark.sql(
        "SELECT page.page_id AS page_id, common.ch AS ch, count(*) AS n, sum(page.during_time) AS dur "
        "FROM tideline_page_log GROUP BY 1, 2"
    )


def search_log(spark: SparkSession, folder: str) -> DataFrame:
    rows = applog.search_log(_log(spark, folder), keep=("seq",))
    return applog.with_user_and_keyword(rows)


def device_log(spark: SparkSession, folder: str) -> DataFrame:
    return applog.device_log(_log(spark, folder), keep=("seq",))


# ---- messages -------------------------------------------------------------

def snake_json(spark: SparkSession, folder: str) -> DataFrame:
    """Metric beans as messages: camel-case fields, two of them hidden."""
    rows = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("custKey"), F.col("c_name").alias("userName"),
        F.col("c_nationkey").alias("provinceId"), F.col("c_acctbal").alias("ts"),
        F.col("c_mktsegment").alias("marketSegment"),
    )
    return snake_messages(rows, hidden=["ts"])


def upsert_messages(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return to_messages(rows, key=["s_suppkey"])


QUERIES = {
    "cdc_route_dim": cdc_route_dim,
    "cdc_route_dwd": cdc_route_dwd,
    "cdc_image": cdc_image,
    "cdc_upsert": cdc_upsert,
    "cdc_upsert_columns": cdc_upsert_columns,
    "cdc_delete": cdc_delete,
    "dim_scan_limit": dim_scan_limit,
    "log_split_page": log_split_page,
    "log_split_err": log_split_err,
    "log_split_start": log_split_start,
    "log_split_display": log_split_display,
    "log_split_action": log_split_action,
    "dirty_json": dirty_json,
    "json_messages": json_messages,
    "search_log": search_log,
    "device_log": device_log,
    "snake_json": snake_json,
    "upsert_messages": upsert_messages,
}


def _cells(sink: str, source: str, key: str, columns: list[str], op: str = "'r'", extra: str = "") -> str:
    parts = [(c, f"CAST({c} AS VARCHAR)") for c in columns] + [("op", op)]
    return " UNION ALL ".join(
        f"SELECT '{sink}' AS sink_table, 'info' AS sink_family, CAST({key} AS VARCHAR) AS row_key, {op} AS op, "
        f"'{name}' AS \"column\", {value} AS cell FROM {source}"
        for name, value in parts
    )


def _fact_cells(sink: str, status: str, op: str, columns: list[str]) -> str:
    parts = [(c, f"CAST({c} AS VARCHAR)") for c in columns] + [("ts_ms", "CAST(o_orderkey * 1000 AS VARCHAR)")]
    return " UNION ALL ".join(
        f"SELECT '{sink}' AS sink_table, '{op}' AS op, CAST(o_orderkey AS VARCHAR) AS row_key, "
        f"'{name}' AS \"column\", {value} AS cell FROM orders WHERE o_orderstatus = '{status}'"
        for name, value in parts
    )


_CHG = f"""{sql.DETAILS}, chg AS (
  SELECT *, line_status = 'F' AND sku_num < 10 AS gone FROM det)"""


def _cell_sql(name: str, value: str) -> str:
    return f"""SELECT id AS row_key, '{name}' AS "column", arg_max({value}, v) FILTER (NOT gone AND {value} <> '') AS cell,
      max(v) FILTER (NOT gone AND {value} <> '') AS seen_at FROM chg GROUP BY id"""


_CELLS = f"""WITH {_CHG}, cells AS (
  {_cell_sql('sku_id', 'CAST(sku_id AS VARCHAR)')} UNION ALL
  {_cell_sql('flag', "CASE WHEN return_flag <> 'N' THEN return_flag ELSE '' END")} UNION ALL
  {_cell_sql('num', "CASE WHEN sku_num % 3 <> 0 THEN CAST(sku_num AS VARCHAR) END")}),
del AS (SELECT id, max(v) AS gone_at FROM chg WHERE gone GROUP BY id),
live AS (SELECT * FROM cells LEFT JOIN del ON row_key = id
  WHERE cell IS NOT NULL AND seen_at > coalesce(gone_at, 0))"""

ORACLE = {
    "cdc_route_dim": " UNION ALL ".join([
        _cells("dim_base_province", "nation", "n_nationkey", ["n_nationkey", "n_name"]),
        _cells("dim_spu_info", "supplier", "s_suppkey", ["s_suppkey", "s_name", "s_nationkey"]),
        _cells("dim_sku_info", "part", "p_partkey", ["p_partkey", "p_name", "p_brand"]),
    ]),
    "cdc_route_dwd": " UNION ALL ".join([
        _fact_cells("dwd_order_insert", "O", "c", ["o_orderkey", "o_custkey", "o_orderpriority"]),
        _fact_cells("dwd_order_update", "P", "u", ["o_orderkey", "o_orderstatus"]),
    ]),
    "cdc_image": """SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id,
      o_orderstatus AS status, CASE o_orderstatus WHEN 'O' THEN 'c' WHEN 'P' THEN 'u' ELSE 'd' END AS op,
      o_orderkey * 1000 AS ts_ms FROM orders""",
    "cdc_upsert": f"""{_CELLS} SELECT 'dim_line' AS sink_table, row_key, "column", cell FROM live""",
    "cdc_upsert_columns": f"""{_CELLS} SELECT row_key, max(cell) FILTER ("column" = 'sku_id') AS sku_id,
      max(cell) FILTER ("column" = 'flag') AS flag, max(cell) FILTER ("column" = 'num') AS num FROM live GROUP BY 1""",
    "cdc_delete": f"""WITH {_CHG}
    SELECT id AS row_key, 'u' AS op, CAST(sku_id AS VARCHAR) AS sku_id FROM (
      SELECT * FROM chg QUALIFY row_number() OVER (PARTITION BY id ORDER BY v DESC) = 1) WHERE NOT gone""",
    "dim_scan_limit": "SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 100",
    "log_split_page": f"""WITH {sql.LOG}
    SELECT seq, mid, uid, page_id, during_time, last_page_id, ts_ms AS ts FROM log WHERE event_type <> 'signup'""",
    "log_split_err": f"WITH {sql.LOG} SELECT seq, CAST(k AS VARCHAR) AS code, ts_ms AS ts FROM log WHERE event_type = 'error'",
    "log_split_start": f"WITH {sql.LOG} SELECT seq, ch AS entry, ts_ms AS ts FROM log WHERE event_type = 'signup'",
    "log_split_display": f"""WITH {sql.LOG}, d AS (
      SELECT *, unnest(range(1, k % 4 + 1)) AS i FROM log WHERE event_type <> 'signup')
    SELECT seq, page_id, i AS pos_seq, 'd' || i AS item, ts_ms AS ts FROM d""",
    "log_split_action": f"""WITH {sql.LOG}, d AS (
      SELECT *, unnest(range(2, k % 4 + 1)) AS i FROM log WHERE event_type <> 'signup' AND k % 4 > 1)
    SELECT seq, page_id, 'a' || i AS action_id FROM d""",
    "dirty_json": f"""WITH {sql.LOG}
    SELECT seq, '{{"ts":' || ts_ms AS value FROM log WHERE seq % 7 = 0""",
    "json_messages": f"""WITH {sql.LOG}
    SELECT page_id, ch, count(*) AS n, CAST(sum(during_time) AS BIGINT) AS dur FROM log
    WHERE seq % 11 <> 0 AND seq % 7 <> 0 GROUP BY 1, 2""",
    "search_log": f"""WITH {sql.LOG}
    SELECT seq, uid, ts_ms AS ts, split_part(os, ' ', 1) AS os, item AS keyword FROM log
    WHERE uid IS NOT NULL AND item_type = 'keyword'""",
    "device_log": f"""WITH {sql.LOG}
    SELECT seq, coalesce(uid, '-1') AS uid, ts_ms AS ts, split_part(os, ' ', 1) AS os, ar, ch, md, vc, ba,
      CASE WHEN item_type = 'keyword' THEN item END AS search_item FROM log""",
    "snake_json": """SELECT '{"cust_key":' || c_custkey || ',"user_name":"' || c_name || '","province_id":' || c_nationkey
      || ',"market_segment":"' || c_mktsegment || '"}' AS value FROM customer""",
    "upsert_messages": """SELECT '{"s_suppkey":' || s_suppkey || '}' AS key, '{"s_suppkey":' || s_suppkey
      || ',"s_name":"' || s_name || '","s_nationkey":' || s_nationkey || '}' AS value FROM supplier""",
}
