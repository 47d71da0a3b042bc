"""Records of the older layout, comment records, and tables that are written and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tideline.operators import cdc, people
from tideline.plans.feeds import FACT_CONFIG, order_changes
from tideline.plans.tables import literal_rows, table
from tideline.session import new_folder
from tideline.sinks.writers import apply_table_config, write_partitioned
from tideline.sources.readers import initial_then_changes, read_words


def legacy_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as messages of the older layout, decoded into the current one; an update names only its old status."""
    rows = table(spark, folder, "orders").where("o_orderkey IS NOT NULL")
    kind = (
        F.when(F.col("o_orderkey") % 10 == 0, "bootstrap-insert").when(F.col("o_orderstatus") == "O", "insert")
        .when(F.col("o_orderstatus") == "P", "update").otherwise("delete")
    )
    cells = F.create_map(
        F.lit("o_orderkey"), F.col("o_orderkey").cast("string"), F.lit("o_orderstatus"), F.col("o_orderstatus"),
        F.lit("o_orderpriority"), F.col("o_orderpriority"),
    )
    message = F.to_json(F.struct(
        F.when(F.col("o_orderkey") % 2 == 0, "shop").otherwise("other").alias("database"), F.lit("orders").alias("table"),
        kind.alias("type"), F.col("o_orderkey").alias("ts"), cells.alias("data"),
        F.when(kind == "update", F.create_map(F.lit("o_orderstatus"), F.lit("O"))).alias("old"),
    ))
    changes = cdc.drop_bootstrap(cdc.decode_legacy_changes(rows.select(message.alias("value")), database="shop"))
    image = cdc.row_image()
    return changes.select(
        "op", "ts_ms", F.col("source")["table"].alias("source_table"), image["o_orderkey"].alias("id"),
        F.col("before")["o_orderstatus"].alias("old_status"), F.col("after")["o_orderstatus"].alias("new_status"),
        F.col("before")["o_orderpriority"].alias("old_priority"),
    )


def comment_records(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents as comment changes, reduced to comment records; every ninth is a delete."""
    docs = table(spark, folder, "documents")
    gone = F.col("doc_id") % 9 == 0
    after = F.create_map(
        F.lit("id"), F.col("doc_id").cast("string"), F.lit("user_id"), F.col("n_chars").cast("string"),
        F.lit("order_id"), F.concat("lang", F.col("doc_id").cast("string")), F.lit("comment_txt"), F.col("text"),
        F.lit("nick_name"), F.col("source"), F.lit("appraise"), (F.col("doc_id") % 4).cast("string"),
    )
    changes = docs.select(
        F.when(~gone, after).alias("after"), F.when(gone, "d").otherwise("c").alias("op"),
        (F.col("doc_id") * 1000).alias("ts_ms"),
        F.create_map(F.lit("db"), F.lit("shop"), F.lit("table"), F.when(F.col("doc_id") % 5 == 0, "other").otherwise(
            "comment_info"), F.lit("server_id"), F.lit("1")).alias("source"),
    )
    return people.comment_records(changes).withColumn("commentTxt", F.md5("commentTxt"))


def landed_words(spark: SparkSession, folder: str) -> DataFrame:
    """The words of all part names, written as text files with repeats and blanks, read back as a word list."""
    path = new_folder(spark, "words")
    names = table(spark, folder, "part").select(F.explode(F.split("p_name", " ")).alias("word"))
    names.select(F.concat(F.lit(" "), "word", F.lit("  ")).alias("value")).write.text(path)
    return read_words(spark, path)


def landed_routes(spark: SparkSession, folder: str) -> DataFrame:
    """Routed order changes written to the folders of their targets in two batches, the second one twice."""
    path = new_folder(spark, "routes")
    config = literal_rows(
        spark, FACT_CONFIG, "source_table string, source_type string, sink_table string, sink_columns string, op string"
    )
    changes = cdc.keep_changes(order_changes(table(spark, folder, "orders")), "shop")
    routed = cdc.route_facts(changes, config).select(
        "sink_table", "op", "ts_ms", F.col("data")["o_orderkey"].alias("row_key")
    )
    for batch_id in (0, 1, 1):
        half = routed.where(F.pmod(F.col("row_key").cast("bigint"), F.lit(2)) == batch_id)
        write_partitioned(half, path, batch_id=batch_id)
    return spark.read.parquet(path).select("sink_table", "op", "ts_ms", "row_key", F.col("batch").cast("bigint").alias("batch"))


#: The snapshot of ``snapshot_then_changes`` is taken at this time.
TAKEN_MS = 700_000


def snapshot_then_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as they stand after a snapshot and the changes of them; a change older than the snapshot does not count."""
    orders = table(spark, folder, "orders")
    changes = order_changes(orders)
    snapshot = cdc.snapshot_changes(
        orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"), "shop", "orders", F.lit(TAKEN_MS))
    feed = initial_then_changes(snapshot, changes.select(*snapshot.columns))
    image = cdc.row_image()
    rows = feed.select(
        image["o_orderkey"].alias("row_key"), "op", image["o_orderstatus"].alias("status"), "seq")
    return cdc.current_rows(rows, ["row_key"], ["seq"]).drop("seq")


def landed_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """Sink tables created, filled, dropped and created anew by two versions of a configuration, then read back."""
    path, database = new_folder(spark, "catalog"), f"tideline_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{path}'")
    columns = "sink_table string, sink_columns string, op string, version int"
    first = [("dim_part", "p_partkey,p_name", "r", 1), ("dim_supplier", "s_suppkey,s_name", "c", 1), ("dim_nation", "n_nationkey,n_name", "c", 1)]
    # One stays, one gets another column and starts empty, one goes and one comes.
    second = [
        ("dim_part", "p_partkey,p_name", "c", 2), ("dim_supplier", "s_suppkey,s_name,s_nationkey", "u", 2), ("dim_nation", "", "d", 2),
        ("dim_region", "r_regionkey,r_name", "c", 2)]
    sources = {"dim_part": "part", "dim_supplier": "supplier", "dim_nation": "nation", "dim_region": "region"}

    def fill(name: str, keep: Column) -> None:
        sink = spark.table(f"{database}.{name}")
        rows = table(spark, folder, sources[name]).select(*[F.col(c).cast("string") for c in sink.columns])
        rows.where(keep).write.insertInto(f"{database}.{name}")

    odd = lambda c: F.pmod(F.col(c).cast("long"), F.lit(2)) == 1
    apply_table_config(literal_rows(spark, first, columns), database, path, ["version"])
    for name, key in (("dim_part", "p_partkey"), ("dim_supplier", "s_suppkey"), ("dim_nation", "n_nationkey")):
        fill(name, odd(key))
    apply_table_config(literal_rows(spark, second, columns), database, path, ["version"])
    for name, key in (("dim_part", "p_partkey"), ("dim_supplier", "s_suppkey")):
        fill(name, ~odd(key))
    fill("dim_region", F.lit(True))
    left = [r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").where("NOT isTemporary").collect()]
    found = None
    for name in sorted(left):
        rows = spark.table(f"{database}.{name}")
        cells = rows.select(F.lit(name).alias("sink_table"), F.concat_ws("|", *rows.columns).alias("row"))
        found = cells if found is None else found.unionByName(cells)
    return found


QUERIES = {
    "snapshot_then_changes": snapshot_then_changes,
    "landed_catalog": landed_catalog,
    "legacy_changes": legacy_changes,
    "comment_records": comment_records,
    "landed_words": landed_words,
    "landed_routes": landed_routes,
}

ORACLE = {
    "snapshot_then_changes": f"""SELECT CAST(o_orderkey AS VARCHAR) AS row_key,
      CASE WHEN o_orderkey * 1000 < {TAKEN_MS} THEN 'r' WHEN o_orderstatus = 'O' THEN 'c' ELSE 'u' END AS op, o_orderstatus AS status
    FROM orders WHERE o_orderkey * 1000 < {TAKEN_MS} OR o_orderstatus IN ('O', 'P')""",
    "landed_catalog": """SELECT 'dim_part' AS sink_table, p_partkey || '|' || p_name AS row FROM part
    UNION ALL SELECT 'dim_supplier', s_suppkey || '|' || s_name || '|' || s_nationkey FROM supplier WHERE s_suppkey % 2 = 0
    UNION ALL SELECT 'dim_region', r_regionkey || '|' || r_name FROM region""",
    "legacy_changes": """SELECT CASE o_orderstatus WHEN 'O' THEN 'c' WHEN 'P' THEN 'u' ELSE 'd' END AS op,
      o_orderkey * 1000 AS ts_ms, 'orders' AS source_table, CAST(o_orderkey AS VARCHAR) AS id,
      CASE o_orderstatus WHEN 'O' THEN NULL WHEN 'P' THEN 'O' ELSE o_orderstatus END AS old_status,
      CASE WHEN o_orderstatus IN ('O', 'P') THEN o_orderstatus END AS new_status,
      CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END AS old_priority
    FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey % 10 <> 0""",
    "comment_records": """SELECT doc_id * 1000 AS ts_ms, 'shop' AS db, 'comment_info' AS "table", '1' AS server_id, 'c' AS op,
      CAST(doc_id % 4 AS VARCHAR) AS appraise, md5(text) AS "commentTxt", source AS nick_name, CAST(NULL AS BIGINT) AS create_time,
      n_chars AS user_id, CAST(NULL AS BIGINT) AS sku_id, doc_id AS id, CAST(NULL AS BIGINT) AS spu_id, CAST(NULL AS BIGINT) AS order_id
    FROM documents WHERE doc_id % 9 <> 0 AND doc_id % 5 <> 0""",
    "landed_words": "SELECT DISTINCT unnest(string_split(p_name, ' ')) AS word FROM part",
    "landed_routes": """SELECT CASE o_orderstatus WHEN 'O' THEN 'dwd_order_insert' ELSE 'dwd_order_update' END AS sink_table,
      CASE o_orderstatus WHEN 'O' THEN 'c' ELSE 'u' END AS op, o_orderkey * 1000 AS ts_ms,
      CAST(o_orderkey AS VARCHAR) AS row_key, o_orderkey % 2 AS batch
    FROM orders WHERE o_orderstatus IN ('O', 'P')""",
}
