"""Fact tables, dictionary joins and interval joins over the sample tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tideline.functions.text import md5_key
from tideline.operators import cdc, facts, joins, keyed
from tideline.plans import sql
from tideline.plans.tables import DAY_MS, ORDER, as_double, details, literal_rows, orders, page_log, table

AMOUNTS = ["split_original_amount", "split_activity_amount", "split_coupon_amount", "split_total_amount"]


#: Keys to salt in the queries that show the salted plans; every order is joined, these ones over several salts.
HOT_ORDERS = tuple(range(64))


def order_detail_fact(spark: SparkSession, folder: str, hot: Sequence = ()) -> DataFrame:
    """Lines with their order, and the activity and coupon of a part of them."""
    lines = details(spark, folder)
    placed = orders(spark, folder).select("order_id", "user_id", "province_id")
    base = table(spark, folder, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), "l_discount", "l_tax", "l_suppkey", "l_partkey"
    )
    activities = base.where("l_discount >= 0.08").groupBy("id").agg(
        F.max("l_suppkey").alias("activity_id"), F.min("l_suppkey").alias("activity_rule_id")
    )
    coupons = base.where("l_tax >= 0.07").groupBy("id").agg(F.max("l_partkey").alias("coupon_id"))
    rows = lines.withColumn("create_ms", F.col("ts_ms")).withColumn(
        "line_amount", facts.line_amount(F.col("sku_num").cast("string"), F.col("split_original_amount").cast("string"))
    )
    joined = facts.order_details(rows, placed, activities, coupons, hot)
    return as_double(
        joined.select(
            "id", "order_id", "user_id", "sku_id", "province_id", "activity_id", "activity_rule_id", "coupon_id",
            "date_id", "create_ms", "sku_num", *AMOUNTS, "line_amount", "ts_ms",
        ),
        *AMOUNTS, "line_amount",
    )


def order_detail_hot(spark: SparkSession, folder: str) -> DataFrame:
    """As ``order_detail_fact``, with named orders salted."""
    return order_detail_fact(spark, folder, HOT_ORDERS)


def order_cancel_fact(spark: SparkSession, folder: str) -> DataFrame:
    changed = orders(spark, folder).select("order_id", "order_status", F.col("order_ms").alias("operate_ms"))
    lines = details(spark, folder).select("id", "order_id", "sku_id", "sku_num", "split_total_amount")
    return as_double(facts.cancelled_details(lines, changed, "F"), "split_total_amount")


def pay_success_fact(spark: SparkSession, folder: str) -> DataFrame:
    """Lines shipped from 30 days before to 5 days after the order; one priority has no name."""
    payments = orders(spark, folder).select(
        "order_id", "user_id", "province_id", F.substring("priority", 1, 1).alias("payment_type_code"),
        F.col("order_ms").alias("pay_ms"),
    )
    names = (
        table(spark, folder, "orders")
        .select(
            F.substring("o_orderpriority", 1, 1).alias("dic_code"),
            F.expr("substr(o_orderpriority, 3)").alias("dic_name"),
        )
        .where("dic_code <> '5'")
        .distinct()
    )
    lines = details(spark, folder).select(
        F.col("id").alias("order_detail_id"), "order_id", "sku_id", "sku_num",
        F.col("split_total_amount").alias("split_payment_amount"), F.col("ts_ms").alias("detail_ms"),
    )
    paid = facts.paid_details(payments, lines, names, 30 * DAY_MS, 5 * DAY_MS)
    return as_double(paid, "split_payment_amount")


REFUND_NAMES = [("O", "open"), ("F", "finished")] + [(str(i), f"reason {i}") for i in range(1, 7)]


def _dictionary(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return literal_rows(spark, rows, "dic_code string, dic_name string")


def refund_fact(spark: SparkSession, folder: str) -> DataFrame:
    requests = details(spark, folder).where("return_flag = 'R'").select(
        "id", "order_id", "sku_id", F.col("line_status").alias("refund_type"),
        F.col("line_number").cast("string").alias("refund_reason_type"), F.col("sku_num").alias("refund_num"),
        F.col("split_total_amount").alias("refund_amount"), "ts_ms",
    )
    placed = orders(spark, folder).select("order_id", "user_id", "province_id")
    return as_double(facts.refunds(requests, placed, _dictionary(spark, REFUND_NAMES)), "refund_amount")


def refund_pay_fact(spark: SparkSession, folder: str) -> DataFrame:
    returned = details(spark, folder).where("return_flag = 'R'")
    payments = returned.where("line_status = 'F'").select(
        "id", "order_id", "sku_id", F.col("line_number").cast("string").alias("payment_type_code"),
        (F.col("ts_ms") + 13 * 3_600_000).alias("callback_ms"), F.col("split_total_amount").alias("refund_amount"),
    )
    requests = returned.select("order_id", "sku_id", F.col("sku_num").alias("refund_num"))
    placed = orders(spark, folder).select("order_id", "user_id", "province_id")
    rows = facts.paid_refunds(payments, requests, placed, _dictionary(spark, REFUND_NAMES))
    return as_double(rows, "refund_amount")


# ---- comments -------------------------------------------------------------

RATINGS = [("1200", "good"), ("1201", "fair"), ("1202", "poor")]


def _comments(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"),
        F.pmod(F.col("doc_id"), F.lit(150)).alias("user_id"),
        F.col("doc_id").alias("order_id"),
        F.concat(F.lit("120"), (F.col("doc_id") % 5).cast("string")).alias("appraise"),
        F.col("text").alias("comment_txt"),
        (F.col("doc_id") * 1000).alias("ts_ms"),
    )


_COMMENTS = """com AS (SELECT doc_id AS id, doc_id % 150 AS user_id, doc_id AS order_id, '120' || (doc_id % 5) AS appraise,
  text AS comment_txt, doc_id * 1000 AS ts_ms FROM documents)"""


def comment_fact(spark: SparkSession, folder: str) -> DataFrame:
    """Comments within a minute of their order record, rating names under hashed keys."""
    hashed = _dictionary(spark, RATINGS).select(md5_key(F.col("dic_code")).alias("row_key"), "dic_name")
    placed = table(spark, folder, "labels").select(
        F.col("doc_id").alias("id"),
        (F.col("doc_id") * 1000 + F.pmod(F.col("doc_id"), F.lit(4)) * 25_000).alias("tm_ms"), "quality", "toxic",
    )
    rated = facts.rated_comments(_comments(spark, folder), hashed)
    return facts.comments_with_orders(rated, placed)


def comment_named(spark: SparkSession, folder: str) -> DataFrame:
    return facts.named_comments(_comments(spark, folder), _dictionary(spark, RATINGS))


# ---- cart -----------------------------------------------------------------

def cart_delta(spark: SparkSession, folder: str) -> DataFrame:
    """Cart changes made of successive line quantities of an order."""
    lines = details(spark, folder).select("order_id", "sku_num", *ORDER)
    before = keyed.neighbor(lines, ["order_id"], ORDER, ["sku_num"], "old", "ts_ms")
    first = F.when(F.col("order_id") % 2 == 0, "c").otherwise("r")
    num = F.col("sku_num").cast("string")
    changes = before.select(
        F.when(F.col("old").isNotNull(), F.create_map(F.lit("sku_num"), F.col("old.sku_num").cast("string"))).alias(
            "before"
        ),
        F.create_map(
            F.lit("id"), F.col("order_id").cast("string"), F.lit("user_id"), F.col("supplier_id").cast("string"),
            F.lit("sku_id"), F.col("sku_id").cast("string"), F.lit("sku_num"), num,
        ).alias("after"),
        F.create_map(F.lit("table"), F.lit("cart_info")).alias("source"),
        F.when(F.col("old").isNull(), first).otherwise("u").alias("op"),
        "ts_ms",
    )
    return facts.cart_adds(cdc.of_table(changes, "cart_info"))


# ---- interval joins -------------------------------------------------------

def _events(spark: SparkSession, folder: str, kind: str, prefix: str, *columns: str) -> DataFrame:
    rows = page_log(spark, folder).where(F.col("event_type") == kind)
    return rows.select("user_id", *[F.col(c).alias(prefix + c) for c in columns])


def interval_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Users and body measures within an hour; on equal names the measure wins."""
    users = _events(spark, folder, "signup", "", "seq", "k", "vc", "ts_ms")
    body = _events(spark, folder, "click", "b_", "seq", "k", "during_time", "ts_ms")
    pairs = joins.interval_join(users, body, ["user_id"], "ts_ms", "b_ts_ms", -3_600_000, 3_600_000, ["seq"])
    left = ["user_id", "seq", "k", "vc", "ts_ms"]
    merged = joins.merge_right_wins(
        pairs.withColumn("l_seq", F.col("seq")), [*left, "l_seq"], ["seq", "k", "during_time", "ts_ms"], "b_"
    )
    return merged


def interval_minute(spark: SparkSession, folder: str) -> DataFrame:
    """As the reference interval: 60 seconds around."""
    users = _events(spark, folder, "signup", "a_", "seq", "ts_ms")
    body = page_log(spark, folder).where("event_type <> 'signup'").select(
        "user_id", F.col("seq").alias("b_seq"), F.col("ts_ms").alias("b_ts_ms")
    )
    return joins.interval_join(users, body, ["user_id"], "a_ts_ms", "b_ts_ms", -60_000, 60_000, ["a_seq"])


def interval_order(spark: SparkSession, folder: str, hot: Sequence = ()) -> DataFrame:
    """Lines and their order when both changed within 60 days of each other."""
    lines = details(spark, folder).select("id", "order_id", "sku_id", "sku_num", F.col("ts_ms").alias("detail_ms"))
    placed = orders(spark, folder).select("order_id", "user_id", "total_amount", F.col("order_ms").alias("ts_ms"))
    return joins.interval_join(lines, placed, ["order_id"], "detail_ms", "ts_ms", -60 * DAY_MS, 60 * DAY_MS, ["id", "sku_id"], hot)


def interval_hot(spark: SparkSession, folder: str) -> DataFrame:
    """As ``interval_order``, with named orders salted."""
    return interval_order(spark, folder, HOT_ORDERS)


def interval_nested(spark: SparkSession, folder: str) -> DataFrame:
    """Profile and order within 30 minutes, nested as two records."""
    users = _events(spark, folder, "view", "u_", "seq", "vc", "ts_ms")
    bought = _events(spark, folder, "purchase", "o_", "seq", "item", "during_time", "ts_ms")
    pairs = joins.interval_join(users, bought, ["user_id"], "u_ts_ms", "o_ts_ms", -1_800_000, 1_800_000, ["u_seq"])
    record = joins.nest(pairs, {
        "user": ["user_id", "u_seq", "u_vc", "u_ts_ms"], "Age": ["o_seq", "o_item", "o_during_time", "o_ts_ms"]
    })
    return record.select("user.*", "Age.*")


def interval_search(spark: SparkSession, folder: str) -> DataFrame:
    """Order records and searches of the user within an hour."""
    bought = _events(spark, folder, "purchase", "o_", "seq", "ts_ms")
    searched = page_log(spark, folder).where("item_type = 'keyword'").select(
        "user_id", F.col("seq").alias("s_seq"), F.col("item").alias("keyword"), F.col("ts_ms").alias("s_ts_ms"), "os"
    )
    return joins.interval_join(bought, searched, ["user_id"], "o_ts_ms", "s_ts_ms", -3_600_000, 3_600_000, ["o_seq"])


def interval_category(spark: SparkSession, folder: str) -> DataFrame:
    """Searches and changes of the category dictionary within three days; one change per word and day."""
    searched = page_log(spark, folder).where("item_type = 'keyword'").select(
        F.col("item").alias("keyword"), "seq", "ts_ms"
    )
    changed = (
        page_log(spark, folder)
        .where("item_type = 'keyword' AND event_type = 'error'")
        .groupBy(F.col("item").alias("keyword"), F.to_date("ts").alias("d"))
        .agg(F.min("ts_ms").alias("dic_ts_ms"), F.min("ch").alias("search_category"))
        .drop("d")
    )
    return joins.interval_join(searched, changed, ["keyword"], "ts_ms", "dic_ts_ms", -3 * DAY_MS, 3 * DAY_MS, ["seq"])


# ---- lookups --------------------------------------------------------------

def dim_lookup_inner(spark: SparkSession, folder: str) -> DataFrame:
    """Blocking lookup chain: every step must match, supplier 0 to 4 and their nation."""
    lines = details(spark, folder).select("id", "order_id", "supplier_id", "ts_ms")
    supplier = table(spark, folder, "supplier").where("s_suppkey < 5")
    return joins.lookup_chain(lines, [
        (supplier, "supplier_id", "s_suppkey", {"s_name": "spu_name", "s_nationkey": "nation_id"}),
        (table(spark, folder, "nation"), "nation_id", "n_nationkey", {"n_name": "nation_name"}),
    ], "inner")


def dim_lookup_misses(spark: SparkSession, folder: str) -> DataFrame:
    """What the chain above dropped at its first step, per supplier."""
    lines = details(spark, folder).select("supplier_id")
    supplier = table(spark, folder, "supplier").where("s_suppkey < 5")
    return joins.missing_keys(lines, supplier, "supplier_id", "s_suppkey")


def _member(spark: SparkSession, folder: str, negate: bool) -> DataFrame:
    words = table(spark, folder, "supplier").where("s_nationkey < 5").select(F.col("s_suppkey").alias("word"))
    lines = details(spark, folder).select("id", "supplier_id", "ts_ms")
    return joins.members(lines, words, "supplier_id", "word", negate)


def member_batch(spark: SparkSession, folder: str) -> DataFrame:
    return _member(spark, folder, False)


def member_missing(spark: SparkSession, folder: str) -> DataFrame:
    return _member(spark, folder, True)


QUERIES = {
    "order_detail_fact": order_detail_fact,
    "order_detail_hot": order_detail_hot,
    "order_cancel_fact": order_cancel_fact,
    "pay_success_fact": pay_success_fact,
    "refund_fact": refund_fact,
    "refund_pay_fact": refund_pay_fact,
    "comment_fact": comment_fact,
    "comment_named": comment_named,
    "cart_delta": cart_delta,
    "interval_profile": interval_profile,
    "interval_minute": interval_minute,
    "interval_order": interval_order,
    "interval_hot": interval_hot,
    "interval_nested": interval_nested,
    "interval_search": interval_search,
    "interval_category": interval_category,
    "dim_lookup_inner": dim_lookup_inner,
    "dim_lookup_misses": dim_lookup_misses,
    "member_batch": member_batch,
    "member_missing": member_missing,
}

_DIC = sql.values(REFUND_NAMES, "dic", "dic_code, dic_name")
_RATE = sql.values(RATINGS, "dic", "dic_code, dic_name")
_DATE = "strftime(make_timestamp({0} * 1000), '%Y-%m-%d')"
_TIME = "strftime(make_timestamp({0} * 1000), '%Y-%m-%d %H:%M:%S')"

ORACLE = {
    "order_detail_fact": f"""WITH {sql.DETAILS}, {sql.ORDERS},
    act AS (SELECT l_orderkey || '-' || l_linenumber AS id, max(l_suppkey) AS activity_id,
      min(l_suppkey) AS activity_rule_id FROM lineitem WHERE l_discount >= 0.08 GROUP BY 1),
    cou AS (SELECT l_orderkey || '-' || l_linenumber AS id, max(l_partkey) AS coupon_id
      FROM lineitem WHERE l_tax >= 0.07 GROUP BY 1)
    SELECT det.id, det.order_id, user_id, sku_id, province_id, activity_id, activity_rule_id, coupon_id,
      {_DATE.format('ts_ms')} AS date_id, ts_ms AS create_ms, sku_num,
      CAST(split_original_amount AS DOUBLE) AS split_original_amount,
      CAST(split_activity_amount AS DOUBLE) AS split_activity_amount,
      CAST(split_coupon_amount AS DOUBLE) AS split_coupon_amount,
      CAST(split_total_amount AS DOUBLE) AS split_total_amount,
      CAST(sku_num * split_original_amount AS DOUBLE) AS line_amount, ts_ms
    FROM det JOIN ord ON det.order_id = ord.order_id LEFT JOIN act ON det.id = act.id LEFT JOIN cou ON det.id = cou.id""",
    "order_cancel_fact": f"""WITH {sql.DETAILS}, {sql.ORDERS}
    SELECT id, order_id, sku_id, sku_num, CAST(split_total_amount AS DOUBLE) AS split_total_amount,
      {_DATE.format('order_ms')} AS order_cancel_date_id, {_TIME.format('order_ms')} AS cancel_time
    FROM det JOIN ord USING (order_id) WHERE order_status = 'F'""",
    "pay_success_fact": f"""WITH {sql.DETAILS}, {sql.ORDERS}
    SELECT det.id AS order_detail_id, order_id, sku_id, sku_num, CAST(split_total_amount AS DOUBLE) AS
      split_payment_amount, ts_ms AS detail_ms, user_id, province_id, left(priority, 1) AS payment_type_code,
      substr(priority, 3) AS payment_type_name, order_ms AS pay_ms
    FROM ord JOIN det USING (order_id)
    WHERE ts_ms BETWEEN order_ms - {30 * DAY_MS} AND order_ms + {5 * DAY_MS} AND left(priority, 1) <> '5'""",
    "refund_fact": f"""WITH {sql.DETAILS}, {sql.ORDERS}, {_DIC}
    SELECT id, order_id, sku_id, line_status AS refund_type, d1.dic_name AS refund_type_name,
      CAST(line_number AS VARCHAR) AS refund_reason_type, d2.dic_name AS refund_reason_type_name,
      sku_num AS refund_num, CAST(split_total_amount AS DOUBLE) AS refund_amount, ts_ms, user_id, province_id
    FROM det JOIN ord USING (order_id) JOIN dic d1 ON line_status = d1.dic_code
      JOIN dic d2 ON CAST(line_number AS VARCHAR) = d2.dic_code WHERE return_flag = 'R'""",
    "refund_pay_fact": f"""WITH {sql.DETAILS}, {sql.ORDERS}, {_DIC}, ret AS (SELECT * FROM det WHERE return_flag = 'R')
    SELECT p.id, p.order_id, p.sku_id, CAST(p.line_number AS VARCHAR) AS payment_type_code,
      dic_name AS payment_type_name, p.ts_ms + 46800000 AS callback_ms,
      CAST(p.split_total_amount AS DOUBLE) AS refund_amount, r.sku_num AS refund_num, user_id, province_id,
      {_DATE.format('(p.ts_ms + 46800000)')} AS date_id, {_TIME.format('(p.ts_ms + 46800000)')} AS callback_time
    FROM ret p JOIN ret r ON p.order_id = r.order_id AND p.sku_id = r.sku_id JOIN ord ON p.order_id = ord.order_id
      JOIN dic ON CAST(p.line_number AS VARCHAR) = dic_code WHERE p.line_status = 'F'""",
    "comment_fact": f"""WITH {_COMMENTS}, {_RATE},
    info AS (SELECT doc_id, doc_id * 1000 + (doc_id % 4) * 25000 AS tm_ms, quality, toxic FROM labels)
    SELECT com.*, coalesce(dic_name, 'N/A') AS dic_name, doc_id AS info_id, tm_ms AS info_tm_ms,
      quality AS info_quality, toxic AS info_toxic, strftime(make_timestamp(ts_ms * 1000), '%Y%m%d') AS ds
    FROM com JOIN info ON com.order_id = doc_id AND tm_ms - ts_ms BETWEEN -60000 AND 60000
      LEFT JOIN dic ON md5(appraise) = md5(dic_code)""",
    "comment_named": f"""WITH {_COMMENTS}, {_RATE}
    SELECT com.*, dic_name AS appraise_name FROM com LEFT JOIN dic ON appraise = dic_code""",
    "cart_delta": f"""WITH {sql.DETAILS}, c AS (
      SELECT *, lag(sku_num) OVER (PARTITION BY order_id ORDER BY v) AS old FROM det)
    SELECT CAST(order_id AS VARCHAR) AS id, CAST(supplier_id AS VARCHAR) AS user_id, CAST(sku_id AS VARCHAR) AS sku_id,
      CASE WHEN old IS NULL AND order_id % 2 = 0 THEN CAST(sku_num AS VARCHAR)
        ELSE CAST(sku_num - old AS VARCHAR) END AS sku_num, ts_ms
    FROM c WHERE old IS NULL OR sku_num > old""",
    "interval_profile": f"""WITH {sql.LOG}
    SELECT a.user_id, a.vc, a.seq AS l_seq, b.seq, b.k, b.during_time, b.ts_ms FROM log a JOIN log b
      ON a.user_id = b.user_id AND b.ts_ms - a.ts_ms BETWEEN -3600000 AND 3600000
    WHERE a.event_type = 'signup' AND b.event_type = 'click'""",
    "interval_minute": f"""WITH {sql.LOG}
    SELECT a.user_id, a.seq AS a_seq, a.ts_ms AS a_ts_ms, b.seq AS b_seq, b.ts_ms AS b_ts_ms FROM log a JOIN log b
      ON a.user_id = b.user_id AND b.ts_ms - a.ts_ms BETWEEN -60000 AND 60000
    WHERE a.event_type = 'signup' AND b.event_type <> 'signup'""",
    "interval_order": f"""WITH {sql.DETAILS}, {sql.ORDERS}
    SELECT id, order_id, sku_id, sku_num, det.ts_ms AS detail_ms, user_id, total_amount, order_ms AS ts_ms
    FROM det JOIN ord USING (order_id) WHERE abs(order_ms - det.ts_ms) <= {60 * DAY_MS}""",
    "interval_nested": f"""WITH {sql.LOG}
    SELECT a.user_id, a.seq AS u_seq, a.vc AS u_vc, a.ts_ms AS u_ts_ms, b.seq AS o_seq, b.item AS o_item,
      b.during_time AS o_during_time, b.ts_ms AS o_ts_ms FROM log a JOIN log b
      ON a.user_id = b.user_id AND b.ts_ms - a.ts_ms BETWEEN -1800000 AND 1800000
    WHERE a.event_type = 'view' AND b.event_type = 'purchase'""",
    "interval_search": f"""WITH {sql.LOG}
    SELECT a.user_id, a.seq AS o_seq, a.ts_ms AS o_ts_ms, b.seq AS s_seq, b.item AS keyword, b.ts_ms AS s_ts_ms, b.os
    FROM log a JOIN log b ON a.user_id = b.user_id AND b.ts_ms - a.ts_ms BETWEEN -3600000 AND 3600000
    WHERE a.event_type = 'purchase' AND b.item_type = 'keyword'""",
    "interval_category": f"""WITH {sql.LOG}, s AS (SELECT * FROM log WHERE item_type = 'keyword'),
    dic AS (SELECT item, min(ts_ms) AS dic_ts_ms, min(ch) AS search_category FROM s WHERE event_type = 'error'
      GROUP BY item, d)
    SELECT s.item AS keyword, seq, ts_ms, dic_ts_ms, search_category FROM s JOIN dic
      ON s.item = dic.item AND abs(dic_ts_ms - ts_ms) <= {3 * DAY_MS}""",
    "dim_lookup_inner": f"""WITH {sql.DETAILS}
    SELECT id, order_id, supplier_id, ts_ms, s_name AS spu_name, s_nationkey AS nation_id, n_name AS nation_name
    FROM det JOIN supplier ON supplier_id = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey < 5""",
    "dim_lookup_misses": """SELECT l_suppkey AS supplier_id, count(*) AS rows FROM lineitem
    WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey < 5) GROUP BY 1""",
    "member_batch": f"""WITH {sql.DETAILS} SELECT id, supplier_id, ts_ms FROM det
    WHERE supplier_id IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 5)""",
    "member_missing": f"""WITH {sql.DETAILS} SELECT id, supplier_id, ts_ms FROM det
    WHERE supplier_id NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 5)""",
}

ORACLE["order_detail_hot"] = ORACLE["order_detail_fact"]
ORACLE["interval_hot"] = ORACLE["interval_order"]
