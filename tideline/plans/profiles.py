"""User labels, scores, moderation and scalar conversions over the sample tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tideline.functions import labels, times
from tideline.functions.text import first_token, joined_set, last_token, md5_key, negate
from tideline.operators import joins, moderation, people as people_ops
from tideline.plans import label_sql, sql
from tideline.plans.tables import DAY_MS, literal_rows, page_log, pick, table

AS_OF = "2025-05-15"
BANNED = ["hat", "quelle", "the", "tion", "zzzz"]
# Search category of each first-level category, which the regions stand for.
REGION_TOPICS = [
    ("AFRICA", "时尚与潮流"), ("AMERICA", "性价比"), ("ASIA", "健康与养生"), ("EUROPE", "科技与数码"),
]


# ---- moderation -----------------------------------------------------------

def _messages(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as comments; every fifth ends in a banned word after a comma."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    word = pick(F.col("doc_id") % len(BANNED), BANNED)
    return docs.select(
        "doc_id", F.when(F.col("doc_id") % 5 == 1, F.concat("text", F.lit(","), word)).otherwise(F.col("text")).alias("msg")
    )


def moderation_level(spark: SparkSession, folder: str) -> DataFrame:
    return moderation.moderate(_messages(spark, folder), "msg", BANNED).drop("msg")


def moderation_join(spark: SparkSession, folder: str) -> DataFrame:
    """The same check against a dictionary table: the words of the part names."""
    words = table(spark, folder, "part").select(F.explode(F.split("p_name", " ")).alias("word")).distinct()
    return moderation.moderate_by_join(_messages(spark, folder), "doc_id", "msg", words).drop("msg")


# ---- labels ---------------------------------------------------------------

def user_base_labels(spark: SparkSession, folder: str) -> DataFrame:
    users = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), (F.lit(-7305) + F.pmod(F.col("c_custkey") * 13, F.lit(27000))).alias("birthday")
    )
    return labels.user_labels(users, "birthday", F.lit(AS_OF).cast("date")).withColumn(
        "zodiac_classic", labels.zodiac(F.to_date("birthday"), "classic")
    )


def order_bands(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        (times.to_millis(F.col("o_orderdate")) + (F.col("o_orderkey") % 24) * 3_600_000).alias("create_ms"),
        (F.col("o_totalprice") / 100).alias("amount"),
    )
    return labels.order_bands(rows, "create_ms", "amount").withColumn(
        "time_early", labels.day_part(F.col("create_ms"), "early", "UTC")
    ).withColumn("price_range", labels.price_band(F.col("amount"), "range"))


_DIMS = {
    "category1_name": ("category", 3), "tm_name": ("brand", 5), "price_sensitive": ("price", 1),
    "time_period": ("time", 7), "keyword_type": ("keyword", 11), "os": ("os", 2),
}
_GROUPS = [*labels.AGE_GROUPS, "0-17"]


def _value_list(dim: str) -> list[str]:
    """All values of a dimension and one unknown."""
    return [v for vs, _ in labels.RAW_SCORES[dim] for v in vs] + ["other"]


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"))
    chosen = {
        name: pick((F.floor(F.col("id") / step)) % len(_value_list(dim)), _value_list(dim))
        for name, (dim, step) in _DIMS.items()
    }
    return labels.age_scores(
        rows.select("id", pick(F.col("id") % len(_GROUPS), _GROUPS).alias("age_group"),
                    *[c.alias(n) for n, c in chosen.items()])
    )


def age_score(spark: SparkSession, folder: str) -> DataFrame:
    rows = _scored(spark, folder)
    return rows.withColumns({c: F.col(c).cast("double") for c in labels.SCORE_COLUMNS.values()})


def age_total(spark: SparkSession, folder: str) -> DataFrame:
    """Totals of the youngest group, the one the label job keeps."""
    rows = labels.total_score(_scored(spark, folder).where(F.col("age_group") == labels.AGE_GROUPS[0]))
    return rows.select("id", F.col("total_score").cast("double").alias("total_score"), "new_age_group")


def category_levels(spark: SparkSession, folder: str) -> DataFrame:
    """Three category levels in one row: nation, its region, and the region again as first level."""
    third = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("b3name"), F.col("n_regionkey").alias("category2_id")
    )
    second = table(spark, folder, "region").select(
        F.col("r_regionkey").alias("category2_id"), F.col("r_name").alias("b2name"),
        F.col("r_regionkey").alias("category1_id"),
    )
    first = table(spark, folder, "region").select(
        F.col("r_regionkey").alias("category1_id"), F.col("r_name").alias("b1name")
    )
    return third.join(second, "category2_id").join(first, "category1_id").select("id", "b3name", "b2name", "b1name")


def device_search_score(spark: SparkSession, folder: str) -> DataFrame:
    """Device and search scores of each page view; the search term leads to a category and its topic."""
    pages = page_log(spark, folder).select(
        "seq", "uid", first_token(F.col("os")).alias("os"),
        F.when(F.col("item_type") == "keyword", F.col("item")).alias("search_item"),
    )
    levels = category_levels(spark, folder).dropDuplicates(["b3name"])
    topics = literal_rows(spark, REGION_TOPICS, "category_name string, search_category string")
    named = joins.lookup_chain(pages, [
        (levels, "search_item", "b3name", {"b1name": "b1_category"}),
        (topics, "b1_category", "category_name", {"search_category": "search_category"}),
    ])
    return labels.search_scores(labels.device_scores(named))


def people(pages: DataFrame) -> DataFrame:
    """Sign-ups as profiles; ages follow from the user number."""
    return pages.where("event_type = 'signup'").select(
        F.col("user_id").alias("uid"), F.col("seq").alias("profile_seq"), F.concat("mid", "vc").alias("login_name"),
        "ts_ms", labels.age_group(F.lit(15) + F.pmod("user_id", F.lit(40))).alias("age_group"),
    )


def purchases(pages: DataFrame) -> DataFrame:
    """Purchases as orders."""
    return pages.where("event_type = 'purchase'").select(
        F.col("user_id").alias("uid"), F.col("seq").alias("order_id"), F.col("ts_ms").alias("order_ms"),
        F.col("ts_ms").alias("create_ms"), F.col("during_time").cast("double").alias("original_total_amount"),
        pick(F.col("k") % len(_value_list("category")), _value_list("category")).alias("category1_name"),
        pick(F.col("k") % len(_value_list("brand")), _value_list("brand")).alias("tm_name"),
    )


def searches(pages: DataFrame) -> DataFrame:
    return pages.where("item_type = 'keyword'").select(
        F.col("user_id").alias("uid"), F.col("seq").alias("search_seq"), F.col("ts_ms").alias("search_ms"),
        first_token(F.col("os")).alias("os"), F.col("item").alias("keyword"),
    )


def topics(pages: DataFrame) -> DataFrame:
    """One dictionary change per word and day."""
    return (
        pages.where("item_type = 'keyword' AND event_type = 'error'")
        .groupBy(F.col("item").alias("keyword"), F.to_date("ts").alias("d"))
        .agg(F.min("ts_ms").alias("topic_ms"), F.min("k").alias("k"))
        .select("keyword", "topic_ms", pick(F.col("k") % 7, _value_list("keyword")).alias("keyword_type"))
    )


def label_columns(scored: DataFrame) -> DataFrame:
    return scored.select(
        "profile_seq", "order_id", "search_seq", "topic_ms", "age_group", "time_period", "price_sensitive",
        F.col("total_score").cast("double").alias("total_score"), "new_age_group",
    )


def age_label_job(spark: SparkSession, folder: str) -> DataFrame:
    """The label chain on events: sign-ups are profiles, purchases orders, searches searches.

    The intervals are wide enough for the sample: three hours around a profile
    and twelve around an order.
    """
    pages = page_log(spark, folder)
    return label_columns(people_ops.age_label_job(
        people(pages), purchases(pages), searches(pages), topics(pages),
        profile_ms=3 * 3_600_000, search_ms=12 * 3_600_000, topic_ms=DAY_MS,
    ))


# ---- scalar functions -----------------------------------------------------

def time_convert(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders")
    ms = times.to_millis(F.col("o_orderdate")) + (F.col("o_orderkey") % 24) * 3_600_000
    text = F.col("o_orderpriority")
    return rows.select(
        F.col("o_orderkey").alias("id"),
        times.date_text(times.from_millis(ms)).alias("d"),
        times.datetime_text(times.from_millis(ms)).alias("dt"),
        times.datetime_text(times.from_millis(ms), "Asia/Shanghai").alias("dt_local"),
        times.compact_date_text(times.from_millis(ms)).alias("ds"),
        times.parse_millis(times.datetime_text(times.from_millis(ms))).alias("back_ms"),
        times.parse_millis(times.datetime_text(times.from_millis(ms)), "Asia/Shanghai").alias("back_local_ms"),
        times.to_millis(times.from_seconds(F.floor(ms / 1000))).alias("sec_ms"),
        times.to_millis(times.from_millis(ms) - F.expr("INTERVAL 30 MINUTES")).alias("minus_ms"),
        text.try_cast("int").alias("not_a_number"),
        F.substring(text, 1, 1).try_cast("int").alias("number"),
        negate(F.substring(text, 1, 1)).cast("double").alias("negated"),
        md5_key(text).alias("hashed"),
        first_token(text, "-").alias("head"),
        last_token(text, "-").alias("tail"),
        joined_set(F.split(text, "")).alias("letters"),
        F.round(F.col("o_totalprice") / 7000, 3).alias("rounded"),
    )


QUERIES = {
    "moderation": moderation_level,
    "moderation_join": moderation_join,
    "user_base_labels": user_base_labels,
    "order_bands": order_bands,
    "age_score": age_score,
    "age_total": age_total,
    "age_label_job": age_label_job,
    "category_levels": category_levels,
    "device_search_score": device_search_score,
    "time_convert": time_convert,
}

# ---- comparison SQL -------------------------------------------------------

_MSG = f"""msg AS (SELECT doc_id, CASE WHEN doc_id % 5 = 1 THEN text || ',' ||
  {BANNED}[doc_id % {len(BANNED)} + 1] ELSE text END AS msg FROM documents),
chk AS (SELECT doc_id, msg, string_split(regexp_replace(msg, ',+\\z', ''), ',')[-1] AS last_word FROM msg)"""


def _grade(hit: str, found: str) -> str:
    return f"""CASE WHEN {hit} THEN 1 ELSE 0 END AS is_violation,
      CASE WHEN {hit} THEN 'P0' WHEN {found} <> '' THEN 'P1' ELSE '' END AS violation_grade,
      CASE WHEN {hit} THEN last_word ELSE {found} END AS violation_msg"""


_CHOICE = "SELECT o_orderkey AS id, " + f"{_GROUPS}[o_orderkey % {len(_GROUPS)} + 1] AS age_group, " + ", ".join(
    f"{_value_list(dim)}[(o_orderkey // {step}) % {len(_value_list(dim))} + 1] AS {name}"
    for name, (dim, step) in _DIMS.items()
) + " FROM orders"

_AGE_SQL = f"""{label_sql.SCORES}, o AS ({_CHOICE}), scored AS (SELECT o.*, """ + ", ".join(
    (f"CASE WHEN age_group = '0-17' THEN -1 ELSE s_{dim}.pts END" if dim == "category" else f"s_{dim}.pts")
    + f" AS {labels.SCORE_COLUMNS[dim]}"
    for dim, _ in _DIMS.values()
) + " FROM o " + " ".join(
    f"LEFT JOIN score s_{dim} ON s_{dim}.dim = '{dim}' AND s_{dim}.val = o.{name} AND s_{dim}.grp = age_group"
    for name, (dim, _) in _DIMS.items()
) + ")"

_TOTAL = " + ".join(f"coalesce({c}, 0)" for c in labels.SCORE_COLUMNS.values())


_MS = "(epoch_us(o_orderdate) // 1000 + (o_orderkey % 24) * 3600000)"


def _fmt(ms: str, pattern: str) -> str:
    return f"strftime(make_timestamp({ms} * 1000), '{pattern}')"


ORACLE = {
    "moderation": f"""WITH {_MSG}, f AS (SELECT *, array_to_string([w FOR w IN {BANNED} IF contains(msg, w)], ', ')
      AS found FROM chk) SELECT doc_id, {_grade(f'last_word IN {tuple(BANNED)}', 'found')} FROM f""",
    "moderation_join": f"""WITH {_MSG}, words AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS w FROM part),
    hits AS (SELECT doc_id, string_agg(w, ', ' ORDER BY w) AS found FROM chk JOIN words ON contains(msg, w) GROUP BY 1),
    f AS (SELECT chk.*, coalesce(found, '') AS found, last_word IN (SELECT w FROM words) AS hit
      FROM chk LEFT JOIN hits USING (doc_id))
    SELECT doc_id, {_grade('hit', 'found')} FROM f""",
    "user_base_labels": f"""WITH u AS (SELECT c_custkey AS id,
      CAST(DATE '1970-01-01' + CAST(-7305 + (c_custkey * 13) % 27000 AS INTEGER) AS DATE) AS b FROM customer),
    a AS (SELECT *, month(b) * 100 + day(b) AS md, date_sub('year', b, DATE '{AS_OF}') AS age,
      (year(b) // 10) * 10 AS decade_n FROM u)
    SELECT id, strftime(b, '%Y-%m-%d') AS birthday,
      {label_sql.SIGN} AS zodiac_sign,
      {label_sql.CLASSIC_SIGN} AS zodiac_classic,
      decade_n AS birth_decade, decade_n || '年代' AS decade, age,
      {label_sql.AGE_GROUP} AS age_group FROM a""",
    "order_bands": f"""WITH o AS (SELECT o_orderkey AS id, {_MS} AS create_ms, o_totalprice / 100 AS amount FROM orders),
    h AS (SELECT *, (create_ms // 3600000 + 8) % 24 AS h8, (create_ms // 3600000) % 24 AS h0 FROM o)
    SELECT id, create_ms, amount, {label_sql.DAY_PART.format('h8')} AS time_period,
      CASE WHEN amount < 1000 THEN '低价商品' WHEN amount <= 4000 THEN '中价商品' ELSE '高价商品' END AS price_sensitive,
      {label_sql.EARLY_PART.format('h0')} AS time_early,
      CASE WHEN amount < 1000 THEN '低价商品' WHEN amount <= 4000 THEN '中间商品' ELSE '高价商品' END AS price_range
    FROM h""",
    "age_score": f"WITH {_AGE_SQL} SELECT * FROM scored",
    "age_total": f"""WITH {_AGE_SQL}, t AS (SELECT id, round({_TOTAL}, 3) AS total_score FROM scored
      WHERE age_group = '18-24') SELECT id, total_score, """
    + label_sql.TOTAL_GROUP + " AS new_age_group FROM t",
    "age_label_job": f"""WITH {sql.LOG}, {label_sql.SCORES},
    p AS (SELECT user_id AS uid, seq, ts_ms FROM log WHERE event_type = 'signup' AND 15 + user_id % 40 BETWEEN 18 AND 24),
    o AS (SELECT user_id AS uid, seq, ts_ms, CAST(during_time AS DOUBLE) AS amount,
      {_value_list('category')}[k % {len(_value_list('category'))} + 1] AS cat,
      {_value_list('brand')}[k % {len(_value_list('brand'))} + 1] AS brand,
      (ts_ms // 3600000 + 8) % 24 AS h FROM log WHERE event_type = 'purchase'),
    s AS (SELECT user_id AS uid, seq, ts_ms, split_part(os, ' ', 1) AS os, item FROM log WHERE item_type = 'keyword'),
    t AS (SELECT item, min(ts_ms) AS topic_ms, {_value_list('keyword')}[min(k) % 7 + 1] AS topic FROM log
      WHERE item_type = 'keyword' AND event_type = 'error' GROUP BY item, d),
    j AS (SELECT p.seq AS profile_seq, o.seq AS order_id, s.seq AS search_seq, topic_ms, cat, brand, os, topic,
      {label_sql.DAY_PART.format('h')} AS time_period,
      CASE WHEN amount < 1000 THEN '低价商品' WHEN amount <= 4000 THEN '中价商品' ELSE '高价商品' END AS price_sensitive
      FROM p JOIN o ON p.uid = o.uid AND abs(p.ts_ms - o.ts_ms) <= 10800000
      JOIN s ON s.uid = o.uid AND abs(s.ts_ms - o.ts_ms) <= 43200000
      JOIN t ON t.item = s.item AND abs(topic_ms - o.ts_ms) <= {DAY_MS}),
    r AS (SELECT j.*, (SELECT round(coalesce(sum(pts), 0), 3) FROM score WHERE grp = '18-24' AND (
      (dim = 'category' AND val = cat) OR (dim = 'brand' AND val = brand) OR (dim = 'os' AND val = os)
      OR (dim = 'keyword' AND val = topic) OR (dim = 'time' AND val = time_period)
      OR (dim = 'price' AND val = price_sensitive))) AS total_score FROM j)
    SELECT profile_seq, order_id, search_seq, topic_ms, '18-24' AS age_group, time_period, price_sensitive, total_score,
    """ + label_sql.TOTAL_GROUP + " AS new_age_group FROM r",
    "category_levels": """SELECT n_nationkey AS id, n_name AS b3name, r2.r_name AS b2name, r1.r_name AS b1name
    FROM nation JOIN region r2 ON n_regionkey = r2.r_regionkey JOIN region r1 ON r2.r_regionkey = r1.r_regionkey""",
    "device_search_score": f"""WITH {sql.LOG}, {sql.values(REGION_TOPICS, 'topic', 'category_name, search_category')},
    p AS (SELECT seq, uid, split_part(os, ' ', 1) AS os, CASE WHEN item_type = 'keyword' THEN item END AS search_item
      FROM log)
    SELECT seq, uid, os, search_item, r_name AS b1_category, search_category, os AS judge_os,
      {label_sql.DEVICE_SIX},
      {label_sql.SEARCH_SIX}
    FROM p LEFT JOIN nation ON search_item = n_name LEFT JOIN region ON n_regionkey = r_regionkey
      LEFT JOIN topic ON r_name = category_name""",
    "time_convert": f"""WITH o AS (SELECT *, {_MS} AS ms FROM orders)
    SELECT o_orderkey AS id, {_fmt('ms', '%Y-%m-%d')} AS d, {_fmt('ms', '%Y-%m-%d %H:%M:%S')} AS dt,
      {_fmt('(ms + 28800000)', '%Y-%m-%d %H:%M:%S')} AS dt_local, {_fmt('ms', '%Y%m%d')} AS ds, ms AS back_ms,
      ms - 28800000 AS back_local_ms, ms AS sec_ms, ms - 1800000 AS minus_ms,
      TRY_CAST(o_orderpriority AS INTEGER) AS not_a_number, CAST(left(o_orderpriority, 1) AS INTEGER) AS number,
      -CAST(left(o_orderpriority, 1) AS DOUBLE) AS negated, md5(o_orderpriority) AS hashed,
      string_split(o_orderpriority, '-')[1] AS head, string_split(o_orderpriority, '-')[-1] AS tail,
      array_to_string(list_sort(list_distinct(string_split(o_orderpriority, ''))), ',') AS letters,
      round(o_totalprice / 7000, 3) AS rounded
    FROM o""",
}
