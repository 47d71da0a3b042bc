"""Labels merged from several sources, over the sample tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tideline.functions.times import to_millis
from tideline.operators import survivors
from tideline.plans import sql
from tideline.plans.tables import as_double, literal_rows, page_log, table

JIN = "\u65a4"
#: Sources and their weights; the last one has none.
SOURCES = ["device", "order", "profile", "other", "unknown"]
WEIGHTS = {"device": "1.0", "order": "0.8", "profile": "0.6", "other": "0.4"}


def _records(spark: SparkSession, folder: str) -> DataFrame:
    """Orders stand for records of their customer; numbers follow from the keys."""
    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("uid"), to_millis(F.col("o_orderdate")).alias("ts_ms"), F.col("o_orderkey").alias("k"),
        F.element_at(F.array(*map(F.lit, SOURCES)), (F.col("o_orderkey") * 7 % 5 + 1).cast("int")).alias("source"),
    )


def _weights(spark: SparkSession, folder: str) -> DataFrame:
    tenths = F.col("k") * 37 % 2400 + 150
    amount = F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"), (F.col("k") % 10).cast("string"))
    return _records(spark, folder).select(
        "uid", "ts_ms", "source", F.when(F.col("k") % 3 == 0, JIN).otherwise("kg").alias("unit"),
        F.when(F.col("k") % 11 == 0, "about").otherwise(F.concat(F.lit("~ "), amount, F.lit(" net"))).alias("value"),
    )


def weight_label(spark: SparkSession, folder: str) -> DataFrame:
    """Weights up to a day, merged with those from then on."""
    rows, cut = _weights(spark, folder), 852_076_800_000  # 1997-01-01
    base, increment = (survivors.weighed(part, WEIGHTS) for part in (rows.where(F.col("ts_ms") < cut), rows.where(F.col("ts_ms") >= cut)))
    return as_double(survivors.weight_labels(base, increment), "weight")


def height_label(spark: SparkSession, folder: str) -> DataFrame:
    cm = 150 + F.col("uid") % 40 + F.col("k") * 13 % 4 * 3
    value = (
        F.when(F.col("k") % 17 == 0, "666").when(F.col("k") % 19 == 0, "40 cm")
        .when(F.col("k") % 5 == 0, F.concat(F.floor(cm / 100).cast("string"), F.lit("."), F.lpad((cm % 100).cast("string"), 2, "0")))
        .otherwise(F.concat(cm.cast("string"), F.lit(" cm")))
    )
    return survivors.height_labels(_records(spark, folder).select(
        "uid", "ts_ms", "source", value.alias("value"), F.when(F.col("k") % 5 == 0, "m").otherwise("cm").alias("unit")))


#: Category, side and weight.
CATEGORIES = [
    ("dresses", "female", "1.0"), ("cosmetics", "female", "0.9"), ("jewellery", "female", "0.7"), ("suits", "male", "1.0"),
    ("game consoles", "male", "0.8"), ("running shoes", "male", "0.6"), ("kitchen", "family", "1.0"), ("textiles", "family", "0.5"),
]
_NAMES = [c for c, *_ in CATEGORIES] + ["books"]


def gender_label(spark: SparkSession, folder: str) -> DataFrame:
    pages = page_log(spark, folder)
    kind = F.when(F.col("event_type") == "purchase", "buy").when(F.col("event_type") == "click", "cart").when(F.col("event_type") == "view", "view")
    behaviour = pages.select(
        F.col("user_id").alias("uid"), kind.alias("kind"),
        F.element_at(F.array(*map(F.lit, _NAMES)), ((F.col("k") + F.col("user_id")) % len(_NAMES) + 1).cast("int")).alias("category"))
    categories = literal_rows(spark, CATEGORIES, "category string, side string, weight string").withColumn(
        "weight", F.col("weight").cast("decimal(4,3)"))
    return as_double(survivors.gender_labels(behaviour, categories), "female_score", "male_score", "family_share")


QUERIES = {"weight_label": weight_label, "height_label": height_label, "gender_label": gender_label}

_RECORDS = """rec AS (
  SELECT o_custkey AS uid, epoch_us(o_orderdate) // 1000 AS ts_ms, o_orderkey AS k,
    ['device', 'order', 'profile', 'other', 'unknown'][o_orderkey * 7 % 5 + 1] AS source FROM orders)"""

ORACLE = {
    "weight_label": f"""WITH {_RECORDS}, w AS (
      SELECT uid, ts_ms, k, CASE source WHEN 'device' THEN 1.0 WHEN 'order' THEN 0.8 WHEN 'profile' THEN 0.6 WHEN 'other' THEN 0.4 END AS p,
        CAST((k * 37 % 2400 + 150) * 10 + k % 10 AS DECIMAL(12,2)) / 100 / CASE WHEN k % 3 = 0 THEN 2 ELSE 1 END AS kg
      FROM rec WHERE k % 11 <> 0)
    SELECT uid, round(CAST(arg_max(CAST(kg AS DECIMAL(12,4)), (p, ts_ms, CAST(kg AS DECIMAL(12,4)))) AS DOUBLE) + 1e-9, 1) AS weight
    FROM w WHERE p IS NOT NULL AND kg BETWEEN 30 AND 200 AND uid IS NOT NULL GROUP BY uid""",
    "height_label": f"""WITH {_RECORDS}, h AS (
      SELECT uid, ts_ms, source, 150 + uid % 40 + k * 13 % 4 * 3 AS cm FROM rec WHERE k % 17 <> 0 AND k % 19 <> 0 AND uid IS NOT NULL),
    spread AS (
      SELECT uid, max(cm) - min(cm) AS spread FROM (
        SELECT uid, source, cm FROM h QUALIFY row_number() OVER (PARTITION BY uid, source ORDER BY ts_ms DESC, cm DESC) = 1) GROUP BY uid),
    three AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY ts_ms DESC, cm DESC, source DESC) AS k FROM h QUALIFY k <= 3),
    votes AS (SELECT uid, cm, count(*) AS n, min(k) AS k FROM three GROUP BY uid, cm),
    first AS (
      SELECT uid, first(cm ORDER BY n DESC, k) AS mode, first(cm ORDER BY k) AS newest FROM votes GROUP BY uid)
    SELECT uid, CAST(CASE WHEN spread > 5 THEN mode ELSE newest END AS INTEGER) AS height FROM first JOIN spread USING (uid)""",
    "gender_label": f"""WITH {sql.LOG}, {sql.values([(c, s, float(w)) for c, s, w in CATEGORIES], 'cat', 'category, side, weight')}, b AS (
      SELECT user_id AS uid, event_type = 'purchase' AS bought,
        CASE event_type WHEN 'purchase' THEN 0.5 WHEN 'click' THEN 0.3 ELSE 0.2 END AS share,
        [{", ".join(f"'{c}'" for c in _NAMES)}][(k + user_id) % {len(_NAMES)} + 1] AS category
      FROM log WHERE event_type IN ('purchase', 'click', 'view') AND user_id IS NOT NULL),
    s AS (
      SELECT uid, coalesce(sum(CAST(share * weight AS DECIMAL(12,6))) FILTER (side = 'female'), 0) AS f,
        coalesce(sum(CAST(share * weight AS DECIMAL(12,6))) FILTER (side = 'male'), 0) AS m,
        count(*) FILTER (bought) AS buys, count(*) FILTER (bought AND side = 'family') AS fam
      FROM b LEFT JOIN cat USING (category) GROUP BY uid)
    SELECT uid, CAST(f AS DOUBLE) AS female_score, CAST(m AS DOUBLE) AS male_score,
      CASE WHEN buys > 0 THEN fam / buys END AS family_share,
      CASE WHEN buys > 0 AND 100 * fam >= 30 * buys AND 10 * abs(f - m) <= greatest(f, m) THEN 'family'
        WHEN f > m THEN 'female' WHEN m > f THEN 'male' ELSE 'unknown' END AS gender
    FROM s""",
}
