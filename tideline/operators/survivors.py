"""User labels merged from records of several sources: weight, height and gender.

Every label is an aggregate, combined before the shuffle, or the last few
records of a user, cut on the map side; a user with very many records is a few
rows per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

#: How much a kind of behaviour counts.
BEHAVIOUR = {"buy": "0.5", "cart": "0.3", "view": "0.2"}


def number(text: Column) -> Column:
    """The number in a text of digits and other characters; null where there is none."""
    return F.regexp_replace(text, "[^0-9.]", "").try_cast("decimal(12,4)")


# ---- weight -----------------------------------------------------------------

def kilograms(value: Column, unit: Column, jin: str = "\u65a4") -> Column:
    """Weight in kilograms; a jin is half of one."""
    return F.when(unit == jin, number(value) / 2).otherwise(number(value)).cast("decimal(12,4)")


def weighed(records: DataFrame, weights: Mapping[str, str], low: int = 30, high: int = 200) -> DataFrame:
    """``(uid, kg, priority, ts_ms)`` of each user's surviving record of ``(uid, ts_ms, value, unit, source)``.

    Records outside ``low .. high`` or of a source without a weight do not
    count.  The source of the highest weight survives, then the newest record,
    then the larger value.
    """
    source = F.create_map(*[x for name, w in weights.items() for x in (F.lit(name), F.lit(w).cast("decimal(6,3)"))])
    rows = records.select("uid", "ts_ms", kilograms(F.col("value"), F.col("unit")).alias("kg"), source[F.col("source")].alias("priority"))
    return survivors(rows.where(F.col("kg").between(low, high) & F.col("priority").isNotNull() & F.col("uid").isNotNull()))


def survivors(rows: DataFrame) -> DataFrame:
    """One record of each user: by priority, then time, then value.  Merges a base with an increment as well as raw records."""
    best = rows.groupBy("uid").agg(F.max(F.struct("priority", "ts_ms", "kg")).alias("r"))
    return best.select("uid", "r.kg", "r.priority", "r.ts_ms")


def weight_labels(base: DataFrame, increment: DataFrame) -> DataFrame:
    """``(uid, weight)`` from the surviving records so far and those of a day, half-up to one decimal."""
    merged = survivors(base.unionByName(increment))
    return merged.select("uid", F.round("kg", 1).cast("decimal(6,1)").alias("weight"))


# ---- height -----------------------------------------------------------------

def height_labels(
    records: DataFrame, low: int = 100, high: int = 250, special: Sequence[int] = (666, 888), apart: int = 5, last: int = 3,
) -> DataFrame:
    """``(uid, height)`` in whole centimetres from ``(uid, ts_ms, value, unit, source)``.

    Values outside ``low .. high`` and ``special`` ones do not count.  If the
    newest values of a user's sources lie more than ``apart`` apart, the mode
    of the ``last`` valid records decides; of equally frequent values the
    newest one, so without a mode it is the newest record, as it is where the
    sources agree.
    """
    cm = F.when(F.col("unit") == "m", number(F.col("value")) * 100).otherwise(number(F.col("value")))
    rows = records.select("uid", "ts_ms", "source", F.round(cm, 0).cast("int").alias("cm"))
    rows = rows.where(F.col("cm").between(low, high) & ~F.col("cm").isin(*special) & F.col("uid").isNotNull())
    newest = rows.groupBy("uid", "source").agg(F.max(F.struct("ts_ms", "cm")).alias("r"))
    spread = newest.groupBy("uid").agg((F.max("r.cm") - F.min("r.cm")).alias("spread"))
    # The limit is applied on the map side as well.
    order = Window.partitionBy("uid").orderBy(F.desc("ts_ms"), F.desc("cm"), F.desc("source"))
    few = rows.withColumn("k", F.row_number().over(order)).where(F.col("k") <= last)
    counted = few.groupBy("uid", "cm").agg(F.count("*").alias("n"), F.min("k").alias("k"))
    chosen = counted.groupBy("uid").agg(
        F.max_by("cm", F.struct("n", -F.col("k"))).alias("mode"), F.min_by("cm", "k").alias("newest"))
    return chosen.join(spread, "uid").select("uid", F.when(F.col("spread") > apart, F.col("mode")).otherwise(F.col("newest")).alias("height"))


# ---- gender -----------------------------------------------------------------

def gender_labels(
    behaviour: DataFrame, categories: DataFrame, shares: Mapping[str, str] = BEHAVIOUR, family_share: str = "0.30", close: str = "0.10",
    names: tuple[str, str, str, str] = ("female", "male", "family", "unknown"),
) -> DataFrame:
    """``(uid, female_score, male_score, family_share, gender)`` from ``(uid, kind, category)``.

    ``categories`` has ``category, side, weight``; ``side`` is one of the first
    three ``names``.  A behaviour counts its share times the weight of its
    category for the side.  A user with at least ``family_share`` of the
    purchases in family categories, whose scores differ by at most ``close`` of
    the higher one, is a family; otherwise the higher score decides, and equal
    ones leave the label unknown.
    """
    female, male, family, unknown = names
    share = F.create_map(*[x for kind, s in shares.items() for x in (F.lit(kind), F.lit(s).cast("decimal(4,3)"))])
    rows = behaviour.where(F.col("kind").isin(*shares) & F.col("uid").isNotNull()).join(categories, "category", "left").select(
        "uid", "side", (F.col("kind") == "buy").alias("bought"), (share[F.col("kind")] * F.col("weight")).alias("points"))
    score = lambda side: F.coalesce(F.sum(F.when(F.col("side") == side, F.col("points"))), F.lit(0)).cast("decimal(20,6)")
    sums = rows.groupBy("uid").agg(
        score(female).alias("female_score"), score(male).alias("male_score"),
        F.count_if("bought").alias("buys"), F.count_if(F.col("bought") & (F.col("side") == family)).alias("family_buys"))
    apart = F.abs(F.col("female_score") - F.col("male_score"))
    limit = F.greatest("female_score", "male_score") * F.lit(close).cast("decimal(4,3)")
    enough = (F.col("buys") > 0) & (F.col("family_buys") >= F.col("buys") * F.lit(family_share).cast("decimal(4,3)"))
    label = (
        F.when(enough & (apart <= limit), family).when(F.col("female_score") > F.col("male_score"), female)
        .when(F.col("male_score") > F.col("female_score"), male).otherwise(unknown)
    )
    part = F.when(F.col("buys") > 0, F.col("family_buys") / F.col("buys"))
    return sums.select("uid", "female_score", "male_score", part.alias("family_share"), label.alias("gender"))
