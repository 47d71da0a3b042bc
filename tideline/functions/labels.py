"""User labels: calendar labels, bands and the rule-weighted age scores.

Everything is a column expression: lookup tables are literal maps folded into
the plan, so scoring is a projection without a join.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tideline.functions.times import from_millis, local

# --------------------------------------------------------------------------
# Fixed values.  They decide the labels, so they must stay exactly as they are.
AGE_GROUPS = ["18-24", "25-29", "30-34", "35-39", "40-49", "50+"]
AGE_SUFFIXES = ["18_24", "25_29", "30_34", "35_39", "40_49", "50"]
# Highest age of each bounded group, in order, starting with the minors.
AGE_LIMITS = [(17, "0-17"), (24, "18-24"), (29, "25-29"), (34, "30-34"), (39, "35-39"), (49, "40-49")]
OLDEST_GROUP = "50+"

# (month * 100 + day of the last day of the sign, sign); later days are Capricorn again.
ZODIAC = {
    "label": [
        (119, "摩羯座"), (218, "水瓶座"), (320, "双鱼座"), (419, "白羊座"), (520, "金牛座"), (621, "双子座"),
        (722, "巨蟹座"), (822, "狮子座"), (922, "处女座"), (1023, "天秤座"), (1122, "天蝎座"), (1221, "射手座"),
    ],
    "classic": [
        (119, "摩羯座"), (218, "水瓶座"), (320, "双鱼座"), (419, "白羊座"), (520, "金牛座"), (620, "双子座"),
        (722, "巨蟹座"), (822, "狮子座"), (922, "处女座"), (1022, "天秤座"), (1121, "天蝎座"), (1221, "射手座"),
    ],
}
YEAR_END_SIGN = "摩羯座"

# First hour that no longer belongs to the part of the day.
DAY_PARTS = {
    "label": [(6, "凌晨"), (9, "早晨"), (12, "上午"), (14, "中午"), (18, "下午"), (22, "晚上"), (24, "夜间")],
    "early": [(5, "凌晨"), (8, "早晨"), (12, "上午"), (14, "中午"), (18, "下午"), (21, "晚上"), (24, "夜间")],
}
LABEL_ZONE = "Asia/Shanghai"

PRICE_BANDS = {"label": ("低价商品", "中价商品", "高价商品"), "range": ("低价商品", "中间商品", "高价商品")}
PRICE_EDGES = (1000, 4000)

ERA_SUFFIX = "年代"

SCORE_WEIGHTS = {"category": "0.3", "brand": "0.2", "price": "0.15", "time": "0.1", "keyword": "0.15", "os": "0.1"}
# Raw scores in the order of AGE_GROUPS.
RAW_SCORES = {
    "category": [
        (["珠宝", "礼品箱包", "鞋靴", "服饰内衣", "个护化妆", "数码"], ("0.9", "0.8", "0.6", "0.4", "0.2", "0.1")),
        (["母婴", "钟表", "厨具", "电脑办公", "家居家装", "家用电器", "图书、音像、电子书刊", "手机", "汽车用品"],
         ("0.2", "0.4", "0.6", "0.8", "0.9", "0.7")),
        (["运动健康", "食品饮料、保健食品"], ("0.1", "0.2", "0.4", "0.6", "0.8", "0.9")),
    ],
    "brand": [
        (["Redmi", "苹果", "联想", "TCL", "小米"], ("0.9", "0.7", "0.5", "0.3", "0.2", "0.1")),
        (["长粒香", "金沙河", "索芙特", "CAREMiLLE", "欧莱雅", "香奈儿"], ("0.1", "0.3", "0.5", "0.7", "0.8", "0.9")),
    ],
    "price": [
        (["高价商品"], ("0.1", "0.2", "0.3", "0.4", "0.5", "0.6")),
        (["中价商品"], ("0.2", "0.4", "0.6", "0.7", "0.8", "0.7")),
        (["低价商品"], ("0.8", "0.6", "0.4", "0.3", "0.2", "0.1")),
    ],
    "time": [
        (["凌晨"], ("0.2", "0.1", "0.1", "0.1", "0.1", "0.1")),
        (["早晨"], ("0.1", "0.1", "0.1", "0.1", "0.2", "0.3")),
        (["上午"], ("0.2", "0.2", "0.2", "0.2", "0.3", "0.4")),
        (["中午"], ("0.4", "0.4", "0.4", "0.4", "0.4", "0.3")),
        (["下午"], ("0.4", "0.5", "0.5", "0.5", "0.5", "0.4")),
        (["晚上"], ("0.8", "0.7", "0.6", "0.5", "0.4", "0.3")),
        (["夜间"], ("0.9", "0.7", "0.5", "0.3", "0.2", "0.1")),
    ],
    "keyword": [
        (["时尚与潮流"], ("0.9", "0.7", "0.5", "0.3", "0.2", "0.1")),
        (["性价比"], ("0.2", "0.4", "0.6", "0.7", "0.8", "0.8")),
        (["科技与数码"], ("0.8", "0.6", "0.4", "0.3", "0.2", "0.1")),
        (["学习与发展"], ("0.4", "0.5", "0.6", "0.7", "0.8", "0.7")),
        (["健康与养生"], ("0.1", "0.2", "0.4", "0.6", "0.8", "0.9")),
        (["家庭与育儿"], ("0.1", "0.2", "0.4", "0.6", "0.8", "0.7")),
    ],
    "os": [(["Android"], ("0.8", "0.7", "0.6", "0.5", "0.4", "0.3")), (["iOS"], ("0.7", "0.6", "0.5", "0.4", "0.3", "0.2"))],
}
# The search profile scores health terms like family terms.
SEARCH_OVERRIDES = {"健康与养生": ("0.1", "0.2", "0.4", "0.6", "0.8", "0.7")}
# Lowest total of each group, highest first.
TOTAL_BANDS = [
    ("0.75", "18-24"), ("0.69", "25-29"), ("0.585", "30-34"), ("0.47", "35-39"), ("0.365", "40-49"), ("0.26", "50+"),
]
INVALID_TOTAL = "数据无效"
OTHER_GROUP_SCORE = -1
# --------------------------------------------------------------------------

SCORE_COLUMNS = {
    "category": "category_score",
    "brand": "tm_score",
    "price": "price_sensitive_score",
    "time": "time_period_score",
    "keyword": "keyword_type_score",
    "os": "os_score",
}
_SCORE = "decimal(4,3)"


def _below(value: Column, bands: list[tuple], last: str | None, inclusive: bool) -> Column:
    """Label of the first band whose edge is not exceeded; null stays null."""
    def holds(edge):
        return value <= edge if inclusive else value < edge

    first, *rest = bands
    chain = reduce(lambda c, b: c.when(holds(b[0]), b[1]), rest, F.when(holds(first[0]), first[1]))
    return chain if last is None else chain.when(value.isNotNull(), last)


# ---- calendar labels ------------------------------------------------------

def epoch_day(days: Column) -> Column:
    """Days since 1970-01-01 to DATE."""
    return F.date_add(F.lit("1970-01-01").cast("date"), days.cast("int"))


def age(birthday: Column, as_of: Column) -> Column:
    """Completed years on ``as_of``; null for a birthday in the future."""
    before = (F.month(as_of) * 100 + F.dayofmonth(as_of)) < (F.month(birthday) * 100 + F.dayofmonth(birthday))
    years = F.year(as_of) - F.year(birthday) - before.cast("int")
    return F.when(birthday <= as_of, years)


def birth_decade(birthday: Column) -> Column:
    return (F.floor(F.year(birthday) / 10) * 10).cast("int")


def era(birthday: Column) -> Column:
    return F.concat(birth_decade(birthday).cast("string"), F.lit(ERA_SUFFIX))


def zodiac(birthday: Column, variant: str = "label") -> Column:
    return _below(F.month(birthday) * 100 + F.dayofmonth(birthday), ZODIAC[variant], YEAR_END_SIGN, True)


def age_group(years: Column) -> Column:
    return _below(years, AGE_LIMITS, OLDEST_GROUP, True)


def day_part(ms: Column, variant: str = "label", tz: str = LABEL_ZONE) -> Column:
    """Part of the day of an epoch-millisecond instant; null before the epoch."""
    hour = F.when(ms >= 0, F.hour(local(from_millis(ms), tz)))
    return _below(hour, DAY_PARTS[variant], None, False)


def price_band(amount: Column, variant: str = "label", strict: bool = False) -> Column:
    """Price band of an amount.  A negative amount gives null, or fails when ``strict``."""
    low, middle, high = PRICE_BANDS[variant]
    band = (
        F.when(amount < PRICE_EDGES[0], low).when(amount <= PRICE_EDGES[1], middle).when(amount.isNotNull(), high)
    )
    negative = F.raise_error(F.concat(F.lit("negative amount: "), amount.cast("string"))) if strict else F.lit(None)
    return F.when(amount < 0, negative.cast("string")).otherwise(band)


def user_labels(df: DataFrame, birthday: str, as_of: Column) -> DataFrame:
    """Add zodiac sign, birth decade, era, age and age group next to an epoch-day birthday."""
    day = epoch_day(F.col(birthday))
    years = age(day, as_of)
    return df.withColumns({
        birthday: F.date_format(day, "yyyy-MM-dd"),
        "zodiac_sign": zodiac(day),
        "birth_decade": birth_decade(day),
        "decade": era(day),
        "age": years,
        "age_group": age_group(years),
    })


def order_bands(df: DataFrame, create_ms: str, amount: str, tz: str = LABEL_ZONE) -> DataFrame:
    """Add the day-part and price-band labels of an order."""
    return df.withColumns({
        "time_period": day_part(F.col(create_ms), tz=tz),
        "price_sensitive": price_band(F.col(amount)),
    })


# ---- scores ---------------------------------------------------------------

def score_rows(dim: str, weight: str | None = None, overrides: dict[str, tuple[str, ...]] | None = None) -> dict[str, list[Decimal]]:
    """Weighted scores per value of a dimension, in the order of AGE_GROUPS, half-up to three places."""
    factor = Decimal(weight or SCORE_WEIGHTS[dim])
    rows = {v: scores for values, scores in RAW_SCORES[dim] for v in values}
    rows.update(overrides or {})
    return {
        v: [(Decimal(s) * factor).quantize(Decimal("0.001"), rounding="ROUND_HALF_UP") for s in scores]
        for v, scores in rows.items()
    }


def _score_map(rows: dict[str, list[Decimal]]) -> Column:
    parts: list[Column] = []
    for value, scores in rows.items():
        parts += [F.lit(value), F.array(*[F.lit(s).cast(_SCORE) for s in scores])]
    return F.create_map(*parts)


def _group_index(group: Column) -> Column:
    return F.try_element_at(
        F.create_map(*[x for i, g in enumerate(AGE_GROUPS, 1) for x in (F.lit(g), F.lit(i))]), group
    )


def age_scores(
    df: DataFrame,
    group: str = "age_group",
    category: str = "category1_name",
    brand: str = "tm_name",
    price: str = "price_sensitive",
    time: str = "time_period",
    keyword: str = "keyword_type",
    os: str = "os",
) -> DataFrame:
    """Six partial scores for the row's own age group.

    An unknown value scores null.  Rows of any other age group get a category
    score of -1 and no other score.
    """
    index = _group_index(F.col(group))
    inputs = {"category": category, "brand": brand, "price": price, "time": time, "keyword": keyword, "os": os}
    scores = {}
    for dim, name in inputs.items():
        value = F.trim(F.col(name)) if dim == "keyword" else F.col(name)
        scores[SCORE_COLUMNS[dim]] = F.try_element_at(
            F.try_element_at(_score_map(score_rows(dim)), value), index
        )
    outside = F.col(group).isNotNull() & index.isNull()
    scores["category_score"] = F.when(outside, F.lit(OTHER_GROUP_SCORE).cast(_SCORE)).otherwise(
        scores["category_score"]
    )
    return df.withColumns(scores)


def total_score(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Sum of the present scores and the age group it stands for."""
    names = columns or list(SCORE_COLUMNS.values())
    zero = F.lit(0).cast("decimal(10,3)")
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(n).cast("decimal(10,3)"), zero) for n in names])
    total = F.round(total, 3).cast("decimal(10,3)")
    first, *rest = [(F.lit(Decimal(edge)), label) for edge, label in TOTAL_BANDS]
    band = reduce(
        lambda c, b: c.when(F.col("total_score") >= b[0], b[1]), rest, F.when(F.col("total_score") >= first[0], first[1])
    )
    return df.withColumn("total_score", total).withColumn("new_age_group", band.otherwise(INVALID_TOTAL))


def device_scores(df: DataFrame, os: str = "os", weight: str = "0.1") -> DataFrame:
    """``judge_os`` (first of a comma list) and its six device scores; null for another system."""
    table = _score_map(score_rows("os", weight))
    df = df.withColumn("judge_os", F.substring_index(F.col(os), ",", 1))
    row = F.try_element_at(table, F.col("judge_os"))
    return df.withColumns({f"device_{s}": row[i].cast("double") for i, s in enumerate(AGE_SUFFIXES)})


def search_scores(df: DataFrame, category: str = "search_category", weight: str = "0.15") -> DataFrame:
    """Six search scores of a search category; zero when the category is unknown."""
    table = _score_map(score_rows("keyword", weight, SEARCH_OVERRIDES))
    row = F.try_element_at(table, F.col(category))
    return df.withColumns({
        f"search_{s}": F.coalesce(row[i].cast("double"), F.lit(0.0)) for i, s in enumerate(AGE_SUFFIXES)
    })
