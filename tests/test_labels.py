"""Label functions at their edges, and the published sample record."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tideline.functions import labels, text, times
from tideline.operators import moderation, people, survivors


def value(spark, column, **inputs):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in inputs.items()]).select(column.alias("x")).first().x


def test_sample_record(spark):
    """Age group 18-24, noodles, Android: the partial scores add up to 0.17."""
    row = spark.createDataFrame(
        [("18-24", "食品饮料、保健食品", "金沙河", 29806.0, 1746574268000, "家庭与育儿", "Android")],
        "age_group string, category1_name string, tm_name string, original_total_amount double, create_ms long, "
        "keyword_type string, os string",
    )
    out = people.scored(row).first()
    assert (out.time_period, out.price_sensitive) == ("早晨", "高价商品")
    got = [float(out[c]) for c in labels.SCORE_COLUMNS.values()]
    assert got == [0.03, 0.02, 0.015, 0.01, 0.015, 0.08]
    assert float(out.total_score) == 0.17
    assert out.new_age_group == "数据无效"


def test_sample_birthday(spark):
    days = (datetime.date(2005, 7, 6) - datetime.date(1970, 1, 1)).days
    users = spark.createDataFrame([(days,)], "birthday int")
    out = labels.user_labels(users, "birthday", F.lit("2025-05-15").cast("date")).first()
    assert (out.birthday, out.zodiac_sign, out.birth_decade, out.decade, out.age, out.age_group) == (
        "2005-07-06", "巨蟹座", 2000, "2000年代", 19, "18-24",
    )


@pytest.mark.parametrize("years,group", [
    (0, "0-17"), (17, "0-17"), (18, "18-24"), (24, "18-24"), (25, "25-29"), (30, "30-34"), (39, "35-39"),
    (40, "40-49"), (49, "40-49"), (50, "50+"), (99, "50+"),
])
def test_age_group(spark, years, group):
    assert value(spark, labels.age_group(F.col("y")), y=years) == group


def test_missing_age_has_no_group(spark):
    assert value(spark, labels.age_group(F.col("y").cast("int")), y=None) is None


@pytest.mark.parametrize("day,variant,sign", [
    ("2000-01-01", "label", "摩羯座"), ("2000-01-20", "label", "水瓶座"), ("2000-06-21", "label", "双子座"),
    ("2000-06-21", "classic", "巨蟹座"), ("2000-10-23", "label", "天秤座"), ("2000-10-23", "classic", "天蝎座"),
    ("2000-11-22", "label", "天蝎座"), ("2000-11-22", "classic", "射手座"), ("2000-12-22", "label", "摩羯座"),
])
def test_zodiac(spark, day, variant, sign):
    assert value(spark, labels.zodiac(F.to_date("d"), variant), d=day) == sign


@pytest.mark.parametrize("hour,label,early", [
    (0, "凌晨", "凌晨"), (5, "凌晨", "早晨"), (6, "早晨", "早晨"), (8, "早晨", "上午"), (9, "上午", "上午"),
    (12, "中午", "中午"), (14, "下午", "下午"), (18, "晚上", "晚上"), (21, "晚上", "夜间"), (22, "夜间", "夜间"),
])
def test_day_part(spark, hour, label, early):
    ms = hour * 3_600_000
    assert value(spark, labels.day_part(F.col("ms"), tz="UTC"), ms=ms) == label
    assert value(spark, labels.day_part(F.col("ms"), "early", "UTC"), ms=ms) == early


def test_price_band(spark):
    for amount, band in [(0.0, "低价商品"), (999.99, "低价商品"), (1000.0, "中价商品"), (4000.0, "中价商品"), (4000.01, "高价商品")]:
        assert value(spark, labels.price_band(F.col("a")), a=amount) == band
    assert value(spark, labels.price_band(F.col("a")), a=-1.0) is None
    with pytest.raises(Exception, match="negative amount"):
        value(spark, labels.price_band(F.col("a"), strict=True), a=-1.0)


def test_other_groups_score_minus_one(spark):
    row = spark.createDataFrame(
        [("0-17", "数码", "小米", "高价商品", "早晨", "性价比", "iOS"), (None, "数码", "小米", "高价商品", "早晨", "性价比", "iOS")],
        "age_group string, category1_name string, tm_name string, price_sensitive string, time_period string, "
        "keyword_type string, os string",
    )
    out = labels.age_scores(row).collect()
    assert float(out[0].category_score) == -1 and out[0].tm_score is None
    assert out[1].category_score is None


def test_padded_topic_is_trimmed(spark):
    row = spark.createDataFrame([("18-24", "x", "x", "x", "x", " 时尚与潮流 ", "x")],
                                "age_group string, category1_name string, tm_name string, price_sensitive string, "
                                "time_period string, keyword_type string, os string")
    assert float(labels.age_scores(row).first().keyword_type_score) == 0.135


def test_search_profile_scores_health_like_family(spark):
    row = spark.createDataFrame([("健康与养生",), (None,), ("nothing",)], "search_category string")
    out = labels.search_scores(row).collect()
    assert out[0].search_50 == 0.105 and out[1].search_18_24 == 0.0 and out[2].search_50 == 0.0


def test_tokens(spark):
    assert value(spark, text.last_token(F.col("t")), t="a,b,,") == "b"
    assert value(spark, text.last_token(F.col("t")), t="plain") == "plain"
    assert value(spark, text.last_token(F.col("t")), t=",,") == ""
    assert value(spark, text.first_token(F.col("t")), t="iOS 16.1") == "iOS"
    assert value(spark, text.words(F.col("t")), t="Red  shoe,小米 (X)") == ["red", "shoe", "小米", "x"]


def test_times(spark):
    ms = 1746574268000
    assert value(spark, times.datetime_text(times.from_millis(F.col("m")), "Asia/Shanghai"), m=ms) == "2025-05-07 07:31:08"
    assert value(spark, times.parse_millis(F.col("t"), "Asia/Shanghai"), t="2025-05-07 07:31:08") == ms
    assert value(spark, times.parse_millis(F.col("t")), t="not a time") is None


@pytest.mark.parametrize("body", ["the hat, x", "no word", "", "aaaa", "x" * 300 + "hat" + "y" * 300, "小米手机,手机"])
def test_moderation_forms_agree(spark, body):
    dictionary = ["hat", "the", "aa", "手机", "y" * 140]
    df = spark.createDataFrame([(1, body)], "id int, msg string")
    words = spark.createDataFrame([(w,) for w in dictionary], "word string")
    one = moderation.moderate(df, "msg", dictionary).first()
    two = moderation.moderate_by_join(df, "id", "msg", words).first()
    assert tuple(one) == tuple(two)
    found = sorted(w for w in dictionary if w in body)
    last = body.rstrip(",").split(",")[-1]
    grade = "P0" if last in dictionary else "P1" if found else ""
    assert tuple(moderation.moderate(df, "msg", words, "id").first()) == tuple(one)
    assert one.violation_grade == grade
    assert one.violation_msg == (last if grade == "P0" else ", ".join(found))


def test_long_word_lists(spark):
    dictionary = [f"w{i}x" for i in range(5_001)]
    df = spark.createDataFrame([(1, "a w17x b w5000x"), (2, "none"), (3, "so,w3x")], "id int, msg string")
    listed = {tuple(r) for r in moderation.moderate(df, "msg", dictionary).collect()}
    assert listed == {tuple(r) for r in moderation.moderate(df, "msg", dictionary, "id").collect()}
    assert {(r[0], r[3]) for r in listed} == {(1, "P1"), (2, ""), (3, "P0")}


# ---- labels merged from several sources -------------------------------------

def labelled(df, column):
    return {r.uid: r[column] for r in df.collect()}


def test_weights(spark):
    schema = "uid long, ts_ms long, value string, unit string, source string"
    weights = {"device": "1.0", "order": "0.8"}
    base = spark.createDataFrame([
        (1, 1, "65 kg", "kg", "device"), (1, 5, "70kg", "kg", "order"), (2, 1, "128.8", "斤", "order"), (3, 1, "29.9", "kg", "device"),
        (3, 2, "200.1", "kg", "device"), (4, 1, "fat", "kg", "device"), (5, 1, "50", "kg", "toy"), (6, 1, "64.45", "kg", "order"),
        (7, 1, "60", "斤", "order"), (8, 1, "400", "斤", "order"), (None, 1, "60", "kg", "order"), (9, 1, None, None, None),
    ], schema)
    later = spark.createDataFrame([
        (1, 9, "66.0", "kg", "order"), (2, 9, "64.44", "kg", "order"), (6, 9, "61", "kg", "device"), (10, 9, "44.25", "kg", "device"),
    ], schema)
    got = labelled(survivors.weight_labels(survivors.weighed(base, weights), survivors.weighed(later, weights)), "weight")
    assert {k: str(v) for k, v in got.items()} == {1: "65.0", 2: "64.4", 6: "61.0", 7: "30.0", 8: "200.0", 10: "44.3"}
    assert str(labelled(survivors.weight_labels(survivors.weighed(base, weights), survivors.weighed(later.limit(0), weights)), "weight")[6]) == "64.5"


def test_heights(spark):
    records = spark.createDataFrame([
        # Sources agree within 5: the newest.
        (1, 1, "175", "cm", "device"), (1, 2, "180", "cm", "order"),
        # Sources differ: the mode of the last three, not the older 170s.
        (2, 1, "170", "cm", "device"), (2, 2, "170", "cm", "device"), (2, 3, "180", "cm", "order"), (2, 4, "171", "cm", "device"), (2, 5, "1.80", "m", "order"),
        # Differ without a mode: the newest.
        (3, 1, "160", "cm", "device"), (3, 2, "170", "cm", "order"), (3, 3, "180", "cm", "profile"),
        # Special and impossible values, also as the newest record.
        (4, 1, "168 cm", "cm", "device"), (4, 2, "666", "cm", "order"), (4, 3, "99", "cm", "order"), (4, 4, "251", "cm", "order"), (4, 5, "tall", "cm", "order"),
        (5, 1, "888", "cm", "device"), (None, 1, "170", "cm", "device"),
        # A tie of two: the newest.
        (6, 1, "160", "cm", "device"), (6, 2, "170", "cm", "order"),
        # The same time: the larger value counts as the newest.
        (7, 1, "160", "cm", "device"), (7, 1, "164", "cm", "device"),
    ], "uid long, ts_ms long, value string, unit string, source string")
    assert labelled(survivors.height_labels(records), "height") == {1: 180, 2: 180, 3: 180, 4: 168, 6: 170, 7: 164}
    assert labelled(survivors.height_labels(records, apart=3), "height")[1] == 180


def test_genders(spark):
    categories = spark.createDataFrame(
        [("dress", "female", Decimal("1.0")), ("suit", "male", Decimal("1.0")), ("pan", "family", Decimal("1.0"))],
        "category string, side string, weight decimal(4,3)")
    rows = [(1, "buy", "dress"), (1, "view", "suit"), (2, "cart", "suit"), (3, "view", "pan"), (4, "view", "dress"), (4, "view", "suit")]
    # 3 of 10 purchases for the family, and scores of 1.0 and 0.9; then 3 of 11.
    rows += [(5, "buy", "pan")] * 3 + [(5, "buy", "book")] * 5 + [(5, "buy", "dress"), (5, "buy", "suit"), (5, "cart", "dress"), (5, "view", "dress")]
    rows += [(5, "view", "suit")] * 2
    rows += [(6, k, c) for _, k, c in rows if _ == 5] + [(6, "buy", "book")]
    rows += [(7, "buy", "pan"), (7, "buy", "dress"), (8, "return", "dress"), (None, "buy", "dress")]
    got = {r.uid: r for r in survivors.gender_labels(spark.createDataFrame(rows, "uid long, kind string, category string"), categories).collect()}
    assert {k: r.gender for k, r in got.items()} == {
        1: "female", 2: "male", 3: "unknown", 4: "unknown", 5: "family", 6: "female", 7: "female"}
    assert (got[5].female_score, got[5].male_score) == (Decimal("1.0"), Decimal("0.9")) and got[3].family_share is None
