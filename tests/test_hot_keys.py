"""One key with most of the rows: salted joins and bucketed windows give the plain result."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tideline.operators import joins, keyed, windows

ROWS = 3000
SMALL = 100  # rows of a bucket, so that user 0 has many


@pytest.fixture(scope="module")
def rows(spark):
    """Two thirds of the rows belong to user 0."""
    return spark.range(ROWS).select(
        F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 40).cast("long").alias("user"),
        F.col("id").alias("seq"),
        (F.col("id") * 60_000 + F.pmod(F.xxhash64("id"), F.lit(50_000))).alias("ms"),
        (F.col("id") % 7).cast("string").alias("v"),
    ).withColumn("ts", F.timestamp_millis("ms"))


def slices(ms="ms"):
    return F.floor(F.col(ms) / 3_600_000)


def by_user(rows):
    groups = defaultdict(list)
    for r in sorted(rows.collect(), key=lambda r: r.seq):
        groups[r.user].append(r)
    return groups


@pytest.mark.parametrize("following", [False, True])
@pytest.mark.parametrize("along,size", [("ms", SMALL), ("ts", SMALL), ("ms", 10**6), (None, SMALL)])
def test_neighbor(rows, following, along, size):
    out = keyed.neighbor(rows, ["user"], ["seq"], ["seq", "v"], "n", along, following, rows_per_bucket=size)
    assert out.columns == [*rows.columns, "n"]
    got = {r.seq: None if r.n is None else (r.n.seq, r.n.v) for r in out.collect()}
    want = {}
    for group in by_user(rows).values():
        for i, r in enumerate(group):
            j = i + 1 if following else i - 1
            want[r.seq] = (group[j].seq, group[j].v) if 0 <= j < len(group) else None
    assert got == want


def test_buckets_follow_the_rows_of_a_key(rows):
    cut = keyed._bucketed(rows, ["user"], "ms", SMALL)
    sizes = {(r.user, r._bucket): r["count"] for r in cut.groupBy("user", "_bucket").count().collect()}
    assert max(sizes.values()) < 2 * SMALL
    assert sum(u == 0 for u, _ in sizes) == 21 and sum(u == 1 for u, _ in sizes) == 1


def test_null_places_join_the_first_bucket(spark):
    rows = spark.createDataFrame([("a", i, None if i < 3 else i * 10) for i in range(12)], "k string, seq long, ms long")
    out = keyed.neighbor(rows, ["k"], ["ms", "seq"], ["seq"], "n", "ms", rows_per_bucket=2)
    assert {r.seq: r.n and r.n.seq for r in out.collect()} == {i: i - 1 if i else None for i in range(12)}


def test_two_hundred_large_keys(spark):
    rows = spark.range(20_000).select((F.col("id") % 200).alias("k"), F.col("id").alias("seq"))
    out = keyed.neighbor(rows, ["k"], ["seq"], ["seq"], "n", "seq", rows_per_bucket=10)
    assert out.where("n.seq <> seq - 200 OR (n IS NULL AND seq >= 200)").count() == 0
    assert "Broadcast" not in out._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("along,size", [("ms", SMALL), ("ms", 10**6), (None, SMALL)])
def test_running_profile(rows, along, size):
    typed = rows.withColumn("day", F.to_date("ts"))
    out = keyed.running_profile(typed, "user", ["seq"], ["v", "day"], along, as_text=False, rows_per_bucket=size)
    got = {r.seq: (r.pv, r.v, r.day) for r in out.collect()}
    for group in by_user(typed).values():
        seen, days = set(), set()
        for n, r in enumerate(group, 1):
            seen.add(r.v)
            days.add(r.day)
            assert got[r.seq] == (n, sorted(seen), sorted(days))


def test_retract_keeps_surviving_sum(rows):
    priced = rows.withColumn("amount", F.col("seq"))
    out = keyed.retract(priced, ["user"], ["seq"], ["amount"])
    last = {u: g[-1].seq for u, g in by_user(rows).items()}
    got = {r.user: r.s for r in out.groupBy("user").agg(F.sum("amount").alias("s")).collect()}
    assert got == last
    assert out.count() == 2 * ROWS - len(last)


@pytest.mark.parametrize("size", [SMALL, 10**6])
def test_retract_ttl(rows, size):
    out = keyed.retract(rows, ["user"], ["ms", "seq"], ["seq"], "ms", 70_000, rows_per_bucket=size)
    want = 0
    for g in by_user(rows).values():
        g = sorted(g, key=lambda r: (r.ms, r.seq))
        want += sum(1 for a, b in zip(g, g[1:]) if b.ms - a.ms <= 70_000)
    assert out.where("row_kind = '-'").count() == want > 0


def test_daily_unique_by_arrival_counts_a_day_again(spark):
    day = 86_400_000
    rows = spark.createDataFrame(
        [("a", 1, 0), ("a", 2, day), ("a", 3, 5), ("a", 4, 6), ("b", 5, 0)], "mid string, seq long, ms long"
    ).withColumn("ts", F.timestamp_millis("ms"))
    for size in (1, 1000):
        out = keyed.daily_unique_by_arrival(rows, ["mid"], "ts", ["seq"], "seq", rows_per_bucket=size)
        assert {r.seq: r.uv_ct for r in out.collect()} == {1: 1, 2: 1, 3: 1, 4: 0, 5: 1}
    assert keyed.first_of_day(rows, ["mid"], "ts", ["seq"]).count() == 3


HOWS = ["inner", "left", "left_semi", "left_anti"]
#: Types of a key on either side; both must see the same hot keys.
TYPES = [("bigint", "bigint"), ("bigint", "int"), ("int", "bigint"), ("string", "bigint"), ("bigint", "string"),
         ("decimal(12,2)", "decimal(20,0)"), ("decimal(12,2)", "int")]


def same_rows(a, b):
    assert a.columns == b.columns
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


@pytest.mark.parametrize("how", HOWS)
@pytest.mark.parametrize("many,one", TYPES)
def test_salted_join(spark, rows, how, many, one):
    names = spark.range(0, 40, 2).select(F.col("id").cast(one).alias("user"), F.concat(F.lit("u"), "id").alias("name"))
    typed = rows.withColumn("user", F.col("user").cast(many))
    plain = typed.join(names, "user", how)
    same_rows(joins.salted_join(typed, names, ["user"], how, ["seq"], hot=[0, 7], salts=5), plain)
    same_rows(joins.salted_join(typed, names, ["user"], how, ["seq"]), plain)


def test_named_keys_are_spread(spark, rows):
    names = spark.range(40).select(F.col("id").alias("user"), (F.col("id") * 2).alias("a"))
    out = joins.salted_join(rows, names, ["user"], "inner", ["seq"], hot=[0], salts=16)
    assert "_salt" in out._jdf.queryExecution().optimizedPlan().toString()
    with pytest.raises(ValueError):
        joins.salted_join(rows, names, ["user"], hot=[0])
    with pytest.raises(ValueError):
        joins.salted_join(rows, names, ["user"], "inner", ["seq"], hot=[(0, 1)])


def test_salted_join_spreads_over_all_sides(spark, rows):
    names = spark.range(40).select(F.col("id").alias("user"), (F.col("id") * 2).alias("a"))
    more = spark.range(5).select(F.col("id").alias("user"), (F.col("id") * 3).alias("b"))
    out = joins.salted_joins(rows, [(names, "inner"), (more, "left")], ["user"], ["seq"], [0])
    same_rows(out, rows.join(names, "user").join(more, "user", "left"))


@pytest.mark.parametrize("lower,upper", [(-60_000, 60_000), (-1_800_000, 5_000), (0, 0), (10, 90_000)])
@pytest.mark.parametrize("kind", ["bigint", "int", "string"])
def test_interval_join(rows, lower, upper, kind):
    left = rows.select(F.col("user").cast(kind).alias("user"), F.col("seq").alias("a"), F.col("ms").alias("a_ms")).where("a % 2 = 0")
    right = rows.select("user", F.col("seq").alias("b"), F.col("ms").alias("b_ms")).where("b % 3 <> 1")
    out = joins.interval_join(left, right, ["user"], "a_ms", "b_ms", lower, upper, ["a"], hot=[0, 3], salts=4)
    plain = left.join(right, "user").where(F.expr(f"b_ms - a_ms BETWEEN {lower} AND {upper}"))
    got = sorted((r.a, r.b) for r in out.collect())
    assert got == sorted((r.a, r.b) for r in plain.collect())
    assert got


def test_interval_join_before_the_epoch(spark):
    left = spark.createDataFrame([(1, -100), (1, 50)], "k int, a_ms long")
    right = spark.createDataFrame([(1, -110), (1, -90), (1, 40), (1, 61)], "k int, b_ms long")
    out = joins.interval_join(left, right, ["k"], "a_ms", "b_ms", -10, 10)
    assert sorted((r.a_ms, r.b_ms) for r in out.collect()) == [(-100, -110), (-100, -90), (50, 40)]


def test_repair_new_visitors(spark):
    day = 86_400_000
    data = [
        ("a", 1, 0, "1"), ("a", 2, 10, "1"), ("a", 3, day, "1"), ("a", 4, 2 * day, "0"),
        ("b", 5, day, "0"), ("b", 6, day + 5, "1"), ("c", 7, 0, "1"),
    ]
    rows = spark.createDataFrame(data, "mid string, seq long, ms long, is_new string").withColumn(
        "ts", F.timestamp_millis("ms")
    )
    for hot in (["a"], ()):
        out = keyed.repair_new_visitors(rows, "mid", "ts", "is_new", ["ts", "seq"], hot=hot)
        assert {r.seq: r.is_new for r in out.collect()} == {1: "1", 2: "1", 3: "0", 4: "0", 5: "0", 6: "0", 7: "1"}


def test_returning_users(spark):
    day = 86_400_000
    data = [("u", 1, 1000), ("u", 2, 2000), ("u", 3, 7 * day + 5), ("u", 4, 15 * day), ("w", 5, 0)]
    rows = spark.createDataFrame(data, "uid string, seq long, ms long").withColumn("ts", F.timestamp_millis("ms"))
    out = keyed.returning_users(rows, ["uid"], "ts", ["ts", "seq"])
    assert {r.seq: r.back_ct for r in out.collect()} == {1: 0, 3: 0, 4: 1, 5: 0}


def test_traffic_totals(spark, sf):
    from tideline.plans.tables import page_log

    pages = page_log(spark, sf)
    out = windows.traffic_window(pages, "1 hour").agg(F.sum("pv_ct"), F.sum("uv_ct"), F.sum("dur_sum")).first()
    want = pages.agg(F.count("*"), F.count_distinct("mid", F.to_date("ts")), F.sum("during_time")).first()
    assert tuple(out) == tuple(want)


def test_zero_window_of_replaced_rows_stays(spark):
    day = 86_400_000
    lines = spark.createDataFrame(
        [("x", 0, 0, 1, 10), ("x", day, 1, 2, 7)], "id string, ts_ms long, seq long, order_id long, amt long"
    ).selectExpr("*", "'p' AS province_id", "CAST(amt AS DECIMAL(16,2)) AS split_total_amount")
    marked = keyed.mark_superseded(lines, ["id"], ["ts_ms", "seq"])
    out = windows.province_order_window(marked, "1 day")
    got = {r.cur_date: (float(r.order_amount), r.order_count) for r in out.collect()}
    assert got == {"1970-01-01": (0.0, 0), "1970-01-02": (7.0, 1)}
    kept = windows.province_order_window(marked, "1 day", legacy_count=True)
    assert {r.cur_date: r.order_count for r in kept.collect()} == {"1970-01-01": 1, "1970-01-02": 1}


def test_last_versions_with_the_places_of_all(spark):
    """As marked versions, and of equal last versions one counts, as SQL's next row decides it."""
    day = 86_400_000
    lines = spark.createDataFrame(
        [(1, 0, 0, 10), (1, day, 1, 7), (2, day, 0, 5), (3, 2 * day, 0, 4), (3, 2 * day, 0, 4)], "id long, ts_ms long, seq long, amt long"
    ).selectExpr("*", "id AS order_id", "'p' AS province_id", "CAST(amt AS DECIMAL(16,2)) AS split_total_amount")
    place = ["order_id", "ts_ms", "province_id"]
    marked = keyed.last_and_places(lines, ["id"], ["ts_ms", "seq"], place, ["split_total_amount"])
    for legacy, counts in ((False, [0, 2, 1]), (True, [1, 2, 1])):
        out = windows.province_order_window(marked, "1 day", legacy_count=legacy).orderBy("stt").collect()
        assert [(float(r.order_amount), r.order_count) for r in out] == list(zip([0.0, 12.0, 4.0], counts))
