"""Streaming jobs fed file by file: several micro-batches give the batch result."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tideline.operators import keyed
from tideline.plans import streams
from tideline.plans.tables import ORDER, as_page_log, details, page_log, table
from tideline.session import new_folder
from tideline.sinks.writers import BatchTable, WindowTable, newest_rows, print_rows
from tideline.sources.readers import read_files
from tideline.streaming import bloom, changelog, history, processors
from tideline.streaming.runner import Job, bounded_delay, event_time, late_rows

SETS = ["os", "ch"]


@pytest.fixture(scope="module")
def pages(spark, sf):
    return page_log(spark, sf).select("seq", "mid", "uid", "ts", "ts_ms", "is_new", "os", "ch", "page_id")


@pytest.fixture(scope="module")
def feed(spark, pages, tmp_path_factory):
    """The page log as three files in time order, one file per micro-batch."""
    folder = str(tmp_path_factory.mktemp("feed"))
    bounds = [0, 300, 650, 10**9]
    for i in range(3):
        part = pages.where((F.col("seq") >= bounds[i]) & (F.col("seq") < bounds[i + 1])).coalesce(1)
        part.write.mode("append").parquet(folder)
    return read_files(spark, folder, pages.schema, "*.parquet", max_files=1)


def run(spark, name, source, each=None, mode="append", **job):
    table = BatchTable(spark, new_folder(spark, name))
    batches = []

    def write(batch, batch_id):
        batches.append(batch_id)
        out = each(batch, batch_id) if each else batch
        # A repeated batch must give the same result.
        table.write(out, batch_id)
        if each:
            table.write(each(batch, batch_id), batch_id)

    options = {"interval": None, **job}
    query = Job(name, new_folder(spark, f"{name}-cp"), each_batch=write, output_mode=mode, **options).run(source, 240)
    return table, batches, query


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def test_daily_uniques(spark, pages, feed):
    seen = BatchTable(spark, new_folder(spark, "seen"))
    part = feed.select("mid", "ts", "seq")

    def each(batch, n):
        return history.daily_uniques(batch, n, seen, ["mid"], "ts", ["ts", "seq"])

    table, batches, _ = run(spark, "t-daily", part, each)
    want = keyed.first_of_day(pages.select("mid", "ts", "seq"), ["mid"], "ts", ["ts", "seq"])
    assert len(batches) == 3
    assert rows(table.read(want.schema), "mid", "seq") == rows(want, "mid", "seq")


def test_keyed_state_across_batches(spark, pages, feed):
    part = feed.select("mid", "seq", "ts", F.to_date("ts").alias("visit_date"))
    out = processors.daily_unique_stream(part, "mid", ["ts", "seq"])
    table, batches, _ = run(spark, "t-state", out)
    want = keyed.first_of_day(pages.select("mid", "ts", "seq"), ["mid"], "ts", ["ts", "seq"])
    assert len(batches) >= 3
    assert rows(table.read(out.schema), "mid", "seq") == rows(want, "mid", "seq")


def test_keyed_state_with_ttl_runs_once(spark, feed, pages):
    part = feed.select("mid", "seq", "ts", F.to_date("ts").alias("visit_date"))
    out = processors.daily_unique_stream(part, "mid", ["ts", "seq"], ttl_ms=86_400_000)
    table, _, _ = run(spark, "t-ttl", out, once=True)
    assert table.read(out.schema).count() > 0


def test_returning_users_across_batches(spark, pages, feed):
    known = F.col("uid").isNotNull()
    part = feed.where(known).select("uid", "seq", "ts", F.to_date("ts").alias("visit_date"))
    out = processors.returning_user_stream(part, "uid", ["ts", "seq"], gap_days=2)
    table, _, _ = run(spark, "t-login", out)
    want = keyed.returning_users(pages.where(known).select("uid", "ts", "seq"), ["uid"], "ts", ["ts", "seq"], 2)
    got = rows(table.read(out.schema), "uid", "seq", "uu_ct", "back_ct")
    assert got == rows(want, "uid", "seq", "uu_ct", "back_ct")
    assert any(r[3] for r in got)


def test_visitor_repair(spark, pages, feed):
    part = pages.select("seq", "mid", "ts", "is_new")
    rows_in = feed.select(*part.columns, F.to_date("ts").alias("visit_date"))
    table, batches, _ = run(spark, "t-repair", processors.visitor_repair_stream(rows_in, "mid", ["ts", "seq"], "is_new"))
    want = keyed.repair_new_visitors(part, "mid", "ts", "is_new", ["ts", "seq"])
    assert len(batches) >= 3
    assert rows(table.read(part.schema), "seq", "is_new") == rows(want, "seq", "is_new")


def test_profiles(spark, pages, feed):
    part = pages.select("seq", "mid", "ts", *SETS)
    out = processors.running_profile_stream(feed.select(*part.columns), "mid", ["ts", "seq"], SETS)
    table, _, _ = run(spark, "t-profile", out)
    want = keyed.running_profile(part, "mid", ["ts", "seq"], SETS, "ts")
    assert rows(table.read(want.schema), "seq", "pv", *SETS) == rows(want, "seq", "pv", *SETS)


@pytest.mark.parametrize("form", ["profile", "repair"])
def test_a_batch_reads_and_updates_no_more_as_the_job_ages(spark, tmp_path, form):
    """The same visitors with the same values in every batch: rows read and state entries do not grow."""
    folder = str(tmp_path / "ageing")
    for n in range(5):
        spark.range(60).selectExpr(
            f"{n} * 1000 + id AS seq", "concat('m', id % 20) AS mid", f"timestamp_seconds({n} * 100000 + id) AS ts",
            "concat('os', id % 3) AS os", "concat('ch', id % 2) AS ch", "'1' AS is_new", f"to_date(timestamp_seconds({n} * 100000 + id)) AS visit_date",
        ).coalesce(1).write.mode("append").parquet(folder)
    source = read_files(spark, folder, spark.read.parquet(folder).schema, "*.parquet", max_files=1)
    out = (processors.running_profile_stream(source, "mid", ["ts", "seq"], SETS) if form == "profile"
           else processors.visitor_repair_stream(source, "mid", ["ts", "seq"], "is_new"))
    _, _, query = run(spark, f"t-age-{form}", out)
    progress = [p for p in query.recentProgress if p["numInputRows"]]
    assert [p["numInputRows"] for p in progress] == [60] * 5
    totals = [sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in progress]
    updated = [sum(op["numRowsUpdated"] for op in p["stateOperators"]) for p in progress]
    assert len(set(totals)) == 1 and max(updated[1:]) <= updated[0]


# ---- changelogs -----------------------------------------------------------

def order_streams(spark, tmp_path, batches):
    """Streams of lines, orders and coupons from (lines, orders, coupons) of each batch."""
    kinds = {
        "lines": "id string, order_id long, amount decimal(10,2), at timestamp", "orders": "order_id long, user_id long, v long",
        "coupons": "id string, order_id long, coupon_id long, v long",
    }
    found = []
    for i, (name, schema) in enumerate(kinds.items()):
        folder = str(tmp_path / name)
        for parts in batches:
            spark.createDataFrame(parts[i], schema).coalesce(1).write.mode("append").parquet(folder)
        found.append(read_files(spark, folder, spark.read.parquet(folder).schema, "*.parquet", max_files=1))
    return found


def day(n):
    return datetime.datetime(2024, 1, n, 1, 2, 3, 456789)


BATCHES = [
    # A line before its order; an order before its lines; a coupon before its line.
    ([("a", 1, Decimal("1.10"), day(1)), ("b", 1, Decimal("2.20"), day(2)), ("n", None, Decimal("1"), day(1))], [(2, 20, 1), (None, 9, 1)], [("c", 2, 7, 1)]),
    # The late order, a line of the other one, and a repeated line.
    ([("c", 2, Decimal("3.30"), None), ("a", 1, Decimal("1.10"), day(1))], [(1, 10, 5)], []),
    # A late coupon takes rows back; an order is replaced; an older version of it does not count.
    ([("d", 3, Decimal("4.40"), day(4))], [(2, 21, 2), (1, 11, 4)], [("a", 1, 8, 1), ("a", 1, 9, 2), (None, 1, 1, 1)]),
]
FULL = [
    ("a", 1, Decimal("1.10"), day(1), 10, 9), ("a", 1, Decimal("1.10"), day(1), 10, 9), ("b", 1, Decimal("2.20"), day(2), 10, None),
    ("c", 2, Decimal("3.30"), None, 21, 7),
]


def joined_changes(spark, tmp_path, name, **kw):
    lines, orders, coupons = order_streams(spark, tmp_path, BATCHES)
    changes = changelog.join_changes(lines, orders, {"coupon": coupons}, "order_id", "id", version="v", **kw)
    table, _, query = run(spark, name, changes)
    return table.read(changes.schema), changes.columns


@pytest.mark.parametrize("hot", [[], [1, 2]])
def test_a_changelog_folds_to_the_join(spark, tmp_path, hot):
    found, columns = joined_changes(spark, tmp_path, f"t-changes-{len(hot)}", hot=hot, salts=3)
    assert columns == ["row_kind", "id", "order_id", "amount", "at", "user_id", "coupon_id"]
    by_batch = {b: [r for r in found.collect() if r.batch == b] for b in range(3)}
    assert by_batch[0] == []
    assert sorted((r.row_kind, r.id) for r in by_batch[1]) == [("+", "a"), ("+", "a"), ("+", "b"), ("+", "c")]
    # Taken back: both copies of a without the coupon, and c with the replaced order.
    assert sorted((r.id, r.user_id, r.coupon_id) for r in by_batch[2] if r.row_kind == "-" and r.coupon_id in (None, 7)) == [
        ("a", 10, None), ("a", 10, None), ("c", 20, 7)]
    assert sorted(map(tuple, changelog.fold(found.drop("batch")).collect()), key=str) == sorted(FULL, key=str)


def test_combined_extras_and_a_batch_that_runs_again(spark, tmp_path):
    """A job that fails after its batch was written repeats it from its checkpoint: the table is as if it had not."""
    lines, orders, coupons = order_streams(spark, tmp_path, BATCHES)
    changes = changelog.join_changes(
        lines, orders, {"coupon": coupons.drop("v")}, "order_id", "id", {"coupon": {"coupon_id": min}}, version="v")
    table = BatchTable(spark, new_folder(spark, "again"))
    failed = []

    def write(batch, batch_id):
        table.write(batch, batch_id)
        if batch_id in (1, 2) and batch_id not in failed:
            failed.append(batch_id)
            raise RuntimeError("lost after the write")

    job = Job("t-again", new_folder(spark, "t-again-cp"), each_batch=write, interval=None)
    for _ in range(2):
        with pytest.raises(Exception, match="lost after the write"):
            job.run(changes, 240)
    job.run(changes, 240)
    assert failed == [1, 2]
    want = [(*r[:-1], 8 if r[0] == "a" else r[-1]) for r in FULL]
    assert sorted(map(tuple, changelog.fold(table.read(changes.schema).drop("batch")).collect()), key=str) == sorted(want, key=str)


def test_a_changelog_of_tables_needs_no_window(spark):
    """The sides of a batch are aggregated and joined; a batch that runs again gives the same changes."""
    kinds = ("id string, order_id long, amount decimal(10,2), at timestamp", "order_id long, user_id long, v long",
             "id string, order_id long, coupon_id long, v long")
    sides, table = (BatchTable(spark, new_folder(spark, f"t-{n}")) for n in ("sides", "joined"))
    for n, parts in enumerate(BATCHES):
        lines, orders, coupons = (spark.createDataFrame(p, k) for p, k in zip(parts, kinds))
        both = history.join_sides(lines, orders, {"coupon": coupons.drop("v")}, "order_id", "id")
        for _ in range(2):
            out = history.joined_changes(both, n, sides, {"coupon": {"coupon_id": F.max}}, version="v")
            table.write(out, n)
        text = out._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in text and "Join" in text
    assert out.columns == ["row_kind", "id", "order_id", "amount", "at", "user_id", "coupon_id"]
    found = table.read(out.schema)
    assert sorted((r.row_kind, r.id) for r in found.where("batch = 1").collect()) == [("+", "a"), ("+", "a"), ("+", "b"), ("+", "c")]
    assert sorted(map(tuple, changelog.fold(found.drop("batch")).collect()), key=str) == sorted(FULL, key=str)


def test_a_stream_keeps_no_rows_in_memory_by_shuffle_partition(spark, sf, monkeypatch):
    kept = []
    monkeypatch.setattr(type(spark.range(1)), "persist", lambda self, *a: kept.append(self) or self)
    assert streams.stream_province(spark, sf).count() > 0
    assert kept == []


def test_a_slice_of_a_feed_is_many_files(spark, sf):
    """One small file would be one task of the stream, whatever the cores."""
    feed = streams.Feed(spark, sf, "events")
    feed.land(0)
    files = spark.read.parquet(feed.path).select(F.input_file_name()).distinct().count()
    assert files >= spark.sparkContext.defaultParallelism > 1


def test_made_rows_of_a_feed_are_made_once(spark, sf):
    rows = table(spark, sf, "events").groupBy("user_id").agg(F.max("ts").alias("ts"))
    feed = streams.Feed(spark, sf, "events", rows)
    assert "Aggregate" not in feed.rows._jdf.queryExecution().executedPlan().toString()
    for k in range(streams.SLICES):
        feed.land(k)
    assert spark.read.parquet(feed.path).exceptAll(rows).count() == 0 and spark.read.parquet(feed.path).count() == rows.count()


def test_timed_retraction(spark, tmp_path):
    """A version within the limit is taken back, one beyond it is not; a timer forgets it once the watermark has passed."""
    folder = str(tmp_path / "versions")
    for part in ([("a", 1_000, 1), ("b", 1_000, 2)], [("a", 11_000, 3), ("b", 11_001, 4), ("c", 30_000, 5)], [("c", 30_500, 6), ("c", 60_000, 7)]):
        spark.createDataFrame(part, "id string, ts_ms long, n long").coalesce(1).write.mode("append").parquet(folder)
    source = read_files(spark, folder, "id string, ts_ms long, n long", "*.parquet", max_files=1)
    out = changelog.retraction_stream(source, ["id"], ["ts_ms", "n"], ["n"], "ts_ms", 10_000)
    table, _, query = run(spark, "t-timed", out)
    got = sorted((r.id, r.ts_ms, r.n, r.row_kind) for r in table.read(out.schema).collect())
    assert got == sorted([
        ("a", 1_000, 1, "+"), ("a", 1_000, -1, "-"), ("a", 11_000, 3, "+"), ("b", 1_000, 2, "+"), ("b", 11_001, 4, "+"),
        ("c", 30_000, 5, "+"), ("c", 30_000, -5, "-"), ("c", 30_500, 6, "+"), ("c", 60_000, 7, "+"),
    ])
    # The versions of a and b are forgotten; that of c, its timer and its index entries are left.
    last = query.recentProgress[-1]["stateOperators"][0]
    most = max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress)
    assert last["numRowsTotal"] < most and last["numRowsRemoved"] + sum(
        p["stateOperators"][0]["numRowsRemoved"] for p in query.recentProgress) > 0


def test_a_late_match_of_an_outer_join(spark, tmp_path):
    """A partner within the delay joins; a later one is dropped, and the row has come out alone."""
    from tideline.streaming.joins import interval_join_stream

    left, right = str(tmp_path / "left"), str(tmp_path / "right")
    schema = {left: "k long, l_ms long", right: "k long, r_ms long"}

    def put(path, *rows_in):
        spark.createDataFrame(list(rows_in), schema[path]).coalesce(1).write.mode("append").parquet(path)

    def source(path, ms, out):
        return event_time(read_files(spark, path, schema[path]), ms, out)

    put(left, (1, 100_000), (2, 100_000), (3, 100_000))
    put(right, (9, 100_000))
    pairs = interval_join_stream(source(left, "l_ms", "lt"), source(right, "r_ms", "rt"), "k", "lt", "rt", -5_000, 5_000, how="left")
    pairs = pairs.select("k", "l_ms", "r_ms")
    table = BatchTable(spark, new_folder(spark, "outer"))
    job = Job("t-outer", new_folder(spark, "t-outer-cp"), each_batch=table.write, interval=None)
    job.run(pairs, 240)
    # Behind the newest right row, but not by more than the delay.
    put(right, (1, 98_000))
    put(left, (8, 200_000))
    job.run(pairs, 240)
    put(right, (8, 200_000), (7, 210_000))
    put(left, (7, 300_000))
    job.run(pairs, 240)
    put(right, (2, 99_000), (6, 300_000))
    job.run(pairs, 240)
    got = sorted((r.k, r.r_ms) for r in table.read(pairs.schema).where("k < 5").collect())
    assert sorted(got, key=str) == [(1, 98_000), (2, None), (3, None)]


# ---- keyed windows and the filter -----------------------------------------

def test_a_window_table_rewrites_touched_parts_only(spark):
    t = WindowTable(spark, new_folder(spark, "windows"), "stt", ["k"])
    schema = spark.createDataFrame([], "stt string, k int, n long").schema

    def write(batch, *rows_in):
        t.upsert(spark.createDataFrame(list(rows_in), schema), batch)

    def now(**kw):
        return sorted(map(tuple, t.current(schema, **kw).collect()))

    write(0, ("2024-01-05 00:00:00", 1, 1), ("2024-01-06 00:00:00", 1, 2), ("2024-02-01 00:00:00", 1, 3))
    write(1, ("2024-01-05 00:00:00", 2, 4), ("2024-01-06 00:00:00", 1, 5))
    want = [("2024-01-05 00:00:00", 1, 1), ("2024-01-05 00:00:00", 2, 4), ("2024-01-06 00:00:00", 1, 5), ("2024-02-01 00:00:00", 1, 3)]
    assert now() == want
    write(1, ("2024-01-05 00:00:00", 2, 4), ("2024-01-06 00:00:00", 1, 5))
    assert now() == want and now(before=1)[1] == ("2024-01-06 00:00:00", 1, 2)
    # A corrected row; February is not written again.
    write(2, ("2024-01-06 00:00:00", 1, 6))
    assert now() == [*want[:2], ("2024-01-06 00:00:00", 1, 6), want[3]]
    parts = t._stored(schema).select("part", "batch").distinct().collect()
    assert sorted((r.part, r.batch) for r in parts) == [("2024-01", 0), ("2024-01", 1), ("2024-01", 2), ("2024-02", 0)]


def test_a_window_sink_of_a_stream_reads_back_as_the_batch(spark, pages, feed):
    """Counts by window, each batch written twice."""
    t = WindowTable(spark, new_folder(spark, "sink"), "stt", ["os"])
    part = feed.select("ts", "os")
    schema = spark.createDataFrame([], "stt string, os string, n long").schema

    def counts(df):
        return df.groupBy(F.date_format(F.date_trunc("day", "ts"), "yyyy-MM-dd HH:mm:ss").alias("stt"), "os").agg(F.count("*").alias("n"))

    def each(batch, n):
        for _ in range(2):
            new = counts(batch).unionByName(t.touched(counts(batch), n)).groupBy("stt", "os").agg(F.sum("n").alias("n"))
            t.upsert(new, n)

    Job("t-sink", new_folder(spark, "t-sink-cp"), each_batch=each, interval=None).run(part, 240)
    assert rows(t.current(schema), "stt", "os", "n") == rows(counts(pages), "stt", "os", "n")


@pytest.mark.parametrize("n,p", [(20_000, 0.01), (20_000, 0.05)])
def test_the_filter_keeps_its_rate_and_loses_nothing(spark, n, p):
    shape = bloom.BloomShape.for_keys(n, p)
    assert bloom.false_positives(n / shape.words, shape.hashes) <= p and shape.words * 64 < 20 * n
    held, other = spark.range(n).selectExpr("id", "id * 7 AS t"), spark.range(n, 3 * n).selectExpr("id", "id * 7 AS t")
    half = [held.where(f"id % 2 = {k}") for k in (0, 1)]
    words = bloom.merge_filters(*[bloom.add_keys(h, ["id", "t"], shape) for h in half])
    assert words.count() <= shape.words
    assert bloom.maybe_seen(held, ["id", "t"], words, shape).where("NOT maybe").count() == 0
    wrong = bloom.maybe_seen(other, ["id", "t"], words, shape).where("maybe").count()
    assert wrong <= 2 * n * p * 1.15
    assert bloom.maybe_seen(other, ["id", "t"], words.limit(0), shape).where("maybe").count() == 0


def test_filtered_deduplication_in_batches(spark, tmp_path):
    """A filter far too small: nearly every key may have been seen, and still no row is lost or repeated."""
    filters, seen = (BatchTable(spark, new_folder(spark, n)) for n in ("words", "seen"))
    shape = bloom.BloomShape(4, 3)
    found = []
    for n in range(3):
        batch = spark.range(200).selectExpr(f"(id + {n} * 70) % 300 AS k", "'x' AS v").unionByName(
            spark.createDataFrame([(1, "x"), (1, "x")], "k long, v string"))
        for _ in range(2):
            fresh = bloom.new_rows(batch, n, filters, seen, ["k"], shape)
        found += [(n, r.k) for r in fresh.collect()]
    assert sorted(k for _, k in found) == list(range(300))


def test_retractions(spark, sf, tmp_path):
    lines = details(spark, sf).select("id", *ORDER)
    edges = lines.approxQuantile("ts_ms", [0.3, 0.6], 0.01)
    for low, high in zip([0, *edges], [*edges, 10**15]):
        lines.where((F.col("ts_ms") >= low) & (F.col("ts_ms") < high)).coalesce(1).write.mode("append").parquet(
            str(tmp_path / "lines")
        )
    versions = BatchTable(spark, new_folder(spark, "versions"))
    measure = ["split_original_amount"]

    def each(batch, n):
        return history.retractions(batch, n, versions, ["id"], ORDER, measure)

    source = read_files(spark, str(tmp_path / "lines"), lines.schema, "*.parquet", max_files=1)
    table, batches, _ = run(spark, "t-retract", source, each)
    want = keyed.retract(lines, ["id"], ORDER, measure)
    # File order is write order, so versions arrive in time order.
    assert len(batches) == 3
    assert rows(table.read(want.schema), "id", *ORDER, "row_kind") == rows(want, "id", *ORDER, "row_kind")


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    folder = str(tmp_path / "late")
    spark.createDataFrame([(1, 100_000), (2, 200_000)], "id int, ms long").coalesce(1).write.mode("append").parquet(folder)
    spark.createDataFrame([(3, 300_000)], "id int, ms long").coalesce(1).write.mode("append").parquet(folder)
    spark.createDataFrame([(4, 50_000), (5, 300_001)], "id int, ms long").coalesce(1).write.mode("append").parquet(folder)
    source = bounded_delay(event_time(read_files(spark, folder, "id int, ms long", max_files=1), "ms"), "et")
    counts = source.groupBy(F.window("et", "10 seconds")).count()
    table, _, query = run(spark, "t-late", counts.select("window.start", "count"), mode="update")
    starts = newest_rows(table.read(counts.select("window.start", "count").schema), ["start"])
    assert starts.count() == 3
    assert late_rows(query) >= 1


def test_missing_event_time_is_the_epoch(spark):
    df = event_time(spark.createDataFrame([(None,)], "ms long"), "ms")
    assert df.first().et.timestamp() == 0


def test_batch_table_upserts_and_compacts(spark):
    t = BatchTable(spark, new_folder(spark, "upsert"))
    schema = spark.createDataFrame([], "id int, v string, op string").schema
    assert t.read(schema).count() == 0
    t.write(spark.createDataFrame([(1, "a", "c"), (2, "b", "c")], schema), 0)
    t.write(spark.createDataFrame([(1, "x", "u"), (2, None, "d")], schema), 1)
    t.write(spark.createDataFrame([(1, "y", "u"), (2, None, "d")], schema), 1)
    live = newest_rows(t.read(schema), ["id"], op="op")
    assert [(r.id, r.v) for r in live.collect()] == [(1, "y")]
    assert newest_rows(t.read(schema, before=1), ["id"], op="op").count() == 2
    fresh = BatchTable(spark, new_folder(spark, "compact"))
    t.compact_into(fresh, live.drop("batch"))
    assert fresh.read(schema).count() == 1


def test_config_is_read_again_for_every_batch(spark, tmp_path):
    from tideline.operators import cdc

    folder = str(tmp_path / "changes")
    def put(i):
        spark.createDataFrame([({"id": str(i)}, "c", i)], "after map<string,string>, op string, ts_ms long").selectExpr(
            "CAST(NULL AS MAP<STRING,STRING>) AS before", "after", "map('table', 't', 'db', 'd') AS source", "op", "ts_ms"
        ).coalesce(1).write.mode("append").parquet(folder)

    for i in range(3):
        put(i)
    source = read_files(spark, folder, spark.read.parquet(folder).schema, max_files=1)
    store = BatchTable(spark, new_folder(spark, "routed"))
    targets = {0: "one", 1: "two", 2: "two"}

    def each(batch, n):
        config = spark.createDataFrame(
            [("t", targets[n], "id", "info", "id")],
            "source_table string, sink_table string, sink_columns string, sink_family string, sink_row_key string",
        )
        history.routed_upserts(cdc.keep_changes(batch), n, config, store)

    Job("t-config", new_folder(spark, "t-config-cp"), each_batch=each, interval=None).run(source, 120)
    got = spark.read.parquet(store.path)
    assert sorted((r.row_key, r.sink_table) for r in got.collect()) == [("0", "one"), ("1", "two"), ("2", "two")]


def test_processing_time_window(spark):
    from tideline.operators.windows import tumble_processing_time

    out = tumble_processing_time(spark.range(5), "10 seconds", [], [F.count("*").alias("n")])
    assert out.agg(F.sum("n").alias("n")).first().n == 5


def test_print_rows(spark, capsys):
    assert print_rows(spark.range(1)) is None
    assert "id" in capsys.readouterr().out


def test_cluster_session_needs_a_shared_folder(spark):
    from tideline.session import shared_root

    root = spark.conf.get("spark.checkpoint.dir", None)
    assert root is None or shared_root(spark) == root.rstrip("/")


def test_page_log_stream_has_the_batch_columns(spark, sf):
    assert as_page_log(table(spark, sf, "events")).columns == page_log(spark, sf).columns


def test_state_partitions_are_set_for_one_job(spark, feed):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    _, _, query = run(spark, "t-partitions", feed.select("mid").dropDuplicates(["mid"]), partitions=2)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    operators = [op for p in query.recentProgress for op in p["stateOperators"]]
    assert {op["numShufflePartitions"] for op in operators} == {2}
