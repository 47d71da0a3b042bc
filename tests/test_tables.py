"""State in tables: jobs over lines and visitors without a Python call for each key."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tideline.operators import keyed
from tideline.plans import streams
from tideline.plans.registry import QUERIES
from tideline.plans.tables import page_log
from tideline.session import new_folder
from tideline.sinks.writers import BatchTable
from tideline.streaming import changelog, history


def state(spark, name):
    return BatchTable(spark, new_folder(spark, name))


@pytest.mark.parametrize("name", [
    "stream_order_cancel", "stream_order_detail", "stream_province", "stream_retract_ttl", "stream_daily_unique", "stream_login",
    "stream_first_seen", "stream_cart", "stream_home_detail", "stream_profile", "stream_visitor_repair", "stream_daily_unique_ttl"])
def test_streams_call_no_python_for_a_key(spark, sf, monkeypatch, name):
    """Millions of lines and visitors: the keys stay in the JVM."""
    from pyspark.sql import GroupedData

    def refuse(*args, **kw):
        raise AssertionError("a Python processor for each key")

    for method in ("transformWithState", "transformWithStateInPandas"):
        monkeypatch.setattr(GroupedData, method, refuse)
    assert streams.QUERIES[name](spark, sf).limit(1).count() == 1


def test_retraction_in_tables_with_late_versions(spark):
    """A version between two stored ones takes back itself only; a batch that runs again leaves the same changes."""
    versions = state(spark, "late-versions")
    batches = [[("a", 10, 1), ("a", 30, 3), ("b", 1, 1)], [("a", 20, 2)], [("a", 40, 4), ("a", 5, 0)]]
    want = [
        [("a", 10, "+", 1), ("a", 10, "-", -1), ("a", 30, "+", 3), ("b", 1, "+", 1)],
        [("a", 20, "+", 2), ("a", 20, "-", -2)],
        [("a", 30, "-", -3), ("a", 40, "+", 4), ("a", 5, "+", 0), ("a", 5, "-", 0)],
    ]
    for n, rows in enumerate(batches):
        batch = spark.createDataFrame(rows, "id string, ts long, n long")
        for _ in range(2):
            out = history.retractions(batch, n, versions, ["id"], ["ts"], ["n"])
            assert sorted((r.id, r.ts, r.row_kind, r.n) for r in out.collect()) == sorted(want[n])
    net = history.changes(versions, batch.schema).groupBy("id").agg(F.sum("n").alias("n"))
    assert sorted(map(tuple, net.collect())) == [("a", 4), ("b", 1)]


def test_a_version_beyond_the_limit_is_not_read_again(spark):
    versions = state(spark, "limit-versions")
    first = spark.createDataFrame([("a", 1_000, 1), ("b", 1_000, 2), ("c", 500, 9)], "id string, ts long, n long")
    history.retractions(first, 0, versions, ["id"], ["ts"], ["n"], "ts", 10_000)
    second = spark.createDataFrame([("a", 11_000, 3), ("b", 11_001, 4)], first.schema)
    got = history.retractions(second, 1, versions, ["id"], ["ts"], ["n"], "ts", 10_000)
    assert sorted((r.id, r.ts, r.row_kind) for r in got.collect()) == [("a", 1_000, "-"), ("a", 11_000, "+"), ("b", 11_001, "+")]


def test_joined_changes_take_back_what_a_late_side_changes(spark):
    line, head, gift = "id string, k long, v decimal(5,2)", "k long, u long, at long", "k long, id string, g long"
    batches = [
        ([("a", 1, Decimal("1.5")), ("a", 1, Decimal("1.5")), ("n", None, None)], [(2, 20, 1), (None, 0, 0)], [(2, "c", 7)]),
        ([("c", 2, None)], [(1, 10, 5)], []),
        ([], [(1, 11, 4), (2, 21, 2)], [(1, "a", 8), (1, "a", 9), (1, None, 5)]),
    ]
    sides, found = state(spark, "sides"), state(spark, "changes")
    for n, (lines, heads, gifts) in enumerate(batches):
        both = history.join_sides(
            spark.createDataFrame(lines, line), spark.createDataFrame(heads, head), {"gift": spark.createDataFrame(gifts, gift)}, "k", "id")
        for _ in range(2):
            found.write(history.joined_changes(both, n, sides, {"gift": {"g": F.max}}, "at"), n)
    out = found.read(history.joined_changes(both, 2, sides, {"gift": {"g": F.max}}, "at").schema)
    last = sorted((r.row_kind, r.id, r.u, r.g) for r in out.where("batch = 2").collect())
    assert last == sorted([("-", "a", 10, None)] * 2 + [("+", "a", 10, 9)] * 2 + [("-", "c", 20, 7), ("+", "c", 21, 7)])
    folded = sorted((r.id, r.u, r.g) for r in changelog.fold(out.drop("batch")).collect())
    assert folded == [("a", 10, 9), ("a", 10, 9), ("c", 21, 7)]


def slices(spark, sf):
    pages = page_log(spark, sf).select("seq", "mid", "ts", "is_new", "os", "ch")
    return pages, [pages.where((F.col("seq") >= low) & (F.col("seq") < high)) for low, high in ((0, 300), (300, 650), (650, 10**9))]


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def in_batches(spark, parts, name, step):
    """Each batch twice: a batch that runs again gives the same."""
    kept, out = state(spark, name), []
    for n, part in enumerate(parts):
        first, second = (step(part, n, kept).collect() for _ in range(2))
        assert sorted(first, key=str) == sorted(second, key=str)
        out += first
    return out


@pytest.mark.parametrize("form", ["profile", "repair", "returning"])
def test_visitors_in_tables_give_the_batch_result(spark, sf, form):
    pages, parts = slices(spark, sf)
    order, sets = ["ts", "seq"], ["os", "ch"]
    if form == "profile":
        step = lambda b, n, t: history.running_profile(b, n, t, "mid", order, sets, "ts")
        want, columns = keyed.running_profile(pages, "mid", order, sets, "ts"), ["seq", "pv", *sets]
    elif form == "repair":
        step = lambda b, n, t: history.repaired_visitors(b, n, t, "mid", "ts", "is_new", order)
        want, columns = keyed.repair_new_visitors(pages, "mid", "ts", "is_new", order), ["seq", "is_new"]
    else:
        step = lambda b, n, t: history.returning_users(b, n, t, ["mid"], "ts", order, 2)
        want, columns = keyed.returning_users(pages, ["mid"], "ts", order, 2), ["seq", "uu_ct", "back_ct"]
    got = in_batches(spark, parts, f"visitors-{form}", step)
    assert sorted((tuple(r[c] for c in columns) for r in got), key=str) == rows(want, *columns)


@pytest.mark.parametrize("name", ["comment_fact", "comment_named", "refund_fact", "cdc_route_dim"])
def test_rows_are_not_shuffled_by_a_key_with_few_values(spark, sf, name):
    """The small dictionary goes to the rows: its key, of a few values, deals no rows to tasks."""
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    few = ("appraise", "dic_code", "_row_key", "row_key", "refund_type", "refund_reason_type")
    assert not [line for line in dealt if any(f"hashpartitioning({c}#" in line for c in few)]
    # Configurations may be grouped by their own key; the rows are joined to them where they are.
    assert "SortMergeJoin [source_table" not in plan and "SortMergeJoin [appraise" not in plan
    assert "BroadcastHashJoin" in plan


def test_shuffles_grow_with_the_input(spark, tmp_path):
    """A task's share stays the same: the number of partitions follows the files, and a larger setting stays."""
    from tideline.session import grow_shuffle

    name, needed = "spark.sql.shuffle.partitions", 9 * 3
    before = spark.conf.get(name)
    (tmp_path / "part").write_bytes(b"x" * (9 << 20))
    try:
        assert grow_shuffle(spark, str(tmp_path), target_mb=1) == needed == int(spark.conf.get(name))
        spark.conf.set(name, "100")
        assert grow_shuffle(spark, str(tmp_path), target_mb=1) == 100
    finally:
        spark.conf.set(name, before)
