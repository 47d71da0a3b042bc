"""Changelog joins that take their keys in parts, and what they leave on disk."""

import os
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tideline.plans import streams, trade
from tideline.session import brief_shuffles, new_folder, parts_for
from tideline.sinks.writers import BatchTable
from tideline.streaming import changelog, history

LINE, HEAD, GIFT = "id string, k long, v decimal(5,2)", "k long, u long, at long", "k long, id string, g long"
BATCHES = [
    ([("a", 1, Decimal("1.5")), ("a", 1, Decimal("1.5")), ("n", None, None), ("d", 3, Decimal("2"))], [(2, 20, 1), (None, 0, 0)], [(2, "c", 7)]),
    ([("c", 2, None)], [(1, 10, 5), (3, 30, 1)], [(3, "d", 6)]),
    ([("e", 4, None)], [(1, 11, 4), (2, 21, 2)], [(1, "a", 8), (1, "a", 9), (1, None, 5)]),
]


def state(spark, name):
    return BatchTable(spark, new_folder(spark, name))


def shuffled(spark):
    """Shuffle files of this session that hold rows, with their sizes."""
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = (f"{d}/{name}" for top in manager.localDirsString() for d, _, names in os.walk(top) for name in names)
    return {f: os.path.getsize(f) for f in files if os.path.basename(f).startswith("shuffle_") and f.endswith(".data")}


def test_parts_of_the_keys_give_the_changes_of_all(spark):
    """Each part twice: what is written again replaces itself."""
    gifts = {"gift": {"g": F.max}}
    whole, sides, found = state(spark, "whole"), state(spark, "sides"), state(spark, "changes")
    for n, parts in enumerate(BATCHES):
        both = history.join_sides(
            *(spark.createDataFrame(p, s) for p, s in zip(parts[:2], (LINE, HEAD))), {"gift": spark.createDataFrame(parts[2], GIFT)}, "k", "id")
        want = sorted(map(str, history.joined_changes(both, n, whole, gifts, "at").collect()))
        for _ in range(2):
            stored = history.keep_sides(both, n, sides, 3)
            for part in range(3):
                out = history.side_changes(stored.where(F.col("part") == part), n, gifts, "at")
                found.write(out, n, part=part)
        got = found.read(out.schema).where(F.col("batch") == n)
        assert sorted(map(str, got.select(*out.columns).collect())) == want
    assert len({r.part for r in spark.read.parquet(sides.path).select("part").distinct().collect()}) > 1
    folded = sorted((r.id, r.u, r.g) for r in changelog.fold(found.read(out.schema).select(*out.columns)).collect())
    assert folded == [("a", 10, 9), ("a", 10, 9), ("c", 21, 7), ("d", 30, 6)]


def test_a_part_reads_its_own_files_only(spark):
    both = history.join_sides(
        spark.range(200).selectExpr("cast(id as string) id", "id k"), spark.range(200).selectExpr("id k", "id * 2 u"), {}, "k", "id")
    sides = state(spark, "own-sides")
    stored = history.keep_sides(both, 0, sides, 4)
    parts = [history.side_changes(stored.where(F.col("part") == p), 0, {}) for p in range(4)]
    assert "(part#" in parts[1]._jdf.queryExecution().executedPlan().toString().split("PartitionFilters:")[1]
    assert sorted(r.k for df in parts for r in df.collect()) == list(range(200)) and all(0 < df.count() < 200 for df in parts)


def test_the_number_of_parts_follows_the_files(spark, tmp_path):
    (tmp_path / "part").write_bytes(b"x" * (9 << 20))
    assert parts_for(spark, str(tmp_path), target_mb=4) == 3 and parts_for(spark, str(tmp_path)) == 1


def test_shuffle_files_end_with_their_action(spark, tmp_path):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    rows, before, setting = spark.range(50_000).repartition(3, "id"), shuffled(spark), spark.conf.get(name)
    with pytest.raises(KeyError), brief_shuffles(spark):
        rows.write.parquet(str(tmp_path / "out"))
        raise KeyError
    assert not set(shuffled(spark)) - set(before) and spark.conf.get(name) == setting
    assert spark.read.parquet(str(tmp_path / "out")).count() == 50_000


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Lines that repeat, have versions, no number, no order or no values; orders without key, user or time."""
    folder = str(tmp_path_factory.mktemp("odd"))
    stamp = lambda i: datetime(1995 + i % 6, 1 + i % 12, 1 + i % 28)
    lines = [
        # The id of a line without an order is its number alone, here unlike any order.
        (i % 40 if i % 13 else None, i % 7, i % 5 if i % 11 else None, (i % 4 if i % 13 else 900 + i) if i % 6 else None, float(i % 9), i * 1.25 if i % 8 else None,
         (i % 11) / 100, (i % 9) / 100, "R", "F", stamp(i * 7) if i % 17 else None) for i in range(300)]
    spark.createDataFrame(
        lines + lines[:40], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    ).repartition(3).write.parquet(f"{folder}/lineitem.parquet")
    placed = [(i if i % 10 else None, i % 6 if i % 4 else None, "F", 1.0, stamp(i * 3) if i % 9 else None, "1-URGENT") for i in range(45)]
    spark.createDataFrame(
        placed, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    ).write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(i, i % 3) for i in range(5)], "c_custkey long, c_nationkey int").write.parquet(f"{folder}/customer.parquet")
    return folder


@pytest.mark.parametrize("name", ["stream_order_detail", "stream_order_cancel"])
def test_the_fold_of_parts_is_the_batch_result(spark, odd, monkeypatch, name):
    monkeypatch.setattr(streams, "parts_for", lambda *a: 3)
    got, want = streams.QUERIES[name](spark, odd), trade.QUERIES[name.replace("stream_", "") + "_fact"](spark, odd)
    assert got.dtypes == [(n, dict(want.dtypes)[n]) for n in got.columns] and set(got.columns) == set(want.columns)
    rows = sorted(map(str, got.collect()))
    assert rows == sorted(map(str, want.select(*got.columns).collect())) and len(rows) > 200


def test_order_detail_leaves_no_shuffle_files(spark, sf):
    """The shuffles of all batches stayed until the job ended, and the fold moved all changes again with its result."""
    before = shuffled(spark)
    found = streams.stream_order_detail(spark, sf)
    assert found.count() > 0
    left = {f: size for f, size in shuffled(spark).items() if f not in before}
    # The edges of the slices and the count, not rows.
    assert sum(left.values()) < 50_000
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
