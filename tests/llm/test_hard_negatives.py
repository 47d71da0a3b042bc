"""Hard negatives against a plain search of all pairs in Python integers."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tideline.llm import hard_negatives as hn
from tideline.llm.labelled import smallest_hashes


def brute(rows, step):
    """``rows`` of (vec_id, label, integer vector)."""
    found = {}
    size = max((len(v) for *_, v in rows), default=0)
    rows = sorted((i, k, v + [0] * (size - len(v))) for i, k, v in rows)
    for a, label, v in rows:
        if a % step:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, k) for i, k, w in rows if i != a)
        for s, p, _ in [x for x in scored if x[2] == label][:5]:
            fit = [(i, -n) for n, i, k in scored if k != label and 50 * -s <= 100 * -n <= 95 * -s]
            for rank, (i, n) in enumerate(fit[:3], 1):
                found[a, p, rank] = (i, -s, n)
    return found


def whole(vector):
    return [math.floor(256 * x) for x in vector]


def result(df):
    return {(r.anchor_id, r.positive_id, r["rank"]): (r.negative_id, r.positive_score, r.negative_score) for r in df.collect()}


def frame(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, label int, embedding array<{kind}>")


def drawn(n, dim, seed, spread=0.4):
    """Clusters, exact copies of a hot vector, ties and far-away rows."""
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    rows = []
    for i in range(n):
        if i % 3 == 0:
            v = [round(x * 8) / 8 for x in centres[0]]
        else:
            v = [round((x + r.gauss(0, spread)) * 8) / 8 for x in r.choice(centres)]
        rows.append((i, r.randrange(4), v))
    return rows


@pytest.mark.parametrize("kind", ["float", "double"])
def test_all_pairs(spark, kind):
    rows = drawn(700, 6, 1)
    got = result(hn.mine(hn.usable(frame(spark, rows, kind)), F.col("vec_id") % 20 == 0))
    assert got == brute([(i, k, whole(v)) for i, k, v in rows], 20) and len(got) > 300


def test_blocks_and_pieces(spark, monkeypatch):
    """Small pieces, blocks and products cut the hot leaf and the anchors, and a large tree is searched in parts."""
    for name, value in (("PIECE", 40), ("BLOCK", 7), ("CELLS", 900), ("SAMPLE", 200), ("LEAST_SAMPLE", 10)):
        monkeypatch.setattr(hn, name, value)
    rows = drawn(600, 5, 2)
    got = result(hn.mine(hn.usable(frame(spark, rows)), F.col("vec_id") % 10 == 0))
    assert got == brute([(i, k, whole(v)) for i, k, v in rows], 10)


def test_the_sample(spark, sf):
    df = hn.relabelled(hn.usable(spark.read.parquet(f"{sf}/embeddings.parquet")))
    rows = [(r.vec_id, r.label, whole(r.embedding)) for r in df.collect()]
    assert result(hn.mine(df, F.col("vec_id") % 50 == 0)) == brute(rows, 50)


def test_values_beyond_the_floats(spark):
    """Components whose products leave the exact floats, in rows of equal rounded scores."""
    big = [(0, 1, [3e6, 1.0]), (1, 1, [2e6, 0.5]), (2, 2, [1.5e6, 0.25]), (3, 2, [1.5e6, 0.75]), (4, 3, [1.2e6, -7.0]), (5, 1, [1e-3, 1e6])]
    got = result(hn.mine(hn.usable(frame(spark, big, "double")), F.col("vec_id") % 50 == 0))
    assert got == brute([(i, k, whole(v)) for i, k, v in big], 50) and got


def test_odd_rows(spark):
    """Nulls, repeats, shorter vectors and columns named like results; negative and zero scores."""
    nan, inf = float("nan"), float("inf")
    odd = [
        (0, 1, [1.0, 0.5]), (0, 1, [1.0, 0.5]), (1, 1, [0.9, 0.5]), (2, 2, [0.7, 0.4]), (3, 2, [0.7]), (4, None, [1.0, 1.0]),
        (5, 2, None), (6, 2, [None, 1.0]), (8, 2, [nan, 1.0]), (9, 2, [inf, 1.0]), (None, 2, [0.7, 0.4]), (10, 2, []),
        (50, 3, [-1.0, 0.0]), (51, 3, [1.0, 0.0]), (52, 4, [0.0, 0.0]), (100, 5, [0.0, 0.0]), (101, 5, [1.0, 1.0]), (0, 2, [0.1, 0.1]),
    ]
    df = frame(spark, odd).selectExpr("*", "'x' AS leaf", "'y' AS Score", "1 AS rank", "2 AS anchor_id")
    kept = [r for r in odd if None not in r[:2] and r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])]
    one = {r[0]: r for r in sorted(kept, key=lambda r: (r[0], r[1]), reverse=True)}
    got = result(hn.mine(hn.usable(df), F.col("vec_id") % 50 == 0))
    assert got == brute([(i, k, whole(v)) for i, k, v in one.values()], 50)
    assert got[0, 1, 1][0] == 51
    # A positive with score 0 takes negatives of score 0, in the order of ids.
    assert [got[100, 101, k][0] for k in (1, 2, 3)] == [0, 1, 2]
    assert hn.mine(hn.usable(df.limit(0)), F.col("vec_id") % 50 == 0).collect() == []


def test_subtrees_are_skipped(spark):
    """Anchors of tight clusters reach few leaves, and these hold all scores of the window."""
    import numpy as np

    r = np.random.default_rng(3)
    centres = r.integers(-200, 200, (8, 4))
    rows = (centres[r.integers(0, 8, 4000)] + r.integers(-6, 7, (4000, 4))).astype("i2")
    norms = (rows.astype(float) ** 2).sum(axis=1)
    tree = hn.Tree(rows[:1000], norms.max())
    leaf, seen = tree.descend(rows, norms)
    ranges = {}
    for number, d, nearest in seen:
        for j in np.unique(nearest):
            for i in range(d.shape[1]):
                ranges[number, i, int(j)] = (d[nearest == j, i].min(), d[nearest == j, i].max())
    tree.with_ranges([(*k, *v) for k, v in ranges.items()])
    anchors = rows[:50]
    scores = hn.inner(anchors, rows).astype(int)
    high = np.sort(scores, axis=1)[:, [-2]]
    low = high * 9 // 10
    found = tree.reach(anchors, low, high)
    for a, leaves in enumerate(found):
        assert set(leaf[(scores[a] >= low[a]) & (scores[a] <= high[a])]) <= set(leaves)
    assert np.mean([len(x) for x in found]) < tree.leaves / 2


def test_bounded_sample(spark):
    df = spark.range(100_000).withColumnRenamed("id", "vec_id").repartition(8)
    drawn_ids = smallest_hashes(df, "vec_id", 500, 100_000)
    assert drawn_ids.count() == 500
    assert df.where(F.shiftrightunsigned(F.xxhash64("vec_id"), 32) <= int((1.5 * 500 + 100) / 100_000 * (1 << 32))).count() < 1_100
