"""Hard negatives by a GNAT-style multiway hyperplane tree with exact leaves.

The score of two rows is the integer inner product of their vectors.  A
further coordinate, the root of ``R² - |x|²`` with the largest norm ``R``, puts
all rows on a sphere; an anchor has 0 there, so its squared distance from a
row is ``|a|² + R² - 2 * score`` and a window of scores is an annulus around it.

* A bounded sample of rows, those of the smallest id hashes, gives the split
  points of each node, chosen far apart.  A row goes to the nearest one, level
  by level, into a leaf.  All rows are indexed.
* Each split point keeps, for its own subtree and each sibling, the range of
  its distances to all rows there.  The ranges are minima and maxima over all
  rows; their number depends on the shape of the tree only.
* An anchor skips a subtree if for some split point the range does not meet
  what the annulus allows.  It is sent to the leaves that remain; a large leaf
  is cut into pieces, anchors into blocks, and every block is scored against a
  piece by one exact matrix product.
* The positives are searched the same way, in the window above the fifth best
  score among the rows of the anchor's label in the sample.

Nothing that grows with the table reaches the driver: split points, ranges and
leaf sizes are bounded, anchors and rows meet by a shuffle.

Defined results: rows with a null id, label, vector or component, or a
component that is not finite, take no part; of several rows of one id the one
with the smallest label and vector counts; components that a shorter vector
does not have are 0; scores beyond a long count as the largest or smallest
long; equal scores are ordered by id; an anchor without positives or a
positive without negatives gives no row; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tideline.llm.frames import bounded_batches, stored
from tideline.llm.labelled import smallest_hashes
from tideline.plans.tables import table

POSITIVES, NEGATIVES = 5, 3
#: Rows that the split points and the first bounds of a search are taken from.
SAMPLE = 4_096
#: Split points of a node, levels of nodes, and sample rows that a node needs.
ARITY, DEPTH, LEAST_SAMPLE = 8, 2, 64
#: Rows of a piece of a leaf, anchors of a block, and scores computed at once.
PIECE, BLOCK, CELLS = 8_192, 16_384, 2_000_000

_LIMIT = (1 << 63) - 1


# ---- exact arithmetic -------------------------------------------------------

def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of ``a`` and ``b``, exact, as floats while these are exact."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)))
    most = a.shape[1] * float(np.abs(a).max()) * float(np.abs(b).max())
    if most < 1 << 24:
        return a.astype(np.float32) @ b.astype(np.float32).T
    if most < 1 << 53:
        return a.astype(np.float64) @ b.astype(np.float64).T
    whole = [np.array([[int(x) for x in row] for row in m], dtype=object) for m in (a, b)]
    return np.clip(whole[0] @ whole[1].T, -_LIMIT, _LIMIT).astype(np.int64)


# ---- rows -------------------------------------------------------------------

def usable(embeddings: DataFrame) -> DataFrame:
    """``(vec_id, label, embedding)`` of the rows that take part, one per id."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = embeddings.where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~bad
    ).select("vec_id", "label", "embedding")
    one = rows.groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("r"))
    return one.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("r.label").cast("long").alias("label"), "r.embedding")


def whole_vectors(rows: DataFrame, scale: int = 256) -> tuple[DataFrame, str]:
    """``(vec_id, label, v, norm2)`` with ``floor(scale * x)`` as packed numbers, and their numpy type."""
    rows = stored(rows, "vectors")
    size, most = rows.agg(
        F.max(F.size("embedding")), F.max(F.array_max(F.transform("embedding", lambda x: F.abs(x.cast("double")))))
    ).first()
    top = scale * (most or 0) + 1
    kind = "<i2" if top < 1 << 15 else "<i4" if top < 1 << 31 else "<f8"
    bounded_batches(rows.sparkSession)

    def run(batches):
        for batch in batches:
            lists = batch.column("embedding")
            flat = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
            dense = np.zeros((len(lengths), size or 0))
            dense[np.arange(size or 0) < lengths[:, None]] = flat
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), batch.column("label"),
                pa.array([r.tobytes() for r in dense.astype(kind)], pa.binary()), pa.array((dense * dense).sum(axis=1)),
            ], ["vec_id", "label", "v", "norm2"])

    return rows.mapInArrow(run, "vec_id long, label long, v binary, norm2 double"), kind


def dense(column: pa.Array, kind: str) -> np.ndarray:
    """Packed vectors as the rows of a matrix."""
    parts = column.to_pylist()
    return np.frombuffer(b"".join(parts), dtype=kind).reshape(len(parts), len(parts[0]) // np.dtype(kind).itemsize if parts else 0)


# ---- tree -------------------------------------------------------------------

@dataclass
class Node:
    """Split points as rows of ``points`` with norms; children are nodes, or numbers of leaves."""

    points: np.ndarray
    norms: np.ndarray
    children: list
    low: np.ndarray | None = None
    high: np.ndarray | None = None


class Tree:
    """Nodes by number, the first being the root; without nodes everything is leaf 0."""

    def __init__(self, vectors: np.ndarray, radius2: float, arity: int = ARITY, depth: int = DEPTH, least: int = LEAST_SAMPLE):
        self.radius2, self.leaves = radius2, 0
        self.nodes: list[Node] = []
        self.root = self._build(vectors.astype(np.float64), arity, depth, least)

    def _build(self, rows: np.ndarray, arity: int, depth: int, least: int):
        """The number of a node, or ``("leaf", number)``."""
        if not depth or len(rows) < least or not len(chosen := self._far_apart(rows, arity)):
            self.leaves += 1
            return "leaf", self.leaves - 1
        node = Node(chosen, (chosen * chosen).sum(axis=1), [])
        self.nodes.append(node)
        number = len(self.nodes) - 1
        nearest = self.distances(node, rows, (rows * rows).sum(axis=1)).argmin(axis=1)
        node.children = [self._build(rows[nearest == j], arity, depth - 1, least) for j in range(len(chosen))]
        return number

    def _far_apart(self, rows: np.ndarray, arity: int) -> np.ndarray:
        """Distinct rows, each the farthest from those before; none if there are not two."""
        norms, chosen = (rows * rows).sum(axis=1), [0]
        nearest = np.full(len(rows), np.inf)
        while len(chosen) < arity:
            k = chosen[-1]
            nearest = np.minimum(nearest, self.distances(Node(rows[[k]], norms[[k]], []), rows, norms)[:, 0])
            far = int(nearest.argmax())
            if nearest[far] <= self.slack:
                break
            chosen.append(far)
        return rows[chosen] if len(chosen) > 1 else rows[:0]

    @property
    def slack(self) -> float:
        """More than the rounding of any distance."""
        return 1e-6 * (1 + self.radius2**0.5)

    def distances(self, node: Node, rows: np.ndarray, norms: np.ndarray | None) -> np.ndarray:
        """Distances of rows (or, without norms, of anchors) from the split points, on the sphere."""
        rows = rows.astype(np.float64)
        lift = np.sqrt(np.maximum(self.radius2 - node.norms, 0))
        if norms is None:
            squares = (rows * rows).sum(axis=1)[:, None] + self.radius2 - 2 * rows @ node.points.T
        else:
            own = np.sqrt(np.maximum(self.radius2 - norms, 0))[:, None]
            squares = norms[:, None] + node.norms - 2 * rows @ node.points.T + (own - lift) ** 2
        return np.sqrt(np.maximum(squares, 0))

    def descend(self, rows: np.ndarray, norms: np.ndarray):
        """The leaf of each row; and (node, distances, nearest split point) of the rows at each node."""
        leaf, seen = np.zeros(len(rows), dtype=np.int32), []
        queue = [(self.root, np.arange(len(rows)))]
        while queue:
            child, at = queue.pop()
            if isinstance(child, tuple):
                leaf[at] = child[1]
                continue
            d = self.distances(self.nodes[child], rows[at], norms[at])
            nearest = d.argmin(axis=1)
            seen.append((child, d, nearest))
            queue += [(c, at[nearest == j]) for j, c in enumerate(self.nodes[child].children) if (nearest == j).any()]
        return leaf, seen

    def reach(self, anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[list[int]]:
        """Leaves that may hold a score in one of the windows ``low .. high`` (a row of windows for each anchor)."""
        squares = (anchors.astype(np.float64) ** 2).sum(axis=1)[:, None] + self.radius2
        near, far = (np.sqrt(np.maximum(squares - 2 * x.astype(np.float64), 0)) for x in (high, low))
        found: list[list[int]] = [[] for _ in anchors]
        queue = [(self.root, np.arange(len(anchors)), low <= high)]
        while queue:
            child, at, open_ = queue.pop()
            if isinstance(child, tuple):
                for i in at.tolist():
                    found[i].append(child[1])
                continue
            node = self.nodes[child]
            d = self.distances(node, anchors[at], None)
            for j, c in enumerate(node.children):
                alive = open_.copy()
                for i in range(len(node.children)):
                    own = d[:, i:i + 1]
                    least = np.maximum(own - far[at], near[at] - own)
                    alive &= (node.low[i, j] <= own + far[at] + self.slack) & (node.high[i, j] >= least - self.slack)
                some = alive.any(axis=1)
                if some.any():
                    queue.append((c, at[some], alive[some]))
        return found

    def with_ranges(self, ranges: list) -> Tree:
        """Take over ``(node, point, child, low, high)``; a subtree without rows keeps an empty range."""
        for node in self.nodes:
            size = len(node.children)
            node.low, node.high = np.full((size, size), np.inf), np.full((size, size), -np.inf)
        for number, i, j, low, high in ranges:
            self.nodes[number].low[i, j], self.nodes[number].high[i, j] = low, high
        return self


def indexed(rows: DataFrame, tree: Tree, kind: str) -> DataFrame:
    """The rows with their ``leaf``."""
    def run(batches):
        for batch in batches:
            leaf, _ = tree.descend(dense(batch.column("v"), kind), batch.column("norm2").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("vec_id", "label", "v")], pa.array(leaf)], ["vec_id", "label", "v", "leaf"])

    return rows.mapInArrow(run, "vec_id long, label long, v binary, leaf int")


def ranges(rows: DataFrame, tree: Tree, kind: str) -> DataFrame:
    """``(node, point, child, low, high)``: distances of a split point to all rows under a sibling; a task sends each once."""
    def run(batches):
        low = [np.full((len(n.children),) * 2, np.inf) for n in tree.nodes]
        high = [np.full((len(n.children),) * 2, -np.inf) for n in tree.nodes]
        for batch in batches:
            _, seen = tree.descend(dense(batch.column("v"), kind), batch.column("norm2").to_numpy())
            for number, d, nearest in seen:
                for j in np.unique(nearest):
                    low[number][:, j] = np.minimum(low[number][:, j], d[nearest == j].min(axis=0))
                    high[number][:, j] = np.maximum(high[number][:, j], d[nearest == j].max(axis=0))
        out = [(n, i, j, low[n][i, j], high[n][i, j]) for n in range(len(low)) for i, j in zip(*np.nonzero(high[n] >= low[n]))]
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64())
        columns = zip(*out) if out else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array([*c], k) for c, k in zip(columns, kinds)], ["node", "point", "child", "low", "high"])

    found = rows.mapInArrow(run, "node int, point int, child int, low double, high double")
    return found.groupBy("node", "point", "child").agg(F.min("low").alias("low"), F.max("high").alias("high"))


# ---- search -----------------------------------------------------------------

def first_per_anchor(anchor: np.ndarray, score: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` highest scores of each anchor; equal ones in the order given."""
    order = np.lexsort((-score, anchor))
    a = anchor[order]
    begin = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else np.zeros(0, dtype=int)
    rank = np.arange(len(a)) - np.repeat(begin, np.diff(np.r_[begin, len(a)]))
    return order[rank < n]


def candidates(anchors: pa.Table, rows: pa.Table, kind: str, same: bool, n: int):
    """``(anchor_id, slot, id, score)`` of the first ``n`` rows of the same (or another) label in each window of each anchor."""
    rows = rows.sort_by("vec_id")
    matrix, ids, labels = dense(rows["v"], kind), rows["vec_id"].to_numpy(), rows["label"].to_numpy()
    low, high = (np.array(anchors[c].to_pylist(), dtype=np.int64).reshape(len(anchors), -1) for c in ("low", "high"))
    queries, own = dense(anchors["v"], kind), anchors["vec_id"].to_numpy()
    own_label = anchors["label"].to_numpy()
    step = max(1, CELLS // max(1, len(rows)))
    for begin in range(0, len(anchors), step):
        part = slice(begin, begin + step)
        scores = inner(queries[part], matrix)
        a, r = np.nonzero(scores >= low[part].min(axis=1)[:, None])
        s = scores[a, r].astype(np.int64)
        a += begin
        fit = (labels[r] == own_label[a]) == same
        fit &= ids[r] != own[a]
        a, r, s = a[fit], r[fit], s[fit]
        for slot in range(low.shape[1]):
            inside = np.flatnonzero((s >= low[a, slot]) & (s <= high[a, slot]))
            best = inside[first_per_anchor(a[inside], s[inside], n)]
            yield own[a[best]], np.full(len(best), slot, dtype=np.int32), ids[r[best]], s[best]


def search(anchors: DataFrame, rows: DataFrame, sizes: list[int], n_anchors: int, tree: Tree, kind: str, same: bool, n: int) -> DataFrame:
    """``(anchor_id, slot, id, score, rank)``: the first ``n`` rows of each window ``low[slot] .. high[slot]`` of each anchor."""
    shape = pickle.dumps(tree)
    blocks = max(1, -(-n_anchors // BLOCK))
    pieces = [max(1, -(-size // PIECE)) for size in sizes]
    n_pieces: Column = F.get(F.array(*map(F.lit, pieces)), F.col("leaf"))

    def route(batches):
        tree = pickle.loads(shape)
        for batch in batches:
            low, high = (
                np.array(batch.column(c).to_pylist(), dtype=np.int64).reshape(batch.num_rows, -1) for c in ("low", "high"))
            leaves = tree.reach(dense(batch.column("v"), kind), low, high)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(leaves, pa.list_(pa.int32()))], [*batch.schema.names, "leaves"])

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [*candidates(left, right, kind, same, n)] if len(left) and len(right) else []
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, dtype=t) for t in ("i8", "i4", "i8", "i8")]
        return pa.table(dict(zip(("anchor_id", "slot", "id", "score"), columns)))

    anchors = anchors.select("vec_id", "label", "v", "low", "high")
    sent = (
        anchors.mapInArrow(route, "vec_id long, label long, v binary, low array<long>, high array<long>, leaves array<int>")
        .select("*", F.explode("leaves").alias("leaf")).drop("leaves")
        .withColumn("piece", F.explode(F.sequence(F.lit(0), n_pieces - 1)))
        .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    )
    dealt = rows.withColumn("piece", F.pmod(F.xxhash64("vec_id", F.lit(1)), n_pieces).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["leaf", "piece", "block"]
    found = sent.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(meet, "anchor_id long, slot int, id long, score long")
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def bounds(anchors: DataFrame, sample: tuple[np.ndarray, np.ndarray, np.ndarray], kind: str, n: int) -> DataFrame:
    """The anchors with one window ``low .. high``: from the score of the ``n``-th best row of their label in the sample."""
    ids, labels, matrix = sample

    def run(batches):
        for batch in batches:
            queries = dense(batch.column("v"), kind)
            own, label = batch.column("vec_id").to_numpy(), batch.column("label").to_numpy()
            least = np.full(len(own), -_LIMIT, dtype=np.int64)
            for k in np.unique(label):
                at, members = np.flatnonzero(label == k), np.flatnonzero(labels == k)
                scores = inner(queries[at], matrix[members]).astype(np.int64)
                scores[own[at][:, None] == ids[members]] = -_LIMIT
                if len(members) >= n:
                    least[at] = np.sort(scores, axis=1)[:, -n]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("vec_id", "label", "v")],
                 pa.array([[x] for x in least.tolist()], pa.list_(pa.int64())),
                 pa.array([[_LIMIT]] * len(own), pa.list_(pa.int64()))],
                ["vec_id", "label", "v", "low", "high"],
            )

    return anchors.mapInArrow(run, "vec_id long, label long, v binary, low array<long>, high array<long>")


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``; ``rows`` has ``vec_id, label, embedding``."""
    packed, kind = whole_vectors(rows)
    packed = stored(packed, "packed")
    total, radius2 = packed.agg(F.count("*"), F.max("norm2")).first()
    drawn = smallest_hashes(packed, "vec_id", SAMPLE, total).collect()
    matrix = dense(pa.array([r.v for r in drawn], pa.binary()), kind)
    sample = (np.array([r.vec_id for r in drawn], dtype=np.int64), np.array([r.label for r in drawn], dtype=np.int64), matrix)
    tree = Tree(matrix, radius2 or 0.0)
    tree.with_ranges(ranges(packed, tree, kind).collect())  # at most ARITY squared for each node
    index = stored(indexed(packed, tree, kind), "leaves")
    sizes = [0] * tree.leaves
    for r in index.groupBy("leaf").count().collect():  # one row per leaf
        sizes[r.leaf] = r["count"]
    anchors = stored(index.where(is_anchor).drop("leaf"), "anchors")
    n_anchors = anchors.count()

    best = stored(search(bounds(anchors, sample, kind, positives), index, sizes, n_anchors, tree, kind, True, positives), "positives")
    order = F.sort_array(F.collect_list(F.struct("rank", "id", "score")))  # at most ``positives``
    chosen = best.groupBy(F.col("anchor_id").alias("vec_id")).agg(order.alias("chosen"))
    low, high = windows_of("chosen")
    asked = anchors.join(chosen, "vec_id").select("vec_id", "label", "v", low.alias("low"), high.alias("high"), "chosen")
    # All windows of an anchor travel in arrays of one length; a missing positive has an empty window.
    asked = asked.withColumns({
        c: F.concat(c, F.array_repeat(F.lit(x), F.lit(positives) - F.size(c))) for c, x in (("low", _LIMIT), ("high", -_LIMIT))})
    found = search(asked, index, sizes, n_anchors, tree, kind, False, negatives)
    first = best.select("anchor_id", (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return found.join(first, ["anchor_id", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def windows_of(chosen: str) -> tuple[Column, Column]:
    """Lowest and highest score between 50 and 95 hundredths of each positive's; empty below 0."""
    low = F.expr(f"transform({chosen}, p -> if(p.score < 0, {_LIMIT}, p.score - p.score div 2))")
    high = F.expr(f"transform({chosen}, p -> if(p.score < 0, -{_LIMIT}, p.score - p.score div 20 - if(p.score % 20 = 0, 0, 1)))")
    return low, high


def relabelled(rows: DataFrame) -> DataFrame:
    """Every seventh id has the next of ten labels."""
    return rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return mine(relabelled(usable(table(spark, folder, "embeddings"))), F.col("vec_id") % 50 == 0)


SQL = f"""
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id,
    CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM e a, e b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
pos AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM p WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES})
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score,
  score AS negative_score
FROM pos JOIN p USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER w <= {NEGATIVES}
"""

QUERIES = {"op12_hard_negatives": op12_hard_negatives}
ORACLE = {"op12_hard_negatives": SQL}
