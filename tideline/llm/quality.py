"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration.

Each text becomes a short vector of statistics.  Their standardised values go
through ``FEATURES`` random cosines, which approximate a Gaussian kernel.  The
ridge fit needs only sums of outer products, added up per partition of the
sample, so what meets on the driver has the size of the kernel, not of the
data.  A fold kept apart turns raw scores into frequencies by isotonic
regression.  Every whole text is scored in one narrow pass.

Defined results: null and empty texts score as a text of zero words; without
labels, or with labels of one kind, every score is their mean (1 without
labels: nothing is rejected on no evidence); repeated rows get equal scores;
input columns named like a result give way to it.  Labels of held-out rows
(``frames.held_out``) are never read.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tideline.llm.frames import bounded_batches, free_name, held_out, stored, without
from tideline.llm.labelled import labelled_texts
from tideline.llm.spans import LINE, SOLID, Group, Spans, byte_set, groups, segment_sums
from tideline.plans.tables import table

#: Bound of the labelled sample, and the partitions over which it is summed.
MAX_LABELLED, PARTS = 40_000, 8
FEATURES, RIDGE, SEED = 256, 1e-2, 5
#: Scores under this are rejected.
THRESHOLD = 0.3

_CLASSES = {
    "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "digit": bytes(range(48, 58)),
    "symbol": b"#$%&*<>@^~=+_\\/{}[]", "bar": b"|", "mark": b"!?", "stop": b".,;:", "wide": bytes(range(128, 256)),
}
_TABLES = [~byte_set(v) for v in _CLASSES.values()]


def statistics(group: Group) -> np.ndarray:
    """One row of statistics for each text."""
    words, lines = Spans(group, SOLID, lower=False), Spans(group, LINE, lower=False)
    n_bytes = np.diff(group.bounds)
    n_words, n_lines = np.diff(words.first), np.diff(lines.first)
    per_byte, per_word, per_line = (np.maximum(x, 1) for x in (n_bytes, n_words, n_lines))
    shares = [segment_sums(t[group.data], group.bounds) / per_byte for t in _TABLES]
    h, g = words.hashes(), lines.hashes()
    again = np.zeros(len(h), dtype=bool)
    again[1:] = h[1:] == h[:-1]
    again[words.first[:-1][n_words > 0]] = False
    sizes = words.end - words.start
    last = words.data[words.end - 1] if len(sizes) else np.zeros(0, dtype=np.uint8)
    odd = (_TABLES[3] | _TABLES[4])[last]
    return np.column_stack([
        *shares,
        np.log1p(n_words), n_bytes / per_word, np.log1p(n_lines) - np.log1p(n_words),
        _distinct(h, words.first) / per_word, _distinct(g, lines.first) / per_line,
        segment_sums(again, words.first) / per_word, segment_sums(odd, words.first) / per_word,
        segment_sums(sizes == 1, words.first) / per_word, segment_sums(sizes > 20, words.first) / per_word,
    ])


def _distinct(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Number of distinct hashes in each segment."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return np.bincount(owner[new], minlength=len(first) - 1)


WIDTH = len(_CLASSES) + 9


class Model:
    """Standardisation, cosines, ridge weights and the calibration steps."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.mean, self.spread = mean, spread
        self.turn = rng.normal(size=(WIDTH, FEATURES)) / np.sqrt(WIDTH / 2)
        self.phase = rng.uniform(0, 2 * np.pi, FEATURES)
        self.weights = np.zeros(FEATURES + 1)
        self.steps: tuple[np.ndarray, np.ndarray] | None = None
        self.constant: float | None = None

    def cosines(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -6, 6)
        return np.column_stack([np.cos(z @ self.turn + self.phase) * np.sqrt(2 / FEATURES), np.ones(len(x))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.cosines(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        raw = self.raw(x)
        return np.clip(np.interp(raw, *self.steps) if self.steps else raw, 0, 1)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least-squares rising fit: places and values of the pooled blocks."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []  # sum of y, weight, sum of x
    for a, b in zip(x[order].tolist(), y[order].tolist()):
        blocks.append([b, 1, a])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            top = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], top)]
    return np.array([b[2] / b[1] for b in blocks]), np.array([b[0] / b[1] for b in blocks])


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, calibrate, y, x)`` of the labelled rows."""
    known = labelled_texts(docs, labels, "quality", MAX_LABELLED)
    schema = T.StructType([*without(known.schema, ["text"]).fields, T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(batches):
        for batch in batches:
            x = [row for group in groups(batch.column("text")) for row in statistics(group)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("y"), pa.array(x, pa.list_(pa.float64()))], schema.names
            )

    one = known.mapInArrow(run, schema).groupBy("doc_id").agg(F.first("y").alias("y"), F.min("x").alias("x"))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    return one.select(
        F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).cast("int").alias("part"), (fold == 4).alias("calibrate"), "y", "x"
    )


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(-1, WIDTH)


def _sums(sample: DataFrame, of) -> np.ndarray:
    """Sum over all rows of what ``of(x, y)`` gives for a batch: one row for each of at most PARTS tasks."""

    def run(batches):
        total = 0
        for batch in batches:
            if batch.num_rows:
                total = total + of(_matrix(batch), batch.column("y").to_numpy())
        if not np.isscalar(total):
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["sums"])

    rows = sample.coalesce(PARTS).mapInArrow(run, "sums binary").collect()
    return sum((np.frombuffer(r.sums) for r in rows), np.zeros(1))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    bounded_batches(docs.sparkSession)
    sample = stored(_sample(docs, labels).repartition(PARTS, "part"), "quality")
    total, good = sample.agg(F.count("*"), F.sum("y")).first()
    model = Model(np.zeros(WIDTH), np.ones(WIDTH))
    if not total or good in (0, total):
        model.constant = good / total if total else 1.0
        return model
    moments = _sums(sample, lambda x, y: np.concatenate([x.sum(0), (x * x).sum(0)])) / total
    mean = moments[:WIDTH]
    model = Model(mean, np.sqrt(np.maximum(moments[WIDTH:] - mean * mean, 0)) + 1e-3)
    fit, kept = sample.where(~F.col("calibrate")), sample.where("calibrate")

    def normal(x, y):
        phi = model.cosines(x)
        return np.concatenate([(phi.T @ phi).ravel(), phi.T @ y])

    size = FEATURES + 1
    sums = _sums(fit, normal)
    if len(sums) == 1:
        model.constant = good / total
        return model
    model.weights = np.linalg.solve(sums[: size * size].reshape(size, size) + RIDGE * np.eye(size), sums[size * size:])

    def raw(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(model.raw(_matrix(batch))), batch.column("y").cast(pa.float64())], ["raw", "y"]
            )

    pairs = kept.mapInArrow(raw, "raw double, y double").collect()
    if pairs:
        model.steps = isotonic(*np.array(pairs).T)
    return model


def score(docs: DataFrame, model: Model, name: str = "score", gone: Sequence[str] = ()) -> DataFrame:
    """The documents, without the columns ``gone``, with the column ``name`` between 0 and 1."""
    bounded_batches(docs.sparkSession)
    fields = without(docs.schema, [name, *gone]).fields
    schema = T.StructType([*fields, T.StructField(name, T.DoubleType())])

    def run(batches):
        for batch in batches:
            scores = [np.zeros(0), *[model.score(statistics(group)) for group in groups(batch.column("text"))]]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in fields], pa.array(np.concatenate(scores))], schema.names
            )

    return docs.mapInArrow(run, schema)


def drop_rejected(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Documents that score at least ``threshold``, with their own columns."""
    name = free_name(docs, "_score")
    return score(docs, model, name).where(F.col(name) >= threshold).drop(name)


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = score(docs, train(docs, table(spark, folder, "labels")), gone=["text"])
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


QUERIES = {"op3_quality": op3_quality}
ORACLE: dict[str, str] = {}
