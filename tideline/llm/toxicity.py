"""Toxicity by non-negative positive-unlabelled learning.

Texts are sets of features: words and beginnings of words.  The features of a
bounded sample of confirmed toxic texts that could be enriched are counted in
all texts outside the held-out fold, in one narrow pass that sends one count
per task and feature; the most enriched are the vocabulary.  All texts outside
the fold are the unlabelled ones.  They become their features of the
vocabulary, equal sets with their number, and are dealt to bags of bounded
size; a set that is more frequent than there are bags counts in all of them.
One numpy classifier per bag is trained in parallel tasks with the risk

    prior * E_P[l(f)] + max(0, E_U[l(-f)] - prior * E_P[l(-f)]),

l being the logistic loss.  When the second part turns negative, the step
ascends it, as the non-negative estimator asks.  The mean of the bags scores
every whole text in one narrow pass.

Defined results: null and empty texts score as a text without features; with
no confirmed example, every score is the prior (0 without labels); repeated
rows get equal scores; input columns named like a result give way to it.
Labels of held-out rows (``frames.held_out``) are never read.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tideline.llm.frames import bounded_batches, held_out, stored, without
from tideline.llm.labelled import labelled_texts
from tideline.llm.spans import WORD, Spans, groups
from tideline.plans.tables import table

#: Bounds of the confirmed toxic texts, of the features considered and chosen, and of the sets of a bag.
MAX_TOXIC, MAX_CANDIDATES, VOCABULARY, BAG_SETS = 4_000, 32_768, 1_024, 16_000
#: Beginnings of words, in bytes.
PREFIXES = (4, 5, 6, 7, 8)
#: A feature has to occur in so many texts, toxic examples and all texts together.
LEAST_TEXTS = 5
#: and to be so many standard errors more frequent in toxic ones.
LEAST_SURPLUS = 2.5
STEPS, RATE, DECAY = 300, 0.1, 1e-3


def features(spans: Spans) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words and of beginnings of words, and the span each comes from."""
    parts, owners = [spans.hashes()], [np.arange(len(spans.start))]
    sizes = spans.end - spans.start
    for size in PREFIXES:
        long = np.flatnonzero(sizes >= size)
        at = spans.start[long]
        parts.append(spans.hashes(at, at + size) ^ np.uint64(size))
        owners.append(long)
    return np.concatenate(parts), np.concatenate(owners)


def _feature_sets(df: DataFrame) -> DataFrame:
    """Replace ``text`` by the distinct feature hashes of the text."""
    schema = T.StructType([*without(df.schema, ["text"]).fields, T.StructField("x", T.ArrayType(T.LongType()))])

    def run(batches):
        for batch in batches:
            sets = []
            for group in groups(batch.column("text")):
                spans = Spans(group, WORD)
                h, owner = features(spans)
                row = np.searchsorted(spans.first, owner, "right") - 1
                order = np.lexsort((h, row))
                h, row = h[order], row[order]
                new = np.ones(len(h), dtype=bool)
                new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
                h, row = h[new].view(np.int64), row[new]
                bounds = np.searchsorted(row, np.arange(group.last - group.first + 1))
                sets += [h[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in schema.fields[:-1]], pa.array(sets, pa.list_(pa.int64()))], schema.names
            )

    return df.mapInArrow(run, schema)


class Vocabulary:
    """Sorted hashes with a bit table in front that turns most features away."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes.astype(np.uint64))
        self.bits = np.zeros(1 << 20, dtype=bool)
        self.bits[self.hashes & np.uint64(0xFFFFF)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``h`` of known features, and their numbers."""
        at = np.flatnonzero(self.bits[h & np.uint64(0xFFFFF)])
        if not len(at) or not len(self.hashes):
            return at[:0], at[:0]
        number = np.minimum(np.searchsorted(self.hashes, h[at]), len(self.hashes) - 1)
        known = self.hashes[number] == h[at]
        return at[known], number[known]


def _sum_rows(row: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(row, weights=values, minlength=n)


def _numbered(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``v``: for each text the sorted numbers of its features in the vocabulary, as packed 16-bit integers."""
    def run(batches):
        for batch in batches:
            sets = []
            for group in groups(batch.column("text")):
                spans = Spans(group, WORD)
                h, owner = features(spans)
                at, number = vocabulary.find(h)
                row = np.searchsorted(spans.first, owner[at], "right") - 1
                size = max(1, len(vocabulary.hashes))
                pair = np.unique(row * size + number)
                bounds = np.searchsorted(pair, np.arange(group.last - group.first + 1) * size)
                packed = (pair % size).astype("<u2")
                sets += [packed[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(sets, pa.binary())], ["v"])

    return docs.select("text").mapInArrow(run, "v binary")


def _unpacked(sets: list[bytes]) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype="<u2") for x in sets]


def _counts(docs: DataFrame, hashes: np.ndarray) -> DataFrame:
    """``(h, u)``: how many of all texts have each of the features ``hashes``."""
    known = docs.sparkSession.sparkContext.broadcast(hashes)

    def run(batches):
        vocabulary = Vocabulary(known.value)
        size = len(vocabulary.hashes)
        count = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for group in groups(batch.column("text")):
                spans = Spans(group, WORD)
                h, owner = features(spans)
                at, number = vocabulary.find(h)
                row = np.searchsorted(spans.first, owner[at], "right") - 1
                count += np.bincount(np.unique(row * size + number) % max(1, size), minlength=size)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(vocabulary.hashes[some].view(np.int64)), pa.array(count[some])], ["h", "u"])

    return docs.select("text").mapInArrow(run, "h long, u long").groupBy("h").agg(F.sum("u").alias("u"))


def fit_bag(positive: list[np.ndarray], unlabelled: list[np.ndarray], weights: np.ndarray, size: int, prior: float) -> np.ndarray:
    """Weights and bias of a linear classifier over ``size`` features that minimises the non-negative risk by Adam.

    ``weights`` are the numbers of unlabelled texts of each set.
    """
    parts = []
    for texts, share in ((positive, np.ones(len(positive))), (unlabelled, weights)):
        number = np.concatenate([*texts, np.zeros(0, dtype="<u2")]).astype(np.int64)
        parts.append((np.repeat(np.arange(len(texts)), [len(t) for t in texts]), number, len(texts), share / share.sum()))
    w = np.zeros(size + 1)
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, STEPS + 1):
        f = [_sum_rows(r, w[v], n) + w[size] for r, v, n, _ in parts]
        # Derivatives of l(f) and l(-f) are -s(-f) and s(f).
        up = [1 / (1 + np.exp(-np.clip(x, -30, 30))) for x in f]
        negative = np.logaddexp(0, f[1]) @ parts[1][3] - prior * np.logaddexp(0, f[0]) @ parts[0][3]
        if negative >= 0:
            slope = [-prior * (1 - up[0]) - prior * up[0], up[1]]
        else:
            slope = [prior * up[0], -up[1]]
        g = DECAY * w
        for (r, v, _, share), d in zip(parts, slope):
            d = d * share
            g[:size] += np.bincount(v, weights=d[r], minlength=size)
            g[size] += d.sum()
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        w = w - RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w


def train(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted vocabulary and weights (the last is the bias)."""
    bounded_batches(docs.sparkSession)
    learnt = labels.where(F.col("toxic").isin(0, 1) & ~held_out())
    share = learnt.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0
    none = np.zeros(0, dtype=np.uint64)
    if not 0 < share < 1:
        return none, np.array([np.log(max(share, 1e-9) / max(1 - share, 1e-9))])
    prior = np.array([np.log(share / (1 - share))])
    rest = docs.where(~held_out()).select("doc_id", "text")
    toxic = _feature_sets(labelled_texts(docs, labels, "toxic", MAX_TOXIC, only=1))
    toxic = stored(toxic.groupBy("doc_id").agg(F.min("x").alias("x")), "toxicity")
    n_toxic, n_rest = toxic.count(), rest.count()
    if not n_toxic or not n_rest:
        return none, prior
    p, u = F.col("p") / n_toxic, F.col("u") / n_rest
    surplus = (p - u) / F.sqrt((p * (1 - p) + 0.01) / n_toxic + (u * (1 - u) + 0.01) / n_rest)
    counts = toxic.select(F.explode("x").alias("h")).groupBy("h").agg(F.count("*").alias("p"))
    # No count in the other texts lifts a surplus above that of a feature none of them has.
    possible = stored(
        counts.withColumn("u", F.lit(0)).where(surplus >= LEAST_SURPLUS).orderBy(F.desc("p"), "h").limit(MAX_CANDIDATES)
        .select("h", "p"), "toxic_counts")
    candidates = np.array([r.h for r in possible.select("h").collect()], dtype=np.int64).view(np.uint64)
    chosen = (
        possible.join(_counts(rest, candidates), "h", "left").select("h", "p", F.coalesce("u", F.lit(0)).alias("u"))
        .where(F.col("p") + F.col("u") >= LEAST_TEXTS)
        .withColumn("z", surplus).where(F.col("z") >= LEAST_SURPLUS).orderBy(F.desc("z"), "h")
        .limit(VOCABULARY).collect()
    )
    vocabulary = Vocabulary(np.array([r.h for r in chosen], dtype=np.int64).view(np.uint64))
    size = len(vocabulary.hashes)

    def known(x: list[int]) -> bytes:
        return np.unique(vocabulary.find(np.array(x, dtype=np.int64).view(np.uint64))[1]).astype("<u2").tobytes()

    # At most MAX_TOXIC sets of VOCABULARY numbers.
    inside = toxic.select(F.array_intersect("x", F.lit([r.h for r in chosen]).cast("array<bigint>")).alias("x"))
    positive = docs.sparkSession.sparkContext.broadcast(sorted(known(r.x or []) for r in inside.collect()))
    sets = stored(_numbered(rest, vocabulary).groupBy("v").agg(F.count("*").alias("n")), "unlabelled")
    bags = max(1, -(-sets.count() // BAG_SETS))
    own = F.array(F.pmod(F.xxhash64("v"), F.lit(bags)).cast("int"))
    dealt = sets.select(
        "v", F.when(F.col("n") >= bags, F.col("n") / bags).otherwise(F.col("n").cast("double")).alias("n"),
        F.explode(F.when(F.col("n") >= bags, F.sequence(F.lit(0), F.lit(bags - 1))).otherwise(own)).alias("bag"))

    def bag(rows: pd.DataFrame) -> pd.DataFrame:
        # Sums of floats depend on the order of the sets.
        rows = rows.sort_values("v")
        weights = fit_bag(_unpacked(positive.value), _unpacked(rows["v"].tolist()), rows["n"].to_numpy(), size, share)
        return pd.DataFrame({"w": [weights.tolist()]})

    # One row of fixed width for each bag: summed in order, so that the mean is the same whatever the tasks.
    fitted = dealt.groupBy("bag").applyInPandas(bag, "w array<double>")
    mean = fitted.select(F.posexplode("w").alias("i", "x")).groupBy("i").agg(
        F.avg(F.col("x").cast("decimal(38,12)")).alias("x")).orderBy("i").collect()
    return vocabulary.hashes, np.array([float(r.x) for r in mean])


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], name: str = "score", gone: Sequence[str] = ()) -> DataFrame:
    """The documents, without the columns ``gone``, with the column ``name`` between 0 and 1."""
    bounded_batches(docs.sparkSession)
    vocabulary, weights = Vocabulary(model[0]), model[1]
    fields = without(docs.schema, [name, *gone]).fields
    schema = T.StructType([*fields, T.StructField(name, T.DoubleType())])

    def run(batches):
        for batch in batches:
            scores = [np.zeros(0)]
            for group in groups(batch.column("text")):
                spans = Spans(group, WORD)
                h, owner = features(spans)
                at, number = vocabulary.find(h)
                row = np.searchsorted(spans.first, owner[at], "right") - 1
                pair = np.unique(row * (len(weights) - 1) + number) if len(at) else at
                width = max(1, len(weights) - 1)
                f = _sum_rows(pair // width, weights[pair % width], group.last - group.first) + weights[-1]
                scores.append(1 / (1 + np.exp(-np.clip(f, -30, 30))))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in fields], pa.array(np.concatenate(scores))], schema.names
            )

    return docs.mapInArrow(run, schema)


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = score(docs, train(docs, table(spark, folder, "labels")), gone=["text"])
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


QUERIES = {"op2_toxicity": op2_toxicity}
ORACLE: dict[str, str] = {}
