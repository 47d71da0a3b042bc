"""Filter interaction audit with wide packed counters.

A set of filters is applied to a corpus in every order.  What a step of an
order does to a document depends only on which filters it fails (its mask) and
on its labels.  So every mask becomes one big integer whose 64-bit fields hold
the outcomes of all steps of all orders, 600 steps for five filters; the
integers of the documents of a part are summed, equal ones as a product, and
the sum is cut into its fields.  A field holds a count of documents, which
Spark keeps in 63 bits, so no field ever runs over into the next.

One narrow pass reads the texts.  What is shuffled is an id, a digest and a few
flags a document; documents of equal text are combined before they are
shuffled by digest, so a text that a third of the rows share stays small.  The
sums take one row per part, mask and labels.

Defined results: a null text counts as empty and is identical to other empty
texts; a null part is the part ''; a null id is never larger than another, so
such a row has no earlier copy, nor is it one; repeated rows are counted as
the rows they are, and rows of one id are no copies of each other; an id
labelled several times has each label that any of its rows gives; an empty
table gives no parts; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from tideline.llm.frames import bounded_batches
from tideline.plans.tables import table

#: The filters, in the order of their bits.  ``E`` looks at the whole table.
FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10

#: Outcomes of a step, each a field.
OUTCOMES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
GOOD, TOXIC = 1, 2

_CAPITALS = bytes(range(65, 91))
_SYMBOL = re.compile(rb"[#$%&*|]")


def failures(raw: bytes, n_chars: int) -> int:
    """Bits of the filters A to D that a text fails."""
    words = raw.split()  # bytes split at the six ASCII white-space characters
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    return (
        (len(words) < LEAST_WORDS) | (100 * len(set(words)) < LEAST_DISTINCT * len(words)) << 1
        | (100 * capitals > MOST_CAPITALS * n_chars) << 2 | (_SYMBOL.search(raw) is not None) << 3
    )


def flags(docs: DataFrame, part: str) -> DataFrame:
    """``(doc_id, part, digest, mask)`` of every row; the mask has no bit of E yet."""
    df = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), "text")
    bounded_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            sizes = pc.utf8_length(texts).to_pylist()
            raw = texts.cast(pa.large_binary()).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"),
                 pa.array([hashlib.sha256(t).digest() for t in raw], pa.binary()),
                 pa.array([failures(t, n) for t, n in zip(raw, sizes)], pa.int32())],
                ["doc_id", "part", "digest", "mask"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    return df.mapInArrow(run, f"doc_id {kind}, part string, digest binary, mask int")


def mask_counts(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """``(part, mask, marks, n)``: rows by the filters they fail and by their labels (``GOOD`` and ``TOXIC``)."""
    marked = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        (F.max((F.coalesce("quality", F.lit(0)) == 1).cast("int")) * GOOD
         + F.max((F.coalesce("toxic", F.lit(0)) == 1).cast("int")) * TOXIC).alias("marks"))
    rows = (
        flags(docs, part).groupBy("doc_id", "part", "digest", "mask").agg(F.count("*").alias("n"))
        .join(marked, "doc_id", "left").withColumn("marks", F.coalesce("marks", F.lit(0)))
    )
    # Rows of one text and kind; ``first`` has the smallest id and how many rows it has.  Null ids stand apart.
    kinds = ["digest", "part", "mask", "marks"]
    same = rows.where(F.col("doc_id").isNotNull()).groupBy(*kinds).agg(
        F.sum("n").alias("n"), F.min(F.struct("doc_id", "n")).alias("first"))
    # One row per text.
    texts = same.groupBy("digest").agg(F.min("first.doc_id").alias("smallest"))
    split = same.join(texts, "digest").select(
        "part", "mask", "marks", "n",
        F.when(F.col("first.doc_id") == F.col("smallest"), F.col("first.n")).otherwise(0).alias("originals"))
    bit = 1 << FILTERS.index("E")
    both = split.select("part", "marks", F.explode(F.array(
        F.struct("mask", F.col("originals").alias("n")),
        F.struct((F.col("mask") + bit).alias("mask"), (F.col("n") - F.col("originals")).alias("n")),
    )).alias("x")).select("part", "x.mask", "marks", "x.n")
    nameless = rows.where(F.col("doc_id").isNull()).select("part", "mask", "marks", "n")
    return both.union(nameless).groupBy("part", "mask", "marks").agg(F.sum("n").alias("n")).where("n > 0")


def packed(mask: int, marks: int, orders: list[tuple[int, ...]]) -> int:
    """The outcomes of every step for one document, as an integer of 64-bit fields, step after step."""
    fields = np.zeros((len(orders), len(orders[0]), len(OUTCOMES)), dtype="<u8")
    for o, order in enumerate(orders):
        gone = False
        for s, bit in enumerate(order):
            fails = mask >> bit & 1
            removed = fails and not gone
            fields[o, s] = (
                not (gone or fails), removed, fails and gone, mask == 1 << bit,
                removed and marks & GOOD > 0, removed and marks & TOXIC > 0,
            )
            gone = gone or bool(fails)
    return int.from_bytes(fields.tobytes(), "little")


def unpacked(total: int, n_orders: int, n_filters: int) -> np.ndarray:
    """Counts by order, step and outcome."""
    size = n_orders * n_filters * len(OUTCOMES)
    return np.frombuffer(total.to_bytes(size * 8, "little"), dtype="<u8").reshape(n_orders, n_filters, -1).astype(np.int64)


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of ``filters`` and step, from ``(part, mask, marks, n)``."""
    orders = list(permutations(range(len(filters))))

    def sums(rows: pd.DataFrame) -> pd.DataFrame:
        # At most one row per mask and labels.
        total = sum(int(n) * packed(int(m), int(k), orders) for m, k, n in zip(rows["mask"], rows["marks"], rows["n"]))
        found = unpacked(total, len(orders), len(filters))
        at = np.array(orders)
        removed = np.zeros(len(filters), dtype=np.int64)
        np.add.at(removed, at.ravel(), found[:, :, OUTCOMES.index("removed")].ravel())
        names = ["".join(filters[b] for b in order) for order in orders]
        return pd.DataFrame({
            "part": rows["part"].iloc[0], "filter_order": np.repeat(names, len(filters)),
            "step": np.tile(np.arange(1, len(filters) + 1, dtype=np.int32), len(orders)),
            **{name: found[:, :, k].ravel() for k, name in enumerate(OUTCOMES)},
            "shapley": removed[at].ravel(),
        })

    longs = ", ".join(f"{c} long" for c in (*OUTCOMES, "shapley"))
    return counts.groupBy("part").applyInPandas(sums, f"part string, filter_order string, step int, {longs}")


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit(mask_counts(table(spark, folder, "documents"), table(spark, folder, "labels")))


_ORDERS = ", ".join(f"('{''.join(p)}')" for p in permutations(FILTERS))
SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
l AS (
  SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    concat(CASE WHEN len(w) < {LEAST_WORDS} THEN 'A' ELSE '' END,
      CASE WHEN 100 * len(list_distinct(w)) < {LEAST_DISTINCT} * len(w) THEN 'B' ELSE '' END,
      CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > {MOST_CAPITALS} * length(text)
        THEN 'C' ELSE '' END,
      CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END,
      CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END) AS fails
  FROM d LEFT JOIN l ON d.doc_id = l.doc_id),
m AS (SELECT part, fails, good, toxic, count(*) AS n FROM f GROUP BY ALL),
s AS (
  SELECT o AS filter_order, step, substr(o, step, 1) AS letter, substr(o, 1, step - 1) AS earlier
  FROM (VALUES {_ORDERS}) t(o), (SELECT unnest(range(1, 6)) AS step)),
x AS (
  SELECT part, filter_order, step, letter, n, good, toxic, fails = letter AS alone, contains(fails, letter) AS fail,
    regexp_matches(fails, '[' || earlier || '0]') AS gone
  FROM m, s),
r AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, letter,
    CAST(coalesce(sum(n) FILTER (NOT fail AND NOT gone), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER (fail AND NOT gone), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (fail AND gone), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (alone), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(n) FILTER (fail AND NOT gone AND good = 1), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(n) FILTER (fail AND NOT gone AND toxic = 1), 0) AS BIGINT) AS toxic_lost
  FROM x GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM r
"""

QUERIES = {"op11_filter_audit": op11_filter_audit}
ORACLE = {"op11_filter_audit": SQL}
