"""Line deduplication by winnowing over line hashes.

Lines are hashed by their words.  A run is a shortest stretch of consecutive
lines with at least ``min_words`` words, taken forwards from each line and
backwards from each line; any repeated passage of that size contains one.
From each run the smallest line hash is selected, so equal runs always select
equal fingerprints, and a passage cannot be missed.

Fingerprints found at a single place end there.  At those left, the match is
extended both ways: the hash of the run around the fingerprint, forwards and
backwards, has to agree.  Of equal runs the first, by id and place, stays; the
lines of all later ones are deleted.  Runs overlap, so a longer passage goes
whole, up to its last line.  Every step is an aggregate or a join on hashes; an
occurrence is held against the first one only, never against all others.

A line is deleted exactly if it lies in a stretch of consecutive lines with at
least ``min_words`` words that also begins at an earlier place.

Defined results: lines without words belong to no run and are not counted, but
those inside a deleted stretch go with it; words are compared without ASCII
case and white space; documents are in the order of their ids, null last, then
of the hash of the text; rows with equal id and text are one document and get
equal results; a null text stays null; a text that loses all its lines becomes
empty; input columns named like a result give way to it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tideline.llm.frames import bounded_batches, free_name, stored, without
from tideline.llm.spans import LINE, SOLID, Spans, _powers, _INVERSE, _P, chain, groups, mix
from tideline.plans.tables import table

#: Words of a repeated passage.
MIN_WORDS = 50

_RUNS = T.ArrayType(T.StructType([
    T.StructField("i", T.IntegerType()), T.StructField("e", T.IntegerType()), T.StructField("w", T.LongType()),
]))


class Lines:
    """Lines with words of a group of texts: hash, number of words, owner."""

    def __init__(self, group):
        words, lines = Spans(group, SOLID), Spans(group, LINE)
        bounds = np.append(np.searchsorted(words.start, lines.start), len(words.start))
        self.hashes = sequence_hashes(words.hashes(), bounds[:-1], bounds[1:])
        counts = np.diff(bounds)
        full = counts > 0
        self.hashes, self.counts = self.hashes[full], counts[full]
        #: Lines of text i are ``first[i] .. first[i + 1]``.
        self.first = np.searchsorted(lines.start[full], group.bounds)

    def runs(self, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Owner, first line and end (in lines of the group) of all shortest runs, forwards and backwards."""
        n = len(self.counts)
        total = np.concatenate([[0], np.cumsum(self.counts)])
        owner = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        here = np.arange(n)
        end = np.searchsorted(total, total[:-1] + min_words, "left")
        ahead = end <= self.first[1:][owner]
        begin = np.searchsorted(total, total[1:] - min_words, "right") - 1
        back = (total[1:] >= min_words) & (begin >= self.first[:-1][owner])
        i = np.concatenate([here[ahead], begin[back]])
        e = np.concatenate([end[ahead], here[back] + 1])
        _, keep = np.unique(i * (n + 1) + e, return_index=True)
        return owner[i[keep]], i[keep], e[keep]


def sequence_hashes(h: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of each stretch ``first .. last`` of a sequence of hashes."""
    n = len(h)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(h * _powers(_P, n)[:n], out=sums[1:])
    value = (sums[last] - sums[first]) * _powers(_INVERSE, n + 1)[first]
    return mix(value + (last - first).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def smallest(h: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Least value of each non-empty stretch, from minima over stretches of doubling length."""
    out = h[first].copy()
    level, size = h, 1
    sizes = last - first
    while True:
        fits = (sizes >= size) & (sizes < 2 * size)
        out[fits] = np.minimum(level[first[fits]], level[last[fits] - size])
        if not (sizes >= 2 * size).any():
            return out
        level = np.minimum(level[:-size], level[size:])
        size *= 2


def fingerprints(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``(doc_id, digest, fp, places, runs)``: a row for each selected line hash of a document."""
    bounded_batches(docs.sparkSession)
    fields = docs.select("doc_id", F.xxhash64("text").alias("digest")).schema.fields
    schema = T.StructType([
        *fields, T.StructField("fp", T.LongType()), T.StructField("places", T.IntegerType()), T.StructField("runs", _RUNS),
    ])

    def run(batches):
        for batch in batches:
            for group in groups(batch.column("text")):
                lines = Lines(group)
                owner, i, e = lines.runs(min_words)
                if not len(i):
                    continue
                whole = sequence_hashes(lines.hashes, i, e)
                least = smallest(lines.hashes, i, e)
                order = np.lexsort((i, least, owner))
                owner, i, e, whole, least = (x[order] for x in (owner, i, e, whole, least))
                new = np.ones(len(i), dtype=bool)
                new[1:] = (owner[1:] != owner[:-1]) | (least[1:] != least[:-1])
                at = np.flatnonzero(new)
                base = lines.first[owner]
                runs = pa.ListArray.from_arrays(
                    pa.array(np.append(at, len(i)), pa.int32()),
                    pa.StructArray.from_arrays(
                        [pa.array((i - base).astype(np.int32)), pa.array((e - base).astype(np.int32)),
                         pa.array(whole.view(np.int64))],
                        ["i", "e", "w"],
                    ),
                )
                # Lines of the document with this hash.
                ours = np.repeat(np.arange(group.last - group.first), np.diff(lines.first))
                known = np.sort(chain(lines.hashes, ours.astype(np.uint64)))
                wanted = chain(least[at], owner[at].astype(np.uint64))
                places = np.searchsorted(known, wanted, "right") - np.searchsorted(known, wanted, "left")
                rows = pa.array(group.first + owner[at])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(rows), batch.column("digest").take(rows),
                     pa.array(least[at].view(np.int64)), pa.array(places.astype(np.int32)), runs],
                    schema.names,
                )

    return docs.select("doc_id", F.xxhash64("text").alias("digest"), "text").mapInArrow(run, schema)


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``(doc_id, digest, ranges)``: lines to delete, as ranges over the lines with words."""
    prints = stored(fingerprints(docs, min_words), "fingerprints")
    again = prints.groupBy("fp").agg(F.sum("places").alias("n")).where("n > 1").select("fp")
    runs = prints.join(again, "fp").select("doc_id", "digest", F.inline("runs"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest", "i")
    first = runs.groupBy("w").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").select("w", "first")
    later = runs.join(first, "w").where(place > F.col("first"))
    return later.groupBy("doc_id", "digest").agg(F.collect_set(F.struct("i", "e")).alias("ranges"))


def without_lines(text: str, ranges: list[tuple[int, int]]) -> tuple[str, int]:
    """The text without the lines of the ranges, and how many lines with words went."""
    gone: set[int] = set()
    for i, e in ranges:
        gone.update(range(i, e))
    out, number, removed = [], -1, 0
    for line in text.split("\n"):
        solid = any(SOLID[b] for b in line.encode()[:64]) or bool(line.strip(" \t\n\x0b\f\r"))
        number += solid
        # A blank line goes with the deleted lines on both its sides.
        inside = number in gone and (solid or number + 1 in gone)
        removed += inside and solid
        if not inside:
            out.append(line)
    return "\n".join(out), removed


def dedupe_lines(
    docs: DataFrame, min_words: int = MIN_WORDS, names: tuple[str, str] = ("n_lines", "n_removed")
) -> DataFrame:
    """The documents without later repeated lines, with the numbers of lines with words and of lines removed."""
    digest, own, ranges, there = (free_name(docs, n) for n in ("_found", "_digest", "_ranges", "_there"))
    found = repeated_runs(docs, min_words).select(
        F.col("doc_id").alias(there), F.col("digest").alias(digest), F.col("ranges").alias(ranges)
    )
    keyed = docs.withColumn(own, F.xxhash64("text"))
    # Hash the ranges, the smaller side by far: the texts are shuffled but not sorted.
    joined = keyed.join(
        found.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col(there)) & (F.col(own) == F.col(digest)), "left"
    ).select(*[F.col(f"`{f.name}`") for f in without(docs.schema, [*names])], ranges)
    fields = joined.schema.fields[:-1]
    schema = T.StructType([*fields, *[T.StructField(n, T.LongType()) for n in names]])

    def run(batches):
        for batch in batches:
            n_lines = [np.diff(Lines(g).first) for g in groups(batch.column("text"))]
            texts, removed = batch.column("text"), np.zeros(batch.num_rows, dtype=np.int64)
            hit = batch.column(ranges).is_valid().to_numpy(zero_copy_only=False)
            if hit.any():
                new = texts.to_pylist()
                for k in np.flatnonzero(hit).tolist():
                    if new[k] is not None:
                        pairs = [(r["i"], r["e"]) for r in batch.column(ranges)[k].as_py()]
                        new[k], removed[k] = without_lines(new[k], pairs)
                texts = pa.array(new, texts.type)
            yield pa.RecordBatch.from_arrays(
                [*[texts if f.name == "text" else batch.column(f.name) for f in fields],
                 pa.array(np.concatenate(n_lines) if n_lines else [], pa.int64()), pa.array(removed)],
                schema.names,
            )

    return joined.mapInArrow(run, schema)


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedupe_lines(table(spark, folder, "documents").select("doc_id", "text"))


_SOLID = r"[^\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

SQL = f"""
WITH raw AS (
  SELECT doc_id, row_number() OVER (ORDER BY doc_id, text) AS d, text, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS ln
  FROM documents WHERE text IS NOT NULL),
lines AS (
  SELECT *, row_number() OVER (PARTITION BY d ORDER BY ln) AS n, sum(c) OVER (PARTITION BY d ORDER BY ln) AS upto
  FROM (SELECT *, len(w) AS c, array_to_string(w, ' ') AS norm
    FROM (SELECT *, regexp_extract_all(translate(line, '{_UPPER}', '{_UPPER.lower()}'), '{_SOLID}') AS w FROM raw))
  WHERE c > 0),
docs AS (SELECT d, list(norm ORDER BY n) AS ls, count(*) AS n_lines FROM lines GROUP BY d),
ahead AS (
  SELECT a.d, a.n AS i, min(b.n) AS e FROM lines a JOIN lines b
    ON a.d = b.d AND b.n >= a.n AND b.n < a.n + {MIN_WORDS} AND b.upto - a.upto + a.c >= {MIN_WORDS} GROUP BY ALL),
back AS (
  SELECT a.d, max(b.n) AS i, a.n AS e FROM lines a JOIN lines b
    ON a.d = b.d AND b.n <= a.n AND b.n > a.n - {MIN_WORDS} AND a.upto - b.upto + b.c >= {MIN_WORDS} GROUP BY ALL),
runs AS (
  SELECT d, i, e, array_to_string(ls[i:e], chr(10)) AS w
  FROM (SELECT * FROM ahead UNION SELECT d, i, e FROM back) JOIN docs USING (d)),
later AS (
  SELECT d, i, e FROM (SELECT *, row_number() OVER (PARTITION BY w ORDER BY d, i) AS k FROM runs) WHERE k > 1),
gone AS (SELECT DISTINCT d, unnest(range(i, e + 1)) AS n FROM later),
marked AS (
  SELECT r.d, r.ln, r.line, l.n IS NOT NULL AS solid, last_value(l.n IGNORE NULLS) OVER (PARTITION BY r.d ORDER BY r.ln) AS n
  FROM raw r LEFT JOIN lines l USING (d, ln)),
verdict AS (
  SELECT m.*, g.n IS NOT NULL AND (solid OR h.n IS NOT NULL) AS inside
  FROM marked m LEFT JOIN gone g ON m.d = g.d AND m.n = g.n LEFT JOIN gone h ON m.d = h.d AND m.n + 1 = h.n),
result AS (
  SELECT d, coalesce(string_agg(line, chr(10) ORDER BY ln) FILTER (NOT inside), '') AS text,
    count(*) FILTER (solid) AS n_lines, count(*) FILTER (solid AND inside) AS n_removed
  FROM verdict GROUP BY d)
SELECT doc_id, r.text, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed
FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id, text) AS d FROM documents WHERE text IS NOT NULL) LEFT JOIN result r USING (d)
UNION ALL SELECT doc_id, NULL, 0, 0 FROM documents WHERE text IS NULL
"""

QUERIES = {"op5_line_dedup": op5_line_dedup}
ORACLE = {"op5_line_dedup": SQL}
