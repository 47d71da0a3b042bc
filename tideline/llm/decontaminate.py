"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of consecutive words of the benchmark items.  They
are found by Spark, made distinct, and taken in blocks of bounded number and
size, so a broadcast has a bound however large the benchmark is and however
many items share a window: it holds windows and a number for the set of their
items, never the items.  Each block is one narrow pass over the documents,
without a shuffle.  In a pass

* a shift table over hashed pairs of words tells how far a scan may jump; many
  scans run side by side in numpy, one for each stretch of a document,
* where the shift is zero, the hash of the last pair together with that of the
  first selects the test strings,
* and the bytes of the words decide.

What a pass finds is the places in a text and the numbers of item sets.  The
items are joined to the numbers by Spark, once for each different text with a
hit.

Defined results: a null text or item has no words; an item without words has
no window; a null item id takes part in hits but is not listed; repeated rows
get equal results; an empty benchmark hits nothing; input columns named like a
result give way to it.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tideline.llm.frames import bounded_batches, free_name, stored, without
from tideline.llm.spans import WORD, Spans, chain, expand, groups, whole
from tideline.plans.tables import table

#: Words of a window.
WINDOW = 10
#: Windows searched in one pass and their bytes, in the driver and in every Python worker.
BLOCK_WINDOWS, BLOCK_BYTES = 100_000, 16 << 20
#: Scans run over stretches of so many window places.
STRETCH = 512

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct ``(pattern, item)``: space-joined words of each window of each item."""
    words = F.regexp_extract_all(lower_ascii(F.coalesce("text", F.lit(""))), F.lit(WORDS), F.lit(0))
    sized = benchmark.select(F.col("item_id").cast("string").alias("item"), words.alias("w")).where(F.size("w") > 0)
    last = F.greatest(F.size("w") - F.lit(window), F.lit(0))
    cut = F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice("w", i + 1, window), " "))
    return sized.select(F.explode(F.array_distinct(cut)).alias("pattern"), "item").distinct()


def numbered_windows(windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(pattern, number)`` of every window, and ``(number, item)`` of every set of items that some windows have.

    The number is a hash of the number of items, the sum of their hashes and
    the exclusive or of other ones: windows with the same items share it.
    """
    total = F.sum(F.xxhash64("item").cast("decimal(38,0)"))
    key = F.xxhash64(F.count("item"), total.cast("string"), F.bit_xor(F.xxhash64(F.lit(1), "item")))
    numbered = stored(windows.groupBy("pattern").agg(key.alias("number")), "windows")
    one = numbered.groupBy("number").agg(F.min("pattern").alias("pattern"))
    return numbered, windows.join(one, "pattern").where(F.col("item").isNotNull()).select("number", "item")


class Tables:
    """Shift table and suffix buckets for the patterns of one length."""

    def __init__(self, patterns: list[bytes], numbers: list[int], hashes: np.ndarray):
        self.length = hashes.shape[1]
        self.block = min(2, self.length)
        bits = max(12, int(np.ceil(np.log2(hashes.size * 8 + 1))))
        self.mask = np.uint64((1 << min(bits, 24)) - 1)
        free = self.length - self.block + 1
        self.shift = np.full(int(self.mask) + 1, free, dtype=np.int16)
        for last in range(self.block - 1, self.length):
            np.minimum.at(self.shift, self._block(hashes, last) & self.mask, self.length - 1 - last)
        keys = chain(self._block(hashes, self.length - 1), self._block(hashes, self.block - 1))
        order = np.argsort(keys, kind="stable")
        self.keys, self.hashes = keys[order], hashes[order]
        self.patterns, self.numbers = [patterns[i] for i in order], [numbers[i] for i in order]

    def _block(self, hashes: np.ndarray, last: int) -> np.ndarray:
        return hashes[:, last] if self.block == 1 else chain(hashes[:, last - 1], hashes[:, last])

    def _at(self, h: np.ndarray, last: np.ndarray) -> np.ndarray:
        return h[last] if self.block == 1 else chain(h[last - 1], h[last])

    def places(self, h: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Last words of the windows that the shift table cannot rule out."""
        begin, stop = first[:-1] + self.length - 1, first[1:]
        stretches = np.maximum(-((begin - stop) // STRETCH), 0)
        k, owner = expand(np.zeros_like(stretches), stretches)
        at, until = begin[owner] + k * STRETCH, np.minimum(begin[owner] + (k + 1) * STRETCH, stop[owner])
        found = []
        while len(at):
            jump = self.shift[self._at(h, at) & self.mask]
            found.append(at[jump == 0])
            at = at + np.maximum(jump, 1)
            keep = at < until
            at, until = at[keep], until[keep]
        return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)

    def search(self, spans: Spans, h: np.ndarray) -> Iterator[tuple[int, int]]:
        """Pairs of (place of the first word, number of the pattern) of all occurrences."""
        last = self.places(h, spans.first)
        keys = chain(self._at(h, last), self._at(h, last - self.length + self.block))
        which, owner = expand(np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right"))
        at = last[owner] - self.length + 1
        likely = np.ones(len(at), dtype=bool)
        for j in range(self.length):
            likely &= h[at + j] == self.hashes[which, j]
        for i, p in zip(at[likely].tolist(), which[likely].tolist()):
            if b" ".join(map(spans.text, range(i, i + self.length))) == self.patterns[p]:
                yield i, self.numbers[p]


class Block:
    """The tables of one block of windows; travels as plain rows and is built once per Python worker."""

    _built: tuple[str, list[Tables], list[int]] | None = None

    @classmethod
    def of(cls, key: str, rows: list[tuple[str, int]]) -> tuple[list[Tables], list[int]]:
        """The tables, and the number of the item set of each window."""
        if cls._built is None or cls._built[0] != key:
            by_length: dict[int, list[int]] = {}
            for n, (pattern, _) in enumerate(rows):
                by_length.setdefault(pattern.count(" ") + 1, []).append(n)
            tables = []
            for length, numbers in sorted(by_length.items()):
                texts = [rows[n][0] for n in numbers]
                h = Spans(whole(texts), WORD).hashes().reshape(len(texts), length)
                tables.append(Tables([t.encode() for t in texts], numbers, h))
            cls._built = (key, tables, [number for _, number in rows])
        return cls._built[1:]


def _search(df: DataFrame, fields: list[T.StructField], names: tuple[str, str, str], block, key: str) -> DataFrame:
    """``fields`` of each row, its word count, the places of one block's windows, and the numbers of their item sets."""
    schema = T.StructType([
        *fields, T.StructField(names[0], T.LongType()), T.StructField(names[1], T.ArrayType(T.IntegerType())),
        T.StructField(names[2], T.ArrayType(T.LongType())),
    ])

    def run(batches):
        tables, sets = Block.of(key, pickle.loads(block.value))
        for batch in batches:
            n_words, hits, found = [np.zeros(0, dtype=np.int64)], [], []
            for group in groups(batch.column("text")):
                spans = Spans(group, WORD)
                n_words.append(np.diff(spans.first))
                h = spans.hashes()
                own = [([], set()) for _ in range(group.last - group.first)]
                for t in tables:
                    pairs = list(t.search(spans, h))
                    rows = np.searchsorted(spans.first, [i for i, _ in pairs], "right") - 1
                    for (i, n), row in zip(pairs, rows.tolist()):
                        begin = i - int(spans.first[row])
                        own[row][0].append((begin, begin + t.length))
                        own[row][1].add(sets[n])
                hits += [_united(places) for places, _ in own]
                found += [sorted(numbers) for _, numbers in own]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in fields], pa.array(np.concatenate(n_words)),
                 pa.array(hits, pa.list_(pa.int32())), pa.array(found, pa.list_(pa.int64()))], schema.names)

    return df.mapInArrow(run, schema)


class Blocks:
    """The windows of a benchmark in blocks; one is on the driver at a time."""

    def __init__(self, numbered: DataFrame, block_windows: int):
        self.windows = numbered.withColumn("block", F.xxhash64("pattern"))
        count, size = numbered.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("pattern")), F.lit(0))).first()
        self.n = max(1, -(-count // block_windows), -(-size // BLOCK_BYTES))
        self.name = uuid.uuid4().hex

    def __iter__(self):
        """A broadcast of (pattern, number) and its key."""
        for b in range(self.n):
            rows = self.windows.where(F.pmod("block", F.lit(self.n)) == b).select("pattern", "number").collect()
            packed = pickle.dumps([(r.pattern, r.number) for r in rows])
            yield self.windows.sparkSession.sparkContext.broadcast(packed), f"{self.name}/{b}"


def _united(places: list[tuple[int, int]]) -> list[int]:
    """Union of word ranges, as a flat list of begins and ends."""
    out: list[int] = []
    for begin, end in sorted(places):
        if out and begin <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [begin, end]
    return out


#: Columns that a search adds: words, begins and ends of hit words, ids of the items found, whether any was.
RESULTS = ("n_words", "hits", "item_ids", "contaminated")


def find_items(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS,
    names: tuple[str, str, str, str] = RESULTS, gone: tuple[str, ...] = (),
) -> DataFrame:
    """The documents, without the columns ``gone``, with the columns ``names``; written once to the shared folder."""
    bounded_batches(docs.sparkSession)
    numbered, items = numbered_windows(stored(item_windows(benchmark, window), "item_windows"))
    digest, sets, found_at, found_sets, number = (
        free_name(docs, n) for n in ("_digest", "_sets", "_found_at", "_found_sets", "_number"))
    keyed = docs.withColumn(digest, F.xxhash64("text"))
    count, places, ids, contaminated = names
    plain = (count, places, sets)
    base, more = None, None
    for block, key in Blocks(numbered, block_windows):
        if base is None:
            base = stored(_search(keyed, without(keyed.schema, [*names, *gone]).fields, plain, block, key), "hits")
        else:
            found = _search(keyed.select(digest, "text"), [keyed.schema[digest]], plain, block, key).where(F.size(places) > 0)
            found = stored(found.drop(count).dropDuplicates([digest]), "hits")
            more = found if more is None else more.union(found)
        block.destroy()
    if more is not None:
        # At most one row for each text and block.
        rest = more.groupBy(digest).agg(
            F.flatten(F.collect_list(places)).alias(found_at), F.flatten(F.collect_list(sets)).alias(found_sets))
        pairs = F.concat(places, F.coalesce(found_at, F.slice(places, 1, 0)))
        numbers = F.array_union(sets, F.coalesce(found_sets, F.slice(sets, 1, 0)))
        base = base.join(rest, digest, "left").withColumns({places: united(pairs), sets: numbers}).drop(found_at, found_sets)
    listed = (
        base.where(F.size(sets) > 0).dropDuplicates([digest]).select(digest, F.explode(sets).alias(number))
        .join(items.withColumnRenamed("number", number), number).groupBy(digest).agg(F.array_sort(F.collect_set("item")).alias(ids))
    )
    none = F.array().cast("array<string>")
    joined = base.join(listed, digest, "left").withColumn(ids, F.coalesce(ids, none))
    kept = [F.col(f"`{f.name}`") for f in without(docs.schema, [*names, *gone])]
    return joined.select(*kept, count, places, ids, (F.size(places) > 0).alias(contaminated))


def united(pairs: Column) -> Column:
    """Union of word ranges, a flat array of begins and ends, as such an array in order."""
    ranges = F.sort_array(F.transform(F.sequence(F.lit(0), (F.size(pairs) / 2).cast("int") - 1), lambda i: F.struct(
        F.get(pairs, 2 * i).alias("b"), F.get(pairs, 2 * i + 1).alias("e"))))

    def merge(done: Column, x: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        longer = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.greatest(last, x["e"])))
        return F.when((F.size(done) > 0) & (x["b"] <= last), longer).otherwise(F.concat(done, F.array(x["b"], x["e"])))

    empty = F.array().cast("array<int>")
    return F.when(F.size(pairs) > 0, F.aggregate(ranges, empty, merge)).otherwise(empty)


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """Documents without any window of the benchmark, with their own columns; narrow, one pass for each block."""
    bounded_batches(docs.sparkSession)
    numbered, _ = numbered_windows(stored(item_windows(benchmark, window), "item_windows"))
    names = tuple(free_name(docs, f"_{n}") for n in ("n_words", "hits", "sets"))
    kept, blocks = docs, Blocks(numbered, block_windows)
    for k, (block, key) in enumerate(blocks, 1):
        kept = _search(kept, list(docs.schema.fields), names, block, key).where(F.size(names[1]) == 0).drop(*names)
        if k < blocks.n:  # one block is alive at a time
            kept = stored(kept, "kept")
            block.destroy()
    return kept


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    hits = find_items(docs, table(spark, folder, "benchmark"), gone=("text",))
    covered = F.aggregate(
        F.transform("hits", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)), F.lit(0).cast("long"), lambda a, x: a + x
    )
    return hits.select(
        "doc_id", "n_words", covered.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), "contaminated",
    )


SQL = f"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{WORDS}') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{WORDS}') AS w
  FROM benchmark),
pat AS (
  SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, array_to_string(w[i:i + least(len(w), {WINDOW}) - 1], ' ') AS p
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS i FROM b WHERE len(w) > 0)),
win AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS p
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM pat) WHERE len(w) >= n)),
hit AS (SELECT r, i, win.n, item_id FROM win JOIN pat ON win.n = pat.n AND win.p = pat.p),
words AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM hit) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

QUERIES = {"op1_decontaminate": op1_decontaminate}
ORACLE = {"op1_decontaminate": SQL}
