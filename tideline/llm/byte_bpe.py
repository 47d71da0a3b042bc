"""Byte-level BPE encoding and decoding.

``fold_words`` is the fold over arrays: Spark higher-order functions merge the
bytes of distinct words, the lowest rank first, with the rank map as a literal
of the plan.  Every round copies the arrays of a word, so a word of n bytes
costs n squared, and the ids would have to come back to all places of a word by
a shuffle; README.md has the figures.  ``encode`` therefore folds the same
merges in the tasks, in one narrow pass: the distinct new words of many texts
are merged side by side as arrays, and kept in the bounded memory of a Python
worker.  Decoding concatenates the binary pieces of the ids.

Defined results: null counts as empty and gives no ids; repeated rows get equal
results; input columns named like a result give way to it.
"""

from __future__ import annotations

import base64
import hashlib
import pickle
import uuid
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tideline.llm.classes import Words
from tideline.llm.frames import bounded_batches, free_name, without
from tideline.llm.merges import Memory, Pairs, kept
from tideline.plans.tables import table


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank file: one base64 piece and its rank a line."""
    with open(path, "rb") as file:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)}


def word_pattern(pattern: str, ranks: dict[bytes, int]) -> Words:
    """The pattern with the character tables of the library that reads rank files."""
    import tiktoken

    def members(one: str, text: str) -> list[str]:
        coder = tiktoken.Encoding("members", pat_str=one, mergeable_ranks=ranks, special_tokens={})
        return [coder.decode(coder.encode_ordinary(text))]

    return Words.fitted(pattern, members)


#: Characters of texts whose new words are merged together.
TOGETHER = 1 << 20


class Coder:
    """Ids of texts and texts of ids."""

    def __init__(self, ranks: dict[bytes, int], words: Words):
        self.pairs, self.words = Pairs(ranks), words.compiled()
        pieces = [b""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            pieces[rank] = piece
        self.pieces = pa.array(pieces, pa.large_binary())
        self.memory = Memory(lambda word: self._ids([word])[0])

    def _ids(self, words: list[str]) -> list[bytes]:
        return self.pairs.ids([w.encode() for w in words])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return next(self.encode_all([text]))

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text."""
        waiting, length = [], 0
        for text in texts:
            waiting.append(self.words.findall(text))
            length += len(text)
            if length >= TOGETHER:
                yield from self._encoded(waiting)
                waiting, length = [], 0
        yield from self._encoded(waiting)

    def _encoded(self, texts: list[list[str]]) -> Iterator[bytes]:
        self.memory.learn(chain.from_iterable(texts), self._ids)
        for words in texts:
            yield b"".join(map(self.memory.__getitem__, words))

    def decode(self, ids: bytes) -> bytes:
        """The pieces of the ids, concatenated: the value buffer of the pieces taken in order."""
        values = self.pieces.take(pa.array(np.frombuffer(ids, dtype="<u4"))).buffers()[2]
        return values.to_pybytes() if values else b""


def _packed(spark: SparkSession, path: str, pattern: str):
    ranks = read_ranks(path)
    return spark.sparkContext.broadcast(pickle.dumps((ranks, word_pattern(pattern, ranks))))


def _mapped(df: DataFrame, name: str, kind: T.DataType, path: str, pattern: str, make, gone: tuple = ()) -> DataFrame:
    """``df``, without the columns ``gone``, with the column ``name`` made from each batch by ``make(coder, batch)``."""
    packed, key = _packed(bounded_batches(df.sparkSession), path, pattern), uuid.uuid4().hex
    fields = without(df.schema, [name, *gone]).fields
    schema = T.StructType([*fields, T.StructField(name, kind)])

    def run(batches):
        coder = kept(key, lambda: Coder(*pickle.loads(packed.value)))
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in fields], make(coder, batch)], schema.names)

    return df.mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, pattern: str, name: str = "ids", text: str = "text") -> DataFrame:
    """The documents with the ids of ``text`` as little-endian unsigned 32-bit integers in a binary column."""
    return _mapped(docs, name, T.BinaryType(), path, pattern, lambda coder, batch: pa.array(
        list(coder.encode_all(pc.fill_null(batch.column(text), "").to_pylist())), pa.binary()
    ))


def decode(df: DataFrame, path: str, pattern: str, name: str = "decoded", ids: str = "ids") -> DataFrame:
    """The rows with the bytes that the ids stand for; null ids decode to nothing."""
    return _mapped(df, name, T.BinaryType(), path, pattern, lambda coder, batch: pa.array(
        [coder.decode(x or b"") for x in batch.column(ids).to_pylist()], pa.binary()
    ))


def round_trip(docs: DataFrame, path: str, pattern: str, name: str = "coded", gone: tuple = ()) -> DataFrame:
    """The documents, without the columns ``gone``, with a struct of ``n_tokens`` and the digests of ids and decoded bytes, in one pass."""
    kind = T.StructType([
        T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ])

    def make(coder: Coder, batch: pa.RecordBatch) -> pa.Array:
        counts, coded, decoded = [], [], []
        for ids in coder.encode_all(pc.fill_null(batch.column("text"), "").to_pylist()):
            counts.append(len(ids) // 4)
            coded.append(hashlib.sha256(ids).hexdigest())
            decoded.append(hashlib.sha256(coder.decode(ids)).hexdigest())
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())],
            ["n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return _mapped(docs, name, kind, path, pattern, make, gone)


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document."""
    coded = round_trip(docs.select("doc_id", "text"), path, pattern, gone=("text",))
    return coded.select("doc_id", "coded.n_tokens", "coded.ids_sha256", "coded.decoded_sha256")


#: Slots of each of the two halves of the literal rank map.
SLOTS = 1 << 16
#: More than any rank: a pair that does not merge.
NONE = 1 << 30


def _slots(h: int) -> tuple[int, int]:
    return h % SLOTS, (h >> 20) % SLOTS


def rank_map(ranks: dict[bytes, int]) -> list[list[tuple[int, int]]]:
    """Two tables of (hash, rank): a piece is at its slot of the first or at that of the second (cuckoo hashing)."""
    tables: list[list] = [[None] * SLOTS, [None] * SLOTS]
    for piece, rank in ranks.items():
        entry, side = (xxhash.xxh64_intdigest(piece, 42), rank), 0
        for _ in range(10_000):
            at = _slots(entry[0])[side]
            entry, tables[side][at] = tables[side][at], entry
            if entry is None:
                break
            side = 1 - side
        else:
            raise ValueError("the rank map is too full")
    return [[(h - (h >> 63 << 64), r) for h, r in (x or (0, NONE) for x in t)] for t in tables]


def rank_of(ranks: dict[bytes, int]):
    """A function from a binary column to its rank, or ``NONE``; the map is a constant of the plan."""
    constant = lambda values: F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")
    (k1, r1), (k2, r2) = ([constant(x) for x in zip(*t)] for t in rank_map(ranks))

    def rank(piece: Column) -> Column:
        def look(h: Column) -> Column:
            a = h.bitwiseAND(SLOTS - 1).cast("int")
            b = F.shiftrightunsigned(h, 20).bitwiseAND(SLOTS - 1).cast("int")
            return F.when(F.get(k1, a) == h, F.get(r1, a)).when(F.get(k2, b) == h, F.get(r2, b)).otherwise(NONE)

        return F.get(F.transform(F.array(F.xxhash64(piece)), look), F.lit(0))

    return rank


def fold_words(words: DataFrame, ranks: dict[bytes, int], word: str = "word") -> DataFrame:
    """Distinct ``word`` strings with ``ids``, by higher-order functions only: a round merges the leftmost pair of the
    lowest rank and looks up the two pairs that this makes anew."""
    rank = rank_of(ranks)

    def step(acc: Column, _: Column) -> Column:
        parts, near = acc["parts"], acc["near"]
        i = F.array_position(near, F.array_min(near)).cast("int")
        merged = F.concat(F.get(parts, i - 1), F.get(parts, i))
        before = F.when(i > 1, F.array(rank(F.concat(F.get(parts, i - 2), merged)))).otherwise(F.slice(near, 1, 0))
        after = F.when(i + 1 < F.size(parts), F.array(rank(F.concat(merged, F.get(parts, i + 1))))).otherwise(F.slice(near, 1, 0))
        done = F.struct(
            F.concat(F.slice(parts, F.lit(1), i - 1), F.array(merged), F.slice(parts, i + 2, F.size(parts))).alias("parts"),
            F.concat(F.slice(near, F.lit(1), F.greatest(i - 2, F.lit(0))), before, after, F.slice(near, i + 2, F.size(parts))).alias("near"),
        )
        return F.when((F.size(near) == 0) | (F.array_min(near) == NONE), acc).otherwise(done)

    raw = F.encode(F.col(word), "UTF-8")
    single = F.transform(F.sequence(F.lit(1), F.length(raw)), lambda i: F.substring(raw, i, F.lit(1)))
    near = F.transform(F.slice(F.sequence(F.lit(1), F.length(raw)), F.lit(1), F.length(raw) - 1), lambda i: rank(F.substring(raw, i, F.lit(2))))
    rounds = F.slice(F.sequence(F.lit(1), F.length(raw)), F.lit(1), F.length(raw) - 1)
    folded = F.aggregate(rounds, F.struct(single.alias("parts"), near.alias("near")), step, lambda acc: acc["parts"])
    merged = F.when(rank(raw) < NONE, F.array(raw)).otherwise(folded)
    parts = free_name(words, "_parts")
    return words.withColumn(parts, F.explode(F.array(merged))).withColumn(
        "ids", F.transform(parts, lambda p: rank(p).cast("int"))).drop(parts)


def op10_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, folder, "documents")
    return digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


QUERIES = {"op10_byte_bpe": op10_byte_bpe}
ORACLE: dict[str, str] = {}
