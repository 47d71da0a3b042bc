"""SimHash near-duplicates by multi-index hashing.

A fingerprint of 64 bits is cut into three segments.  Two fingerprints that
differ in at most four bits differ in at most one bit of some segment, so
every distinct fingerprint is entered under its three segment values, and
looks up the Hamming ball of radius one around each.  Of a pair that differs
in one bit of a segment, one has a 0 there: looking up only what turns a 0
into a 1 finds it once, with half the look-ups.  The full distance decides.

What shares a segment value is compared in numpy, in bounded pieces; only a
spanning forest of the links found leaves a piece, never all pairs.  A segment
value that many fingerprints share is dealt to pairs of blocks, so a group of
near copies of any size spreads over tasks.  Exact copies are one fingerprint.

Defined results: null and empty texts, and texts without words, have the
fingerprint zero and are linked like any other; rows of equal id are rows like
any other; a null id is never a component's id unless the component has no
other (then null); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tideline.llm.components import components
from tideline.llm.frames import bounded_batches, free_name, stored, without
from tideline.llm.spans import LOWER, expand
from tideline.plans.tables import table

SHINGLE, SEED, DISTANCE = 4, 42, 4
#: (lowest bit, width) of the segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Fingerprints under one segment value that one task compares; beyond it they are dealt to blocks.
BLOCK = 8_000
#: Pairs compared at once.
PIECE = 2_000_000

_LOWER = LOWER.tobytes()


def fingerprint(text: str) -> int:
    """64-bit SimHash over the hashes of the word shingles."""
    words = text.encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < SHINGLE:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        end = np.cumsum(sizes + 1) - 1
        begin = (end - sizes)[: len(words) - SHINGLE + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(begin, end[SHINGLE - 1:].tolist())]
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.array(hashes[at:at + (1 << 16)], dtype=">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(bits, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def with_fingerprint(docs: DataFrame, name: str = "fp", gone: Sequence[str] = ()) -> DataFrame:
    """The documents, without the columns ``gone``, with the fingerprint as a signed 64-bit number."""
    bounded_batches(docs.sparkSession)
    fields = without(docs.schema, [name, *gone]).fields
    schema = T.StructType([*fields, T.StructField(name, T.LongType())])

    def run(batches):
        for batch in batches:
            prints = [fingerprint(t) for t in pc.fill_null(batch.column("text"), "").to_pylist()]
            signed = np.array(prints, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in fields], pa.array(signed)], schema.names)

    return docs.mapInArrow(run, schema)


#: What a row does under a segment value: an entry that also compares itself with later entries, an entry that is
#: only looked up, a look-up.
BOTH, SERVES, ASKS = 0, 1, 2


def _entries(prints: DataFrame, look_up: bool) -> DataFrame:
    """``(key, role, fp)``: the entries and, if asked for, the look-ups of distinct fingerprints."""

    def run(batches):
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            keys, roles, rows = [], [], []

            def add(key: np.ndarray, role: int, row: np.ndarray) -> None:
                keys.append(key)
                roles.append(np.full(len(row), role, dtype=np.int8))
                rows.append(row)

            for number, (low, width) in enumerate(SEGMENTS):
                key = ((fp >> np.uint64(low)) & np.uint64((1 << width) - 1)) | np.uint64(number << 32)
                add(key, BOTH, np.arange(len(fp)))
                for bit in range(width if look_up else 0):
                    zero = np.flatnonzero(key & np.uint64(1 << bit) == 0)
                    add(key[zero] | np.uint64(1 << bit), ASKS, zero)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(roles)),
                 pa.array(fp[np.concatenate(rows)].view(np.int64))],
                ["key", "role", "fp"],
            )

    return prints.select("fp").mapInArrow(run, "key long, role byte, fp long")


def _dealt(prints: DataFrame, block: int) -> DataFrame:
    """Entries and look-ups with the part of their segment value in which they meet.

    Most values have one part.  Where many fingerprints share a value, its
    entries are dealt to ``b`` blocks, which meet pair by pair, and the
    look-ups to ``c`` blocks, which meet each block of entries.
    """
    counts = _entries(prints, False).groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > block)
    # Look-ups come from the values that have one bit less.
    near = counts.select("n", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(21)), lambda i: F.col("key").bitwiseOR(
            F.call_function("shiftleft", F.lit(1).cast("long"), i)))).alias("key"), F.col("key").alias("from")
    ).where("key <> from")
    hot = stored(
        counts.select("key", F.col("n").alias("t"), F.lit(0).cast("long").alias("p"))
        .union(near.select("key", F.lit(0).cast("long"), "n"))
        .groupBy("key").agg(F.ceil(F.sum("t") / block).alias("b"), F.ceil(F.sum("p") / block).alias("c"))
        .select("key", F.greatest("b", F.lit(1)).cast("int").alias("b"), F.greatest("c", F.lit(1)).cast("int").alias("c")),
        "hot",
    )
    rows = _entries(prints, True)
    if not hot.head(1):
        return rows.withColumn("part", F.lit(0).cast("long"))
    own = F.pmod(F.xxhash64("fp"), F.col("b")).cast("int")
    blocks, asking = F.sequence(F.lit(0), F.col("b") - 1), F.sequence(F.lit(1), F.col("c"))

    def part(x, y, z):
        return ((x.cast("long") * F.col("b") + y) * (F.col("c") + 1) + z).alias("part")

    both = F.transform(blocks, lambda i: F.struct(
        part(F.least(own, i), F.greatest(own, i), F.lit(0)), F.lit(BOTH).cast("byte").alias("role")))
    serves = F.transform(asking, lambda z: F.struct(part(own, own, z), F.lit(SERVES).cast("byte").alias("role")))
    asker = 1 + F.pmod(F.xxhash64("fp", F.lit(1)), F.col("c")).cast("int")
    asks = F.transform(blocks, lambda i: F.struct(part(i, i, asker), F.lit(ASKS).cast("byte").alias("role")))
    single = F.array(F.struct(F.lit(0).cast("long").alias("part"), F.col("role").alias("role")))
    places = F.when(F.col("b").isNull(), single).when(F.col("role") == ASKS, asks).otherwise(F.concat(both, serves))
    return rows.join(hot, "key", "left").select("key", "fp", F.inline(places))


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of links: every node but the smallest of its tree, with that smallest one."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = flat[: len(a)], flat[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    other = root != np.arange(len(nodes))
    return nodes[other], nodes[root[other]]


def _compare(key: np.ndarray, part: np.ndarray, role: np.ndarray, fp: np.ndarray, distance: int):
    """Links among whole groups of equal (key, part), rows sorted by role within each."""
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (part[1:] != part[:-1])
    begin = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    middle = begin + np.add.reduceat(role != ASKS, begin)
    first = np.where(role == ASKS, begin[group], np.arange(len(key)) + 1)
    last = np.where(role == SERVES, 0, middle[group])
    total = np.cumsum(np.maximum(last - first, 0))
    at = 0
    while at < len(key):
        done = total[at - 1] if at else 0
        until = max(at + 1, int(np.searchsorted(total, done + PIECE, "right")))
        mine, owner = expand(first[at:until], last[at:until])
        x, y = fp[at + owner], fp[mine]
        close = np.bitwise_count(x ^ y) <= distance
        a, b = x[close].view(np.int64), y[close].view(np.int64)
        if len(a):
            yield _forest(a, b)
        at = until


def links(prints: DataFrame, distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """``(a, b)``: enough links between distinct ``fp`` to connect all that differ in at most ``distance`` bits."""
    if distance >= 2 * len(SEGMENTS):
        raise ValueError(f"{len(SEGMENTS)} segments find distances below {2 * len(SEGMENTS)}")
    bounded_batches(prints.sparkSession)
    sorted_rows = _dealt(prints, block).repartition("key", "part").sortWithinPartitions("key", "part", "role")

    def run(batches):
        kept = None
        for batch in batches:
            rows = [batch.column(c).to_numpy() for c in ("key", "part", "role", "fp")]
            rows[3] = rows[3].view(np.uint64)
            if kept is not None:
                rows = [np.concatenate(x) for x in zip(kept, rows)]
            key, part = rows[:2]
            # The last group may go on in the next batch.
            if not len(key):
                continue
            changes = np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1]))
            whole = int(changes[-1]) + 1 if len(changes) else 0
            kept = [x[whole:] for x in rows]
            if whole:
                for a, b in _compare(*[x[:whole] for x in rows], distance):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
        if kept is not None and len(kept[0]):
            for a, b in _compare(*kept, distance):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return sorted_rows.select("key", "part", "role", "fp").mapInArrow(run, "a long, b long")


def component_ids(prints: DataFrame) -> DataFrame:
    """``(fp, root, component_id)`` for every distinct ``fp`` of ``prints(doc_id, fp)``."""
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    roots = components(links(distinct))
    joined = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    joined = stored(joined, "roots")
    ids = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    return joined.join(ids, "root").select("fp", "root", "component_id")


def find_groups(docs: DataFrame) -> DataFrame:
    """``doc_id, fp, component_id`` of every document."""
    prints = stored(with_fingerprint(docs.select("doc_id", "text"), gone=["text"]), "simhash")
    return prints.join(component_ids(prints), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component: the one of the smallest id (null last), then of the first row."""
    row = free_name(docs, "_row")
    kept = stored(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    texts = kept.select("doc_id", F.col(row).alias("row"), "text")
    prints = stored(with_fingerprint(texts, gone=["text"]), "simhash")
    groups = component_ids(prints.select("doc_id", "fp"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
    best = prints.groupBy("fp").agg(first.alias("best")).join(groups, "fp")
    chosen = best.groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.row").alias(row))
    # Hash the numbers, a few bytes a document: the texts are shuffled but not sorted.
    return kept.join(chosen.hint("shuffle_hash"), row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = find_groups(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op8_simhash": op8_simhash}
ORACLE: dict[str, str] = {}
