"""Secret scans with corpus-wide ownership.

Patterns find candidates in every whole text in one narrow pass.  What tells a
live credential from a documentation example is who has it: the hash of every
candidate is counted by distinct documents (repositories) and distinct sources
(owners) over the whole corpus.  Hashes of at least ``EXAMPLE_OWNERS`` owners,
or in more than ``EXAMPLE_REPOSITORIES`` repositories of whatever owners, are
widely copied examples, the others belong to somebody and look live.

Beyond the base kinds, long mixed tokens are candidates too.  Alone they prove
nothing, so they become spans, of the kind ``owned``, only if they have fewer
than ``EXAMPLE_OWNERS`` owners; those of several owners are listed once more in
``shared_spans``.  All of them count as live or copied.  Base spans always
stay.

Only hashes are shuffled, each level of distinct counts combined before it
moves; the texts stay where they are.

Defined results: a null text counts as empty; rows without a source share one
owner; a null id counts as one repository of its owner; repeated rows are one
repository and get equal results; an empty table gives an empty result; input
columns named like a result give way to it.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tideline.llm.frames import bounded_batches, stored
from tideline.plans.tables import table

#: Owners from which on a candidate is a widely copied example.
EXAMPLE_OWNERS = 3
#: A candidate in more distinct documents is one too, even if a single owner has them all.
EXAMPLE_REPOSITORIES = 10
#: Least entropy, in bits a character, of a token of the kind ``owned``.
LEAST_BITS = 3.5

KINDS = ("assign", "access", "hex", "owned")


def _either(words: str) -> str:
    """ASCII letters in either case, and nothing that only folds to them."""
    return re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", words)


ASSIGN = re.compile(
    "(?:" + _either("password|passwd|secret|token|api_?key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")


def _bits(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def find(text: str) -> list[tuple[int, int, int, str]]:
    """Candidates as (start, kind, end, value), in this order."""
    found = []
    for m in ASSIGN.finditer(text):
        if m.end(1) - m.start(1) >= 6:
            found.append((m.start(), 0, m.end(), m[1]))
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    base = sorted((s, e) for s, _, e, _ in found)
    for m in TOKEN.finditer(text):
        v = m[0]
        mixed = any(c.isdigit() for c in v) and any(c.isalpha() for c in v)
        if mixed and not any(s < m.end() and m.start() < e for s, e in base) and _bits(v) >= LEAST_BITS:
            found.append((m.start(), 3, m.end(), v))
    return sorted(found)


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


_SPAN = T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("kind", T.IntegerType()),
    T.StructField("end", T.IntegerType()), T.StructField("h", T.LongType()),
])


def scan(docs: DataFrame, owner: str) -> DataFrame:
    """``(doc_id, owner, base_sha256, found)`` of every row."""
    bounded_batches(docs.sparkSession)
    df = docs.select("doc_id", F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"), "text")
    schema = T.StructType([
        *df.schema.fields[:2], T.StructField("base_sha256", T.StringType()), T.StructField("found", T.ArrayType(_SPAN)),
    ])

    def run(batches):
        for batch in batches:
            digests, found = [], []
            for text in pc.fill_null(batch.column("text"), "").to_pylist():
                spans = find(text)
                base = _joined([s[:3] for s in spans if s[1] < 3])
                digests.append(hashlib.sha256(base.encode()).hexdigest())
                found.append([
                    {"start": s, "kind": k, "end": e, "h": xxhash.xxh64_intdigest(v.encode(), 7) - (1 << 63)}
                    for s, k, e, v in spans
                ])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("owner"), pa.array(digests, pa.string()),
                 pa.array(found, pa.list_(pa.struct([
                     ("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("h", pa.int64())])))],
                schema.names,
            )

    return df.mapInArrow(run, schema)


def ownership(scanned: DataFrame) -> DataFrame:
    """``(h, repositories, owners)`` of every candidate."""
    places = scanned.where(F.size("found") > 0).select("doc_id", "owner", F.explode(F.array_distinct("found.h")).alias("h"))
    return (
        places.groupBy("h", "owner", "doc_id").agg(F.lit(1).alias("one"))
        .groupBy("h", "owner").agg(F.count("*").alias("n"))
        .groupBy("h").agg(F.sum("n").alias("repositories"), F.count("*").alias("owners"))
    )


def find_secrets(
    docs: DataFrame, owner: str = "source", example_owners: int = EXAMPLE_OWNERS,
    example_repositories: int = EXAMPLE_REPOSITORIES,
) -> DataFrame:
    """``doc_id``, counts and digest of the base spans, all spans, how many of them are live or copied, spans of several owners."""
    scanned = stored(scan(docs, owner).withColumn("row", F.monotonically_increasing_id()), "secrets")
    hits = scanned.where(F.size("found") > 0).select("row", F.inline("found"))
    judged = hits.join(ownership(scanned), "h")
    copied = (F.col("owners") >= example_owners) | (F.col("repositories") > example_repositories)
    owned = (F.col("kind") == 3) & (F.col("owners") < example_owners)
    chosen, shared = (F.col("kind") < 3) | owned, owned & (F.col("owners") > 1)
    spans = lambda which: F.concat_ws(",", F.transform(
        F.sort_array(F.collect_list(F.when(which, F.struct("start", "kind", "end")))),
        lambda s: F.concat_ws(":", F.get(F.array(*map(F.lit, KINDS)), s["kind"]), s["start"], s["end"]),
    ))
    by_row = judged.groupBy("row").agg(
        spans(chosen).alias("spans"), spans(shared).alias("shared_spans"),
        F.count_if(chosen & ~copied).alias("n_live"), F.count_if(chosen & copied).alias("n_copied"),
        F.max("repositories").alias("most_repositories"), F.max("owners").alias("most_owners"),
    )
    kinds = F.transform("found", lambda s: s["kind"])
    count = [F.size(F.filter(kinds, lambda x: x == F.lit(k))).cast("long") for k in range(3)]
    totals = ("n_live", "n_copied", "most_repositories", "most_owners")
    return scanned.join(by_row, "row", "left").select(
        "doc_id", count[0].alias("n_assign"), count[1].alias("n_access"), count[2].alias("n_hex"), "base_sha256",
        F.coalesce("spans", F.lit("")).alias("spans"),
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in totals],
        F.coalesce("shared_spans", F.lit("")).alias("shared_spans"),
    )


def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return find_secrets(table(spark, folder, "documents"))


QUERIES = {"op7_secrets": op7_secrets}
ORACLE: dict[str, str] = {}
