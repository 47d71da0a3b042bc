"""The corpus pipeline: five stages, each written as Parquet and read again by the next.

Quality classifier, line deduplication, near-duplicate removal and benchmark
decontamination keep the columns of ``documents``; the last stage encodes what
is left and decodes it again.

Defined results: without labels no document is rejected; rows of equal id and
text are one document to line deduplication and leave one row of their group;
null and empty texts share a fingerprint, so one of them stays, and have no
tokens; null ids are ordinary rows, after all others in the order of ids; extra
columns travel on to the fourth stage; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tideline.llm import byte_bpe, decontaminate, line_dedup, quality, simhash
from tideline.llm.frames import free_name, stored
from tideline.plans.tables import table

#: Not expressible in SQL: the classifier, the fingerprints and the merges.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labels of these documents, does not reject."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.drop_rejected(docs, model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that repeat an earlier passage; ``n_chars`` follows the text."""
    names = tuple(free_name(docs, n) for n in ("_lines", "_removed"))
    kept = line_dedup.dedupe_lines(docs, names=names).drop(*names)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(
            F.length("text").cast(docs.schema["n_chars"].dataType)))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document left."""
    import public_tokenizers

    return byte_bpe.digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_repeated_lines),
    ("simhash near-dedup", keep_one_of_each_group),
    ("benchmark decontamination", drop_benchmark),
    ("byte-level bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage{k}")
    return docs
