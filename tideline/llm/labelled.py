"""Bounded training samples for the two classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tideline.llm.frames import held_out


def smallest_hashes(rows: DataFrame, key: str, bound: int, total: int) -> DataFrame:
    """The ``bound`` rows, of ``total``, with the smallest hashes of ``key``; equal hashes are ordered by the key.

    Rows beyond one and a half times the share wanted are filtered in the scan,
    so a task hands on its part of about that many rows and not ``bound`` each.
    """
    h = F.shiftrightunsigned(F.xxhash64(key), 32)
    share = min(1.0, (1.5 * bound + 100) / max(1, total))
    return rows.where(h <= int(share * (1 << 32))).orderBy(h, key).limit(bound)


def labelled_texts(docs: DataFrame, labels: DataFrame, column: str, bound: int, only: int | None = None) -> DataFrame:
    """``(doc_id, y, text)`` of at most ``bound`` labelled ids outside the held-out fold.

    The ids are those with the smallest hashes, so the sample does not depend
    on the order of rows; an id labelled twice takes the larger label.  At most
    ``bound`` ids of 12 bytes are broadcast.
    """
    known = labels.select("doc_id", F.col(column).cast("int").alias("y")).where(
        F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()
    )
    ids = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    if only is not None:
        ids = ids.where(F.col("y") == only)
    ids = smallest_hashes(ids, "doc_id", bound, ids.count())
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("doc_id", "y", "text")
