"""Comment moderation against a dictionary of banned words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tideline.functions.text import dictionary_hits, last_token, words_in_text
from tideline.operators.joins import member_flag

#: A list longer than this is joined as a table if the rows have a key; both plans give the same rows.
LITERAL_WORDS = 5_000


def moderate(df: DataFrame, text: str, dictionary: Sequence[str] | DataFrame, key: str | None = None) -> DataFrame:
    """Violation level of each text, for a list of words or a table with the column ``word``.

    A list is folded into the plan; a table, or a long list where ``key``
    identifies a row, is joined.

    ``P0`` when the last comma-separated part is a banned word, else ``P1``
    when the text contains any, else empty.  ``violation_msg`` names the word
    or words.
    """
    if isinstance(dictionary, DataFrame):
        if key is None:
            raise ValueError("a table of words needs the name of a key of the rows")
        return moderate_by_join(df, key, text, dictionary)
    banned = sorted(set(dictionary))
    if len(banned) > LITERAL_WORDS and key is not None:
        return moderate_by_join(df, key, text, df.sparkSession.createDataFrame([(w,) for w in banned], "word string"))
    last = last_token(F.col(text))
    listed = F.coalesce(last.isin(*banned), F.lit(False))
    found = F.array_join(words_in_text(F.col(text), banned), ", ")
    checked = df.withColumns({"_last": last, "_hit": listed, "_found": F.when(~listed, found)})
    return _grade(checked, "_hit", "_found", "_last")


def moderate_by_join(df: DataFrame, key: str, text: str, dictionary: DataFrame, word: str = "word") -> DataFrame:
    """As :func:`moderate`, for a dictionary table of any size.  ``key`` identifies a row."""
    hits = dictionary_hits(df, key, text, dictionary, word).select(
        key, F.array_join("words", ", ").alias("_found")
    )
    flagged = member_flag(df.withColumn("_last", last_token(F.col(text))), dictionary, "_last", word, "_hit")
    joined = flagged.join(hits, key, "left").withColumn("_hit", F.col("_hit") == 1)
    return _grade(joined, "_hit", "_found", "_last").select(
        *df.columns, "is_violation", "violation_grade", "violation_msg"
    )


def _grade(df: DataFrame, hit: str, found: str, last: str) -> DataFrame:
    some = F.coalesce(F.col(found) != "", F.lit(False))
    return df.withColumns({
        "is_violation": F.col(hit).cast("int"),
        "violation_grade": F.when(F.col(hit), "P0").when(some, "P1").otherwise(""),
        "violation_msg": F.when(F.col(hit), F.col(last)).when(some, F.col(found)).otherwise(""),
    }).drop(hit, found, last)
