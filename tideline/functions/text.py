"""String helpers: tokens, keys, joined sets and dictionary search."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Splits on runs of ASCII characters that are neither letters nor digits, so
# text in other scripts is kept and the split is the same in every engine.
WORD_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def first_token(text: Column, sep: str = " ") -> Column:
    return F.substring_index(text, sep, 1)


def last_token(text: Column, sep: str = ",") -> Column:
    """Last non-empty trailing token: separators at the end do not count."""
    trimmed = F.regexp_replace(text, f"(?:{sep})+\\z", "")
    return F.substring_index(trimmed, sep, -1)


def joined_set(values: Column, sep: str = ",") -> Column:
    """Distinct values in a stable order as one string."""
    return F.array_join(F.array_sort(F.array_distinct(values)), sep)


def md5_key(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def negate(amount: Column, kind: str = "decimal(16,2)") -> Column:
    """Numeric negation of an amount held as text; unreadable text gives null."""
    return -amount.try_cast(kind)


def words(text: Column) -> Column:
    """Lower-case words of a text as an array, without empty entries."""
    return F.filter(F.split(F.lower(text), WORD_BREAK), lambda w: w != "")


def explode_words(df: DataFrame, text: str, out: str = "keyword") -> DataFrame:
    """One row per word; rows without a word disappear, as with a lateral table."""
    return df.withColumn(out, F.explode(words(F.col(text)))).drop(text)


def register_word_function(spark: SparkSession, name: str = "word_split") -> None:
    """SQL table function ``name(text)`` for ``LATERAL``; inlined by the optimizer."""
    pattern = WORD_BREAK.replace("\\", "\\\\")
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(body STRING) RETURNS TABLE (keyword STRING) "
        f"RETURN SELECT w FROM (SELECT explode(split(lower(body), '{pattern}')) AS w) WHERE w <> ''"
    )


def words_in_text(text: Column, dictionary: Sequence[str]) -> Column:
    """Dictionary words that occur in a text, in dictionary order."""
    return F.filter(
        F.array(*[F.lit(w) for w in dictionary]).cast("array<string>"),
        lambda w: F.contains(text, w),
    )


def dictionary_hits(df: DataFrame, key: str, text: str, dictionary: DataFrame, word: str = "word") -> DataFrame:
    """``(key, words)`` for a dictionary too long to test word by word.

    Every place of a text is looked up once, by as many characters as the
    shortest word has; only the words that begin with them are then searched in
    the text.  The work is linear in the text, whatever the lengths of the
    words, and the dictionary is never collected.  ``key`` must identify a row.
    """
    entries = dictionary.select(F.col(word).alias("_w")).where("_w <> ''").distinct()
    # One number: the length of the shortest word.
    least = entries.agg(F.min(F.length("_w")).alias("_n")).scalar()
    anchors = entries.select("_w", F.substring("_w", F.lit(1), least).alias("_a"))
    # A look-ahead matches at every place, in one pass over the text.
    at_each = F.concat(F.lit("(?s)(?=(.{"), least.cast("string"), F.lit("}))"))
    pieces = df.select(
        F.col(key), F.explode(F.array_distinct(F.regexp_extract_all(F.col(text), at_each, F.lit(1)))).alias("_a")
    )
    likely = pieces.join(anchors, "_a").groupBy(key).agg(F.collect_set("_w").alias("_likely"))
    found = df.select(F.col(key), F.col(text).alias("_text")).join(likely, key).select(
        key, F.array_sort(F.filter("_likely", lambda w: F.contains(F.col("_text"), w))).alias("words")
    )
    return found.where(F.size("words") > 0)
