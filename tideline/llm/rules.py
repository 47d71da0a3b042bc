"""Quality rules: text counts, and how often a line occurs across the documents of a host.

DataFrame functions only.  Lines are normalised (ASCII lower case, white space
collapsed) and hashed; each document counts a line once.  A line is frequent
on a host when more than ``MIN_DOCS`` documents and more than ``MAX_SHARE`` of
the host's documents have it, and, on a host of any size, when more than
``MANY_DOCS`` documents have it.  Frequent lines are removed, and a document
that keeps less than ``MIN_LEFT`` of the words of its distinct lines is
depleted.

``remove_frequent`` gives the texts that are left: the places of the frequent
lines are found by hash and the text is cut there, each text once.  ``judge``
counts the words of the same lines.

For the verdicts the texts do not travel: the first pass writes a hash and a word count for
each line, counts are combined before they are shuffled, and Catalyst picks
the join with the frequent lines by their size on disk.

Repeated three-word windows are found within the row: an exact set of window
hashes tells whether there are any, and only then are the windows sorted.
Large intermediate arrays come out of ``explode(array(x))``, which keeps
Catalyst from computing them again for every element.

Defined results: a null text has no words and fails; documents without a host
share one host of their own; rows of equal id, host and text are counted as
the rows they are and get equal results; an empty table gives an empty result;
input columns named like a result give way to it.  Blank lines stay in a text,
and a null text stays null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tideline.llm.frames import free_name, stored
from tideline.plans.tables import table

MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
#: A line is frequent in more than so many documents, and in more than this share of the documents of its host;
#: or in more than ``MANY_DOCS`` documents.
MIN_DOCS, MAX_SHARE, MANY_DOCS = 10, 0.05, 1_000
#: Share of the words of its distinct lines that a document has to keep.
MIN_LEFT = 0.3

_SPACE = " \t\n\x0b\f\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SYMBOLS = "#*$%&|<>"


def _once(column: Column) -> Column:
    """Compute ``column`` here, whatever is made of it later."""
    return F.explode(F.array(column))


def text_counts(docs: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    solid = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(_SPACE)) != "")
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines"]
    df = docs.select(
        *keys,
        F.length(F.translate(text, _SPACE, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, _SYMBOLS, ""))).cast("long").alias("n_symbols"),
        _once(solid).alias("lines"), "text",
    ).select(
        *keys, "word_chars", "n_symbols", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _once(F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), "")).alias("w"),
    )
    at = F.sequence(F.lit(1), F.size("w") - 2)
    windows = F.transform(at, lambda i: F.xxhash64(F.get("w", i - 1), F.get("w", i), F.get("w", i + 1)))
    df = df.select(
        *keys, *counts[1:], F.size("w").cast("long").alias("n_words"),
        _once(F.when(F.size("w") >= 3, windows).otherwise(F.array().cast("array<bigint>"))).alias("g"),
    )
    ordered = F.sort_array(F.transform("g", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    df = df.select(*keys, *counts, _once(
        F.when(F.size(F.array_distinct("g")) < F.size("g"), ordered).otherwise(none)
    ).alias("s"))
    same = F.transform("s", lambda x, k: F.when(
        (F.coalesce(F.get("s", k - 1)["h"] == x["h"], F.lit(False)))
        | (F.coalesce(F.get("s", k + 1)["h"] == x["h"], F.lit(False))), x["i"]))
    df = df.select(*keys, *counts, _once(F.sort_array(F.filter(same, lambda x: x.isNotNull()))).alias("p"))
    covered = F.transform("p", lambda x, k: F.least(F.lit(3), F.coalesce(F.get("p", k + 1) - x, F.lit(3))))
    df = df.select(*keys, *counts, F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_repeat_words"))
    return df.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")))


def document_lines(docs: DataFrame, keys: list[str], host: str) -> DataFrame:
    """``keys``, host, every line of each document as (hash, words; 0 of a blank one) and the words of its distinct lines."""
    text = F.translate(F.coalesce(F.col("text"), F.lit("")), _UPPER, _UPPER.lower())
    lines = F.transform(F.split(F.regexp_replace(text, r"[\x20\x09\x0B-\x0D]+", " "), "\n"), lambda x: F.btrim(x, F.lit(" ")))
    words = lambda x: F.length(x) - F.length(F.translate(x, " ", "")) + 1
    distinct = F.array_distinct(F.filter("lines", lambda x: x != ""))
    return docs.select(*keys, F.coalesce(host, F.lit("")).alias("host"), _once(lines).alias("lines")).select(
        *keys, "host",
        F.transform("lines", lambda x: F.struct(
            F.xxhash64(x).alias("h"), F.when(x == "", 0).otherwise(words(x)).alias("w"))).alias("lines"),
        F.aggregate(distinct, F.lit(0).cast("long"), lambda a, x: a + words(x)).alias("line_words"),
    )


def frequent_lines(
    lines: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, many_docs: int = MANY_DOCS,
) -> DataFrame:
    """``(host, h)`` of the lines above the first two limits, or in more than ``many_docs`` documents of any host."""
    sizes = lines.groupBy("host").agg(F.count("*").alias("total"))
    solid = F.filter("lines", lambda x: x["w"] > 0)
    counts = (
        lines.select("host", F.explode(F.array_distinct(solid["h"])).alias("h")).groupBy("host", "h").agg(F.count("*").alias("n"))
        .where(F.col("n") > min(min_docs, many_docs))
    )
    above = (F.col("n") > min_docs) & (F.col("n") > max_share * F.col("total"))
    return counts.join(sizes, "host").where(above | (F.col("n") > many_docs)).select("host", "h")


def removed_lines(lines: DataFrame, keys: list[str], many_docs: int = MANY_DOCS) -> DataFrame:
    """``keys`` and host of the documents with frequent lines, the places of these lines, and the words of the distinct ones."""
    frequent = stored(frequent_lines(lines, many_docs=many_docs), "frequent")
    return (
        lines.select(*keys, "host", F.posexplode("lines").alias("at", "line")).where(F.col("line.w") > 0)
        .select(*keys, "host", "at", "line.h", "line.w").join(frequent, ["host", "h"])
        .groupBy(*keys, "host", "h").agg(F.max("w").alias("w"), F.collect_set("at").alias("at"))
        .groupBy(*keys, "host").agg(
            F.sum("w").alias("removed_words"), F.sort_array(F.flatten(F.collect_list("at"))).alias("removed_at"))
    )


def remove_frequent(docs: DataFrame, host: str = "source", many_docs: int = MANY_DOCS) -> DataFrame:
    """``docs`` with the ``text`` that is left without the frequent lines; ``judge`` counts the words of these lines."""
    keys = ["doc_id", "digest"]
    keyed = docs.select("doc_id", host, "text", F.xxhash64("text").alias("digest"))
    lines = stored(document_lines(keyed, keys, host), "lines")
    gone, at, raw = (free_name(docs, n) for n in ("_gone", "_at", "_raw"))
    removed = removed_lines(lines, keys, many_docs).select(F.struct("doc_id", "digest", "host").alias(gone), F.col("removed_at").alias(at))
    both = docs.join(
        removed, docs["doc_id"].eqNullSafe(F.col(f"{gone}.doc_id")) & F.xxhash64(docs["text"]).eqNullSafe(F.col(f"{gone}.digest"))
        & (F.coalesce(docs[host], F.lit("")) == F.col(f"{gone}.host")), "left"
    ).withColumn(raw, _once(F.split("text", "\n")))
    first = lambda k: F.coalesce(F.get(at, k - 1) + 1, F.lit(0))
    left = F.transform(F.sequence(F.lit(0), F.size(at)), lambda k: F.slice(
        raw, first(k) + 1, F.coalesce(F.get(at, k), F.size(raw)) - first(k)))
    text = F.when(F.col(at).isNull(), F.col("text")).otherwise(F.array_join(F.flatten(left), "\n"))
    return both.select(*[(text if c == "text" else F.col(f"`{c}`")).alias(c) for c in docs.columns])


def judge(docs: DataFrame, host: str = "source", min_left: float = MIN_LEFT, many_docs: int = MANY_DOCS) -> DataFrame:
    """``doc_id``, the counts, base_failed, the words of distinct lines in all and in frequent lines, and ``kept``."""
    keyed = docs.select("doc_id", host, "text", F.xxhash64("text").alias("digest"))
    keys = ["doc_id", "digest"]
    lines = stored(document_lines(keyed, keys, host), "lines")
    removed = removed_lines(lines, keys, many_docs).select(
        F.col("doc_id").alias("id"), F.col("digest").alias("d"), F.col("host").alias("owner"), "removed_words")
    # Copies of a row have equal totals: any of them will do.
    totals = lines.groupBy(*keys).agg(F.max("line_words").alias("line_words"))
    counts = text_counts(keyed.withColumn("host", F.coalesce(host, F.lit(""))), [*keys, "host"])
    both = counts.join(
        removed, F.col("doc_id").eqNullSafe(F.col("id")) & F.col("digest").eqNullSafe(F.col("d"))
        & (F.col("host") == F.col("owner")), "left"
    ).drop("id", "d", "owner")
    totals = totals.select(F.col("doc_id").alias("id"), F.col("digest").alias("d"), "line_words")
    both = both.join(totals, F.col("doc_id").eqNullSafe(F.col("id")) & F.col("digest").eqNullSafe(F.col("d")))
    gone = F.coalesce("removed_words", F.lit(0))
    depleted = F.col("line_words") - gone < min_left * F.col("line_words")
    return both.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "line_words", gone.cast("long").alias("removed_words"), (~F.col("base_failed") & ~depleted).alias("kept"),
    )


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return judge(table(spark, folder, "documents"))


_WORDS = r"[^\x20\x09-\x0D]+"
SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w
  FROM documents),
grams AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT k) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS k FROM again) GROUP BY r),
raw AS (SELECT r, host, unnest(string_split(text, chr(10))) AS line FROM d),
solid AS (SELECT *, regexp_extract_all(line, '{_WORDS}') AS lw FROM raw WHERE regexp_matches(line, '{_WORDS}')),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM solid GROUP BY r),
lines AS (
  SELECT DISTINCT r, host, translate(array_to_string(lw, ' '), '{_UPPER}', '{_UPPER.lower()}') AS norm, len(lw) AS lw
  FROM solid),
sizes AS (SELECT host, count(*) AS total FROM d GROUP BY host),
frequent AS (
  SELECT host, norm FROM (SELECT host, norm, count(*) AS n FROM lines GROUP BY ALL) JOIN sizes USING (host)
  WHERE n > {MIN_DOCS} AND n > CAST({MAX_SHARE} AS DOUBLE) * total OR n > {MANY_DOCS}),
words AS (
  SELECT r, sum(lw) AS line_words, coalesce(sum(lw) FILTER (f.norm IS NOT NULL), 0) AS removed_words
  FROM lines l LEFT JOIN frequent f ON l.host = f.host AND l.norm = f.norm GROUP BY r),
c AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(text) - length(translate(text, '{_SYMBOLS}', '')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(line_words, 0) AS line_words,
    coalesce(removed_words, 0) AS removed_words
  FROM d LEFT JOIN rep USING (r) LEFT JOIN dup USING (r) LEFT JOIN words USING (r))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, CAST(line_words AS BIGINT) AS line_words,
  CAST(removed_words AS BIGINT) AS removed_words,
  n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words)
    AND NOT (line_words - removed_words < CAST({MIN_LEFT} AS DOUBLE) * line_words) AS kept
FROM c
"""

QUERIES = {"op4_quality_rules": op4_quality_rules}
ORACLE = {"op4_quality_rules": SQL}
