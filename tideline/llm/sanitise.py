"""Personal data, and the terms that give it away.

DataFrame functions only.  Patterns find e-mail addresses, IP addresses, card
and phone numbers in every whole text (the base spans).  Hiding them is not
enough where a word that always stands beside an address tells whose it was.
So the values found are protected entities, and the corpus tells how much
every term near one reveals of it.  With ``n`` documents, ``n(e)`` of them with
entity ``e``, ``n(t)`` with term ``t`` and ``n(e, t)`` with ``t`` near ``e``,

* a term gains ``log2(n * n(e, t) / (n(e) * n(t)))`` bits about the entity, its
  pointwise mutual information, and
* leaves ``-log2(n(e, t) / n(t))`` bits unknown to one who sees the term.

A term near an entity in at least ``CONTEXTS`` different surroundings (copies
of a text are one) that gains at least ``GAIN`` bits is removed wherever it
stands if it leaves at most ``log2(10 / 9)`` bits, and generalised if it leaves
at most one.  The conditions are compared as products of counts.

Near are ``NEAR`` characters on either side, so a text gives a bounded number
of pairs for each span, however long it is.  Terms are counted in all texts;
what is shuffled of a text is a hash for each distinct word, combined before
it moves, and the surroundings of spans.  A text that holds a term to hide is
read once more.

Defined results: a null text counts as empty; repeated rows are counted as the
rows they are and get equal results; an empty table gives an empty result;
base spans stay whatever the terms, and a term is not marked where it overlaps
one; extra columns are ignored by ``find_private`` and kept by ``sanitise``,
where a null text stays null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tideline.llm.frames import free_name, stored
from tideline.plans.tables import table

KINDS = ("email", "ip", "card", "phone", "removed", "generalised")
#: Characters on either side of a span, shortest term, least surroundings, and least gain in bits.
NEAR, LETTERS, CONTEXTS, GAIN = 100, 3, 2, 4
#: A term of this share of documents near one entity is removed, or generalised.
REMOVED, GENERALISED = (9, 10), (1, 2)

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LETTER = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"

# Possessive loops do not recurse, and a run of characters is tried from its
# beginning only (``\G`` is the end of the match before).
_LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){15,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"

_SPANS = "array<struct<start:int,end:int,value:string>>"


def _once(column: Column) -> Column:
    """Compute ``column`` here, whatever is made of it later."""
    return F.explode(F.array(column))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"{_LETTER}+"), F.lit(0))


def places(text: Column, pattern: Column) -> Column:
    """The matches of a pattern, leftmost first and apart, with their places in characters.

    The pieces between the matches and the matches themselves add up to the text.
    """
    pairs = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0)), lambda gap, value: F.struct(
        F.length(gap).alias("gap"), F.length(value).alias("size"), value.alias("value")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + x["gap"]
        end = begin + x["size"]
        return F.struct(end.alias("at"), F.concat(
            state["spans"], F.array(F.struct(begin.alias("start"), end.alias("end"), x["value"].alias("value")))).alias("spans"))

    found = F.aggregate(F.filter(pairs, lambda x: x["value"].isNotNull()), start, step, lambda state: state["spans"])
    return F.when(F.regexp_like(text, pattern), found).otherwise(F.array().cast(_SPANS))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Every second digit from the right counts twice, less 9 from 10 on; the sum ends in 0."""
    reverse = F.split(F.reverse(_digits(value)), "")
    parts = F.transform(reverse, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(parts, F.lit(0), lambda a, x: a + x) % 10 == 0


def base_spans(text: Column) -> list[Column]:
    """Spans of each base kind."""
    size = lambda x: F.length(_digits(x["value"]))
    return [
        places(text, F.lit(EMAIL)),
        F.filter(places(text, F.lit(IP)), lambda x: x["value"].rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")),
        F.filter(places(text, F.lit(CARD)), lambda x: size(x).between(16, 19) & _luhn(x["value"])),
        F.filter(places(text, F.lit(PHONE)), lambda x: size(x).between(8, 15)),
    ]


def surroundings(text: Column, span: Column) -> Column:
    """The lower-case text on both sides of a span, without the words cut at its ends or touching the span."""
    begin = F.greatest(span["start"] - NEAR, F.lit(0))
    left = F.substring(text, begin + 1, span["start"] - begin)
    left = F.when(begin > 0, F.regexp_replace(left, f"^{_LETTER}+", "")).otherwise(left)
    right = F.substring(text, span["end"] + 1, F.lit(NEAR))
    right = F.when(span["end"] + NEAR < F.length(text), F.regexp_replace(right, f"{_LETTER}+$", "")).otherwise(right)
    return F.concat_ws(" ", F.regexp_replace(left, f"{_LETTER}+$", ""), F.regexp_replace(right, f"^{_LETTER}+", ""))


def scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, digest, found)`` of every row; ``found`` has kind, place, entity and surroundings of the base spans."""
    text = F.coalesce("text", F.lit(""))
    df = docs.select("doc_id", F.xxhash64("text").alias("digest"), text.alias("text")).select(
        "doc_id", "digest", "text", _once(F.struct(*[c.alias(k) for k, c in zip(KINDS, base_spans(F.col("text")))])).alias("b"))
    none = F.array().cast("array<struct<kind:int,start:int,end:int,entity:string,near:string>>")
    low = lower_ascii(F.col("text"))

    def described(k: int) -> Column:
        entity = [lower_ascii, lambda value: value, _digits, _digits][k]
        return F.transform(f"b.{KINDS[k]}", lambda x: F.struct(
            F.lit(k).alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
            F.concat_ws(":", F.lit(KINDS[k]), entity(x["value"])).alias("entity"), surroundings(low, x).alias("near"),
        ))

    some = sum((F.size(f"b.{kind}") for kind in KINDS[1:4]), F.size(f"b.{KINDS[0]}")) > 0
    return df.select("doc_id", "digest", F.when(some, F.concat(*map(described, range(4)))).otherwise(none).alias("found"))


def revealing_terms(docs: DataFrame, scanned: DataFrame) -> DataFrame:
    """``(h, term, removed)`` of the terms to hide; ``scanned`` has a stable ``row``."""
    spans = scanned.where(F.size("found") > 0).select("row", F.explode("found").alias("s")).select("row", "s.entity", "s.near")
    near = spans.select("row", "entity", "near", F.explode(F.array_distinct(words(F.col("near")))).alias("term"))
    pairs = near.where(F.length("term") >= LETTERS).groupBy("entity", "term").agg(
        F.count_distinct("row").alias("both"), F.count_distinct(F.xxhash64("near")).alias("contexts")
    ).where(F.col("contexts") >= CONTEXTS)
    pairs = stored(pairs.withColumn("h", F.xxhash64("term")), "near_terms")
    entities = spans.groupBy("entity").agg(F.count_distinct("row").alias("with_entity"))
    counts = distinct_words(docs, []).groupBy("h").agg(F.count("*").alias("with_term"))
    total = scanned.count()
    judged = pairs.join(counts, "h").join(entities, "entity").where(
        (F.lit(float(total)) * F.col("both") >= float(1 << GAIN) * F.col("with_entity") * F.col("with_term"))
        & (GENERALISED[1] * F.col("both") >= GENERALISED[0] * F.col("with_term")))
    return judged.groupBy("h", "term").agg(
        F.bool_or(REMOVED[1] * F.col("both") >= REMOVED[0] * F.col("with_term")).alias("removed"))


def distinct_words(docs: DataFrame, keys: list[Column]) -> DataFrame:
    """``keys`` and the hash ``h`` of every distinct word of each row."""
    hashes = F.transform(words(lower_ascii(F.coalesce("text", F.lit("")))), lambda w: F.xxhash64(w))
    return docs.select(*keys, F.explode(F.array_distinct(hashes)).alias("h"))


def term_spans(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``(id, d, hidden)``: id, digest and spans (kind, start, end) of the texts that hold terms to hide, once each."""
    keys = [F.col("doc_id").alias("id"), F.xxhash64("text").alias("d")]
    holders = stored(
        distinct_words(docs, keys).join(terms, "h").groupBy("id", "d").agg(
            F.sort_array(F.collect_set(F.struct("term", "removed"))).alias("terms")), "term_holders")
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("digest")).join(
        holders, F.col("doc_id").eqNullSafe(F.col("id")) & F.col("digest").eqNullSafe(F.col("d")))
    pattern = F.concat(F.lit(f"(?<!{_LETTER})(?:"), F.array_join("terms.term", "|"), F.lit(f")(?!{_LETTER})"))
    spans = texts.dropDuplicates(["id", "d"]).select("id", "d", "terms", _once(places(lower_ascii(F.col("text")), pattern)).alias("spans"))
    removed = F.transform(F.filter("terms", lambda t: t["removed"]), lambda t: t["term"])
    return spans.select("id", "d", F.transform("spans", lambda s: F.struct(
        F.when(F.array_contains(removed, s["value"]), 4).otherwise(5).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
    )).alias("hidden"))


def find_private(docs: DataFrame) -> DataFrame:
    """``(doc_id, digest, spans)`` of every row; spans are (kind, start, end), by kind, then by start."""
    scanned = stored(scan(docs).withColumn("row", F.monotonically_increasing_id()), "private")
    hidden = term_spans(docs, stored(revealing_terms(docs, scanned), "revealing"))
    both = scanned.join(hidden, F.col("doc_id").eqNullSafe(F.col("id")) & F.col("digest").eqNullSafe(F.col("d")), "left")
    base = F.transform("found", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    apart = F.filter("hidden", lambda t: ~F.exists("found", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    spans = F.when(F.col("hidden").isNull(), base).otherwise(F.sort_array(F.concat(base, apart)))
    return both.select("doc_id", "digest", spans.alias("spans"))


def sanitise(docs: DataFrame) -> DataFrame:
    """The documents with their private spans replaced by the kind, revealing terms removed or replaced by their class."""
    found, at = free_name(docs, "_found"), free_name(docs, "_at")
    spans = find_private(docs).where(F.size("spans") > 0).dropDuplicates(["doc_id", "digest"]).select(
        F.struct("doc_id", "digest", "spans").alias(found))
    both = docs.join(
        spans, docs["doc_id"].eqNullSafe(F.col(f"{found}.doc_id")) & F.xxhash64(docs["text"]).eqNullSafe(F.col(f"{found}.digest")), "left")
    ordered = F.sort_array(F.transform(f"{found}.spans", lambda s: F.struct(
        s["start"].alias("start"), (-s["end"]).alias("last"), s["kind"].alias("kind"))))
    # Spans that overlap become one, of the kind that begins first.
    kind = "array<struct<start:int,end:int,kind:int>>"

    def merge(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], -s["last"]).alias("end"), last["kind"].alias("kind"))
        new = F.struct(s["start"].alias("start"), (-s["last"]).alias("end"), s["kind"].alias("kind"))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] > s["start"]), F.concat(
            F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(F.concat(done, F.array(new)))

    both = both.withColumn(at, _once(F.aggregate(ordered, F.array().cast(kind), merge)))
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS[:4]], F.lit(""))

    def shown(s: Column) -> Column:
        value = F.substring("text", s["start"] + 1, s["end"] - s["start"])
        broad = F.when(value.rlike("^[0-9]+$"), "<NUMBER>").when(value.rlike("[0-9]"), "<CODE>").otherwise("<WORD>")
        return F.when(s["kind"] == 5, broad).otherwise(F.get(names, s["kind"]))

    before = lambda i: F.coalesce(F.get(at, i - 1)["end"], F.lit(0))
    pieces = F.transform(at, lambda s, i: F.concat(F.substring("text", before(i) + 1, s["start"] - before(i)), shown(s)))
    rest = F.substring("text", F.element_at(at, -1)["end"] + 1, F.length("text"))
    text = F.when(F.col(at).isNull(), F.col("text")).otherwise(F.concat(F.array_join(pieces, ""), rest))
    return both.select(*[(text if c == "text" else F.col(f"`{c}`")).alias(c) for c in docs.columns])


def op13_private_data(spark: SparkSession, folder: str) -> DataFrame:
    found = find_private(table(spark, folder, "documents"))
    show = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(F.array(*map(F.lit, KINDS)), s["kind"]), s["start"], s["end"])))
    base = F.filter("spans", lambda s: s["kind"] < 4)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return found.select(
        "doc_id",
        *map(count, range(4)),
        F.sha2(show(base), 256).alias("base_sha256"), show(F.col("spans")).alias("spans"),
    )


def _base_sql(kind: int, pattern: str, condition: str) -> str:
    """Matches with their places: lengths of the pieces and matches before."""
    return f"""
  SELECT r, doc_id, low, {kind} AS kind, s, s + size AS e, value FROM (
    SELECT *, CAST(sum(gap) OVER w + sum(size) OVER w - size AS BIGINT) AS s FROM (
      SELECT r, doc_id, low, i, values[i] AS value, length(gaps[i]) AS gap, length(values[i]) AS size FROM (
        SELECT *, unnest(range(1, len(values) + 1)) AS i FROM (
          SELECT *, regexp_extract_all(text, '{pattern}') AS values, string_split_regex(text, '{pattern}') AS gaps FROM d)))
    WINDOW w AS (PARTITION BY r ORDER BY i))
  WHERE {condition}"""


_D = "regexp_replace(value, '[^0-9]', '', 'g')"
_LUHN = (
    f"list_sum([CASE WHEN j % 2 = 1 THEN CAST(substr(reverse({_D}), j, 1) AS INTEGER) "
    f"ELSE CAST(substr(reverse({_D}), j, 1) AS INTEGER) * 2 - CASE WHEN substr(reverse({_D}), j, 1) > '4' THEN 9 ELSE 0 END END "
    f"FOR j IN range(1, length({_D}) + 1)]) % 10 = 0"
)
_NAMES = "[" + ", ".join(f"'{k}'" for k in KINDS) + "]"
SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
    translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}') AS low
  FROM documents),
base AS ({_base_sql(0, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+', 'true')}
  UNION ALL {_base_sql(1, '[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+',
    "len([x FOR x IN string_split(value, '.') IF length(ltrim(x, '0')) > 3 OR CAST('0' || right(x, 3) AS INTEGER) > 255]) = 0")}
  UNION ALL {_base_sql(2, '[0-9](?:[ -]?[0-9])+', f'length({_D}) BETWEEN 16 AND 19 AND {_LUHN}')}
  UNION ALL {_base_sql(3, '[+][0-9][ ().0-9-]+[0-9]', f'length({_D}) BETWEEN 8 AND 15')}),
spans AS (
  SELECT r, kind, s, e, CASE kind WHEN 0 THEN 'email:' || lower(value) WHEN 1 THEN 'ip:' || value
      WHEN 2 THEN 'card:' || {_D} ELSE 'phone:' || {_D} END AS entity,
    regexp_replace(CASE WHEN s > {NEAR} THEN regexp_replace(substr(low, s - {NEAR} + 1, {NEAR}), '^{_LETTER}+', '')
      ELSE substr(low, 1, s) END, '{_LETTER}+$', '') || ' ' ||
    regexp_replace(CASE WHEN e + {NEAR} < length(low) THEN regexp_replace(substr(low, e + 1, {NEAR}), '{_LETTER}+$', '')
      ELSE substr(low, e + 1) END, '^{_LETTER}+', '') AS near
  FROM base),
near AS (SELECT DISTINCT r, entity, near, unnest(regexp_extract_all(near, '{_LETTER}+')) AS term FROM spans),
pairs AS (
  SELECT entity, term, count(DISTINCT r) AS n_both FROM near WHERE length(term) >= {LETTERS}
  GROUP BY entity, term HAVING count(DISTINCT near) >= {CONTEXTS}),
entities AS (SELECT entity, count(DISTINCT r) AS n_entity FROM spans GROUP BY entity),
w AS (SELECT DISTINCT r, unnest(regexp_extract_all(low, '{_LETTER}+')) AS term FROM d),
counts AS (SELECT term, count(*) AS n_term FROM w WHERE term IN (SELECT term FROM pairs) GROUP BY term),
terms AS (
  SELECT term, max(CAST({REMOVED[1]} * n_both >= {REMOVED[0]} * n_term AS INTEGER)) AS removed
  FROM pairs JOIN counts USING (term) JOIN entities USING (entity)
  WHERE (SELECT count(*) FROM d) * n_both >= {1 << GAIN} * n_entity * n_term
    AND {GENERALISED[1]} * n_both >= {GENERALISED[0]} * n_term
  GROUP BY term),
held AS (SELECT DISTINCT d.r, low FROM d JOIN w ON d.r = w.r WHERE w.term IN (SELECT term FROM terms)),
hidden AS (
  SELECT r, CASE removed WHEN 1 THEN 4 ELSE 5 END AS kind, s, s + size AS e FROM (
    SELECT *, CAST(sum(gap) OVER v + sum(size) OVER v - size AS BIGINT) AS s FROM (
      SELECT r, i, values[i] AS value, length(gaps[i]) AS gap, length(values[i]) AS size FROM (
        SELECT *, unnest(range(1, len(values) + 1)) AS i FROM (
          SELECT r, regexp_extract_all(low, '{_LETTER}+') AS values, string_split_regex(low, '{_LETTER}+') AS gaps FROM held)))
    WINDOW v AS (PARTITION BY r ORDER BY i)) JOIN terms ON value = term),
marks AS (
  SELECT r, kind, s, e FROM base UNION ALL
  SELECT r, kind, s, e FROM hidden h WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.r = h.r AND b.s < h.e AND h.s < b.e)),
shown AS (
  SELECT r, count(*) FILTER (kind = 0) AS n_email, count(*) FILTER (kind = 1) AS n_ip, count(*) FILTER (kind = 2) AS n_card,
    count(*) FILTER (kind = 3) AS n_phone,
    string_agg(({_NAMES})[kind + 1] || ':' || s || ':' || e, ',' ORDER BY kind, s) FILTER (kind < 4) AS base,
    string_agg(({_NAMES})[kind + 1] || ':' || s || ':' || e, ',' ORDER BY kind, s) AS spans
  FROM marks GROUP BY r)
SELECT doc_id, CAST(coalesce(n_email, 0) AS BIGINT) AS n_email, CAST(coalesce(n_ip, 0) AS BIGINT) AS n_ip,
  CAST(coalesce(n_card, 0) AS BIGINT) AS n_card, CAST(coalesce(n_phone, 0) AS BIGINT) AS n_phone,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN shown USING (r)
"""

QUERIES = {"op13_private_data": op13_private_data}
ORACLE = {"op13_private_data": SQL}
