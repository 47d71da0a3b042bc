"""Personal data against Python's own patterns, and the terms that reveal it against plain counting."""

import hashlib
import re
from collections import defaultdict

from compare import difference
from pyspark.sql import functions as F

from tideline.llm import sanitise

KINDS = sanitise.KINDS


def luhn(digits):
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def base(text):
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((0, m.start(), m.end(), "email:" + m[0].lower()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((1, m.start(), m.end(), "ip:" + m[0]))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append((2, m.start(), m.end(), "card:" + digits))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 8 <= len(digits) <= 15:
            found.append((3, m.start(), m.end(), "phone:" + digits))
    return found


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(rows):
    """All spans of every (doc_id, text)."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    texts = [(t or "") for _, t in rows]
    found = [base(t) for t in texts]
    both, contexts, holders, with_term = defaultdict(set), defaultdict(set), defaultdict(set), defaultdict(set)
    for r, t in enumerate(texts):
        low = t.translate(lower)
        tokens = [(m.start(), m.end(), m[0]) for m in WORD.finditer(low)]
        for _, _, w in tokens:
            with_term[w].add(r)
        for _, s, e, entity in found[r]:
            holders[entity].add(r)
            # Whole words inside the surroundings; a word at a cut end or touching the span is out.
            left, right = max(0, s - 100), min(len(t), e + 100)
            near = [w for a, b, w in tokens if (left < a or left == a == 0) and b < s]
            near += [w for a, b, w in tokens if e < a and (b < right or b == right == len(t))]
            side = (low[left:s], low[e:right])
            for w in near:
                both[entity, w].add(r)
                contexts[entity, w].add(tuple(near) + side)
    removed, hidden = set(), set()
    for (entity, w), docs in both.items():
        n, n_t = len(docs), len(with_term[w])
        if len(w) >= 3 and len(contexts[entity, w]) >= 2 and len(rows) * n >= 16 * len(holders[entity]) * n_t and 2 * n >= n_t:
            hidden.add(w)
            if 10 * n >= 9 * n_t:
                removed.add(w)
    out = []
    for t, own in zip(texts, found):
        spans = [x[:3] for x in own]
        for m in WORD.finditer(t.translate(lower)):
            if m[0] in hidden and not any(s < m.end() and m.start() < e for _, s, e, _ in own):
                spans.append((4 if m[0] in removed else 5, m.start(), m.end()))
        out.append(sorted(spans))
    return out


def result(df):
    return [(r.doc_id, [(s.kind, s.start, s.end) for s in r.spans]) for r in sanitise.find_private(df).collect()]


def same(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("found", F.lit("mine"))
    got = sorted(result(df), key=repr)
    assert got == sorted(((i, s) for (i, _), s in zip(rows, brute(rows))), key=repr)
    return dict(got)


TRICKY = [
    "a@b.c_d@e.f g@h.i.@x.y", "x.y+z%1@mail-7.example.co.uk.", "a@b a@b. @c.d a@-.-", "ñ34@mail.example.com é", "a@b.c@d.e.f@g.h",
    "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255 1..2.3.4.5 999.1.2.3.4", "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111",
    "4111  1111 1111 1111 1111 04111111111111111 00000000000000000000", "+1 (017) 555-7713 +1 +12 34 56 +123456789012345 6 ++49 30 1234567",
    "+1.2.3.4.5.6.7.8. 🙂 +49 (0) 30-1234567 日本語a@b.cd語", "1" * 30_000 + " " + "1 " * 20_000 + "a" * 60_000 + "@b.c " + "+" * 5000,
    "", None, "tel:+49 30 1234567\nmail:me@here.org", "4111111111111111.1.2.3 10.0.0.1a 10.0.0.1@b.c",
]


def test_base_spans(spark):
    same(spark, list(enumerate(TRICKY)) + [(3, TRICKY[3]), (None, TRICKY[1]), (None, None)])


def revealing():
    """A name beside one address only (removed), one that also stands alone (generalised), and a word that stands everywhere."""
    rows = []
    for i in range(40):
        rows.append((i, f"Nothing to see in text {i} of the archive, only words."))
        rows.append((500 + i, "Note: someone wrote from home about words; ref none. Call today at noon, code zip."))
    for i in range(3):
        rows.append((100 + i, f"Note {i * 7}: Zebulon Thorwald Quirk wrote from z.q@corp.example about the archive, ref ÄX{i}."))
    rows += [(200, "Zebulon was here, without an address."), (201, "QUIRK quirk, quirky; Quirk"), (202, "the quirk of it")]
    # Copies are one surrounding: they prove nothing.
    rows += [(300 + i, "Copied Vanderlyn is at v@corp.example today.") for i in range(5)]
    for i in range(4):
        rows.append((400 + i, f"Call Mirabel{'' if i else ','} on +49 30 12345{i // 3}67 at {i} o'clock, zip 99{i}10, code q7x9."))
    return rows


def test_terms_that_reveal(spark):
    rows = revealing()
    got = same(spark, rows)
    text = dict(rows)
    shown = {i: {(KINDS[k], text[i][s:e]) for k, s, e in spans if k > 3} for i, spans in got.items()}
    assert ("generalised", "Zebulon") in shown[100] and ("generalised", "Zebulon") in shown[200]
    assert ("generalised", "quirk") in shown[201] and ("generalised", "QUIRK") in shown[201] and shown[202] == {("generalised", "quirk")}
    assert ("removed", "Thorwald") in shown[100] and {w for _, w in shown[100]} == {"Zebulon", "Thorwald", "Quirk"}
    assert ("removed", "corp") not in shown[100] and not any(w == "archive" for s in shown.values() for _, w in s)
    assert shown[300] == set() and not shown[5]
    assert ("generalised", "q7x9") in shown[403] and ("generalised", "Mirabel") in shown[403]


def test_sanitised_texts(spark):
    rows = revealing()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_found", F.lit("mine")).withColumn("spans", F.lit(1))
    out = {r.doc_id: r for r in sanitise.sanitise(df).collect()}
    assert sanitise.sanitise(df).columns == df.columns and len(out) == len(rows)
    text, spans = dict(rows), dict(result(df))
    for i, row in out.items():
        assert row._found == "mine"
        want, at = "", 0
        for k, s, e in sorted(spans[i], key=lambda x: (x[1], -x[2], x[0])):
            value = text[i][s:e]
            broad = "<NUMBER>" if re.fullmatch("[0-9]+", value) else "<CODE>" if re.search("[0-9]", value) else "<WORD>"
            want += text[i][at:s] + ("" if k == 4 else broad if k == 5 else f"<{KINDS[k].upper()}>")
            at = e
        assert row.text == want + text[i][at:]
    assert "<EMAIL>" in out[100].text and "Zebulon" not in out[100].text and out[5].text == text[5]


def test_overlapping_spans_become_one(spark):
    df = spark.createDataFrame([(1, "see 4111111111111111.1.2.3 and 10.0.0.1@b.c"), (2, None)], "doc_id long, text string")
    out = {r.doc_id: r.text for r in sanitise.sanitise(df).collect()}
    assert out == {1: "see <CARD>.1.2.3 and <EMAIL>", 2: None}


def test_odd_rows_and_no_rows(spark, odd, nothing):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert sorted(result(odd), key=repr) == sorted(((i, s) for (i, _), s in zip(rows, brute(rows))), key=repr)
    assert result(nothing) == [] and sanitise.sanitise(nothing).collect() == []
    assert sanitise.sanitise(odd).exceptAll(odd).count() == 0


def test_the_sql_on_revealing_terms(spark, sf, tmp_path):
    """The sample has hardly any such terms; this table has."""
    rows = revealing() + [(1000 + i, t) for i, t in enumerate(TRICKY) if t is None or len(t) < 10_000]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert difference(sanitise.op13_private_data(spark, str(tmp_path)), con, sanitise.SQL) is None


def test_digest_of_nothing(spark, nothing):
    df = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert sanitise.find_private(df).first().spans == []
    assert hashlib.sha256(b"").hexdigest() == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def test_no_python_on_the_way(spark, sf):
    plan = sanitise.op13_private_data(spark, sf)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
