"""Frequent lines: the limits on a large host, and the texts without them."""

from collections import Counter

from pyspark.sql import functions as F

from tideline.llm import rules

OWN = " ".join(f"w{k}" for k in range(60))


def large_host(spark):
    """1,000 documents of one host; a line that 40 of them share is below 5 %, and most of their words."""
    shared = " ".join(f"s{k}" for k in range(200))
    rows = [(i, f"{OWN} own{i}" + (f"\n{shared}" if i < 40 else ""), "hot") for i in range(1000)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_a_fixed_number_of_documents_is_enough_on_a_large_host(spark):
    docs = large_host(spark)
    by_share = {r.doc_id: r for r in rules.judge(docs, many_docs=40).collect()}
    by_number = {r.doc_id: r for r in rules.judge(docs, many_docs=30).collect()}
    assert all(r.kept and r.removed_words == 0 for r in by_share.values())
    assert all((r.removed_words, r.kept) == ((200, False) if i < 40 else (0, True)) for i, r in by_number.items())


def test_the_limit_does_not_rise_with_the_host(spark):
    """The same 1,001 documents share a line on a host of 1,500 and on one of 30,000 documents, where they are 3 %."""
    shared = " ".join(f"s{k}" for k in range(200))
    docs = spark.range(31_500).selectExpr(
        "id AS doc_id", "if(id < 1500, 'small', 'hot') AS source",
        f"concat('{OWN} own', id, if(id < 1001 OR id BETWEEN 1500 AND 2500, '\n{shared}', ''), "
        f"if(id BETWEEN 3000 AND 3999, '\nmore {shared}', '')) AS text")
    found = {(r.source, r.kept): r.n for r in rules.judge(docs).join(docs.select("doc_id", "source"), "doc_id")
             .groupBy("source", "kept").agg(F.count("*").alias("n")).collect()}
    # 1,000 documents with a line of their own are not more than 1,000.
    assert found == {("small", False): 1001, ("small", True): 499, ("hot", False): 1001, ("hot", True): 28_999}


def without_frequent(rows):
    """Texts without frequent lines, by brute force."""
    norm = lambda line: " ".join(line.translate(str.maketrans(rules._UPPER, rules._UPPER.lower())).split())
    total = Counter(r.source or "" for r in rows)
    n = Counter((r.source or "", x) for r in rows for x in {norm(line) for line in (r.text or "").split("\n")} - {""})
    often = {k for k, v in n.items() if v > rules.MIN_DOCS and v > rules.MAX_SHARE * total[k[0]] or v > rules.MANY_DOCS}
    return [None if r.text is None else "\n".join(x for x in r.text.split("\n") if (r.source or "", norm(x)) not in often) for r in rows]


def test_frequent_lines_leave_the_texts(spark):
    lines = ["All Rights  reserved", "all rights reserved ", "", " \t", "menu", "MENU"]
    rows = [(i, "\n".join([lines[i % 6], f"own {i}", "x y", lines[(i + 3) % 6], lines[i % 2]]), "a" if i % 3 else None) for i in range(60)]
    rows += [(100, None, "a"), (None, "menu", "a"), (None, "menu", "a"), (101, "menu\n", "a"), (102, "menu", "b"), (3, rows[3][1], None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "concat('h', doc_id) AS host", "1 AS _at")
    got = rules.remove_frequent(docs)
    assert got.columns == docs.columns
    before = docs.collect()
    want = Counter((r.doc_id, r.source, r.host, t) for r, t in zip(before, without_frequent(before)))
    assert Counter((r.doc_id, r.source, r.host, r.text) for r in got.collect()) == want
    assert sum(t != r.text for r, t in zip(before, without_frequent(before))) > 50


def test_texts_and_verdicts_agree(spark, odd, nothing):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left = rules.remove_frequent(docs)
    words = rules.document_lines(left, ["doc_id"], "source").select("doc_id", "line_words").collect()
    verdicts = rules.judge(docs).collect()
    assert any(r.removed_words for r in verdicts)
    assert Counter((r.doc_id, r.line_words - r.removed_words) for r in verdicts) == Counter(map(tuple, words))
    kept = {r.doc_id: r.text for r in left.collect()}
    rows = docs.collect()
    assert {r.doc_id: t for r, t in zip(rows, without_frequent(rows))} == kept
    assert Counter(rules.remove_frequent(odd).select("doc_id", "text").collect()) == Counter(odd.select("doc_id", "text").collect())
    assert rules.remove_frequent(nothing).collect() == []
