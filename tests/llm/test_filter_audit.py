"""The filter interaction audit against a plain application of every order to every row."""

import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tideline.llm import filter_audit

RESULTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def fails(rows):
    """The failed filters of every (doc_id, text)."""
    out = []
    for doc_id, text in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        earlier = doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t in rows)
        out.append({
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
            "D": re.search(r"[#$%&*|]", text) is not None, "E": earlier,
        })
    return out


def brute(docs, labels):
    marks = {}
    for doc_id, quality, toxic in labels:
        good, bad = marks.get(doc_id, (False, False))
        marks[doc_id] = (good or quality == 1, bad or toxic == 1)
    marks.pop(None, None)
    failed = fails([(d[0], d[1]) for d in docs])
    found = {}
    for part in {d[2] or "" for d in docs}:
        rows = [(f, *marks.get(d[0], (False, False))) for d, f in zip(docs, failed) if (d[2] or "") == part]
        shares = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = rows
            for step, letter in enumerate(order, 1):
                gone = [r for r in left if r[0][letter]]
                left = [r for r in left if not r[0][letter]]
                shares[letter] += len(gone)
                found[part, "".join(order), step] = [
                    len(left), len(gone), sum(r[0][letter] for r in rows) - len(gone),
                    sum(r[0][letter] and sum(r[0].values()) == 1 for r in rows),
                    sum(r[1] for r in gone), sum(r[2] for r in gone), letter,
                ]
        for key in found:
            if key[0] == part:
                found[key][-1] = shares[found[key][-1]]
    return found


def result(counts):
    return {(r.part, r.filter_order, r.step): [r[c] for c in RESULTS] for r in filter_audit.audit(counts).collect()}


def test_every_order_of_a_small_table(spark, labels):
    plain = " ".join(f"w{i}" for i in range(120))
    rows = [
        (1, plain, "en"), (2, plain, "en"), (2, plain, "en"), (2, plain, "fr"), (3, plain + " #", "en"), (4, "A B C", "en"),
        (5, "same " * 150, "en"), (6, "Same| " * 150, "fr"), (7, None, None), (8, "", "en"), (None, "", "en"), (None, None, None),
        (9, plain.upper(), "de"), (10, plain.upper(), "de"), (11, "é " * 200, "de"), (12, "x\x0by\x1cz " * 60, ""),
        (13, "BC" + "a" * 18, "en"), (14, "BCD" + "a" * 17, "en"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("mask", F.lit("mine"))
    marks = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (3, 1, 1), (5, None, 1), (9, 1, None), (None, 1, 1), (99, 1, 1)]
    marked = spark.createDataFrame(marks, "doc_id long, quality int, toxic int").withColumn("n", F.lit(1))
    found = result(filter_audit.mask_counts(docs, marked))
    assert found == brute(rows, marks)
    assert len(found) == 600 * 4


def test_the_sample(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    marked = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality", "toxic")
    found = result(filter_audit.mask_counts(docs, marked))
    assert found == brute([tuple(r) for r in docs.collect()], [tuple(r) for r in marked.collect()])


def test_odd_rows_and_no_rows(spark, odd, nothing, labels):
    rows = [(r.doc_id, r.text, r.lang) for r in odd.select("doc_id", "text", "lang").collect()]
    assert result(filter_audit.mask_counts(odd, labels)) == brute(rows, [tuple(r) for r in labels.collect()])
    assert result(filter_audit.mask_counts(nothing, labels.limit(0))) == {}


def test_fields_do_not_run_over(spark):
    """Counts far beyond 32 bits in neighbouring fields."""
    rows = [("p", mask, 3, (1 << 55) + mask) for mask in range(32)]
    found = result(spark.createDataFrame(rows, "part string, mask int, marks int, n long"))
    total = sum(n for *_, n in rows)
    for (_, order, step), (kept, removed, redundant, unique, good, toxic, shapley) in found.items():
        bit = 1 << "ABCDE".index(order[step - 1])
        gone = [1 << "ABCDE".index(c) for c in order[:step]]
        assert kept == sum(n for _, m, _, n in rows if not any(m & g for g in gone))
        assert removed + redundant == sum(n for _, m, _, n in rows if m & bit) and unique == rows[bit][3]
        assert good == toxic == removed and kept + removed <= total


def test_a_text_of_a_third_of_the_rows(spark, labels):
    docs = spark.range(30_000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'the same', concat('text ', id)) AS text", "'en' AS lang")
    counts = filter_audit.mask_counts(docs, labels.limit(0)).collect()
    assert sum(r.n for r in counts) == 30_000
    assert {r["mask"]: r.n for r in counts} == {1: 20_001, 17: 9_999}


@pytest.mark.parametrize("mask,order", [(0, "ABCDE"), (31, "EDCBA"), (5, "CABDE")])
def test_packing(mask, order):
    orders = [tuple("ABCDE".index(c) for c in order)]
    total = filter_audit.packed(mask, 0, orders) * 7
    found = filter_audit.unpacked(total, 1, 5)[0]
    assert found[:, 1].sum() == (7 if mask else 0)
    assert found[-1, 0] == (0 if mask else 7)
