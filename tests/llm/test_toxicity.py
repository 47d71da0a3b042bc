"""The model depends on all texts and not on how they are stored."""

import math
import re
import zlib

import numpy as np
import pytest

from tideline.llm import toxicity
from tideline.llm.frames import held_out
from tideline.llm.spans import LOWER, WORD, Group, Spans, whole


@pytest.fixture
def corpus(spark, monkeypatch):
    """600 texts outside the held-out fold, 8 toxic examples, ``zqx`` in 4 of them; 3 different sets make a bag."""
    monkeypatch.setattr(toxicity, "BAG_SETS", 3)
    ids = [r.id for r in spark.range(2000).withColumnRenamed("id", "doc_id").where(~held_out()).limit(600).selectExpr("doc_id AS id").collect()]
    rows = [(i, f"w{i % 7} v{i % 11} u{i % 5}" + (" zqx" if k < 4 else "") + (" bad" if k < 8 else "")) for k, i in enumerate(ids)]
    labels = spark.createDataFrame([(i, int(k < 8)) for k, i in enumerate(ids[:40])], "doc_id long, toxic int")
    return spark.createDataFrame(rows, "doc_id long, text string"), labels


def test_other_files_give_the_same_model(corpus):
    docs, labels = corpus
    one, other = (toxicity.train(d, labels) for d in (docs.coalesce(1), docs.orderBy("text").repartition(7)))
    assert len(one[0]) and np.array_equal(one[0], other[0]) and np.array_equal(one[1], other[1])


def test_markers_count_in_all_texts(corpus):
    marker = toxicity.features(Spans(whole(["zqx"]), WORD))[0]
    assert set(marker.tolist()) <= set(toxicity.train(*corpus)[0].tolist())


def test_scores_by_a_plain_loop(spark):
    """The scores of all texts of a sample from the model, and the model of a single bag from all its texts."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    hashes, weights = toxicity.train(docs, labels)
    number = {h: i for i, h in enumerate(hashes.tolist())}
    rows = docs.collect()

    def numbers(text):
        words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", bytes(LOWER[np.frombuffer(text.encode(), dtype=np.uint8)]))
        found = set()
        for w in set(words):
            spans = Spans(Group(0, 1, np.frombuffer(w, dtype=np.uint8), np.array([0, len(w)])), WORD)
            found |= {number[h] for h in toxicity.features(spans)[0].tolist() if h in number}
        return sorted(found)

    sets = {r.doc_id: numbers(r.text) for r in rows}
    got = {r.doc_id: r.score for r in toxicity.score(docs, (hashes, weights)).collect()}
    for doc_id, v in sets.items():
        assert abs(got[doc_id] - 1 / (1 + math.exp(-sum(weights[i] for i in v) - weights[-1]))) < 1e-9
    learnt = {r.doc_id: r.toxic for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5}
    positive = [np.array(sets[d], dtype="<u2") for d, t in learnt.items() if t == 1]
    rest = [np.array(sets[r.doc_id], dtype="<u2") for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5]
    again = toxicity.fit_bag(positive, rest, np.ones(len(rest)), len(hashes), np.mean(list(learnt.values())))
    assert np.abs(again - weights).max() < 1e-6


def test_equal_texts_count_as_often_as_they_come(spark, monkeypatch):
    """A set that a third of the texts have counts in every bag, with its share."""
    monkeypatch.setattr(toxicity, "BAG_SETS", 50)
    ids = spark.range(3000).selectExpr("id AS doc_id").where(~held_out())
    docs = ids.selectExpr("doc_id", "CASE WHEN doc_id % 3 = 0 THEN 'bad awful copy' ELSE concat('bad word', doc_id % 400, ' awful', doc_id % 7) END AS text")
    labels = ids.where("doc_id % 10 = 1").selectExpr("doc_id", "int(doc_id % 20 = 1) AS toxic")
    hashes, weights = toxicity.train(docs, labels)
    assert len(weights) == len(hashes) + 1 and np.isfinite(weights).all()


def test_no_task_orders_all_ids(spark, sf, monkeypatch):
    """Ids are filtered by a bound on their hash before the ordered cut."""
    from tideline.llm.labelled import labelled_texts

    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    plan = labelled_texts(docs, labels, "quality", 10)._jdf.queryExecution().toString()
    assert re.search(r"shiftrightunsigned\(xxhash64\(doc_id#\d+L?, 42\), 32\) <= \d+", plan)
