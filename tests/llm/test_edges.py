"""Every operator on odd rows and on no rows: nothing crashes, no row is lost, results are the stated ones."""

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tideline.llm import (
    byte_bpe, decontaminate, line_dedup, quality, rules, secrets, sharding, simhash, token_counts, toxicity,
)

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def benchmark_rows(spark):
    return spark.createDataFrame(
        [("a", "the same text the same text"), ("b", None), ("c", ""), (None, "日本語"), ("d", "token"), ("d", "token")],
        "item_id string, text string",
    )


def runs(docs, labels, items):
    return {
        "op1": decontaminate.find_items(docs, items),
        "op1 drop": decontaminate.drop_contaminated(docs, items),
        "op2": toxicity.score(docs, toxicity.train(docs, labels)),
        "op3": quality.score(docs, quality.train(docs, labels)),
        "op4": rules.judge(docs),
        "op5": line_dedup.dedupe_lines(docs),
        "op6": token_counts.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json")),
        "op7": secrets.find_secrets(docs),
        "op8": simhash.find_groups(docs),
        "op8 one": simhash.keep_one(docs),
        "op9": sharding.with_slots(sharding.place(docs, sharding.even_tree(8), sharding.Shard(8))),
        "op10": byte_bpe.decode(byte_bpe.encode(docs, RANKS, PATTERN), RANKS, PATTERN),
        "op10 digests": byte_bpe.digests(docs, RANKS, PATTERN),
    }


@pytest.fixture(scope="module")
def results(odd, labels, benchmark_rows):
    return {k: df.collect() for k, df in runs(odd, labels, benchmark_rows).items()}


def by_id(rows):
    return {r.doc_id: r for r in rows if r.doc_id is not None}


def test_no_row_is_lost(results, odd):
    for name, rows in results.items():
        if name not in ("op1 drop", "op8 one"):
            assert len(rows) == odd.count(), name


def test_no_rows(nothing, labels, benchmark_rows):
    for name, df in runs(nothing, labels.limit(0), benchmark_rows.limit(0)).items():
        assert df.collect() == [], name


def test_empty_references(odd, labels, benchmark_rows):
    assert not decontaminate.find_items(odd, benchmark_rows.limit(0)).where("contaminated").count()
    assert {r.score for r in quality.score(odd, quality.train(odd, labels.limit(0))).collect()} == {1.0}
    assert max(r.score for r in toxicity.score(odd, toxicity.train(odd, labels.limit(0))).collect()) < 1e-6


def test_decontamination(results):
    rows = by_id(results["op1"])
    assert (rows[3].n_words, list(rows[3].hits), list(rows[3].item_ids)) == (6, [0, 6], ["a"])
    assert (list(rows[7].item_ids), rows[7].contaminated) == (["d"], True)  # the item without id hits, but has no name
    assert (rows[1].n_words, rows[1].contaminated) == (0, False)
    assert {r.doc_id for r in results["op1 drop"]} == {None, 1, 2, 4, 5, 6}


def test_scores_are_bounded_and_equal_for_equal_rows(results):
    for name in ("op2", "op3"):
        assert all(0 <= r.score <= 1 for r in results[name])
        assert len({r.score for r in results[name] if r.doc_id == 3}) == 1


def test_rules(results):
    rows = by_id(results["op4"])
    assert (rows[3].n_words, rows[3].word_chars, rows[3].n_dup_lines, rows[3].n_repeat_words) == (6, 22, 1, 6)
    assert (rows[1].n_words, rows[1].base_failed, rows[1].kept) == (0, True, False)
    assert rows[4].n_words == 40_001


def test_lines(results):
    rows = by_id(results["op5"])
    assert rows[1].text is None and rows[2].text == "" and rows[5].text == " \n\t\r\n "
    assert (rows[4].n_removed, rows[6].n_removed, rows[6].text) == (0, 2, "")
    assert rows[3].text == "the same text\nthe same text" and rows[3].n_lines == 2


def test_lines_beside_columns_named_like_the_keys(spark):
    """The names that the join with the deleted lines would like to use."""
    names = ("_digest", "_digest_", "_found", "_found_", "_ranges", "_there", "_There_")
    passage = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(i, f"{passage}\nown {i}") for i in range(3)], "doc_id long, text string").selectExpr(
        "*", *[f"'mine' AS `{n}`" for n in names])
    rows = line_dedup.dedupe_lines(docs).collect()
    assert all(r[n] == "mine" for r in rows for n in names)
    assert sorted((r.doc_id, r.n_removed) for r in rows) == [(0, 0), (1, 1), (2, 1)]


def test_tokens(results):
    rows = by_id(results["op6"])
    assert (rows[1].n_bytes, rows[1].n_tokens, rows[2].n_tokens, rows[5].n_tokens) == (0, 0, 0, 0)
    assert rows[4].over_limit and not rows[3].over_limit


def test_secrets(results):
    rows = by_id(results["op7"])
    assert (rows[7].n_assign, rows[7].spans) == (1, "assign:16:40")
    assert rows[1].spans == "" and rows[1].base_sha256 == hashlib.sha256(b"").hexdigest()


def test_simhash(results, odd):
    rows = by_id(results["op8"])
    assert rows[1].fp == rows[2].fp == rows[5].fp == 0
    assert rows[1].component_id == rows[2].component_id == rows[5].component_id == 1
    assert rows[4].component_id == rows[6].component_id == 4
    kept = results["op8 one"]
    assert sorted(r.doc_id or 0 for r in kept) == [0, 1, 3, 4, 7]
    assert kept[0].__fields__ == odd.columns


def test_shards(results):
    rows = results["op9"]
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r.shard, []).append(r.slot)
        assert r.grown_shard in (r.shard, 8) and 0 <= r.shard < 8 and r.law == "key"
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert len({r.shard for r in rows if r.doc_id == 3}) == 1
    assert by_id(rows)[1]["size"] == 1 and by_id(rows)[7]["size"] == len(by_id(rows)[7].text.encode()) + 1


def test_round_trip(results):
    for r in results["op10"]:
        assert r.decoded == (r.text or "").encode()


def test_pipeline_stages_keep_the_columns(spark, odd, labels, benchmark_rows, tmp_path):
    documents = odd.select("doc_id", "text", "lang", "source", "n_chars")
    for name, df in (("documents", documents), ("labels", labels), ("benchmark", benchmark_rows)):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < 4:
            assert out.columns == documents.columns, name
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    empty = spark.read.parquet(f"{tmp_path}/documents.parquet").where(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0
