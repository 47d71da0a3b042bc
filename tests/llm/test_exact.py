"""Operators against their SQL, the tokenizer libraries, or plain brute force."""

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from compare import difference, duck

import corpus_pipeline
from tideline.llm import byte_bpe, decontaminate, line_dedup, registry, secrets, simhash
from tideline.llm.components import components

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").collect()


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_sql(spark, sf, name):
    assert difference(registry.QUERIES[name](spark, sf), duck(sf), registry.ORACLE[name]) is None


def test_all_are_registered():
    assert {n.split("_")[0] for n in registry.QUERIES} == {f"op{i}" for i in range(1, 14)}


def test_windows_in_several_blocks(spark, sf):
    d, b = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "benchmark"))
    one, many = (
        sorted(decontaminate.find_items(d, b, block_windows=n).select("doc_id", "hits", "item_ids").collect()) for n in (10**6, 150)
    )
    assert one == many and any(r.hits for r in one)
    kept = [sorted(r.doc_id for r in decontaminate.drop_contaminated(d, b, block_windows=n).collect()) for n in (10**6, 150)]
    assert kept[0] == kept[1] == sorted(r.doc_id for r in decontaminate.find_items(d, b).where("NOT contaminated").collect())


def test_a_preamble_of_all_items(spark):
    """20,000 items share their first 30 words: the blocks hold each window once, with a number instead of the items."""
    preamble = " ".join(f"p{i}" for i in range(30))
    items = spark.range(20_000).selectExpr("concat('i', id) AS item_id", f"concat('{preamble} own', id, ' last', id) AS text")
    numbered, sets = decontaminate.numbered_windows(decontaminate.item_windows(items))
    assert numbered.count() == 21 + 2 * 20_000 and sets.count() == 2 * 20_000
    docs = spark.createDataFrame(
        [(1, f"see {preamble} end"), (2, f"{preamble} own7 last7"), (3, "p1 p2 p3"), (4, None), (5, f"see {preamble} end")], "doc_id long, text string")
    got = {r.doc_id: r for r in decontaminate.find_items(docs, items, block_windows=9_000).collect()}
    assert len(got[1].item_ids) == len(got[2].item_ids) == 20_000 and list(got[1].hits) == [1, 31] and list(got[2].hits) == [0, 32]
    assert (got[3].contaminated, got[4].n_words, len(got[5].item_ids)) == (False, 0, 20_000)
    packed = [len(block.value) for block, _ in decontaminate.Blocks(numbered, 9_000)]
    assert len(packed) == 5 and max(packed) < 9_000 * 300


def test_search_against_brute_force(spark):
    rng = random.Random(4)
    text = lambda n: " ".join(rng.choice("abc") for _ in range(n))
    items = [(str(i), text(rng.randrange(0, 14))) for i in range(30)]
    texts = [(i, text(rng.randrange(0, 60))) for i in range(80)]
    want = []
    for i, t in texts:
        w, hit, found = t.split(), set(), set()
        for item, u in items:
            v = u.split()
            n = min(10, len(v))
            grams = {tuple(v[k:k + n]) for k in range(len(v) - n + 1)} if v else set()
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in grams:
                    hit.update(range(k, k + n))
                    found.add(item)
        want.append((i, len(hit), sorted(found)))
    got = decontaminate.find_items(
        spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string")
    ).collect()
    assert sorted((r.doc_id, sum(r.hits[1::2]) - sum(r.hits[::2]), list(r.item_ids)) for r in got) == sorted(want)


def passages(texts, least):
    """Lines to keep: delete what lies in a stretch of ``least`` words that begins at an earlier place too."""
    lines = [t.split("\n") for t in texts]
    seen, gone = {}, set()
    for d, ls in enumerate(lines):
        for i in range(len(ls)):
            for e in range(i + 1, len(ls) + 1):
                if sum(len(x.split()) for x in ls[i:e]) >= least:
                    if seen.setdefault(tuple(ls[i:e]), (d, i)) != (d, i):
                        gone.update((d, k) for k in range(i, e))
    return ["\n".join(x for k, x in enumerate(ls) if (d, k) not in gone) for d, ls in enumerate(lines)]


def test_line_dedup_against_brute_force(spark):
    rng = random.Random(9)
    texts = ["\n".join(" ".join(rng.choice("ab") for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(1, 12)))
             for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedupe_lines(df, min_words=6).collect()}
    assert [got[i] for i in range(60)] == passages(texts, 6)


def secret_spans(text):
    found = []
    key = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in k)
                   for k in ("password", "passwd", "secret", "token", "api_?key"))
    for m in re.finditer(rf"""({key})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, m.end()))
    for kind, pattern, least in ((1, "AKIA[A-Z0-9]+", 20), (2, "[0-9a-f]+", 24)):
        found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(found))


def test_secrets_against_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in registry.QUERIES["op7_secrets"](spark, folder).collect()}
    for d in spark.read.parquet(f"{folder}/documents.parquet").collect():
        want = secret_spans(d.text)
        assert got[d.doc_id].base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert (got[d.doc_id].n_assign, got[d.doc_id].n_hex) == (want.count("assign:"), want.count("hex:"))
    assert sum(r.n_assign for r in got.values())


def test_failing_matches_use_up_their_text():
    assert [s[1] for s in secrets.find("secret=token:abcdef12")] == []
    assert [s[:3] for s in secrets.find('API_KEY = "abcdef"')] == [(0, 0, 17)]


def test_ownership_separates_examples_from_live_ones(spark):
    rows = [(i, "token=example99", f"owner{i}") for i in range(5)] + [(9, "token=mine4444", "me"), (10, "token=mine4444", "me"),
            (11, "see Qx7Lk2Vb9Rt4Zp1Wm6Yc here", "me"), (12, "see Aq3Sw5De7Fr9Gt1Hy2Ju here", "a"), (13, "see Aq3Sw5De7Fr9Gt1Hy2Ju", "b")]
    got = {r.doc_id: r for r in secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert (got[0].n_live, got[0].n_copied, got[0].most_owners) == (0, 1, 5)
    assert (got[9].n_live, got[9].n_copied, got[9].most_repositories) == (1, 0, 2)
    assert got[11].spans == got[12].spans == "owned:4:24" and (got[11].shared_spans, got[12].shared_spans) == ("", "owned:4:24")


def simhash_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(prints):
    """``{id: smallest id}`` by comparing all pairs."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    f = np.array([p for _, p in prints], dtype=np.uint64)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(f[i + 1:] ^ f[i]) <= 4) + i + 1:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(prints):
        least[find(i)] = min(least.get(find(i), d), d)
    return {d: least[find(i)] for i, (d, _) in enumerate(prints)}


def test_simhash_against_all_pairs(spark, sf, docs):
    prints = [(d.doc_id, simhash_of(d.text)) for d in docs]
    want = smallest_reachable(prints)
    for r in registry.QUERIES["op8_simhash"](spark, sf).collect():
        assert int(r.fingerprint, 16) == dict(prints)[r.doc_id] and r.component_id == want[r.doc_id]


@pytest.mark.parametrize("block", [8_000, 15])
def test_links_of_near_copies_lose_nothing(spark, block):
    rng = random.Random(3)
    base, prints = [rng.getrandbits(64) for _ in range(4)], []
    for i in range(600):
        x = base[i % 4]
        for _ in range(rng.randrange(4)):
            x ^= 1 << rng.randrange(64)
        prints.append((i, x))
    prints += [(1000 + i, rng.getrandbits(64)) for i in range(300)]
    signed = spark.createDataFrame([(i, x - (x >> 63 << 64)) for i, x in prints], "doc_id long, fp long")
    links = simhash.links(signed.select("fp").distinct(), block=block)
    assert links.count() < 20 * len(prints)
    roots = components(links)
    joined = signed.join(roots, signed.fp == roots.node, "left")
    groups = {}
    for r in joined.selectExpr("doc_id", "coalesce(root, fp) AS r").collect():
        groups.setdefault(r.r, []).append(r.doc_id)
    assert {d: min(g) for g in groups.values() for d in g} == smallest_reachable(prints)


def test_components_of_a_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    assert {r.node: r.root for r in components(chain).collect()} == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}


def test_token_counts_as_the_library(spark, sf, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in registry.QUERIES["op6_token_counts"](spark, sf).collect():
        text = next(d.text for d in docs if d.doc_id == r.doc_id)
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 2048)


def odd_texts():
    rng = random.Random(2)
    high = [*range(0x2000, 0xD800), *range(0xE000, 0x1FBFF), *range(0x30000, 0x34000)]
    pick = lambda: rng.choice((chr(rng.randrange(32, 127)), chr(rng.randrange(9, 0x2000)), chr(rng.choice(high))))
    return ["", "a" * 500, "ab" * 3000, " \n\n  x  ", "don't'RE'll", "ΑΣ Σ ΑΣΑ ς", "İ ǅ ﬁ Å é", "<|endoftext|> a<|startoftext|>"] + [
        "".join(pick() for _ in range(rng.randrange(1, 30))) for _ in range(2000)
    ]


def test_odd_texts_as_the_libraries():
    import json

    import tiktoken
    from tokenizers import Tokenizer

    from tideline.llm import token_counts

    ranks = byte_bpe.read_ranks(RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coder = byte_bpe.Coder(ranks, byte_bpe.word_pattern(public_tokenizers.PATTERN, ranks))
    path = public_tokenizers.path("word_bpe_49k.json")
    counter = token_counts.WordCounter(data := json.load(open(path)), token_counts.word_pattern(data))
    memory, words = counter.memory(counter.prove()), Tokenizer.from_file(path)
    for text in odd_texts():
        assert np.frombuffer(coder.encode(text), dtype="<u4").tolist() == library.encode_ordinary(text)
        assert coder.decode(coder.encode(text)) == text.encode()
        assert counter.count(text, memory) == len(words.encode(text, add_special_tokens=False).ids)


def test_words_merged_side_by_side():
    """Random ranks, so that a new pair may have a lower rank than the one before; lengths around the limits of a block."""
    import random

    from tideline.llm import merges

    draw = random.Random(7)
    pieces = [bytes([b]) for b in range(256)]
    ranks = {p: i for i, p in enumerate(pieces)}
    alphabet = [b"a", b"b", b"c", b"\xc3\xa9"]
    longer = list({b"".join(draw.choices(alphabet, k=draw.randint(2, 6))) for _ in range(800)})
    draw.shuffle(longer)
    ranks |= {p: 256 + i for i, p in enumerate(longer)}
    words = [b"".join(draw.choices(alphabet, k=draw.choice([0, 1, 2, 3, 9, 30, 64, 65, 200]))) for _ in range(3 * merges.BLOCK)]
    words[5], words[-1] = b"a", b"zzzz"

    def plain(word):
        if word in ranks:
            return [ranks[word]]
        parts = [word[i:i + 1] for i in range(len(word))]
        while True:
            found = [(r, i) for i in range(len(parts) - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
            if not found:
                return [ranks[p] for p in parts]
            _, i = min(found)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    got = [np.frombuffer(x, dtype="<u4").tolist() for x in merges.Pairs(ranks).ids(words)]
    assert got[::7] == [plain(w) for w in words[::7]] and got[5] == [97] and got[-1] == [122] * 4


def test_byte_bpe_digests(spark, sf, docs):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in registry.QUERIES["op10_byte_bpe"](spark, sf).collect():
        text = next(d.text for d in docs if d.doc_id == r.doc_id)
        ids = library.encode_ordinary(text)
        assert r.n_tokens == len(ids) and r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()


def test_fold_over_arrays_gives_the_same_ids(spark, docs):
    """Distinct words of the sample, odd ones, and a longer one."""
    ranks = byte_bpe.read_ranks(RANKS)
    coder = byte_bpe.Coder(ranks, byte_bpe.word_pattern(public_tokenizers.PATTERN, ranks))
    words = {" thanedble", "x", " Ünïcödé", "日本語", "!!!", " 12345", "reoranstble", "ab" * 30}
    words = sorted(words.union(*[coder.words.findall(d.text) for d in docs[:60]]))
    got = byte_bpe.fold_words(spark.createDataFrame([(w,) for w in words], "word string"), ranks).collect()
    assert len(words) > 2_000
    assert {r.word: list(r.ids) for r in got} == {w: np.frombuffer(coder.encode(w), dtype="<u4").tolist() for w in words}


def test_sharding(spark, sf, docs):
    rows = registry.QUERIES["op9_sharding"](spark, sf).collect()
    texts = {d.doc_id: d.text.encode() for d in docs}
    for r in rows:
        assert (r["size"], r.text_crc32) == (len(texts[r.doc_id]) + 1, zlib.crc32(texts[r.doc_id]))
        assert r.grown_shard in (r.shard, 8)
    for shard in range(8):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots))) and len(rows) / 16 < len(slots) < len(rows) / 4


def test_weights_move_rows_only_where_they_change(spark):
    from tideline.llm.sharding import Branch, Shard, shard_of
    from pyspark.sql import functions as F

    def tree(weight):
        return Branch("root", (
            Branch("a", (Branch("a0", (Shard(0), Shard(1))), Branch("a1", (Shard(2), Shard(3, weight))))),
            Branch("b", (Branch("b0", (Shard(4), Shard(5))),)),
        ))

    keys = spark.range(20_000).select(F.col("id").cast("string").alias("k"))
    moves = keys.select(shard_of(F.col("k"), tree(1.0)).alias("x"), shard_of(F.col("k"), tree(2.0)).alias("y")).groupBy("x", "y").count()
    found = {(r.x, r.y): r["count"] for r in moves.collect()}
    # Only subtree a grows: nothing moves into b or between its shards, nor between the shards of rack a0.
    assert not any(x != y and y in (4, 5) for x, y in found) and (0, 1) not in found and (1, 0) not in found
    grown = sum(n for (_, y), n in found.items() if y == 3)
    assert abs(grown / 20_000 - 2 / 7) < 0.02


@pytest.mark.parametrize("name,column,least", [("op2_toxicity", "toxic", 0.85), ("op3_quality", "quality", 0.95)])
def test_held_out_accuracy(spark, name, column, least):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = registry.QUERIES[name](spark, folder).where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r[column] for r in rows]) >= least
    assert all((zlib.crc32(str(r.doc_id).encode()) % 5 == 0) == r.held_out for r in rows)


def test_pipeline(spark, sf, docs):
    """Each stage decides as its operator, on all that the stage before it kept."""
    frame, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, sf)
        out.append(frame.collect())
        frame = spark.createDataFrame(out[-1], frame.schema)
    kept = [{r.doc_id for r in rows} for rows in out]
    assert kept[1] == kept[0] and kept[2] <= kept[1] and kept[3] <= kept[2] and kept[4] == kept[3]
    texts = {r.doc_id: r.text for r in out[1]}
    assert kept[2] == set(smallest_reachable([(i, simhash_of(t)) for i, t in sorted(texts.items())]).values())
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).collect())) == sorted(map(tuple, out[4]))
