"""Results recomputed by plain loops: shards by a descent of the tree, quality scores from the model, links by all pairs."""

import math
import re
import zlib

import numpy as np
import xxhash

import corpus_pipeline
from tideline.llm import quality, registry, sharding

FOLDER = "/root/testdata/sf0.01"


def descend(key, node):
    """The child with the smallest exponential draw, down to a shard."""
    while isinstance(node, sharding.Branch):
        draws = []
        for child in node.children:
            name = child.name if isinstance(child, sharding.Branch) else f"shard{child.number}"
            h = xxhash.xxh64_intdigest(key.encode(), xxhash.xxh64_intdigest(name.encode(), 42))
            draws.append((-math.log(((h >> 12) + 0.5) / 2**52) / child.weight, child))
        node = min(draws, key=lambda d: d[0])[1]
    return node.number


def test_every_shard_by_a_plain_descent(spark):
    tree = sharding.even_tree(8)
    larger = sharding.grown(tree, sharding.Shard(8))
    rows = registry.QUERIES["op9_sharding"](spark, FOLDER).collect()
    assert len(rows) == 1000
    for r in rows:
        assert (r.shard, r.grown_shard) == (descend(str(r.doc_id), tree), descend(str(r.doc_id), larger))
    assert {r.grown_shard for r in rows} == set(range(9))


def statistics(text):
    """The statistics of one text, byte by byte and word by word."""
    raw = text.encode()
    lines = [x for x in raw.split(b"\n") if x]
    words = raw.split()
    n_bytes, n_words, n_lines = max(1, len(raw)), max(1, len(words)), max(1, len(lines))
    classes = [
        lambda b: 65 <= b <= 90, lambda b: 97 <= b <= 122, lambda b: 48 <= b <= 57, lambda b: b in b"#$%&*<>@^~=+_\\/{}[]",
        lambda b: b in b"|", lambda b: b in b"!?", lambda b: b in b".,;:", lambda b: b >= 128,
    ]
    return [
        *[sum(map(c, raw)) / n_bytes for c in classes],
        math.log1p(len(words)), len(raw) / n_words, math.log1p(len(lines)) - math.log1p(len(words)),
        len(set(words)) / n_words, len(set(lines)) / n_lines,
        sum(a == b for a, b in zip(words, words[1:])) / n_words,
        sum(w[-1] in b"#$%&*<>@^~=+_\\/{}[]|" for w in words) / n_words,
        sum(len(w) == 1 for w in words) / n_words, sum(len(w) > 20 for w in words) / n_words,
    ]


def test_quality_scores_by_a_plain_loop(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.train(docs, labels)
    known = {r.doc_id: r.quality for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5}
    rows = {r.doc_id: statistics(r.text) for r in docs.collect()}
    x = np.array([rows[d] for d in sorted(known)])
    assert np.allclose(model.mean, x.mean(0)) and np.allclose(model.spread, x.std(0) + 1e-3)

    def cosines(v):
        z = [min(6.0, max(-6.0, (a - m) / s)) for a, m, s in zip(v, model.mean, model.spread)]
        turned = [sum(a * t for a, t in zip(z, column)) for column in model.turn.T]
        return [math.cos(t + p) * math.sqrt(2 / quality.FEATURES) for t, p in zip(turned, model.phase)] + [1.0]

    phi = {d: cosines(v) for d, v in rows.items()}
    fit = [d for d in sorted(known) if zlib.crc32(str(d).encode()) % 5 != 4]
    a, y = np.array([phi[d] for d in fit]), np.array([known[d] for d in fit], dtype=float)
    weights = np.linalg.solve(a.T @ a + quality.RIDGE * np.eye(a.shape[1]), a.T @ y)
    assert np.abs(a @ weights - a @ model.weights).max() < 1e-6
    # Calibration: the least-squares rising fit of the kept fold, by pooling any falling neighbours until none falls.
    kept = sorted((float(np.dot(phi[d], model.weights)), known[d]) for d in known if d not in set(fit))
    blocks = [[x, [t]] for x, t in ((([r]), t) for r, t in kept)]
    k = 0
    while k < len(blocks) - 1:
        if np.mean(blocks[k][1]) >= np.mean(blocks[k + 1][1]):
            blocks[k:k + 2] = [[blocks[k][0] + blocks[k + 1][0], blocks[k][1] + blocks[k + 1][1]]]
            k = max(0, k - 1)
        else:
            k += 1
    steps = [np.mean(b[0]) for b in blocks], [np.mean(b[1]) for b in blocks]
    for r in quality.score(docs, model).collect():
        want = min(1.0, max(0.0, float(np.interp(np.dot(phi[r.doc_id], model.weights), *steps))))
        assert abs(r.score - want) < 1e-6


def test_links_of_every_twentieth_fingerprint(spark):
    """Recall 1: whatever is within four bits of a query has its component, over 10,000 documents."""
    rows = registry.QUERIES["op8_simhash"](spark, "/root/testdata/sf0.1").collect()
    prints = np.array([int(r.fingerprint, 16) for r in rows], dtype=np.uint64)
    roots = np.array([r.component_id for r in rows])
    found = total = 0
    for i, r in enumerate(rows):
        if r.doc_id % 20 == 0:
            near = np.bitwise_count(prints ^ prints[i]) <= 4
            total += int(near.sum())
            found += int((roots[near] == roots[i]).sum())
    assert found == total > 500


def test_nulls_ties_and_repeats_through_the_pipeline(spark, tmp_path):
    """Every stage on odd rows, with the rows and texts it has to leave."""
    passage = " ".join(f"p{i}" for i in range(60))
    own = lambda k, n=80: " ".join(f"w{k}x{i}" for i in range(n))
    leak = " ".join(f"b{i}" for i in range(12))
    rows = [
        (1, None, "en", "s", None), (2, "", "en", None, 0), (3, own(3), "en", "s", 5), (3, own(3), "en", "s", 5), (4, own(3), None, "s", 5),
        (5, f"{own(5)}\n{passage}", "en", "s", 5), (6, f"{own(6)}\n{passage}", "en", "s", 5), (7, f"{own(7)} {leak} end", "en", "s", 5),
        (None, own(9), "en", "s", None), (None, own(9), "en", "s", None), (10, own(10, 30_000), "de", "t", 5),
    ]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([("i", leak), (None, None), ("e", "")], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, out = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        out.append(docs.collect())
    ids = lambda rows: sorted((r.doc_id for r in rows), key=lambda i: (i is None, i))
    # Without labels nothing is rejected.
    assert ids(out[0]) == [1, 2, 3, 3, 4, 5, 6, 7, 10, None, None]
    # Rows of equal id and text are one document; the copy under another id and the second passage go.
    texts = {r.doc_id: r.text for r in out[1]}
    assert ids(out[1]) == ids(out[0])
    assert (texts[1], texts[2], texts[3], texts[4], texts[6]) == (None, "", own(3), "", own(6)) and texts[5].endswith(passage)
    assert {r.n_chars for r in out[1] if r.doc_id == 4} == {0} and {r.n_chars for r in out[1] if r.doc_id == 1} == {None}
    # Texts without words are one group, as are repeated rows.
    assert ids(out[2]) == [1, 3, 5, 6, 7, 10, None]
    assert ids(out[3]) == [1, 3, 5, 6, 10, None]
    assert ids(out[4]) == ids(out[3]) and {r.n_tokens for r in out[4] if r.doc_id == 1} == {0}
    assert not re.search(leak, " ".join(r.text or "" for r in out[3]))
