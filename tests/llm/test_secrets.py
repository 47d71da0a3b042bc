"""Candidates of several owners, and of many repositories of one owner."""

import hashlib
import math
import random
import re
import string
from collections import Counter

from tideline.llm import secrets

TOKEN = "Aq3Sw5De7Fr9Gt1Hy2Ju"


def found(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return {r.doc_id: r for r in secrets.find_secrets(df).collect()}


def test_a_copy_under_another_owner_keeps_the_token(spark):
    got = found(spark, [(1, f"see {TOKEN} here", "a"), (2, f"see {TOKEN}", "b")])
    for r in got.values():
        assert (r.spans, r.shared_spans, r.n_live, r.n_copied) == ("owned:4:24", "owned:4:24", 1, 0)
    got = found(spark, [(i, TOKEN, f"o{i}") for i in range(3)])
    assert {(r.spans, r.shared_spans, r.n_live, r.n_copied) for r in got.values()} == {("", "", 0, 0)}


def test_many_repositories_of_one_owner_are_an_example(spark):
    n = secrets.EXAMPLE_REPOSITORIES
    for source in ("hot", None):
        rows = [(i, "token=example99", source) for i in range(n + 1)] + [(100 + i, "token=mine4444", source) for i in range(n)]
        rows += [(200 + i, TOKEN, source) for i in range(n + 1)] + [(100, "token=mine4444", source)] * 5
        got = found(spark, rows)
        assert (got[0].n_live, got[0].n_copied, got[0].most_owners, got[0].most_repositories) == (0, 1, 1, n + 1)
        assert (got[100].n_live, got[100].n_copied, got[100].most_repositories) == (1, 0, n)
        assert (got[200].spans, got[200].n_live, got[200].n_copied) == ("owned:0:20", 0, 1)


def brute(rows):
    """Every column of every row by plain counting over (doc_id, text, source)."""
    base = [
        (re.compile("(?:" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in k) for k in (
            "password", "passwd", "secret", "token", "api_?key")) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 6, 1),
        (re.compile("AKIA[A-Z0-9]+"), 20, 0), (re.compile("[0-9a-f]+"), 24, 0),
    ]
    found = []
    for _, text, _ in rows:
        text, own = text or "", []
        for kind, (pattern, least, group) in enumerate(base):
            own += [(m.start(), kind, m.end(), m[group]) for m in pattern.finditer(text) if len(m[group]) >= least]
        taken = [x[:3] for x in own]
        for m in re.finditer(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}", text):
            v = m[0]
            bits = -sum(v.count(c) / len(v) * math.log2(v.count(c) / len(v)) for c in set(v))
            if re.search("[0-9]", v) and re.search("[A-Za-z]", v) and bits >= 3.5 and not any(
                    s < m.end() and m.start() < e for s, _, e in taken):
                own.append((m.start(), 3, m.end(), v))
        found.append(sorted(own))
    places = {}
    for (doc_id, _, source), own in zip(rows, found):
        for *_, v in own:
            places.setdefault(v, set()).add((source or "", doc_id))
    owners = {v: len({o for o, _ in p}) for v, p in places.items()}
    copied = {v: owners[v] >= 3 or len(places[v]) > 10 for v in places}
    names = ("assign", "access", "hex", "owned")
    join = lambda spans: ",".join(f"{names[k]}:{s}:{e}" for s, k, e, _ in spans)
    out = []
    for (doc_id, _, _), own in zip(rows, found):
        chosen = [x for x in own if x[1] < 3 or owners[x[3]] < 3]
        out.append((
            doc_id, *[sum(x[1] == k for x in own) for k in range(3)],
            hashlib.sha256(join([x for x in own if x[1] < 3]).encode()).hexdigest(), join(chosen),
            sum(not copied[x[3]] for x in chosen), sum(copied[x[3]] for x in chosen),
            max((len(places[x[3]]) for x in own), default=0), max((owners[x[3]] for x in own), default=0),
            join([x for x in chosen if x[1] == 3 and owners[x[3]] > 1]),
        ))
    return out


COLUMNS = ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_live", "n_copied", "most_repositories",
           "most_owners", "shared_spans")


def test_all_columns_against_plain_counting(spark):
    """Owned, shared and widely copied tokens of all kinds, in one hot source, several sources and none."""
    rng = random.Random(5)
    letters = string.ascii_letters + string.digits
    tokens = ["".join(rng.choice(letters) for _ in range(rng.randrange(18, 30))) for _ in range(40)]
    keys = ["AKIA" + "".join(rng.choice(string.ascii_uppercase + string.digits) for _ in range(n)) for n in (12, 15, 16, 17, 20)]
    codes = ["".join(rng.choice("0123456789abcdef") for _ in range(n)) for n in (20, 23, 24, 40, 64)]
    forms = ["token={}", "API_KEY: '{}'", "passwd = \"{}\"", "see {} here", "{}", "x/{}/y", "secret=token:{}", "é {} 日本"]
    rows = []
    for i in range(300):
        values = [rng.choice(rng.choice((tokens, tokens[:4], keys, codes, ["short", "a" * 30, "12345678901234567890123"]))) for _ in range(rng.randrange(5))]
        text = " ".join(rng.choice(forms).format(v) for v in values)
        rows.append((i, text, "hot" if i % 3 == 0 else None if i % 7 == 0 else f"o{rng.randrange(60)}"))
    rows += [rows[5], rows[6], (None, rows[7][1], "x"), (None, None, None), (7, tokens[0], "a"), (7, tokens[0], "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = Counter(tuple(r[c] for c in COLUMNS) for r in secrets.find_secrets(df).collect())
    want = Counter(brute(rows))
    assert got == want
    kinds = {k.split(":")[0] for r in want for k in r[5].split(",")}
    assert kinds >= {"assign", "access", "hex", "owned"} and any(r[10] for r in want) and any(r[7] for r in want)
