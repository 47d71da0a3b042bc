import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

LONG = " ".join(f"word{i % 977}" for i in range(40_000)) + "\n" + "a" * 100_000


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns named like results."""
    rows = [
        (None, "no id here at all", "en", "s", 1), (1, None, None, None, None), (2, "", "en", "s", 0),
        (3, "the same text\nthe same text", "en", "s", 27), (3, "the same text\nthe same text", "en", "s", 27),
        (4, LONG, "en", None, len(LONG)), (5, " \n\t\r\n ", "de", "t", 6), (6, LONG, "en", "s", len(LONG)),
        (7, "Ünïcödé 日本語 Σ 🙂 token: \"abcdef0123456789\"", None, "t", 40), (None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clash = ("score", "N_Words", "hits", "item_ids", "contaminated", "fp", "slot", "shard", "size", "n_lines", "n_removed",
             "ids", "coded", "n_tokens", "_score", "_fp", "_row", "host", "h", "run")
    return df.selectExpr("*", *[f"concat('{c}', doc_id) AS `{c}`" for c in clash])


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(3, 1, 0), (3, 0, 1), (None, 1, 1), (7, None, None), (99, 1, 0)], "doc_id long, quality int, toxic int"
    )
