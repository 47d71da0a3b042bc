"""Every registered query against its SQL on the same files."""

import os
import subprocess
import sys

import pytest
from compare import difference, duck

import __spark_entry__ as entry
from tideline.plans.registry import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry_runs(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_a_missing_library_leaves_the_other_queries():
    code = (
        "import sys\n"
        "sys.modules.update(dict.fromkeys(('xxhash', 'regex')))\n"
        "import __spark_entry__ as e\n"
        "print(len(e.queries()), len(e.oracle_sql()), any(n.startswith('op') and n[2].isdigit() for n in e.queries()))"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    said = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True)
    assert said.stdout.split() == [str(len(QUERIES)), str(len(QUERIES)), "False"], said.stderr


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf, name):
    assert difference(QUERIES[name](spark, sf), con, ORACLE[name]) is None


@pytest.mark.parametrize("name,schema", [
    ("traffic_window", "TRAFFIC_METRICS"), ("home_detail_uv_window", "HOME_DETAIL_METRICS"),
    ("login_window", "LOGIN_METRICS"), ("cart_uu_window", "CART_METRICS"), ("province_order_window", "PROVINCE_METRICS"),
])
def test_metric_tables_have_the_declared_columns(spark, sf, name, schema):
    from tideline import schemas

    assert set(QUERIES[name](spark, sf).columns) == set(getattr(schemas, schema).names)
