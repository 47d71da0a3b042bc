"""Properties of the plans that decide whether a query survives a large input."""

import re

import pytest

from tideline.plans.registry import QUERIES

BATCH = sorted(n for n in QUERIES if not n.startswith(("stream_", "landed_")))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text, name):
    return [s for s in re.findall(r"FileScan parquet \[(.*?)\].*?Location: [^,]*?\[([^\]]*)\]", text) if name in s[1]]


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text
    assert "NestedLoopJoin" not in text
    assert "Python" not in text and "Pandas" not in text


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", ["order_detail_fact", "pay_success_fact", "refund_fact", "sku_order_window", "interval_order"])
def test_large_sides_fall_back_to_shuffle_joins(spark, sf, no_broadcast, name):
    text = plan(QUERIES[name](spark, sf))
    assert "SortMergeJoin" in text
    assert "BroadcastHashJoin" not in text


def test_scans_read_only_needed_columns(spark, sf):
    text = plan(QUERIES["province_order_window"](spark, sf))
    lineitem = [s for s in re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*lineitem", text)]
    assert lineitem and all("l_tax" not in s and "l_returnflag" not in s for s in lineitem)
    text = plan(QUERIES["exact_dedup"](spark, sf))
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>", text)


def test_filters_reach_the_scan(spark, sf):
    text = plan(QUERIES["refund_fact"](spark, sf))
    assert "EqualTo(l_returnflag,R)" in text


def test_windows_are_combined_before_the_shuffle(spark, sf):
    text = plan(QUERIES["traffic_window"](spark, sf))
    assert "partial_sum" in text and "partial_min_by" in text
    assert " Window " not in text


def test_marking_replaced_versions_sorts_no_history(spark, sf):
    from tideline.operators.keyed import mark_superseded
    from tideline.plans.tables import ORDER, details

    text = plan(mark_superseded(details(spark, sf).select("id", *ORDER), ["id"], ORDER))
    assert " Window " not in text and "partial_max" in text


def test_provinces_are_summed_without_the_text_of_ids(spark, sf, no_broadcast):
    text = plan(QUERIES["province_order_window"](spark, sf))
    assert "concat_ws" not in text and "partial_max_by" in text


def test_named_whole_numbers_are_a_set(spark, sf):
    text = plan(QUERIES["order_detail_hot"](spark, sf))
    assert "INSET" in text and not re.search(r"= 62\) OR|= 62 OR", text)


def jobs_of(spark, build):
    """Number of jobs that run while ``build()`` makes a plan."""
    spark.sparkContext.setJobGroup("build", "")
    try:
        build()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("build"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("name", BATCH)
def test_building_a_query_starts_no_job(spark, sf, name):
    QUERIES[name](spark, sf)  # the schemas are read once
    assert jobs_of(spark, lambda: QUERIES[name](spark, sf)) == 0


def test_one_shuffle_for_two_joins_on_one_key(spark, sf, no_broadcast):
    text = plan(QUERIES["order_detail_fact"](spark, sf))
    # One for the lines, one each for the activities and coupons.
    assert len(re.findall(r"Exchange hashpartitioning\(id#\d+", text)) == 3
