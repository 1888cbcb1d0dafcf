"""Registered queries against their oracle statements, and the plans of the main ones."""

from __future__ import annotations

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import compare, connect

# All queries take several minutes; by default a spread over the modules runs.
SPREAD = [
    "sell_in_std", "sell_in_kpi_master", "sell_out_kpi", "market_kpi_master", "all_source_full_join", "brand_std",
    "market_label_classify", "fact_waste", "cascade_match", "two_hop_customer_harmonization", "ean_cardinality",
    "pairwise_overlap_matrix", "period_lags", "consecutive_miss_streak", "adstock", "yoy_growth", "sell_out_checks",
    "quality_gate", "column_inventory", "grain_detection", "market_catalog", "dim_date", "dim_brand_scd", "monthly_mart",
]
NAMES = sorted(queries()) if os.environ.get("ALL_QUERIES") else SPREAD


@pytest.fixture(scope="module")
def con(small_dir):
    return connect(small_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_oracle(spark, con, small_dir, name):
    sql = oracle_sql().get(name)
    if sql is None:
        assert queries()[name](spark, small_dir).count() > 0
        return
    ok, note = compare(spark, con, small_dir, queries()[name], sql)
    assert ok, note


def test_entry_returns_the_master_table(spark):
    df = entry(spark)
    assert df.count() > 0 and "data_confidence" in df.columns


def test_dimension_lookups_do_not_shuffle_the_fact(spark, small_dir):
    """Small dimensions broadcast by their size; the facts are only shuffled to aggregate."""
    from cartmetrics.sources.roles import Tables

    plan = Tables(spark, small_dir).sell_out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan


def test_no_large_side_is_broadcast(spark, small_dir):
    """With the size limit lowered, joins fall back to sort-merge: no hint forces a broadcast."""
    from cartmetrics.sources.roles import Tables

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = Tables(spark, small_dir).sell_out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32MB")
