"""The plans of the hot paths: what is read, pre-aggregated and shuffled."""

from __future__ import annotations

import os
import re

import pytest
from conftest import plan

from lakesift.probes import load_all
from lakesift.sources.catalog import load_required

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not there")


def _plan(spark, key):
    return plan(load_all()[key].run(spark, FOLDER))


def test_scans_read_only_required_columns(spark):
    tables = {"customer": spark.read.parquet(f"{FOLDER}/customer.parquet")}
    text = plan(load_required(tables, {"customer": ["c_custkey", "c_acctbal"]})["customer"])
    assert "ReadSchema: struct<c_custkey:bigint,c_acctbal:double>" in text


def test_filters_reach_the_scan(spark):
    text = _plan(spark, "b10_greater")
    assert "PushedFilters: [IsNotNull(p_size), GreaterThan(p_size,40)]" in text


def test_rates_are_preaggregated_and_shuffled_once(spark):
    text = _plan(spark, "d1_d3_line_rates")
    assert "partial_sum" in text[text.index("Exchange hashpartitioning") :]
    assert text.count("Exchange hashpartitioning") == 1
    assert "l_shipdate" not in text


def test_star_around_small_dimensions_shuffles_only_the_aggregate(spark):
    text = _plan(spark, "c2_star_enrichment")
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    assert text.count("BroadcastHashJoin") == 5


def test_a_star_of_large_dimensions_shuffles_the_fact_for_its_own_keys_only(spark, conf):
    """Without broadcasts: one exchange of the fact to group, one for each of its own two keys."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    text = _plan(spark, "c2_star_enrichment")
    keys = re.findall(r"Exchange hashpartitioning\((\w+)#", text)
    # The dimension on the other side of each of the two joins carries the fact's key name.
    assert keys.count("l_orderkey") + keys.count("l_suppkey") == 3 + 2
    assert len(re.findall("SortMergeJoin", text)) == 5


def test_measures_of_one_role_join_nothing_else(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert _plan(spark, "d18_additive_measures").count("Join") == 1


def test_season_change_needs_no_self_join(spark):
    text = _plan(spark, "d22_season_percent")
    assert "Join" not in text


def test_null_profile_is_one_aggregate(spark):
    assert _plan(spark, "d17_column_profile").count("Exchange SinglePartition") == 1


def test_bucketed_lines_are_grouped_and_joined_without_a_shuffle(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = _plan(spark, "c2_bucketed_star")
    scan = text.index("Bucketed: true")
    path = text[text.rindex("SortMergeJoin [l_orderkey", 0, scan) : scan]
    assert path.count("HashAggregate") == 2 and "Exchange" not in path and "lineitem" in text[scan - 400 : scan + 400]


def test_buckets_grow_with_the_table(spark, conf, monkeypatch):
    from lakesift.sources import catalog

    assert catalog.buckets_for(spark.range(100), 4, 9) == 12 and catalog.buckets_for(spark.range(100), 16, 9) == 16
    monkeypatch.setattr(catalog, "buckets_for", lambda df: 24)
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert "SelectedBucketsCount: 24 out of 24" in _plan(spark, "c2_bucketed_star")
