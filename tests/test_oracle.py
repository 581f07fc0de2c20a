"""Every registered query against its oracle, plain and with nearly every key treated as hot."""

from __future__ import annotations

import pytest
from oracle_check import connect, differences

import __spark_entry__ as entry
from tidemark import plans

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = plans.queries(), plans.oracle_sql()
SLICED = [
    "annotate_watermark", "behavior_pattern", "behavior_pattern_latest", "buffered_batches", "cep_order_timeout",
    "cep_three_fails", "cep_times_consecutive", "changelog_group_count", "count_window_avg_ts", "keyed_max_field_running",
    "keyed_state_tour", "late_side_output", "late_window_counts", "most_active_user", "over_avg_rows",
    "over_count_max_named", "reduce_click_count", "running_count", "window_cogroup", "cep_steps", "changelog_weighted_avg",
    "reduce_general", "changelog_topn", "behavior_pattern_asof", "union_watermark", "expiring_count", "periodic_pv",
]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert differences(spark, con, name, QUERIES[name], ORACLES[name], SF) is None


@pytest.mark.parametrize("name", SLICED)
def test_query_with_hot_keys(spark, con, name, tiny_slices):
    assert differences(spark, con, name, QUERIES[name], ORACLES[name], SF) is None


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["window_start", "window_end", "user_id", "cnt"]
    assert frame.count() > 0
