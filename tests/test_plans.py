"""Physical-plan assertions: the plans the engine is meant to produce."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from derivspark.registry import REGISTRY
from tests.conftest import SF01


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def q(spark, key):
    return E.queries()[key](spark, SF01)


def test_dimension_joins_are_broadcast_and_limit_is_top_n(spark):
    p = plan(q(spark, "runner_q1_oi_change"))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    assert "TakeOrderedAndProject" in p


def test_date_range_prunes_month_partitions_and_pushes_filters(spark):
    p = plan(q(spark, "bench_b1_volume"))
    assert "PartitionFilters: [isnotnull(trade_month" in p and "(trade_month#" in p
    assert "PushedFilters: [IsNotNull(trade_date), GreaterThanOrEqual(trade_date" in p


def test_projection_reaches_the_scan(spark):
    p = plan(q(spark, "bench_verify_global"))
    scan = [ln for ln in p.splitlines() if ln.strip().startswith("ReadSchema")]
    assert scan and all("open_interest" not in ln and "high" not in ln for ln in scan)


def test_top_k_per_group_uses_window_group_limit(spark):
    assert "WindowGroupLimit" in plan(q(spark, "topk_per_group"))


def test_scalar_subquery_not_a_join(spark):
    p = plan(q(spark, "runner_q4_option_chain"))
    assert "Subquery" in p and "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


@pytest.mark.parametrize("key", sorted(k for k in REGISTRY if not k.startswith(("stream_", "upsert",
                                                                                       "insert_if", "ingest",
                                                                                       "archive", "retention",
                                                                                       "daily_rollup"))))
def test_no_cartesian_or_nested_loop_joins(spark, key):
    p = plan(q(spark, key))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, key


def test_rolling_columns_share_one_window_pass(spark):
    p = plan(q(spark, "full_q2_volatility"))
    assert p.count("Window [") + p.count("Window (") >= 1
    assert p.count("Sort [expiry_date") <= 1


def test_symbol_filter_reaches_the_fact_scan_as_instrument_ids(spark):
    p = plan(q(spark, "runner_q4_option_chain"))
    assert "PushedFilters: [IsNotNull(instrument_id), In(instrument_id," in p or \
        "In(instrument_id, [" in p


@pytest.mark.parametrize("key", ["runner_q7_active_expiries", "full_q7_active_expiries", "bench_b3_oi",
                                 "full_q4_option_chain", "chart_volume_histogram"])
def test_fact_aggregations_combine_map_side_before_the_shuffle(spark, key):
    """A hot symbol reaches the shuffle as one partial row per task."""
    p = plan(q(spark, key))
    assert "HashAggregate" in p and "partial_" in p
