"""Partition grain is a parameter: day / week stores answer exactly like
the month store, and prune on their own partition column."""

import pytest

from derivspark.plans import analytics as A
from derivspark.plans import storage as S
from derivspark.sources.fixtures import BANKNIFTY, NIFTY
from derivspark.sources.store import open_model
from tests.conftest import SF01
from tests.test_plans import plan

REPORTS = [
    (A.runner_q1_oi_change, {}), (A.full_q1_oi_change, {}), (A.runner_q2_volatility, {}),
    (A.full_q2_volatility, {"symbol": NIFTY}), (A.full_q3_cross_exchange, {}),
    (A.runner_q4_option_chain, {"symbol": NIFTY}), (A.full_q4_option_chain, {"symbols": [NIFTY, BANKNIFTY]}),
    (A.full_q5_max_volume, {}), (A.full_q6_price_movement, {}), (A.bench_b1_volume, {}),
    (A.bench_b1_volume, {"nonzero": True}), (A.bench_b2_rolling, {}), (A.bench_b3_oi, {"min_net_change": 100}),
    (A.bench_verify_global, {}), (A.chart_oi_trends, {"symbols": [NIFTY, BANKNIFTY]}), (A.db_statistics, {}),
]


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def month(spark):
    return open_model(spark, SF01)


@pytest.mark.parametrize("grain", ["day", "week"])
def test_reports_do_not_depend_on_the_grain(spark, month, grain):
    other = open_model(spark, SF01, grain)
    assert other.grain == grain and other.part_col == f"trade_{grain}"
    for fn, kw in REPORTS:
        assert rows(fn(other, **kw)) == rows(fn(month, **kw)), fn.__name__
    assert rows(S.monthly_partition_rollup(other)) == rows(S.monthly_partition_rollup(month))


def test_day_grain_prunes_on_its_partition_and_retention_keeps_whole_months(spark, month, tmp_path):
    day = open_model(spark, SF01, "day")
    p = plan(A.bench_b1_volume(day, nonzero=True))
    assert "PartitionFilters: [isnotnull(trade_day" in p and "trade_day#" in p
    kept = {}
    for m in (month, day):
        path = str(tmp_path / m.grain)
        S.write_partitioned(m.trades, path, partition_by=m.part_col)
        S.drop_partitions_before(spark, path, S.keep_last_months(m, 2), column=m.part_col)
        kept[m.grain] = rows(S.partition_summary(spark.read.parquet(path)))
    assert kept["day"] == kept["month"] and len(kept["month"]) == 2


def test_timestamp_range_on_midnights_uses_the_rollup_with_the_same_result(spark, month):
    via_rollup = A.bench_b2_rolling(month, "2019-08-01 00:00:00", "2019-09-01 00:00:00")
    via_fact = A.bench_b2_rolling(month, "2019-08-01 00:00:00", "2019-08-31 23:59:59.999999")
    assert "daily" in plan(via_rollup) and "daily" not in plan(via_fact)
    assert rows(via_rollup) == rows(via_fact)
