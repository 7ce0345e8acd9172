"""Literal-row unit tests for the operators' edge cases."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from derivspark.functions import metrics as M
from derivspark.operators.ids import dense_ids
from derivspark.operators.reshape import equal_width_histogram, rolling_stats, side_by_side, top_k_per_group


def test_round_half_up_reads_like_decimal_text(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-1.005,), (0.125,), (None,)], "x double")
    got = [r[0] for r in df.select(M.round_half_up("x", 2)).collect()]
    assert got == [1.01, 2.68, -1.01, 0.13, None]


def test_safe_div_zero_denominator_is_null_not_error(spark):
    df = spark.createDataFrame([(5, 0), (6, 3), (1, None)], "a bigint, b bigint")
    assert [r[0] for r in df.select(M.safe_div("a", "b")).collect()] == [None, 2.0, None]


def test_volatility_class_boundaries(spark):
    df = spark.createDataFrame([(5.0,), (5.01,), (2.0,), (2.5,), (0.5,)], "p double")
    got = [r[0] for r in df.select(M.volatility_class("p")).collect()]
    assert got == ["Medium Volatility", "High Volatility", "Low Volatility", "Medium Volatility",
                   "Low Volatility"]


def test_spread_missing_side_is_zero(spark):
    df = spark.createDataFrame([(100.0, None), (100.0, 98.0)], "a double, b double")
    got = df.select(M.spread("a", "b").alias("s"), M.spread_pct("a", "b").alias("p")).collect()
    assert (got[0].s, got[0].p) == (0.0, 0.0)
    assert (got[1].s, got[1].p) == (2.0, 2.0)


def test_rolling_frame_counts_rows_not_days_and_single_row_stddev_is_null(spark):
    days = [dt.date(2019, 8, d) for d in (1, 2, 5, 9, 20, 21, 22, 30)]  # gaps between dates
    df = spark.createDataFrame([("A", d, float(i)) for i, d in enumerate(days)], "s string, d date, v double")
    out = rolling_stats(df, ["s"], "d", "v", 7, stddev="sd", mean="ma", count="n").orderBy("d").collect()
    assert out[0].sd is None and out[0].n == 1
    assert [r.n for r in out] == [1, 2, 3, 4, 5, 6, 7, 7]
    assert out[6].ma == 3.0 and out[7].ma == 4.0


def test_side_by_side_missing_side_null_or_fill(spark):
    df = spark.createDataFrame([("X", "CE", -5), ("X", "PE", 3), ("Y", "PE", 3)], "k string, o string, v bigint")
    nul = {r.k: r for r in side_by_side(df, ["k"], "o", {"CE": "ce_", "PE": "pe_"}, {"v": "v"}).collect()}
    assert (nul["X"].ce_v, nul["X"].pe_v, nul["Y"].ce_v) == (-5, 3, None)
    zero = {r.k: r for r in side_by_side(df, ["k"], "o", {"CE": "ce_", "PE": "pe_"}, {"v": "v"}, fill=0).collect()}
    # ELSE 0 hides a negative maximum when the other side has rows, as in the original query.
    assert (zero["X"].ce_v, zero["X"].pe_v, zero["Y"].ce_v) == (0, 3, 0)


def test_top_k_per_group_ties_are_broken_by_given_keys(spark):
    df = spark.createDataFrame([("A", dt.date(2019, 8, 2), 10), ("A", dt.date(2019, 8, 1), 10),
                                ("A", dt.date(2019, 8, 3), 5)], "s string, d date, v bigint")
    out = top_k_per_group(df, ["s"], [F.col("v").desc(), "d"], 1).collect()
    assert [(r.d, r.v) for r in out] == [(dt.date(2019, 8, 1), 10)]


def test_histogram_last_bin_closed_and_constant_values(spark):
    df = spark.createDataFrame([(0,), (5,), (10,), (10,)], "x bigint")
    h = {r.bin: r for r in equal_width_histogram(df, "x", 5).collect()}
    assert len(h) == 5 and h[0].frequency == 1 and h[2].frequency == 1 and h[4].frequency == 2
    assert h[4].hi == 10.0
    const = equal_width_histogram(spark.createDataFrame([(7,), (7,)], "x bigint"), "x", 3).collect()
    assert {r.bin: r.frequency for r in const} == {0: 2, 1: 0, 2: 0}


def test_dense_ids_with_hot_group_of_copies(spark):
    rows = [(dt.date(2019, 8, 1), "hot", 1)] * 50 + [(dt.date(2019, 8, 1), f"k{i}", i) for i in range(20)] \
        + [(dt.date(2019, 8, 2), "x", 1)] * 3
    df = spark.createDataFrame(rows, "d date, k string, v int")
    out = dense_ids(df, ["k", "v"], "id", ["d"], copies=True)
    got = out.collect()
    assert len(got) == len(rows)
    assert sorted(r.id for r in got) == list(range(1, len(rows) + 1))
    # the bucket prefix orders the ids: every 2019-08-01 row precedes 2019-08-02
    first = max(r.id for r in got if r.d == dt.date(2019, 8, 1))
    assert first == 70 and min(r.id for r in got if r.d == dt.date(2019, 8, 2)) == 71


def test_dense_ids_follow_natural_order(spark):
    df = spark.createDataFrame([(2, "b"), (1, "z"), (2, "a"), (1, "a")], "e int, s string")
    got = [(r.e, r.s, r.id) for r in dense_ids(df, ["s"], "id", ["e"]).orderBy("id").collect()]
    assert got == [(1, "a", 1), (1, "z", 2), (2, "a", 3), (2, "b", 4)]


def test_quality_checks_pass_on_null_and_count_violations(spark):
    from derivspark.plans.quality import check_violations, duplicate_keys, orphans
    d = Decimal
    rows = [("OPTIDX", "CE", d("1"), d("10"), d("5"), d("6"), d("7")),     # ok
            ("OPTIDX", "ZZ", d("-1"), d("5"), d("10"), d("6"), d("7")),    # option, strike, ohlc
            ("BOGUS", None, None, None, None, None, None)]                 # type; NULLs pass CHECK
    df = spark.createDataFrame(rows, "instrument_type string, option_type string, strike_price decimal(12,2), "
                                     "high decimal(12,2), low decimal(12,2), open decimal(12,2), close decimal(12,2)")
    got = {r.rule: r.violations for r in check_violations(df, not_null=["option_type"]).collect()}
    assert got == {"instrument_type_domain": 1, "series_domain": 0, "option_type_domain": 1,
                   "strike_non_negative": 1, "ohlc_consistent": 1, "not_null_option_type": 1}
    keys = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert [tuple(r) for r in duplicate_keys(keys, ["k"]).collect()] == [(1, 2)]
    parent = spark.createDataFrame([(1,)], "k int")
    assert orphans(keys, parent, "k").count() == 1


def test_hash_sample_is_the_n_smallest_hashes_and_reproducible(spark):
    from derivspark.operators.reshape import SAMPLE_MOD, hash_sample
    df = spark.range(0, 5000).withColumnRenamed("id", "k")
    ordered = df.withColumn("u", F.pmod(F.xxhash64("k"), F.lit(SAMPLE_MOD))).toPandas().sort_values(["u", "k"])
    for n in (100, 4000):  # 100: a small threshold cut; 4000: the cut covers every row
        a = sorted(r.k for r in hash_sample(df, n, ["k"]).collect())
        b = sorted(r.k for r in hash_sample(df.repartition(7), n, ["k"]).collect())
        assert a == b == sorted(ordered.k.head(n).tolist())
    assert hash_sample(df.limit(50), 100, ["k"]).count() == 50  # n above the input: all rows


def test_histogram_over_a_sample(spark):
    from derivspark.plans.analytics import chart_volume_histogram
    from derivspark.sources.store import open_model
    from tests.conftest import SF001
    m = open_model(spark, SF001)
    h = chart_volume_histogram(m, sample_rows=1000).collect()
    assert len(h) == 50 and sum(r.frequency for r in h) == 1000


def test_dense_ids_split_a_hot_prefix_in_natural_order(spark, tmp_path):
    hot = [(dt.date(2019, 8, 1), f"k{i}", i) for i in range(400)]      # the hot date: 400 rows
    cold = [(dt.date(2019, 8, 2), f"k{i}", i) for i in range(10)]
    df = spark.createDataFrame(hot + cold, "d date, k string, v int")
    copies = df.where("k = 'k7'").withColumn("x", F.explode(F.sequence(F.lit(1), F.lit(300)))).drop("x")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = dense_ids(df, ["k", "v"], "id", ["d"], copies=True).collect()
        dense_ids(df.union(copies), ["k", "v"], "id", ["d"], copies=True, stage_dir=str(tmp_path))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert sorted(r.id for r in got) == list(range(1, 411))
    assert max(r.id for r in got if r.d == dt.date(2019, 8, 1)) == 400   # prefix order kept
    assert [(r.d, r.k) for r in sorted(got, key=lambda r: r.id)] == sorted((d, k) for d, k, _ in hot + cold)
    # the hot date, and the copies of one of its rows, are sorted in several tasks
    staged = spark.read.parquet(f"{tmp_path}/ranked").withColumn("task", F.shiftright("_at", 33))
    assert staged.where("d = DATE'2019-08-01'").select("task").distinct().count() >= 4
    assert staged.where("k = 'k7' AND d = DATE'2019-08-01'").select("task").distinct().count() >= 2


def test_sizing_conf_scales_with_input_and_slots():
    from derivspark.session import sizing_conf
    big = sizing_conf(100 * 2**40, executors=1000, cores_per_executor=8)
    assert big["spark.sql.shuffle.partitions"] == str(100 * 2**40 // (256 << 20))
    small = sizing_conf(2**30, executors=10, cores_per_executor=8)
    assert small["spark.sql.shuffle.partitions"] == "80"  # never fewer than task slots


def test_period_values_per_grain():
    from derivspark.functions.metrics import period_value
    d = dt.date(2019, 8, 7)  # a Wednesday
    assert (period_value(d, "month"), period_value(d, "week"), period_value(d, "day")) == \
        (201908, 20190805, 20190807)


def test_dense_ids_keep_rows_with_null_buckets(spark):
    from derivspark.operators.ids import dense_ids
    df = spark.createDataFrame([(1, "a"), (None, "b"), (None, "c"), (2, "d")], "g int, v string")
    for copies in (False, True):
        got = sorted((r.id, r.v) for r in dense_ids(df, ["v"], "id", ["g"], copies=copies).collect())
        assert got == [(1, "b"), (2, "c"), (3, "a"), (4, "d")]
    assert dense_ids(df.limit(0), ["v"], "id", ["g"], copies=True).count() == 0


def test_orphans_pass_null_keys(spark):
    from derivspark.plans.quality import orphans
    child = spark.createDataFrame([(1,), (None,), (9,)], "fk int")
    parent = spark.createDataFrame([(1,)], "fk int")
    assert [r.fk for r in orphans(child, parent, "fk").collect()] == [9]


def test_print_result_prints_every_row(spark, capsys):
    from derivspark.sources.sinks import print_result
    print_result(spark.range(120))
    assert len(capsys.readouterr().out.strip().splitlines()) == 121
