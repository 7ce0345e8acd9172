"""Plans without row copies for several distinct counts, statistics that steer joins, defaults, exact
money and the discovered pivot."""

from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import __spark_entry__ as E
from derivspark.functions import metrics as M
from derivspark.operators.reshape import distinct_counts, pivot_discovered
from derivspark.plans import analytics as A
from derivspark.registry import report
from derivspark.sources.catalog import TABLE_DDL, analyze, cost_based, create_tables, drop_tables, register_tables
from derivspark.sources.store import open_model
from tests.conftest import SF001, SF01
from tests.test_plans import plan


@pytest.mark.parametrize("key", ["full_q7_active_expiries", "agg_count_distinct"])
def test_distinct_counts_do_not_expand_the_rows(spark, key):
    assert "Expand" not in plan(E.queries()[key](spark, SF01))


def test_distinct_counts_with_nulls(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, None, 1), (1, "b", None), (None, "a", 5), (None, "a", 6), (2, None, None)],
                               "k int, x string, y int")
    got = {r.k: (r.nx, r.ny) for r in distinct_counts(df, ["k"], {"nx": "x", "ny": "y"}).collect()}
    want = {r.k: (r.nx, r.ny) for r in df.groupBy("k").agg(F.countDistinct("x").alias("nx"), F.countDistinct("y").alias("ny")).collect()}
    assert got == want == {1: (2, 1), None: (1, 2), 2: (0, 0)}


def test_oi_report_ends_in_a_merge_of_top_rows(spark):
    p = plan(E.queries()["bench_b3_oi"](spark, SF01))
    assert "TakeOrderedAndProject" in p and "rangepartitioning" not in p


def test_pivot_of_discovered_columns_is_bounded(spark):
    df = spark.createDataFrame([(1, "b", 2.0), (1, "a", 1.0), (2, "b", None), (2, None, 9.0)], "k int, c string, v double")
    wide = pivot_discovered(df, ["k"], "c", "v")
    assert wide.columns == ["k", "a", "b"] and sorted(map(tuple, wide.collect())) == [(1, 1.0, 2.0), (2, None, None)]
    with pytest.raises(ValueError):
        pivot_discovered(df, ["k"], "c", "v", max_columns=1)


def test_money_is_exact_beyond_the_cents_of_a_double(spark):
    big = Decimal("90071992547409.93")  # 2^53 + 1 cents: no DOUBLE
    df = spark.createDataFrame([(1, big), (1, Decimal("90071992547409.92")), (2, Decimal("0.01"))], "k int, v decimal(16,2)")
    sums = df.groupBy("k").agg(M.round_money(F.sum("v")).alias("total"))
    assert {r.k: r.total for r in sums.collect()} == {1: Decimal("180143985094819.85"), 2: Decimal("0.01")}
    assert report(sums.where("k = 2")).first().total == 0.01
    with pytest.raises(PySparkException):
        report(sums).collect()
    m = open_model(spark, SF01)
    for fn in (A.runner_q3_cross_exchange, A.runner_q7_active_expiries, A.full_q7_active_expiries):
        assert fn(m).schema["total_value_lakh"].dataType.simpleString() == "decimal(38,2)"


def test_statistics_change_the_order_of_joins(spark):
    database = "derivspark_cbo"
    register_tables(spark, open_model(spark, SF01), database)
    sql = (f"SELECT x.expiry_id, t.contracts FROM {database}.trades t JOIN {database}.expiries x ON t.expiry_id = x.expiry_id "
           f"JOIN {database}.instruments i ON t.instrument_id = i.instrument_id WHERE i.symbol = 'Brand#2'")

    def first_join():
        text = spark.sql(sql)._jdf.queryExecution().optimizedPlan().toString()
        joins = [line for line in text.splitlines() if "Join Inner" in line]
        return joins[-1].split("Inner, ")[1]

    with cost_based(spark):
        before = first_join()
        analyze(spark, database)
        after = first_join()
    assert "expiry_id" in before and "instrument_id" in after  # the filtered dimension goes first


def test_tables_with_defaults_and_their_drop_order(spark, tmp_path):
    database = "derivspark_ddl"
    create_tables(spark, database, str(tmp_path / "db"))
    spark.sql(f"INSERT INTO {database}.exchanges (exchange_id, exchange_code, exchange_name) VALUES (1, 'NSE', 'n')")
    row = spark.table(f"{database}.exchanges").first()
    assert (row.country, row.is_active) == ("India", True) and row.created_at is not None
    spark.sql(f"INSERT INTO {database}.trades (trade_id, trade_month) VALUES (7, 201908)")
    row = spark.table(f"{database}.trades").first()
    assert (row.open, row.contracts, row.value_in_lakh, row.change_in_oi) == (0, 0, 0, 0) and row.created_at is not None
    assert drop_tables(spark, database) == ["trades", "expiries", "instruments", "exchanges"] == list(reversed(TABLE_DDL))
    assert drop_tables(spark, database) == []


def test_archives_are_zstd(spark, tmp_path):
    import pyarrow.parquet as pq

    from derivspark.plans import storage as S
    S.archive_before(open_model(spark, SF001), "2019-09-01", str(tmp_path / "archive"))
    files = list((tmp_path / "archive").rglob("*.parquet"))
    assert files and {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}
