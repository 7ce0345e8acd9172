"""The store through the catalog: plain SQL over views and external tables,
and ANALYZE statistics."""

import __spark_entry__ as E
from derivspark.sources.catalog import analyze, register_tables, register_views
from derivspark.sources.store import open_model
from tests.conftest import SF01

# Plain SQL in the original's style (one-level OI report), tie-broken.
OI_SQL = """
SELECT i.symbol, e.exchange_code,
       CAST(SUM(t.change_in_oi) AS BIGINT) AS net_oi_change,
       CAST(ROUND(CAST(CAST(SUM(t.open_interest) AS DOUBLE) / COUNT(t.open_interest) AS DECIMAL(38,10)), 0)
            AS DOUBLE) AS avg_open_interest,
       CAST(SUM(t.contracts) AS BIGINT) AS cumulative_volume,
       COUNT(DISTINCT t.trade_date) AS trading_days
FROM {db}trades t
JOIN {db}instruments i ON t.instrument_id = i.instrument_id
JOIN {db}exchanges e ON i.exchange_id = e.exchange_id
WHERE t.trade_date >= DATE '2019-08-01'
GROUP BY i.symbol, e.exchange_code
ORDER BY ABS(net_oi_change) DESC, i.symbol, e.exchange_code
LIMIT 10
"""


def test_sql_over_temp_views_matches_the_report(spark):
    register_views(open_model(spark, SF01))
    got = [tuple(r) for r in spark.sql(OI_SQL.format(db="")).collect()]
    want = [tuple(r) for r in E.queries()["runner_q1_oi_change"](spark, SF01).collect()]
    assert got == want


def test_external_tables_with_statistics(spark):
    m = open_model(spark, SF01)
    register_tables(spark, m, "derivspark_test")
    analyze(spark, "derivspark_test")
    assert spark.sql("SELECT COUNT(*) FROM derivspark_test.trades").first()[0] == m.rows["trades"]
    parts = spark.sql("SHOW PARTITIONS derivspark_test.trades").count()
    assert parts == 4
    stats = {r[0]: r[1] for r in spark.sql("DESCRIBE TABLE EXTENDED derivspark_test.trades trade_date").collect()}
    assert stats.get("min") == "2019-08-01" and stats.get("max") == "2019-11-15"
    got = [tuple(r) for r in spark.sql(OI_SQL.format(db="derivspark_test.")).collect()]
    want = [tuple(r) for r in E.queries()["runner_q1_oi_change"](spark, SF01).collect()]
    assert got == want
