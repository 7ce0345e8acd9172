"""Query registry: key -> callable(spark, sf_dir) -> DataFrame.

Every callable reads the driver tables under ``sf_dir`` (through the
curated store derived from them) and runs over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from derivspark.plans import analytics as A
from derivspark.session import apply_session_conf
from derivspark.sources.store import open_model

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


# Decimal digits that a DOUBLE always holds.
DOUBLE_DIGITS = 15


def _reported_type(f: T.StructField, as_double: frozenset = frozenset()):
    if isinstance(f.dataType, T.DecimalType) or f.name in as_double:
        return "double"
    if isinstance(f.dataType, T.DateType):
        return "timestamp_ntz"
    return None


def report(df: DataFrame, as_double: frozenset = frozenset(), nearest: bool = False) -> DataFrame:
    """Output boundary. Exact DECIMAL results are reported as DOUBLE: with ``nearest`` (the
    registered queries) the DOUBLE nearest to the exact value, at any size; otherwise, where the
    type allows values beyond 2^53 units of its last place, a value that large stops the query
    instead of losing cents (the reports themselves, and the command line, give DECIMAL).
    DATE results are reported as zone-less TIMESTAMP at midnight — the types a
    pandas consumer receives for them from a columnar SQL engine — so every
    consumer sees the same values whichever way it fetches them. Columns in
    ``as_double`` (integer measures NULL by design) are reported as DOUBLE
    for the same reason: fetched into pandas, a nullable integer column
    becomes a float column on one engine and a nullable-integer column on
    another."""
    exprs, changed = [], False
    for f in df.schema.fields:
        t = _reported_type(f, as_double)
        changed |= t is not None
        value = f"CAST(`{f.name}` AS {t})"
        if t == "double" and not nearest and isinstance(f.dataType, T.DecimalType) and f.dataType.precision > DOUBLE_DIGITS:
            most = (1 << 53) // 10 ** f.dataType.scale
            value = (f"CASE WHEN abs(`{f.name}`) > {most} THEN raise_error('{f.name} has no exact DOUBLE') "
                     f"ELSE {value} END")
        exprs.append(f"{value} AS `{f.name}`" if t else f"`{f.name}`")
    return df.selectExpr(*exprs) if changed else df


NULLABLE_INTEGER_OUTPUTS = {
    "filter_not_null_or": ["ce_volume", "pe_volume"],
    "full_q3_cross_exchange": ["nse_volume", "bse_volume", "mcx_volume"],
    "full_q4_option_chain": ["call_volume", "call_oi", "put_volume", "put_oi"],
    "pivot_null": ["ce_max_oi_change", "pe_max_oi_change"],
    "daily_rollup": ["min_pos_contracts", "pos_volume", "pos_oi", "sum_contracts_hl"],
    "corrected_rollup": ["min_pos_contracts", "pos_volume", "pos_oi", "sum_contracts_hl"],
}


def _reported(key: str, fn: QueryFn) -> QueryFn:
    nullable = frozenset(NULLABLE_INTEGER_OUTPUTS.get(key, []))

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_session_conf(spark)
        return report(fn(spark, sf_dir), nullable, nearest=True)
    run.__name__ = key
    return run


def model_query(key: str, fn, **params) -> None:
    """Register ``fn(model, **params)`` over the curated store of ``sf_dir``."""
    REGISTRY[key] = _reported(key, lambda spark, sf_dir: fn(open_model(spark, sf_dir), **params))


# Fixture symbols standing in for the index names (FIXTURES.md §3).
from derivspark.sources.fixtures import BANKNIFTY as FX_BANKNIFTY, NIFTY as FX_NIFTY  # noqa: E402

model_query("runner_q1_oi_change", A.runner_q1_oi_change)
model_query("full_q1_oi_change", A.full_q1_oi_change)
model_query("runner_q2_volatility", A.runner_q2_volatility)
model_query("full_q2_volatility", A.full_q2_volatility, symbol=FX_NIFTY)
model_query("runner_q3_cross_exchange", A.runner_q3_cross_exchange)
model_query("full_q3_cross_exchange", A.full_q3_cross_exchange)
model_query("runner_q4_option_chain", A.runner_q4_option_chain, symbol=FX_NIFTY)
model_query("full_q4_option_chain", A.full_q4_option_chain, symbols=[FX_NIFTY, FX_BANKNIFTY])
model_query("runner_q5_max_volume", A.runner_q5_max_volume)
model_query("full_q5_max_volume", A.full_q5_max_volume)
model_query("runner_q6_price_movement", A.runner_q6_price_movement)
model_query("full_q6_price_movement", A.full_q6_price_movement)
model_query("runner_q7_active_expiries", A.runner_q7_active_expiries)
model_query("full_q7_active_expiries", A.full_q7_active_expiries)
model_query("bench_b1_volume", A.bench_b1_volume)
model_query("bench_b1_volume_nonzero", A.bench_b1_volume, nonzero=True)
model_query("bench_b2_rolling", A.bench_b2_rolling)
# Bounds within a day: the timestamp filter runs over the fact.
model_query("rolling_timestamp_range", A.bench_b2_rolling, start="2019-08-05 09:15:00", end="2019-09-20 15:30:00")
# The original HAVING literal (10,000) is a parameter; 100 suits the fixture's scale.
model_query("bench_b3_oi", A.bench_b3_oi, min_net_change=100)
model_query("bench_verify_global", A.bench_verify_global)
model_query("db_statistics", A.db_statistics)
model_query("chart_oi_trends", A.chart_oi_trends, symbols=[FX_NIFTY, FX_BANKNIFTY])
model_query("chart_volume_histogram", A.chart_volume_histogram)
model_query("chart_volatility_heatmap", A.chart_volatility_heatmap, symbol=FX_NIFTY)
model_query("chart_heatmap_matrix", A.chart_heatmap_matrix, symbol=FX_NIFTY)
model_query("chart_option_chain", A.chart_option_chain, symbol=FX_NIFTY)

from derivspark.plans import relational as REL  # noqa: E402

model_query("project_alias", REL.project_alias)
model_query("filter_in_list", REL.filter_in_list, symbols=[FX_NIFTY, FX_BANKNIFTY])
model_query("filter_date_range", REL.filter_date_range)
model_query("filter_last_n_days", REL.filter_last_n_days)
model_query("filter_positive_volume", REL.filter_positive_volume)
model_query("filter_expression", REL.filter_expression)
model_query("filter_not_null_or", REL.filter_not_null_or)
model_query("join_symbol", REL.join_symbol)
model_query("join_snowflake", REL.join_snowflake)
model_query("join_contract", REL.join_contract)
model_query("agg_basic", REL.agg_basic)
model_query("agg_count_distinct", REL.agg_count_distinct)
model_query("pivot_null", REL.pivot_null)
model_query("pivot_zero", REL.pivot_zero)
model_query("distinct_rows", REL.distinct_rows)
model_query("topk_per_group", REL.topk_per_group)
model_query("topk_volume", REL.topk_volume)
model_query("scalar_math", REL.scalar_math)
model_query("scalar_null", REL.scalar_null)
model_query("scalar_cast", REL.scalar_cast)
model_query("scalar_date", REL.scalar_date)

from derivspark.plans import model_jobs as MJ  # noqa: E402

for _key in ["build_instruments", "build_expiries", "build_trades", "surrogate_keys",
             "dq_check_violations", "dq_duplicate_keys", "dq_orphans", "dq_declared_keys", "dq_model_rules"]:
    REGISTRY[_key] = _reported(_key, getattr(MJ, _key))

for _key in ["exchange_dim", "insert_if_new", "monthly_partition_rollup", "archive_slice", "retention_keep",
             "daily_rollup", "ingest_raw_csv", "ingest_typed", "stream_ingest", "upsert_latest",
             "stream_daily_bars", "split_by_year", "csv_result_sink", "append_day", "corrected_rollup",
             "load_reconciliation", "stream_to_model", "column_defaults"]:
    REGISTRY[_key] = _reported(_key, getattr(MJ, _key))
