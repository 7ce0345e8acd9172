"""Operator-level queries: one small report per relational operator the
original queries use (projection, filters, joins, aggregates, pivots,
top-k, scalar functions), each over the whole curated model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derivspark.functions import metrics as M
from derivspark.operators.reshape import distinct_counts, side_by_side, top_k, top_k_per_group
from derivspark.plans.analytics import BANKNIFTY, NIFTY, OPTIONS, ORIGINAL_START
from derivspark.sources.store import Model


def _counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), M.sum_long("contracts").alias("volume"))


def project_alias(m: Model) -> DataFrame:
    """Projection with renames (column pruning reaches the scan)."""
    return m.trades.select("expiry_id", "instrument_id", F.col("trade_date").alias("day"),
                           F.col("close").alias("close_price"), F.col("contracts").alias("volume"),
                           F.col("open_interest").alias("oi"))


def filter_in_list(m: Model, symbols=None, option_types=None) -> DataFrame:
    """C4: equality / IN-list predicates on both dimensions."""
    symbols = symbols or [NIFTY, BANKNIFTY]
    option_types = option_types or OPTIONS
    inst = m.instruments.where(F.col("symbol").isin(symbols)).select("instrument_id", "symbol")
    j = m.trades_of(F.col("symbol").isin(symbols)).where(F.col("option_type").isin(option_types)) \
        .select("instrument_id", "option_type", "contracts").join(m.dim_filtered(inst, "instruments"), "instrument_id")
    return _counts(j, "symbol", "option_type")


def filter_date_range(m: Model, start: str = ORIGINAL_START, end: str = "2019-10-31") -> DataFrame:
    """Closed date range; the month partitions outside it are pruned."""
    return _counts(m.trades_between(start, end), "trade_date")


def filter_last_n_days(m: Model, days: int = 30, as_of=None) -> DataFrame:
    """trade_date >= as_of - N days (as_of defaults to the last
    trade date, standing in for CURRENT_DATE)."""
    return _counts(m.last_days(days, as_of), "trade_date")


def filter_positive_volume(m: Model, min_oi: int = 1000) -> DataFrame:
    """Comparisons with constants."""
    t = m.trades.where((F.col("contracts") > 0) & (F.col("open_interest") > min_oi))
    return _counts(m.with_instrument(t.select("instrument_id", "contracts"), "symbol"), "symbol")


def filter_expression(m: Model) -> DataFrame:
    """Filter on an arithmetic expression."""
    t = m.trades.where((F.col("high") - F.col("low")) > 0).select("instrument_id", "high", "low")
    return m.with_instrument(t, "symbol").groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n_rows"),
        M.round_half_up(M.exact_avg(F.col("high") - F.col("low")), 2).alias("avg_range"))


def filter_not_null_or(m: Model) -> DataFrame:
    """C11: IS NOT NULL / OR over conditional sums that are NULL when a
    side has no rows (futures-only days drop out)."""
    t = m.trades.select("instrument_id", "trade_date", "option_type", "contracts")
    g = m.with_instrument(t, "symbol").groupBy("symbol", "trade_date").agg(
        F.sum(F.when(F.col("option_type") == "CE", F.col("contracts"))).cast("bigint").alias("ce_volume"),
        F.sum(F.when(F.col("option_type") == "PE", F.col("contracts"))).cast("bigint").alias("pe_volume"))
    return g.where(F.col("ce_volume").isNotNull() | F.col("pe_volume").isNotNull())


def join_symbol(m: Model) -> DataFrame:
    """Fact -> instrument equi-join (broadcast)."""
    return _counts(m.with_instrument(m.trades.select("instrument_id", "contracts"), "symbol"), "symbol")


def join_snowflake(m: Model) -> DataFrame:
    """Fact -> instrument -> exchange chain."""
    j = m.with_exchange(m.trades.select("instrument_id", "contracts"), "symbol", "series")
    return j.groupBy("exchange_code", "series").agg(
        F.count(F.lit(1)).alias("n_rows"), M.sum_long("contracts").alias("volume"),
        F.countDistinct("symbol").alias("n_symbols"))


def join_contract(m: Model) -> DataFrame:
    """D3: two dimensions joined to one fact."""
    t = m.with_contract(m.trades.select("instrument_id", "expiry_id", "contracts"), "option_type")
    j = m.with_instrument(t, "symbol")
    return j.groupBy("symbol", "option_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("expiry_id").alias("n_contracts"),
        M.sum_long("contracts").alias("volume"))


def agg_basic(m: Model) -> DataFrame:
    """SUM / AVG / MIN / MAX / COUNT(*) per group."""
    t = m.with_instrument(m.trades.select("instrument_id", "contracts", "value_in_lakh", "close", "low", "high"),
                          "symbol")
    return t.groupBy("symbol").agg(
        M.sum_long("contracts").alias("total_volume"),
        F.sum("value_in_lakh").cast("decimal(38,2)").alias("total_value"),
        M.exact_avg("close").alias("avg_close"),
        F.min("low").alias("min_low"), F.max("high").alias("max_high"),
        F.count(F.lit(1)).alias("n_rows"))


def agg_count_distinct(m: Model) -> DataFrame:
    """E5: exact COUNT(DISTINCT) (several per group)."""
    # Symbols and days are in the roll-up; contracts are brought to distinct ones before the join.
    days = m.with_exchange(m.daily.select("instrument_id", "trade_date"), "symbol")
    held = m.with_exchange(m.trades.select("instrument_id", "expiry_id").distinct())
    counts = distinct_counts(days, ["exchange_code"], {"n_symbols": "symbol", "n_days": "trade_date"})
    return counts.join(distinct_counts(held, ["exchange_code"], {"n_contracts": "expiry_id"}), "exchange_code")


def _option_days(m: Model) -> DataFrame:
    t = m.trades.where(F.col("option_type").isin(OPTIONS)) \
        .select("instrument_id", "trade_date", "option_type", "change_in_oi")
    return m.with_instrument(t, "symbol")


def pivot_null(m: Model) -> DataFrame:
    """MAX(CASE WHEN k THEN v END): a missing side is NULL."""
    return side_by_side(_option_days(m), ["symbol", "trade_date"], "option_type",
                        {"CE": "ce_", "PE": "pe_"}, {"change_in_oi": "max_oi_change"})


def pivot_zero(m: Model) -> DataFrame:
    """MAX(CASE WHEN k THEN v ELSE 0 END): a missing side is 0 (and a
    negative maximum is hidden by the 0, as in the original)."""
    return side_by_side(_option_days(m), ["symbol", "trade_date"], "option_type",
                        {"CE": "ce_", "PE": "pe_"}, {"change_in_oi": "max_oi_change"}, fill=0)


def distinct_rows(m: Model) -> DataFrame:
    """DISTINCT over joined attributes."""
    t = m.trades.select("instrument_id", "expiry_date", "option_type")
    return m.with_instrument(t, "instrument_type", "symbol") \
        .select("instrument_type", "symbol", "expiry_date", "option_type").distinct()


def _daily_volume(m: Model) -> DataFrame:
    t = m.with_instrument(m.trades.select("instrument_id", "trade_date", "contracts"), "symbol")
    return t.groupBy("symbol", "trade_date").agg(M.sum_long("contracts").alias("daily_volume"))


def topk_per_group(m: Model, k: int = 3) -> DataFrame:
    """ROW_NUMBER per group over an aggregate, keep the top k."""
    return top_k_per_group(_daily_volume(m), ["symbol"], [F.col("daily_volume").desc(), "trade_date"], k,
                           rank_col="volume_rank")


def topk_volume(m: Model, k: int = 10) -> DataFrame:
    """G1: ORDER BY aggregate DESC LIMIT k."""
    return top_k(_daily_volume(m), [F.col("daily_volume").desc(), "symbol", "trade_date"], k)


def scalar_math(m: Model) -> DataFrame:
    """ROUND to 2 and 0 places, ABS."""
    t = m.with_instrument(m.trades.select("instrument_id", "close", "change_in_oi"), "symbol")
    g = t.groupBy("symbol").agg(M.exact_avg("close").alias("a"), F.sum("change_in_oi").alias("net"))
    return g.select("symbol", M.round_half_up("a", 2).alias("avg_close_2"),
                    M.round_half_up("a", 0).alias("avg_close_0"),
                    F.abs("net").cast("bigint").alias("abs_net_oi_change"))


def scalar_null(m: Model) -> DataFrame:
    """NULLIF-guarded division and COALESCE of the NULL it yields."""
    g = m.trades.groupBy("expiry_id", "trade_date").agg(
        M.sum_long("contracts").alias("volume"), F.sum("value_in_lakh").alias("value"))
    ppc = M.value_per_contract("value", "volume")
    return g.select("expiry_id", "trade_date", "volume", ppc.alias("price_per_contract"),
                    F.coalesce(ppc, F.lit(0.0)).alias("price_or_zero"))


def scalar_cast(m: Model) -> DataFrame:
    """Casts to text, integer, double and date."""
    g = m.trades.groupBy("instrument_id").agg(
        F.min("trade_date").alias("d0"), F.max("strike_price").alias("k"), F.sum("contracts").alias("v"),
        F.count(F.lit(1)).alias("n"), F.max("timestamp").alias("ts"))
    return g.select("instrument_id", F.col("d0").cast("string").alias("first_day"),
                    F.col("k").cast("bigint").alias("max_strike"), F.col("v").cast("double").alias("volume_double"),
                    F.col("n").cast("int").alias("n_rows_int"), F.col("ts").cast("date").alias("last_day"))


def scalar_date(m: Model) -> DataFrame:
    """DATE_TRUNC('month') and 'YYYY-MM' formatting."""
    month = F.date_trunc("month", "trade_date").cast("date")
    g = m.trades.groupBy(month.alias("month_start")).agg(
        F.count(F.lit(1)).alias("n_rows"), M.sum_long("contracts").alias("volume"))
    return g.select("month_start", F.date_format("month_start", "yyyy-MM").alias("month_label"), "n_rows", "volume")
