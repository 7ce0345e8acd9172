"""The named analytics: each is ``f(model, **params) -> DataFrame``.

Two variants of each of the seven reports exist and differ in meaning:
``full_*`` (CTE form, two-level aggregates, pivots, ranks) and ``runner_*``
(the shorter form run by the batch runner). Literal symbols, dates and
thresholds are parameters; defaults are the original literals. Every LIMIT
has extra sort keys that make the cut reproducible.

Plans: reports whose aggregates are sums, counts, min/max and averages
per symbol and day — also under the positive-volume and price-range row
filters — read the stored daily roll-up (``Model.daily_between``); reports
that need contract detail (option type, strike, expiry) or other row
filters read the fact with partition + Parquet predicates
(``Model.trades_between`` / ``trades_of``), projected to the used columns;
dimensions
are joined as checked broadcasts; aggregates run partial (map side) then
final; ranking and rolling windows run over already aggregated rows
(one row per symbol/contract and day), never over raw trades.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derivspark.functions import metrics as M
from derivspark.operators.reshape import (distinct_counts, equal_width_histogram, hash_sample, pivot_discovered, rolling_stats,
                                          side_by_side, top_k, top_k_per_group)
from derivspark.plans.rollup import avg_of
from derivspark.sources.store import Model, as_date, id_in

# Original literals (defaults of the parameters) ---------------------------------
ORIGINAL_START = "2019-08-01"
NIFTY, BANKNIFTY = "NIFTY", "BANKNIFTY"
OPTIONS = ["CE", "PE"]
FUTURES_TYPES = ["FUTIDX", "FUTSTK"]
INDEX_OPTIONS = "OPTIDX"
# Sample stddevs the original leaves unrounded are reported at this many
# decimals: parallel floating-point sums depend on the partial-aggregation
# order, so the last bits are not reproducible across runs or engines.
STAT_PLACES = 6
# Results of at most so many rows are sorted by one merge of the tasks' sorted rows.
MAX_SORTED_ROWS = 100_000
# ---------------------------------------------------------------------------------

r2 = M.round_half_up


def _midnight(ts: str) -> bool:
    return len(ts) == 10 or ts[10:].strip(" T").replace(":", "").replace(".", "").strip("0") == ""


def r0(c):
    return M.round_half_up(c, 0)


# ---------------------------------------------------------------------- Q1 ----

def runner_q1_oi_change(m: Model, since: str = ORIGINAL_START, k: int = 10) -> DataFrame:
    """Top symbols by |net OI change| since a date (row-level average OI),
    from the daily roll-up."""
    d = m.daily_between(since).select("instrument_id", "trade_date", "net_oi_change", "total_oi",
                                      "n_trades", "volume")
    g = m.with_exchange(d, "symbol").groupBy("symbol", "exchange_code").agg(
        M.sum_long("net_oi_change").alias("net_oi_change"),
        r0(avg_of("total_oi")).alias("avg_open_interest"),
        M.sum_long("volume").alias("cumulative_volume"),
        F.countDistinct("trade_date").alias("trading_days"))
    return top_k(g, [F.abs("net_oi_change").desc(), "symbol", "exchange_code"], k)


def full_q1_oi_change(m: Model, days: int = 30, as_of=None, k: int = 10) -> DataFrame:
    """Last-N-day OI momentum: daily sums per (symbol, exchange, type, date),
    then per (symbol, exchange); the average OI is over daily totals."""
    as_of = as_date(as_of) or m.last_trade_date()
    d = m.daily_between(as_of - timedelta(days=days)).select("instrument_id", "trade_date", "net_oi_change",
                                                               "total_oi", "volume")
    daily = m.with_exchange(d, "symbol", "instrument_type") \
        .groupBy("symbol", "exchange_code", "instrument_type", "trade_date").agg(
            F.sum("net_oi_change").alias("daily_oi_change"),
            F.sum("total_oi").alias("total_oi"),
            F.sum("volume").alias("total_volume"))
    sym = daily.groupBy("symbol", "exchange_code").agg(
        M.sum_long("daily_oi_change").alias("net_oi_change"),
        M.exact_avg("total_oi").alias("avg_oi"),
        M.sum_long("total_volume").alias("cumulative_volume"),
        F.countDistinct("trade_date").alias("trading_days"))
    out = sym.select(
        "symbol", "exchange_code", "net_oi_change",
        r0("avg_oi").alias("avg_open_interest"),
        "cumulative_volume", "trading_days",
        M.avg_daily_oi_change("net_oi_change", "trading_days").alias("avg_daily_oi_change"),
        M.oi_change_pct("net_oi_change", "avg_oi").alias("oi_change_pct"))
    return top_k(out, [F.abs("net_oi_change").desc(), "symbol", "exchange_code"], k)


# ---------------------------------------------------------------------- Q2 ----

def runner_q2_volatility(m: Model, since: str = ORIGINAL_START, window_rows: int = 7,
                         k: int = 10) -> DataFrame:
    """Per-symbol daily average close, rolling stddev, summarised per symbol."""
    d = m.daily_between(since).select("instrument_id", "trade_date", "sum_close", "n_trades")
    daily = m.with_instrument(d, "symbol").groupBy("symbol", "trade_date") \
        .agg(avg_of("sum_close").alias("avg_close"))
    rolled = rolling_stats(daily, ["symbol"], "trade_date", "avg_close", window_rows,
                           stddev="rolling_stddev")
    out = rolled.where(F.col("rolling_stddev").isNotNull()).groupBy("symbol").agg(
        F.max("trade_date").alias("latest_date"),
        r2(F.avg("avg_close")).alias("avg_price"),
        r2(F.avg("rolling_stddev")).alias("avg_volatility"),
        r2(F.min("rolling_stddev")).alias("min_volatility"),
        r2(F.max("rolling_stddev")).alias("max_volatility"))
    return top_k(out, [F.col("avg_volatility").desc_nulls_last(), "symbol"], k)


def full_q2_volatility(m: Model, symbol: str = NIFTY, instrument_type: str = INDEX_OPTIONS,
                       start: str = ORIGINAL_START, end: str = "2019-10-31", window_rows: int = 7,
                       min_volume: int = 100, k: int = 50) -> DataFrame:
    """One symbol's options: daily average close per contract, rolling
    stddev/avg/count over the same frame; complete windows with volume."""
    cond = (F.col("symbol") == symbol) & (F.col("instrument_type") == instrument_type)
    contract = ["expiry_date", "strike_price", "option_type"]
    t = m.trades_of(cond, start, end).where(F.col("option_type").isin(OPTIONS)) \
        .select("trade_date", *contract, "close", "contracts")
    daily = t.groupBy("trade_date", *contract).agg(
        M.exact_avg("close").alias("avg_close"), M.sum_long("contracts").alias("volume"))
    rolled = rolling_stats(daily, contract, "trade_date", "avg_close", window_rows,
                           stddev="sd7", mean="ma7", count="window_days")
    out = rolled.where((F.col("window_days") == window_rows) & (F.col("volume") > min_volume)).select(
        "trade_date", *contract,
        r2("avg_close").alias("close_price"), "volume",
        r2("ma7").alias("ma_7day"), r2("sd7").alias("volatility_7day"),
        M.coefficient_of_variation("sd7", "ma7").alias("coefficient_of_variation"),
        F.col("window_days").cast("bigint").alias("window_days"))
    return top_k(out, [F.col("trade_date").desc(), "strike_price", "option_type", "expiry_date"], k)


# ---------------------------------------------------------------------- Q3 ----

def runner_q3_cross_exchange(m: Model) -> DataFrame:
    """Totals per (exchange, instrument type); ``avg_settlement_price`` is
    the average close, as in the original."""
    d = m.daily.select("instrument_id", "volume", "value", "sum_close", "n_trades")
    g = m.with_exchange(d, "symbol", "instrument_type").groupBy("exchange_code", "instrument_type").agg(
        F.countDistinct("symbol").alias("unique_symbols"),
        M.sum_long("volume").alias("total_volume"),
        M.round_money(F.sum("value")).alias("total_value_lakh"),
        r2(avg_of("sum_close")).alias("avg_settlement_price"))
    return g.orderBy(F.col("total_volume").desc(), "exchange_code", "instrument_type")


EXCHANGE_SIDES = {"NSE": "nse", "BSE": "bse", "MCX": "mcx"}


def full_q3_cross_exchange(m: Model, since: str = ORIGINAL_START, types=None, k: int = 30) -> DataFrame:
    """Futures settle price per exchange side by side, spread vs. BSE
    (a missing BSE side gives spread 0); from the daily roll-up."""
    types = types or FUTURES_TYPES
    cond = F.col("instrument_type").isin(types)
    ids = m.instrument_keys(cond)
    d = m.daily_between(since)
    if ids is not None:
        d = d.where(id_in("instrument_id", ids))
    inst = m.instrument_view().where(cond).select("instrument_id", "exchange_code", "symbol", "instrument_type")
    per_ex = d.select("instrument_id", "trade_date", "sum_settle", "n_trades", "volume") \
        .join(m.dim_filtered(inst, "instruments"), "instrument_id") \
        .groupBy("exchange_code", "symbol", "instrument_type", "trade_date").agg(
            avg_of("sum_settle").alias("avg_settle"),
            M.sum_long("volume").alias("total_contracts"))
    wide = side_by_side(per_ex, ["symbol", "trade_date"], "exchange_code", EXCHANGE_SIDES,
                        {"avg_settle": "_settle", "total_contracts": "_volume"})
    out = wide.where(F.col("nse_settle").isNotNull()).select(
        "symbol", "trade_date",
        r2("nse_settle").alias("nse_settle_price"), r2("bse_settle").alias("bse_settle_price"),
        r2("mcx_settle").alias("mcx_settle_price"),
        "nse_volume", "bse_volume", "mcx_volume",
        r2(M.spread("nse_settle", "bse_settle")).alias("nse_bse_spread"),
        r2(M.spread_pct("nse_settle", "bse_settle")).alias("spread_pct"))
    return top_k(out, [F.col("trade_date").desc(), "symbol"], k)


# ---------------------------------------------------------------------- Q4 ----

def runner_q4_option_chain(m: Model, symbol: str = NIFTY, expiry_from: str = "2019-09-26",
                           k: int = 15) -> DataFrame:
    """All-days chain for the nearest expiry on/after a date (nearest over
    all instruments, an uncorrelated scalar subquery); missing side -> 0."""
    nearest = m.expiries.where(F.col("expiry_date") >= F.lit(expiry_from).cast("date")) \
        .agg(F.min("expiry_date")).scalar()
    t = m.trades_of(F.col("symbol") == symbol) \
        .where(F.col("option_type").isin(OPTIONS) & (F.col("expiry_date") == nearest)) \
        .select("expiry_date", "strike_price", "option_type", "contracts", "open_interest", "close")
    summary = t.groupBy("expiry_date", "strike_price", "option_type").agg(
        M.sum_long("contracts").alias("total_volume"),
        M.sum_long("open_interest").alias("total_oi"),
        r2(M.exact_avg("close")).alias("avg_premium"))
    chain = side_by_side(summary, ["expiry_date", "strike_price"], "option_type",
                         {"CE": "CE_", "PE": "PE_"},
                         {"total_volume": "volume", "total_oi": "oi", "avg_premium": "premium"}, fill=0)
    chain = chain.select("expiry_date", "strike_price", "CE_volume", "PE_volume", "CE_oi", "PE_oi",
                         "CE_premium", "PE_premium")
    return top_k(chain, ["strike_price", "expiry_date"], k)


def full_q4_option_chain(m: Model, symbols=None, instrument_type: str = INDEX_OPTIONS,
                         day: str = ORIGINAL_START, k: int = 50) -> DataFrame:
    """One-day chain: calls and puts side by side with put-call ratios.
    ``implied_vol`` is contracts x close (a liquidity proxy)."""
    symbols = symbols or [NIFTY, BANKNIFTY]
    cond = F.col("symbol").isin(symbols) & (F.col("instrument_type") == instrument_type)
    t = m.trades_of(cond, day, day).select("instrument_id", "expiry_date", "strike_price", "option_type",
                                           "contracts", "close", "open_interest")
    inst = m.instruments.where(cond).select("instrument_id", "symbol")
    j = t.join(m.dim_filtered(inst, "instruments"), "instrument_id")
    summary = j.groupBy("symbol", "expiry_date", "strike_price", "option_type").agg(
        M.sum_long("contracts").alias("total_volume"),
        M.exact_avg("close").alias("avg_close"),
        M.sum_long("open_interest").alias("total_oi"),
        F.sum(F.col("contracts") * F.col("close")).alias("implied_volume"))
    chain = side_by_side(summary, ["symbol", "expiry_date", "strike_price"], "option_type",
                         {"CE": "ce_", "PE": "pe_"},
                         {"avg_close": "close", "total_volume": "volume", "total_oi": "oi",
                          "implied_volume": "implied_vol"})
    out = chain.where(F.col("ce_close").isNotNull() | F.col("pe_close").isNotNull()).select(
        "symbol", "expiry_date", "strike_price",
        r2("ce_close").alias("call_price"), F.col("ce_volume").alias("call_volume"),
        F.col("ce_oi").alias("call_oi"), r0("ce_implied_vol").alias("call_implied_vol"),
        r2("pe_close").alias("put_price"), F.col("pe_volume").alias("put_volume"),
        F.col("pe_oi").alias("put_oi"), r0("pe_implied_vol").alias("put_implied_vol"),
        M.put_call_ratio("pe_volume", "ce_volume").alias("pcr_volume"),
        M.put_call_ratio("pe_oi", "ce_oi").alias("pcr_oi"))
    return top_k(out, ["symbol", "expiry_date", "strike_price"], k)


# ---------------------------------------------------------------------- Q5 ----

def runner_q5_max_volume(m: Model, k: int = 10) -> DataFrame:
    """Single best (positive-volume) day per symbol, top k of those; from the
    roll-up's positive-volume sums (days without such rows drop out)."""
    d = m.daily.where(F.col("pos_n") > 0).select("instrument_id", "trade_date", "pos_volume")
    daily = m.with_instrument(d, "symbol").groupBy("symbol", "trade_date") \
        .agg(M.sum_long("pos_volume").alias("daily_volume"))
    best = top_k_per_group(daily, ["symbol"], [F.col("daily_volume").desc(), F.col("trade_date")], 1)
    return top_k(best.select("symbol", "trade_date", "daily_volume"),
                 [F.col("daily_volume").desc(), "symbol"], k)


def full_q5_max_volume(m: Model, days: int = 30, as_of=None, per_group: int = 5, k: int = 50) -> DataFrame:
    """Top volume days per (symbol, type) in the last N days; the rank
    partition ignores the exchange, as in the original."""
    as_of = as_date(as_of) or m.last_trade_date()
    d = m.daily_between(as_of - timedelta(days=days)).where(F.col("pos_n") > 0) \
        .select("instrument_id", "trade_date", "pos_volume", "pos_value", "pos_oi", "pos_n")
    daily = m.with_exchange(d, "symbol", "instrument_type") \
        .groupBy("symbol", "instrument_type", "exchange_code", "trade_date").agg(
            M.sum_long("pos_volume").alias("daily_volume"),
            F.sum("pos_value").alias("daily_value"),
            avg_of("pos_oi", "pos_n").alias("avg_oi"))
    ranked = top_k_per_group(daily, ["symbol", "instrument_type"],
                             [F.col("daily_volume").desc(), "exchange_code", "trade_date"], per_group)
    out = ranked.select(
        "symbol", "instrument_type", "exchange_code", "trade_date", "daily_volume",
        M.round_money("daily_value").alias("daily_value_lakh"), r0("avg_oi").alias("avg_open_interest"),
        M.value_per_contract("daily_value", "daily_volume").alias("avg_price_per_contract"))
    return top_k(out, [F.col("daily_volume").desc(), "symbol", "instrument_type", "exchange_code",
                       "trade_date"], k)


# ---------------------------------------------------------------------- Q6 ----

def runner_q6_price_movement(m: Model, min_pct: float = 5, k: int = 10) -> DataFrame:
    """Daily high-low range as % of close; filter on the rounded value. From
    the roll-up's aggregates over rows with high - low > 0 and close > 0."""
    d = m.daily.where(F.col("n_rc") > 0) \
        .select("instrument_id", "trade_date", "n_rc", "sum_range_rc", "max_range_rc", "sum_pct_rc")
    g = m.with_instrument(d, "symbol").groupBy("symbol", "trade_date").agg(
        r2(avg_of("sum_range_rc", "n_rc")).alias("avg_range"),
        r2(F.sum("sum_pct_rc") / F.sum("n_rc")).alias("avg_range_pct"),
        r2(F.max("max_range_rc")).alias("max_range"),
        M.sum_long("n_rc").alias("num_contracts"))
    return top_k(g.where(F.col("avg_range_pct") > min_pct),
                 [F.col("avg_range_pct").desc(), "symbol", "trade_date"], k)


def full_q6_price_movement(m: Model, start: str = ORIGINAL_START, end: str = "2019-10-31",
                           min_pct: float = 1, k: int = 30) -> DataFrame:
    """Daily averages per (symbol, type); range as % of low, classified. From
    the roll-up's aggregates over rows with high > 0 and low > 0."""
    d = m.daily_between(start, end).where(F.col("n_hl") > 0) \
        .select("instrument_id", "trade_date", "n_hl", "sum_high_hl", "sum_low_hl", "sum_close_hl",
                "sum_contracts_hl", "sum_pct_hl")
    g = m.with_instrument(d, "symbol", "instrument_type").groupBy("symbol", "instrument_type", "trade_date").agg(
        avg_of("sum_high_hl", "n_hl").alias("avg_high"), avg_of("sum_low_hl", "n_hl").alias("avg_low"),
        avg_of("sum_close_hl", "n_hl").alias("avg_close"),
        ((F.sum("sum_high_hl") - F.sum("sum_low_hl")).cast("double") / F.sum("n_hl")).alias("avg_range"),
        M.sum_long("sum_contracts_hl").alias("total_volume"),
        (F.sum("sum_pct_hl") / F.sum("n_hl")).alias("avg_range_pct"))
    out = g.where(F.col("avg_range_pct") > min_pct).select(
        "symbol", "instrument_type", "trade_date",
        r2("avg_high").alias("avg_high"), r2("avg_low").alias("avg_low"),
        r2("avg_close").alias("avg_close"), r2("avg_range").alias("avg_range"),
        r2("avg_range_pct").alias("range_pct"), "total_volume",
        M.volatility_class("avg_range_pct").alias("volatility_class"), "avg_range_pct")
    return top_k(out, [F.col("avg_range_pct").desc(), "symbol", "instrument_type", "trade_date"], k) \
        .drop("avg_range_pct")


# ---------------------------------------------------------------------- Q7 ----

def runner_q7_active_expiries(m: Model, k: int = 15) -> DataFrame:
    """Options activity per (symbol, expiry date)."""
    t = m.trades.where(F.col("option_type").isin(OPTIONS)) \
        .select("instrument_id", "expiry_date", "strike_price", "contracts", "value_in_lakh", "open_interest")
    j = m.with_instrument(t, "symbol")
    g = j.groupBy("symbol", "expiry_date").agg(
        F.countDistinct("strike_price").alias("num_strikes"),
        M.sum_long("contracts").alias("total_volume"),
        M.round_money(F.sum("value_in_lakh")).alias("total_value_lakh"),
        r0(M.exact_avg("open_interest")).alias("avg_oi"))
    return top_k(g, [F.col("total_volume").desc(), "symbol", "expiry_date"], k)


def full_q7_active_expiries(m: Model, instrument_type: str = INDEX_OPTIONS, k: int = 20) -> DataFrame:
    """Index options activity per (symbol, expiry month)."""
    inst = m.instruments.where(F.col("instrument_type") == instrument_type).select("instrument_id", "symbol")
    t = m.trades_of(F.col("instrument_type") == instrument_type).where(F.col("option_type").isin(OPTIONS)) \
        .select("instrument_id", "expiry_id", "expiry_date", "trade_date", "contracts", "value_in_lakh",
                "open_interest")
    j = t.join(m.dim_filtered(inst, "instruments"), "instrument_id") \
        .withColumn("month", F.date_trunc("month", "expiry_date").cast("date"))
    # Per contract first, so contracts are counted as rows; days are counted from their own scan.
    held = j.groupBy("symbol", "month", "expiry_id").agg(
        F.sum("contracts").alias("contracts"), F.sum("value_in_lakh").alias("value"), F.sum("open_interest").alias("oi"),
        F.count("open_interest").alias("n"))
    sums = held.groupBy("symbol", "month").agg(
        F.count("expiry_id").alias("num_contracts"), M.sum_long("contracts").alias("total_volume"),
        F.sum("value").cast(M.MONEY).alias("total_value"), (F.sum("oi").cast("double") / F.sum("n")).alias("avg_oi"))
    g = sums.join(distinct_counts(j, ["symbol", "month"], {"trading_days": "trade_date"}), ["symbol", "month"])
    out = g.select(
        "symbol", F.date_format("month", "yyyy-MM").alias("expiry_month"), "num_contracts",
        "total_volume", M.round_money("total_value").alias("total_value_lakh"), r0("avg_oi").alias("avg_open_interest"),
        "trading_days", M.avg_daily_volume("total_volume", "trading_days").alias("avg_daily_volume"),
        M.value_per_contract("total_value", "total_volume").alias("avg_premium"))
    return top_k(out, [F.col("total_volume").desc(), "symbol", "expiry_month"], k)


# ------------------------------------------------------------- benchmarks ----

def bench_b1_volume(m: Model, start: str = "2019-09-01", end: str = "2019-09-30", k: int = 10,
                    nonzero: bool = False) -> DataFrame:
    """Top daily volumes in a date range, from the daily roll-up (partitions
    pruned); with ``nonzero`` only positive-volume rows count, and days
    without any drop out."""
    d = m.daily_between(start, end)
    if nonzero:
        t = d.where(F.col("pos_n") > 0).select("instrument_id", "trade_date", F.col("pos_volume").alias("volume"),
                                                F.col("pos_value").alias("value"))
    else:
        t = d.select("instrument_id", "trade_date", "volume", "value")
    g = m.with_instrument(t, "symbol").groupBy("symbol", "trade_date").agg(
        M.sum_long("volume").alias("daily_volume"),
        F.sum("value").cast("decimal(38,2)").alias("daily_value"))
    return top_k(g, [F.col("daily_volume").desc(), "symbol", "trade_date"], k)


def bench_b2_rolling(m: Model, start: str = "2019-08-01 00:00:00", end: str = "2019-09-01 00:00:00",
                     window_rows: int = 7) -> DataFrame:
    """Daily volume / close with 7-row moving average and stddev; half-open
    timestamp range (the month partition bounds are derived from it)."""
    lo, hi = start[:10], end[:10]
    if _midnight(start) and _midnight(end):
        # trade_date = CAST(timestamp AS DATE): with both bounds at midnight the
        # timestamp range is exactly the days [lo, hi), served by the roll-up
        d = m.daily_between(lo, as_date(hi) - timedelta(days=1)) \
            .select("instrument_id", "trade_date", "volume", "sum_close", "n_trades")
        daily = m.with_instrument(d, "symbol").groupBy("symbol", "trade_date").agg(
            M.sum_long("volume").alias("volume"), avg_of("sum_close").alias("avg_close"))
    else:
        t = m.trades_between(lo, hi).where(
            (F.col("timestamp") >= F.lit(start).cast("timestamp_ntz"))
            & (F.col("timestamp") < F.lit(end).cast("timestamp_ntz"))) \
            .select("instrument_id", "trade_date", "contracts", "close")
        daily = m.with_instrument(t, "symbol").groupBy("symbol", "trade_date").agg(
            M.sum_long("contracts").alias("volume"), M.exact_avg("close").alias("avg_close"))
    w_daily = rolling_stats(daily, ["symbol"], "trade_date", "volume", window_rows, mean="ma_7day_volume")
    w_daily = rolling_stats(w_daily, ["symbol"], "trade_date", "avg_close", window_rows,
                            stddev="sd7")
    return w_daily.select("symbol", "trade_date", "volume", "avg_close", "ma_7day_volume",
                          M.round_half_up("sd7", STAT_PLACES).alias("volatility_7day")) \
        .orderBy("symbol", "trade_date")


def bench_b3_oi(m: Model, start: str = "2019-09-15", end: str = "2019-09-20", min_oi: int = 1000,
                min_net_change: int = 10000) -> DataFrame:
    """Open-interest totals per symbol in a short window, HAVING on the sum."""
    t = m.trades_between(start, end).where(F.col("open_interest") > min_oi) \
        .select("instrument_id", "open_interest", "change_in_oi")
    g = m.with_instrument(t, "symbol").groupBy("symbol").agg(
        F.count(F.lit(1)).alias("trade_count"),
        M.sum_long("open_interest").alias("total_oi"),
        M.sum_long("change_in_oi").alias("net_oi_change"),
        F.max("open_interest").alias("max_oi"))
    out = g.where(F.col("net_oi_change") > min_net_change)
    order = [F.col("net_oi_change").desc(), "symbol"]
    most = m.rows.get("instruments")  # a row a symbol: no more than there are instruments
    return top_k(out, order, most) if most is not None and most <= MAX_SORTED_ROWS else out.orderBy(*order)


def bench_verify_global(m: Model, since: str = ORIGINAL_START) -> DataFrame:
    """Global row count, volume and average close since a date (roll-up)."""
    return m.daily_between(since).agg(
        M.sum_long("n_trades").alias("n_trades"),
        M.sum_long("volume").alias("total_contracts"),
        avg_of("sum_close").alias("avg_close"))


# -------------------------------------------------------------- statistics ----

def db_statistics(m: Model) -> DataFrame:
    """Seven labelled text metrics: one aggregate pass per table, then
    stacked into (metric, value) rows."""
    tr = m.daily.agg(
        F.sum("n_trades").alias("n"), F.min("trade_date").alias("lo"), F.max("trade_date").alias("hi"),
        F.sum("volume").alias("vol"), F.sum("value").alias("val"))
    trade_rows = tr.select(F.stack(
        F.lit(4),
        F.lit("Total Trades"), F.format_number("n", 0),
        F.lit("Date Range"), F.concat(F.col("lo").cast("string"), F.lit(" to "), F.col("hi").cast("string")),
        F.lit("Total Volume (Contracts)"), F.format_number(F.col("vol").cast("bigint"), 0),
        F.lit("Total Value (Lakh)"), F.format_number("val", 2)).alias("metric", "value"))
    dims = [("Total Instruments", m.instruments), ("Total Expiries", m.expiries), ("Total Exchanges", m.exchanges)]
    out = trade_rows
    for label, df in dims:
        out = out.unionByName(df.agg(F.format_number(F.count(F.lit(1)), 0).alias("value"))
                              .select(F.lit(label).alias("metric"), "value"))
    return out


# ------------------------------------------------------------------ charts ----

def chart_oi_trends(m: Model, symbols=None) -> DataFrame:
    """Daily total open interest of a few symbols (roll-up), by date."""
    symbols = symbols or [NIFTY, BANKNIFTY]
    inst = m.instruments.where(F.col("symbol").isin(symbols)).select("instrument_id", "symbol")
    ids = m.instrument_keys(F.col("symbol").isin(symbols))
    d = m.daily if ids is None else m.daily.where(id_in("instrument_id", ids))
    t = d.select("instrument_id", "trade_date", "total_oi").join(m.dim_filtered(inst, "instruments"), "instrument_id")
    return t.groupBy("symbol", "trade_date").agg(M.sum_long("total_oi").alias("total_oi")) \
        .orderBy("trade_date", "symbol")


def chart_volume_histogram(m: Model, bins: int = 50, sample_rows: int | None = None) -> DataFrame:
    """Equal-width bins of positive volume over all such trades, or over a
    reproducible ``sample_rows`` sample of them (the original binned an
    arbitrary 100,000-row LIMIT)."""
    v = m.trades.where(F.col("contracts") > 0)
    if sample_rows is not None:
        v = hash_sample(v.select("trade_id", "contracts"), sample_rows, ["trade_id"])
        return equal_width_histogram(v.select("contracts"), "contracts", bins)
    # bounds of the whole data from the daily roll-up: one pass over the fact
    bounds = m.daily.agg(F.min("min_pos_contracts").alias("lo"),
                         F.max(F.when(F.col("max_contracts") > 0, F.col("max_contracts"))).alias("hi"))
    return equal_width_histogram(v.select("contracts"), "contracts", bins, bounds)


def chart_volatility_heatmap(m: Model, symbol: str = NIFTY, option_type: str = "CE",
                             strike_lo: float = 10800, strike_hi: float = 11200,
                             start: str = ORIGINAL_START, end: str = "2019-08-15") -> DataFrame:
    """Stddev of close per (strike, date), long form (NULL stddev dropped)."""
    t = m.trades_of(F.col("symbol") == symbol, start, end) \
        .where((F.col("option_type") == option_type) & F.col("strike_price").between(strike_lo, strike_hi)) \
        .select("strike_price", "trade_date", "close")
    g = t.groupBy("strike_price", "trade_date").agg(F.stddev_samp("close").alias("sd"))
    return g.where(F.col("sd").isNotNull()) \
        .select("strike_price", "trade_date", M.round_half_up("sd", STAT_PLACES).alias("volatility"))


def heatmap_matrix(long: DataFrame) -> DataFrame:
    """Strike x date matrix of the long heat-map rows: a column a date that occurs (no more than
    the date range has)."""
    return pivot_discovered(long, ["strike_price"], "trade_date", "volatility").orderBy("strike_price")


def chart_heatmap_matrix(m: Model, symbol: str = NIFTY) -> DataFrame:
    """The volatility heat map as a strike x date matrix."""
    return heatmap_matrix(chart_volatility_heatmap(m, symbol=symbol))


def chart_option_chain(m: Model, symbol: str = NIFTY, expiry: str = "2019-08-29",
                       day: str = ORIGINAL_START) -> DataFrame:
    """Volume per strike, calls and puts side by side, missing -> 0."""
    t = m.trades_of(F.col("symbol") == symbol, day, day) \
        .where((F.col("expiry_date") == F.lit(expiry).cast("date")) & F.col("option_type").isin(OPTIONS)) \
        .select("strike_price", "option_type", "contracts")
    g = t.groupBy("strike_price", "option_type").agg(M.sum_long("contracts").alias("total_volume"))
    wide = g.groupBy("strike_price").pivot("option_type", OPTIONS).agg(F.first("total_volume"))
    return wide.na.fill(0, subset=OPTIONS).select("strike_price", *[F.col(o).cast("bigint") for o in OPTIONS]) \
        .orderBy("strike_price")
