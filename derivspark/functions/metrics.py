"""Reusable column builders for the derived metrics.

All are plain ``pyspark.sql.functions`` expressions, so they stay inside
whole-stage codegen. Every ratio divides by ``NULLIF(den, 0)``: Spark runs
with ANSI mode, where ``x / 0`` raises instead of returning NULL.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _names(*cs) -> bool:
    """True when every input is a plain column name: the builder can then be
    one SQL expression, parsed in the JVM in a single call (the same
    expression the Column API would assemble call by call)."""
    return all(isinstance(c, str) for c in cs)


def _q(c: str) -> str:
    return f"`{c}`"


def nullif_zero(c: ColumnOrName) -> Column:
    return F.nullif(_c(c), F.lit(0))


def as_double(c: ColumnOrName) -> Column:
    return F.expr(f"CAST({_q(c)} AS DOUBLE)") if _names(c) else _c(c).cast("double")


def safe_div(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / NULLIF(den, 0)`` computed in DOUBLE (decimal/decimal division
    has engine-specific result scales; doubles of exact operands do not)."""
    if _names(num, den):
        return F.expr(f"CAST({_q(num)} AS DOUBLE) / NULLIF(CAST({_q(den)} AS DOUBLE), 0)")
    return as_double(num) / nullif_zero(as_double(den))


def round_half_up(c: ColumnOrName, scale: int = 2) -> Column:
    """ROUND half-up to ``scale`` places, returned as DOUBLE.

    Rounds through DECIMAL(38,10) so a double sitting one ulp below a
    half-way point (e.g. 1.005) rounds the way its decimal text reads.
    """
    if _names(c):
        return F.expr(f"CAST(ROUND(CAST({_q(c)} AS DECIMAL(38,10)), {int(scale)}) AS DOUBLE)")
    return F.round(_c(c).cast("decimal(38,10)"), scale).cast("double")


# Sums of money: exact to 10^36 units, two decimals.
MONEY = "decimal(38,2)"


def round_money(c: ColumnOrName) -> Column:
    """A sum of decimals rounded half up to two places, still a DECIMAL: exact at any size, where a
    DOUBLE has no room for cents beyond 2^53 of them."""
    return F.round(_c(c), 2).cast(MONEY)


def exact_avg(c: ColumnOrName) -> Column:
    """AVG as ``CAST(SUM(x) AS DOUBLE) / COUNT(x)``: exact sum of decimals /
    integers first, one division at the end (aggregate expression)."""
    if _names(c):
        return F.expr(f"CAST(SUM({_q(c)}) AS DOUBLE) / COUNT({_q(c)})")
    return F.sum(_c(c)).cast("double") / F.count(_c(c))


def sum_long(c: ColumnOrName) -> Column:
    return F.expr(f"CAST(SUM({_q(c)}) AS BIGINT)") if _names(c) else F.sum(_c(c)).cast("bigint")


# --- named metrics ----------------------------------------------------------

def pct(num: ColumnOrName, den: ColumnOrName) -> Column:
    return safe_div(num, den) * 100


def avg_daily_oi_change(net_oi_change: ColumnOrName, trading_days: ColumnOrName) -> Column:
    return round_half_up(safe_div(net_oi_change, trading_days), 0)


def oi_change_pct(net_oi_change: ColumnOrName, avg_open_interest: ColumnOrName) -> Column:
    return round_half_up(pct(net_oi_change, avg_open_interest), 2)


def coefficient_of_variation(stddev: ColumnOrName, mean: ColumnOrName) -> Column:
    return round_half_up(pct(stddev, mean), 2)


def spread(a: ColumnOrName, b: ColumnOrName) -> Column:
    """|a - COALESCE(b, a)|: a missing second side gives spread 0."""
    return F.abs(_c(a) - F.coalesce(_c(b), _c(a)))


def spread_pct(a: ColumnOrName, b: ColumnOrName) -> Column:
    return pct(_c(a) - F.coalesce(_c(b), _c(a)), a)


def put_call_ratio(put: ColumnOrName, call: ColumnOrName) -> Column:
    return round_half_up(safe_div(put, call), 2)


def value_per_contract(value: ColumnOrName, contracts: ColumnOrName) -> Column:
    return round_half_up(safe_div(value, contracts), 2)


def range_pct(high: ColumnOrName, low: ColumnOrName, base: ColumnOrName) -> Column:
    """(high - low) / base * 100 per row (base = low or close)."""
    return pct(_c(high) - _c(low), base)


# Fixed thresholds of the volatility classification (percent range).
VOLATILITY_CLASSES = [(5, "High Volatility"), (2, "Medium Volatility")]
VOLATILITY_DEFAULT = "Low Volatility"


def volatility_class(range_pct_col: ColumnOrName) -> Column:
    out = None
    for threshold, label in VOLATILITY_CLASSES:
        cond = _c(range_pct_col) > threshold
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(VOLATILITY_DEFAULT)


def avg_daily_volume(total_volume: ColumnOrName, trading_days: ColumnOrName) -> Column:
    return round_half_up(safe_div(total_volume, trading_days), 0)


def month_key(date_col: ColumnOrName) -> Column:
    """yyyymm integer used as the trades partition column."""
    return (F.year(_c(date_col)) * 100 + F.month(_c(date_col))).cast("int")


# Partition granularity of the stored fact: grain -> partition column. Values
# are yyyymm for months and the yyyymmdd of the period start otherwise.
GRAINS = {"month": "trade_month", "week": "trade_week", "day": "trade_day"}


def _ymd(d: Column) -> Column:
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def period_key(date_col: ColumnOrName, grain: str = "month") -> Column:
    """Partition value of a date column for ``grain``."""
    if grain == "month":
        return month_key(date_col)
    if grain == "week":
        return _ymd(F.date_trunc("week", _c(date_col)).cast("date"))
    if grain == "day":
        return _ymd(_c(date_col))
    raise ValueError(f"unknown grain {grain!r}")


def period_value(d, grain: str = "month") -> int:
    """Partition value of a Python date for ``grain`` (literal bounds)."""
    if grain == "month":
        return d.year * 100 + d.month
    if grain == "week":
        d = d - timedelta(days=d.weekday())
    elif grain != "day":
        raise ValueError(f"unknown grain {grain!r}")
    return d.year * 10000 + d.month * 100 + d.day
