"""Daily roll-up of the fact per (instrument, trade_date): the stored
"materialised view" of the frequent symbol/day aggregations.

It keeps exact sums and row counts (never averages), so every SUM, COUNT,
MIN/MAX and AVG = SUM/COUNT over instruments and days that a report needs
can be recomputed from it exactly — also over positive-volume rows only
(``pos_*``, for reports that filter ``contracts > 0``) and under the two
price filters of the range reports (``*_hl``: high > 0 and low > 0;
``*_rc``: high - low > 0 and close > 0). Reports filtering option types or
strikes read the fact.

All sums are exact (percentages are summed as DECIMAL with 12 places), so they do not depend on
the order of rows and can be maintained: ``merge_daily`` takes the aggregates of removed rows
away and adds those of new ones. A minimum or maximum is lost only where the rows removed
held it and the new ones don't reach it; such groups are named, to be computed anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derivspark.functions import metrics as M


PCT = "decimal(28,12)"
# Columns that merge by a minimum or maximum; all other measures are sums.
LOWEST, HIGHEST = ("day_low", "min_pos_contracts"), ("day_high", "max_contracts", "max_range_rc")
# Sums over filtered rows are NULL where no row passes: their counters.
COUNTER = {"pos_": "pos_n", "_hl": "n_hl", "_rc": "n_rc"}


# Row filters of the range reports (fixed by their definitions).
def hl_positive():
    return (F.col("high") > 0) & (F.col("low") > 0)


def range_and_close_positive():
    return ((F.col("high") - F.col("low")) > 0) & (F.col("close") > 0)


def _filtered(cond, tag: str, measures: list[tuple[str, str]], pct_base: str) -> list:
    """Count, sums/maxes and the sum of per-row range % over rows matching
    ``cond``: n_<tag>, <fn>_<col>_<tag>, sum_pct_<tag>."""
    def col(c):
        return (F.col("high") - F.col("low")) if c == "_range" else F.col(c)
    out = [F.sum(F.when(cond, 1).otherwise(0)).cast("bigint").alias(f"n_{tag}")]
    for c, fn in measures:
        v = (F.sum if fn == "sum" else F.max)(F.when(cond, col(c)))
        if fn == "sum":
            v = v.cast("bigint" if c == "contracts" else "decimal(38,2)")
        out.append(v.alias(f"{fn}{c}_{tag}" if c == "_range" else f"{fn}_{c}_{tag}"))
    pct = M.range_pct("high", "low", pct_base).cast(PCT)
    out.append(F.sum(F.when(cond, pct)).cast("decimal(38,12)").alias(f"sum_pct_{tag}"))
    return out


def daily_aggregates(trades: DataFrame, part_col: str = "trade_month") -> DataFrame:
    """(partition, instrument_id, trade_date) -> exact daily aggregates."""
    return trades.groupBy(part_col, "instrument_id", "trade_date").agg(
        F.count(F.lit(1)).alias("n_trades"), M.sum_long("contracts").alias("volume"),
        F.sum("value_in_lakh").cast("decimal(38,2)").alias("value"),
        M.sum_long("open_interest").alias("total_oi"), M.sum_long("change_in_oi").alias("net_oi_change"),
        F.sum("close").cast("decimal(38,2)").alias("sum_close"),
        F.sum("settle_price").cast("decimal(38,2)").alias("sum_settle"),
        F.min("low").alias("day_low"), F.max("high").alias("day_high"),
        F.min(F.when(F.col("contracts") > 0, F.col("contracts"))).alias("min_pos_contracts"),
        F.max("contracts").alias("max_contracts"),
        # the same measures over positive-volume rows only (reports that
        # filter contracts > 0); NULL / 0 when the day has no such row
        F.sum(F.when(F.col("contracts") > 0, 1).otherwise(0)).cast("bigint").alias("pos_n"),
        F.sum(F.when(F.col("contracts") > 0, F.col("contracts"))).cast("bigint").alias("pos_volume"),
        F.sum(F.when(F.col("contracts") > 0, F.col("value_in_lakh"))).cast("decimal(38,2)").alias("pos_value"),
        F.sum(F.when(F.col("contracts") > 0, F.col("open_interest"))).cast("bigint").alias("pos_oi"),
        # price-range aggregates under the two row filters the range reports use
        *_filtered(hl_positive(), "hl", [("high", "sum"), ("low", "sum"), ("close", "sum"), ("contracts", "sum")],
                   pct_base="low"),
        *_filtered(range_and_close_positive(), "rc", [("_range", "sum"), ("_range", "max")], pct_base="close"))


def avg_of(sum_col: str, n_col: str = "n_trades") -> F.Column:
    """Exact average re-assembled from stored sums and counts:
    CAST(SUM(sum) AS DOUBLE) / SUM(n) == CAST(SUM(x) AS DOUBLE) / COUNT(x)."""
    return F.sum(sum_col).cast("double") / F.sum(n_col)


def counter_of(column: str) -> str | None:
    """The counter that must be positive for a filtered sum to have a value."""
    if column in COUNTER.values():
        return None
    return next((n for tag, n in COUNTER.items() if column.startswith(tag) or column.endswith(tag)), None)


def merge_daily(old: DataFrame, plus: DataFrame, minus: DataFrame | None = None) -> DataFrame:
    """Daily aggregates after rows with the aggregates ``minus`` went and rows with ``plus`` came,
    and ``lost``: whether an extreme of the group must be computed anew. Groups without rows go."""
    sides = [("old", old), ("plus", plus), *([("minus", minus)] if minus is not None else [])]
    keys = [c for c in old.columns if c in (*M.GRAINS.values(), "instrument_id", "trade_date")]
    rows = None
    for name, df in sides:
        one = df.select(*old.columns, F.lit(name).alias("_side"))
        rows = one if rows is None else rows.unionByName(one)
    gone = F.col("_side") == "minus"
    aggs, lost = [], F.lit(False)
    for c in (c for c in old.columns if c not in keys):
        kind = old.schema[c].dataType
        if c in LOWEST + HIGHEST:
            fn = F.min if c in LOWEST else F.max
            aggs += [fn(F.when(F.col("_side") == side, F.col(c))).alias(f"_{side}_{c}") for side in ("old", "plus", "minus")]
            was, new, went = (F.col(f"_{side}_{c}") for side in ("old", "plus", "minus"))
            reaches = (went <= was) if c in LOWEST else (went >= was)
            covered = (new <= went) if c in LOWEST else (new >= went)
            lost |= F.coalesce(reaches, F.lit(False)) & ~F.coalesce(covered, F.lit(False))
        else:
            value = F.coalesce(F.col(c), F.lit(0).cast(kind))
            aggs.append(F.sum(F.when(gone, -value).otherwise(value)).cast(kind).alias(c))
    merged = rows.groupBy(*keys).agg(*aggs).where("n_trades > 0").withColumn("lost", lost)
    out = []
    for c in old.columns:
        if c in LOWEST + HIGHEST:
            pick = F.least if c in LOWEST else F.greatest  # both leave NULLs out
            value = pick(f"_old_{c}", f"_plus_{c}")
        else:
            value = F.col(c)
        n = counter_of(c)
        out.append((F.when(F.col(n) > 0, value) if n else value).alias(c))
    return merged.select(*out, "lost")
