"""Data-quality jobs replacing write-time constraint enforcement.

* CHECK / NOT NULL rules: one pass over the data, one conditional count per
  rule (a SQL CHECK passes on NULL, so a violation is ``NOT coalesce(pred, true)``).
* UNIQUE / PK: keys with more than one row (partial aggregation per task).
* Foreign keys: ``left_anti`` joins against the parent key set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from derivspark.operators.joins import maybe_broadcast
from derivspark.schemas import EXCHANGE_ROWS, INSTRUMENT_TYPES, OPTION_TYPES, SERIES_VALUES
from derivspark.plans.normalize import series_of


def feed_rules() -> dict[str, Column]:
    """CHECK rules of the model applied to typed feed rows: name -> predicate
    that must hold."""
    c = F.col
    return {
        "instrument_type_domain": c("instrument_type").isin(INSTRUMENT_TYPES),
        "series_domain": series_of("instrument_type").isin(SERIES_VALUES),
        "option_type_domain": c("option_type").isin(OPTION_TYPES),
        "strike_non_negative": c("strike_price") >= 0,
        "ohlc_consistent": ((c("high") >= c("low")) & (c("high") >= c("open")) & (c("high") >= c("close"))
                            & (c("low") <= c("open")) & (c("low") <= c("close"))),
    }


NOT_NULL = ["exchange_id", "instrument_type", "symbol", "expiry_date", "timestamp"]


def violation(pred: Column) -> Column:
    return ~F.coalesce(pred, F.lit(True))


def check_violations(df: DataFrame, rules: dict[str, Column] | None = None,
                     not_null: list[str] | None = None) -> DataFrame:
    """(rule, violations) for every CHECK and NOT NULL rule, in one scan."""
    rules = rules if rules is not None else feed_rules()
    not_null = not_null if not_null is not None else NOT_NULL
    named = [(k, violation(p)) for k, p in rules.items()] + [(f"not_null_{c}", F.col(c).isNull()) for c in not_null]
    counts = df.agg(*[F.sum(F.when(v, 1).otherwise(0)).cast("bigint").alias(k) for k, v in named])
    pairs = []
    for k, _ in named:
        pairs += [F.lit(k), F.col(k)]
    return counts.select(F.stack(F.lit(len(named)), *pairs).alias("rule", "violations"))


def quarantine(df: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """Rows failing any rule, with the names of the failed rules."""
    rules = rules if rules is not None else feed_rules()
    failed = F.filter(F.array(*[F.when(violation(p), F.lit(k)) for k, p in rules.items()]),
                      lambda x: x.isNotNull())
    return df.withColumn("failed_rules", failed).where(F.size("failed_rules") > 0)


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str | None = None,
            parent_rows: int | None = None) -> DataFrame:
    """Child rows whose foreign key has no parent row (a NULL key passes, as in SQL)."""
    keys = parent.select(F.col(pk or fk).alias(fk)).distinct()
    return child.where(F.col(fk).isNotNull()).join(maybe_broadcast(keys, parent_rows), fk, "left_anti")


# Declared keys and value rules of the stored tables ---------------------------
DECLARED_KEYS = {
    "exchanges": ["exchange_code"],
    "instruments": ["exchange_id", "instrument_type", "symbol"],
    "expiries": ["instrument_id", "expiry_date", "strike_price", "option_type"],
    "trades": ["trade_id", "trade_date"],
}
MODEL_NOT_NULL = {
    "exchanges": ["exchange_id", "exchange_code", "exchange_name"],
    "instruments": ["instrument_id", "exchange_id", "instrument_type", "symbol", "series"],
    "expiries": ["expiry_id", "instrument_id", "expiry_date", "strike_price", "option_type"],
    "trades": ["trade_id", "instrument_id", "expiry_id", "trade_date"],
}


def model_rules() -> dict[str, dict[str, Column]]:
    """CHECK rules on stored columns: table -> name -> predicate that must hold."""
    feed, c = feed_rules(), F.col
    return {
        "exchanges": {"exchange_code_domain": c("exchange_code").isin([r[1] for r in EXCHANGE_ROWS])},
        "instruments": {"instrument_type_domain": feed["instrument_type_domain"],
                        "series_domain": c("series").isin(SERIES_VALUES)},
        "expiries": {k: feed[k] for k in ("option_type_domain", "strike_non_negative")},
        "trades": {"ohlc_consistent": feed["ohlc_consistent"]},
    }


# Fixed rule-derived dirt for the fixture feed (FIXTURES.md §4) ----------------
DIRT_SWAP_HIGH_LOW, DIRT_BAD_OPTION, DIRT_NEG_STRIKE, DIRT_BAD_FK = 211, 223, 227, 229


def dirty_feed(feed_with_keys: DataFrame) -> DataFrame:
    """Apply the fixed dirt rules keyed on l_orderkey."""
    k = F.col("l_orderkey")
    swap = (k % DIRT_SWAP_HIGH_LOW == 0) & (F.col("high") != F.col("low"))
    return (feed_with_keys
            .withColumn("_h", F.when(swap, F.col("low")).otherwise(F.col("high")))
            .withColumn("low", F.when(swap, F.col("high")).otherwise(F.col("low")))
            .withColumn("high", F.col("_h")).drop("_h")
            .withColumn("option_type", F.when(k % DIRT_BAD_OPTION == 0, F.lit("ZZ")).otherwise(F.col("option_type")))
            .withColumn("strike_price", F.when(k % DIRT_NEG_STRIKE == 0, F.lit(-1).cast("decimal(12,2)"))
                        .otherwise(F.col("strike_price")))
            .withColumn("exchange_id", F.when(k % DIRT_BAD_FK == 0, F.lit(-1)).otherwise(F.col("exchange_id"))))
