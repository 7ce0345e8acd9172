"""Normalisation of the typed feed into the keyed four-table model.

exchanges 1:N instruments 1:N expiries 1:N trades (+ trades -> instruments).
Each builder is a DataFrame transform; the store module writes them once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from derivspark.functions.metrics import GRAINS, period_key
from derivspark.operators.ids import dense_ids
from derivspark.operators.joins import max_broadcast_rows, maybe_broadcast
from derivspark.schemas import (DEFAULT_OPTION_TYPE, DEFAULT_STRIKE, EXCHANGE_ROWS, EXCHANGES,
                                MEASURES, PRICE)

INSTRUMENT_KEY = ["exchange_id", "instrument_type", "symbol"]
CONTRACT_ATTRS = ["expiry_date", "strike_price", "option_type"]
EXPIRY_KEY = ["instrument_id", "expiry_date", "strike_price", "option_type"]


def exchange_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(EXCHANGE_ROWS, EXCHANGES)


def series_of(instrument_type) -> F.Column:
    return F.when(F.col(instrument_type).like("%OPT%"), "OPT").otherwise("FUT")


def build_instruments(feed: DataFrame) -> DataFrame:
    """DISTINCT (exchange, type, symbol) + derived series + ordered id."""
    distinct = feed.select(*INSTRUMENT_KEY).distinct().withColumn("series", series_of("instrument_type"))
    ids = dense_ids(distinct, order_cols=INSTRUMENT_KEY[1:], id_col="instrument_id",
                    bucket_cols=INSTRUMENT_KEY[:1], id_type="int")
    return ids.select("instrument_id", *INSTRUMENT_KEY, "series")


def fill_contract_keys(feed: DataFrame) -> DataFrame:
    """NULL strike -> 0 and NULL option type -> 'XX' so that NULL and the
    default meet in the equi-joins (not a null-safe join: 0 must match NULL)."""
    return (feed.withColumn("strike_price", F.coalesce("strike_price", F.lit(DEFAULT_STRIKE).cast(PRICE)))
                .withColumn("option_type", F.coalesce("option_type", F.lit(DEFAULT_OPTION_TYPE))))


def build_expiries(feed: DataFrame, instruments: DataFrame, instrument_rows: int | None = None) -> DataFrame:
    """Contract dimension: DISTINCT contract tuple with a known expiry, keyed
    to its instrument, unique on (instrument, expiry, strike, option)."""
    contracts = (fill_contract_keys(feed.where(F.col("expiry_date").isNotNull()))
                 .select(*INSTRUMENT_KEY, "expiry_date", "strike_price", "option_type")
                 .distinct())
    keyed = contracts.join(maybe_broadcast(instruments.select("instrument_id", *INSTRUMENT_KEY), instrument_rows),
                           INSTRUMENT_KEY).select(*EXPIRY_KEY).distinct()
    ids = dense_ids(keyed, order_cols=EXPIRY_KEY[1:], id_col="expiry_id",
                    bucket_cols=EXPIRY_KEY[:1], id_type="int")
    return ids.select("expiry_id", *EXPIRY_KEY)


def contract_lookup(instruments: DataFrame, expiries: DataFrame) -> DataFrame:
    """Natural contract key -> (instrument_id, expiry_id): both dimensions
    folded into one lookup so the fact needs a single join."""
    return expiries.join(instruments.select("instrument_id", *INSTRUMENT_KEY), "instrument_id") \
        .select(*INSTRUMENT_KEY, "expiry_date", "strike_price", "option_type", "instrument_id", "expiry_id")


def build_trades(feed: DataFrame, instruments: DataFrame, expiries: DataFrame,
                 lookup_rows: int | None = None, with_ids: bool = True, covering: bool = False,
                 stage_dir: str | None = None, tie_col: str | None = None, grain: str | None = None,
                 n_rows: int | None = None) -> DataFrame:
    """Fact build: rows with a timestamp, keyed through the contract lookup
    (NULL expiry rows drop out of the inner join), measures NULL -> 0.

    ``covering`` also keeps the contract attributes (expiry date, strike,
    option type) on each fact row: the stored fact's equivalent of a covering
    index, so option-chain style reports filter and group on them without
    joining a contract dimension that can outgrow any broadcast. The values
    come from the same lookup row as ``expiry_id`` (where it is small they are looked up
    behind the numbering, which then shuffles and stages less); ``expiries`` stays the
    system of record. ``stage_dir``, ``tie_col``, ``n_rows``: see ``dense_ids``.

    ``grain`` adds the partition column and numbers the rows in the order of the files' layout
    (partition, instrument, day, then the rest): the one range sort that finds the ids leaves
    the rows as they are to be written (``written_order``); otherwise ids go by day."""
    rows = fill_contract_keys(feed.where(F.col("timestamp").isNotNull()))
    lookup = maybe_broadcast(contract_lookup(instruments, expiries), lookup_rows)
    keyed = rows.join(lookup, [*INSTRUMENT_KEY, "expiry_date", "strike_price", "option_type"])
    measures = [F.coalesce(F.col(m), F.lit(0).cast(feed.schema[m].dataType)).alias(m) for m in MEASURES]
    late = covering and with_ids and lookup_rows is not None and lookup_rows <= max_broadcast_rows(feed.sparkSession)
    extra = CONTRACT_ATTRS if covering and not late else []
    trades = keyed.select("expiry_id", "instrument_id", F.to_date("timestamp").alias("trade_date"),
                          *measures, "timestamp", *extra, *([tie_col] if tie_col else []))
    if not with_ids:
        return trades
    first = ["trade_date"]
    if grain:
        trades = trades.withColumn(GRAINS[grain], period_key("trade_date", grain))
        first = [GRAINS[grain], "instrument_id", "trade_date"]
    # ids depend on the 3NF columns only (the covering ones follow expiry_id)
    order = [c for c in trades.columns if c not in (*first, tie_col, *extra)]
    ids = dense_ids(trades, order_cols=order, id_col="trade_id", bucket_cols=first,
                    copies=True, stage_dir=stage_dir, tie_col=tie_col, rows=n_rows)
    columns = [c for c in trades.columns if c != tie_col]
    if late:
        ids = ids.join(F.broadcast(expiries.select("expiry_id", *CONTRACT_ATTRS)), "expiry_id")
        after = columns.index("timestamp") + 1
        columns[after:after] = CONTRACT_ATTRS
    return ids.select("trade_id", *columns)


def written_order(trades: DataFrame, grain: str) -> DataFrame:
    """``build_trades`` with a ``grain`` as it is written: its tasks hold ranges of the layout already, so
    they only sort what they read, without a shuffle."""
    return trades.sortWithinPartitions(GRAINS[grain], "instrument_id", "trade_date", "trade_id")
