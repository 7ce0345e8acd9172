"""Time-series roll-up of a live event stream: 1-day OHLC bars.

Event time is the zone-less timestamp interpreted in the session zone (UTC); events of one time
are ordered by ``tie_col``. A micro-batch is aggregated to partial bars, one row a key and
day, which are merged into the stored ones: an open or close is replaced by an earlier or later
event's, highs, lows, counts and exact sums add up. So the table holds every event as soon as
its batch is published, an open day like a closed one, and a late event, however late, changes its
day's bar instead of being dropped; no state is kept between batches. Each batch is one version of the
table (``sources/versions.py``) together with its number, so a batch that is tried again counts once.

``daily_bars`` is the windowed aggregate itself, for batches and for streams that must not change a
bar after its watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from derivspark.functions.metrics import month_key, round_half_up
from derivspark.sources.versions import Transaction, Version, open_version, update

# Decimals for the sum of a bar.
SUM_PLACES = 6
EXACT = "decimal(28,12)"
PARTITION = "bar_month"
BATCHES = "stream string, epoch bigint"


def daily_bars(events: DataFrame, ts_col: str = "ts", value_col: str = "value", key_col: str = "event_type",
               window: str = "1 day", delay: str = "1 day", tie_col: str = "event_id") -> DataFrame:
    ev = events.withColumn("event_time", F.col(ts_col).cast("timestamp"))
    at = F.struct("event_time", *[c for c in (tie_col,) if c in events.columns])
    bars = (ev.withWatermark("event_time", delay)
              .groupBy(F.window("event_time", window), key_col)
              .agg(F.min_by(value_col, at).alias("open"), F.max(value_col).alias("high"),
                   F.min(value_col).alias("low"), F.max_by(value_col, at).alias("close"),
                   F.count(F.lit(1)).alias("n_events"), F.sum(value_col).alias("total")))
    return bars.select(F.to_date(F.col("window.start")).alias("bar_date"), key_col, "open", "high", "low",
                       "close", "n_events", round_half_up("total", SUM_PLACES).alias("total_value"))


def partial_bars(events: DataFrame, ts_col: str = "ts", value_col: str = "value", key_col: str = "event_type",
                 tie_col: str = "event_id") -> DataFrame:
    """A bar a day and key of these events, with what is needed to merge it with others."""
    at = F.struct(ts_col, tie_col)
    day = F.to_date(ts_col)
    bars = events.where(F.col(ts_col).isNotNull()).groupBy(day.alias("bar_date"), key_col).agg(
        F.min(at).alias("open_at"), F.min_by(value_col, at).alias("open"), F.max(at).alias("close_at"),
        F.max_by(value_col, at).alias("close"), F.max(value_col).alias("high"), F.min(value_col).alias("low"),
        F.count(F.lit(1)).alias("n_events"), F.sum(F.col(value_col).cast(EXACT)).cast("decimal(38,12)").alias("total"))
    return bars.withColumn(PARTITION, month_key("bar_date"))


def merge_bars(stored: DataFrame, partial: DataFrame, key_col: str = "event_type") -> DataFrame:
    both = stored.unionByName(partial.select(*stored.columns))
    merged = both.groupBy(PARTITION, "bar_date", key_col).agg(
        F.min("open_at").alias("open_at"), F.min_by("open", "open_at").alias("open"), F.max("close_at").alias("close_at"),
        F.max_by("close", "close_at").alias("close"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.sum("n_events").cast("bigint").alias("n_events"), F.sum("total").cast("decimal(38,12)").alias("total"))
    return merged.select(*stored.columns)


def add_events(spark: SparkSession, root: str, events: DataFrame, stream: str, epoch: int, key_col: str = "event_type",
               on_step=None, **columns) -> Version:
    """Merge one batch of events into the bars at ``root``; a batch (stream, epoch) counts once."""
    def change(t: Transaction) -> bool | None:
        seen = F.col("stream").eqNullSafe(stream) & (F.col("epoch") == epoch)
        if "batches" in t.base.tables and not t.base.table("batches").where(seen).isEmpty():
            return False
        bars = t.staged(partial_bars(events, key_col=key_col, **columns), "partial")
        if "bars" in t.base.tables:
            touched = [r[0] for r in bars.select(PARTITION).distinct().collect()]  # months of the batch
            bars = merge_bars(t.base.table("bars", touched), bars, key_col)
            t.drop("bars", touched)
        t.add("bars", bars, PARTITION, ["bar_date", key_col])
        t.add("batches", spark.createDataFrame([(stream, epoch)], BATCHES).coalesce(1))
    return update(spark, root, f"bars of batch {epoch}", change, on_step=on_step)


def read_bars(spark: SparkSession, root: str, key_col: str = "event_type") -> DataFrame:
    """The bars of the latest version, with the columns of ``daily_bars``."""
    return open_version(spark, root).table("bars").select(
        "bar_date", key_col, "open", "high", "low", "close", "n_events", round_half_up("total", SUM_PLACES).alias("total_value"))


def run_daily_bars(spark: SparkSession, inbox: str, root: str, checkpoint: str, schema, max_files: int = 1000):
    """Merge every event file in ``inbox`` (Parquet) into the bars at ``root`` and stop."""
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(inbox)
    q = (source.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda df, epoch: add_events(df.sparkSession, root, df, checkpoint, epoch))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
