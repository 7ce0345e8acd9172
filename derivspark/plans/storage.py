"""Storage operations on the partitioned fact and the dimensions:
insert-if-new, monthly partitions, archive export, retention, and a
precomputed daily roll-up refreshed by dynamic partition overwrite.

Only partitions named in a write are replaced (``partitionOverwriteMode =
dynamic``); retention drops whole partition folders, which is a metadata
operation instead of a rewrite of the kept data.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from derivspark.functions import metrics as M
from derivspark.operators.ids import dense_ids
from derivspark.operators.joins import maybe_broadcast
from derivspark.plans.rollup import daily_aggregates
from derivspark.sources.fs import delete_path, list_partitions
from derivspark.sources.store import Model

PARTITION = "trade_month"


def write_partitioned(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "zstd",
                      partition_by: str = PARTITION) -> None:
    (df.write.mode(mode).option("partitionOverwriteMode", "dynamic").option("compression", compression)
       .partitionBy(partition_by).parquet(path))


def split_by_year(m: Model, path: str) -> str:
    """One dataset folder per year (``trade_year=YYYY``), e.g. to keep or
    ship years separately."""
    write_partitioned(m.trades.withColumn("trade_year", F.year("trade_date")).drop(m.part_col), path,
                      partition_by="trade_year")
    return path


# ------------------------------------------------------------ insert-if-new ----

def new_rows_with_ids(existing: DataFrame, batch: DataFrame, key: list[str], id_col: str,
                      bucket_cols: list[str], existing_rows: int | None = None) -> DataFrame:
    """``INSERT ... ON CONFLICT DO NOTHING``: batch rows whose unique key is
    neither repeated in the batch nor present in the table, numbered after
    the current maximum id in key order. A NULL in the key is never inserted."""
    fresh = batch.dropna(subset=key).dropDuplicates(key).join(maybe_broadcast(existing.select(*key), existing_rows), key, "left_anti")
    order = [c for c in key if c not in bucket_cols]
    numbered = dense_ids(fresh, order_cols=order, id_col="_rank", bucket_cols=bucket_cols)
    top = existing.agg(F.coalesce(F.max(id_col), F.lit(0))).scalar()
    dtype = existing.schema[id_col].dataType
    return numbered.withColumn(id_col, (top + F.col("_rank")).cast(dtype)).drop("_rank") \
        .select(*existing.columns)


def append_if_new(spark: SparkSession, path: str, batch: DataFrame, key: list[str], id_col: str,
                  bucket_cols: list[str], staging: str) -> DataFrame:
    """Append the new rows of ``batch`` to the Parquet table at ``path``.
    The new rows are staged first, so the table is never read and written
    by the same job."""
    existing = spark.read.parquet(path)
    new_rows_with_ids(existing, batch, key, id_col, bucket_cols).write.mode("overwrite").parquet(staging)
    spark.read.parquet(staging).write.mode("append").parquet(path)
    return spark.read.parquet(path)


# ---------------------------------------------------------- partition reports ----

def monthly_partition_rollup(m: Model) -> DataFrame:
    """Per month: rows, volume and date span (for a month-grain store the
    month is the partition column itself)."""
    month = F.col(PARTITION) if m.grain == "month" else M.month_key("trade_date").alias(PARTITION)
    return m.trades.groupBy(month).agg(
        F.count(F.lit(1)).alias("n_rows"), M.sum_long("contracts").alias("volume"),
        F.min("trade_date").alias("first_day"), F.max("trade_date").alias("last_day"))


def partition_summary(df: DataFrame) -> DataFrame:
    """Per month of trade_date: rows, volume, value and date span."""
    return df.groupBy(M.month_key("trade_date").alias(PARTITION)).agg(
        F.count(F.lit(1)).alias("n_rows"), M.sum_long("contracts").alias("volume"),
        F.sum("value_in_lakh").cast("decimal(38,2)").alias("value"),
        F.min("trade_date").alias("first_day"), F.max("trade_date").alias("last_day"))


# ------------------------------------------------------------------ archive ----

def archive_before(m: Model, cutoff, path: str) -> str:
    """Rows before ``cutoff`` exported as ZSTD Parquet, one folder per month;
    only the months below the cutoff are scanned."""
    write_partitioned(m.trades_between(hi=cutoff, hi_exclusive=True), path, partition_by=m.part_col)
    return path


# ---------------------------------------------------------------- retention ----

def drop_partitions_before(spark: SparkSession, path: str, keep_from: int, column: str = PARTITION) -> list[str]:
    """Delete whole ``column=value`` folders with value < keep_from."""
    dropped = []
    for value, folder in list_partitions(spark, path, column):
        if int(value) < keep_from:
            delete_path(spark, folder)
            dropped.append(value)
    return dropped


def keep_last_months(m: Model, months: int) -> int:
    """Partition value (in the model's grain) of the first day kept when
    keeping ``months`` calendar months up to the last trade date."""
    last = m.last_trade_date()
    y, mo = last.year, last.month - (months - 1)
    while mo <= 0:
        y, mo = y - 1, mo + 12
    return m.period(date(y, mo, 1))


# ------------------------------------------------------------- daily roll-up ----

def daily_rollup(m: Model, periods: list[int] | None = None) -> DataFrame:
    """Daily aggregates per instrument ("materialised view" of the frequent
    symbol/day aggregations); ``periods`` (partition values) limits the
    recomputation."""
    t = m.trades if periods is None else m.trades.where(F.col(m.part_col).isin(periods))
    return daily_aggregates(t, m.part_col)


def refresh_daily_rollup(m: Model, path: str, periods: list[int] | None = None) -> str:
    """Recompute the roll-up for ``periods`` (all when None) and replace just
    those partitions."""
    write_partitioned(daily_rollup(m, periods), path, partition_by=m.part_col)
    return path
