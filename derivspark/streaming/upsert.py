"""Corrections as upserts on the month-partitioned fact.

A row is identified by its ``trade_id``. Of several versions of one row in a
micro-batch the newest stays (``timestamp``, then file time, then the values); it
replaces the stored row unless that has a newer ``timestamp``, so an older version
that arrives in a later run changes nothing.

``run_corrections`` applies a stream of corrections to a store with versions
(``plans/maintain.correct``), where fact and aggregates change together.
``upsert_batch`` and ``run_upserts`` work on a plain partitioned table:
The partitions that hold a corrected row, before or after its correction, are
read; corrected rows are replaced, new ids added, the result is staged, and only
those partitions are overwritten. Other partitions are never rewritten.

A finished stage (its ``_SUCCESS`` file) is the commit: a batch that is tried
again, even after a crash in the middle of the overwrite, reuses the stage and
does not read the damaged table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from derivspark.plans.maintain import correct
from derivspark.sources.fs import delete_path, exists, list_partitions
from derivspark.sources.versions import MAIN, open_version

PARTITION = "trade_month"
KEY = ["trade_id"]
FILE_TIME = "_file_time"
VERSION = "timestamp"


def newest_versions(batch: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """One row a key: the newest version. Partial maxima, so many versions of one key are cheap."""
    order = [c for c in ("timestamp", FILE_TIME) if c in batch.columns]
    version = F.struct(F.struct(F.lit(0), *order).alias("order"), F.struct(*columns).alias("row"))
    return batch.groupBy(*key).agg(F.max(version).alias("_v")).select("_v.row.*")


def upsert_batch(spark: SparkSession, batch: DataFrame, table: str, staging_root: str, epoch: int,
                 key: list[str] | None = None, part_col: str = PARTITION) -> list:
    """Apply one batch; the touched partition values. Rows with a null key are refused."""
    key = key or KEY
    staging = f"{staging_root}/epoch={epoch}"
    if not exists(spark, f"{staging}/_SUCCESS"):
        if not batch.where(" or ".join(f"{k} is null" for k in key)).isEmpty():
            raise ValueError("a correction without a key")
        current = spark.read.parquet(table)
        fixed = newest_versions(batch, key, current.columns)
        if VERSION in current.columns:
            stored = current.select(*key, F.col(VERSION).alias("_stored"))
            not_older = F.col("_stored").isNull() | F.coalesce(F.col(VERSION) >= F.col("_stored"), F.lit(False))
            fixed = fixed.join(stored, key, "left").where(not_older).drop("_stored").select(*current.columns)
        fixed = fixed.persist()
        # Partition values that the batch touches, or that hold a corrected row: bounded by the partition count.
        old = current.select(*key, part_col).join(fixed.select(*key), key, "left_semi").select(part_col)
        months = sorted(r[0] for r in fixed.select(part_col).union(old).distinct().collect())
        if not months:
            fixed.unpersist()
            return []
        kept = current.where(F.col(part_col).isin(months)).join(fixed.select(*key), key, "left_anti")
        merged = kept.unionByName(fixed)
        order = [c for c in ("instrument_id", "trade_date", *key) if c in merged.columns]
        spread = merged.repartitionByRange(part_col, *order).sortWithinPartitions(part_col, *order)
        spread.withColumn("_months", F.lit(",".join(map(str, months)))) \
              .write.mode("overwrite").partitionBy(part_col).parquet(staging)
        fixed.unpersist()
    staged = spark.read.parquet(staging)
    kinds = spark.read.parquet(table).schema[part_col].dataType
    named = staged.select("_months").limit(1).collect()
    (staged.drop("_months").withColumn(part_col, F.col(part_col).cast(kinds))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part_col).parquet(table))
    filled = {v for v, _ in list_partitions(spark, staging, part_col)}
    months = named[0][0].split(",") if named else []
    for value, folder in list_partitions(spark, table, part_col):
        if value in months and value not in filled:  # every row of it moved to another month
            delete_path(spark, folder)
    for value, folder in list_partitions(spark, staging_root, "epoch"):
        if int(value) < epoch:
            delete_path(spark, folder)
    return [int(m) if m.lstrip("-").isdigit() else m for m in months]


def run_upserts(spark: SparkSession, inbox: str, table: str, checkpoint: str, staging_root: str,
                part_col: str = PARTITION, max_files: int = 1000):
    """Apply every correction file in ``inbox`` (Parquet, fact schema) to
    ``table`` and stop."""
    schema = spark.read.parquet(table).schema
    source = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(inbox)
              .select("*", F.col("_metadata.file_modification_time").alias(FILE_TIME)))
    q = (source.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda df, epoch: upsert_batch(spark, df, table, staging_root, epoch,
                                                      part_col=part_col))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def run_corrections(spark: SparkSession, inbox: str, root: str, checkpoint: str, max_files: int = 1000, branch: str = MAIN):
    """Apply every correction file in ``inbox`` (Parquet, columns of ``trades``) to the store at
    ``root`` and stop. A micro-batch is one delivery, known by checkpoint and number."""
    schema = open_version(spark, root, branch=branch).table("trades").schema
    source = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(inbox)
              .select("*", F.col("_metadata.file_modification_time").alias(FILE_TIME)))

    def apply(df: DataFrame, epoch: int) -> None:
        correct(df.sparkSession, root, df, f"{checkpoint}#{epoch}", [VERSION, FILE_TIME], branch=branch)

    q = source.writeStream.option("checkpointLocation", checkpoint).foreachBatch(apply).trigger(availableNow=True).start()
    q.awaitTermination()
    return q
