"""Continuous ingest of raw feed files (Structured Streaming).

File source over the raw CSV folders -> the same lenient typed projection as the batch loader ->
one version of the target a micro-batch (``sources/versions.py``). Rows have no key, so files
are what is recognised: every line of every new file is stored, and a file that is sent again
(delivery, name, length, checksum) adds nothing; see ``maintain.new_files``. Data, rejected
lines and the ledger of files appear together or not at all, so a batch that broke off
and is tried again is neither lost nor doubled. There is no watermark, so a late delivery
(another exchange, an older day) is never dropped.

Targets: the model itself (``into_model``: dimensions, facts and aggregates, as a batch load), or a
landing store with the tables ``feed`` (typed rows by month), ``rejects`` and ``files``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from derivspark.functions.metrics import month_key
from derivspark.plans.maintain import FILE, LINE, SIZE, hashed, load_files, new_files
from derivspark.schemas import RAW_COLUMNS
from derivspark.sources.raw_feed import CORRUPT, stream_raw_lines, typed_feed
from derivspark.sources.versions import MAIN, Transaction, Version, update

PARTITION = "trade_month"
MAX_FILES = 1000


def ingest_stream(raw: DataFrame) -> DataFrame:
    """Typed rows with their file, its length, hashes and the text of lines that may become no row."""
    text = F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(*RAW_COLUMNS)))
    named = raw.withColumns({FILE: F.col("_metadata.file_path"), SIZE: F.col("_metadata.file_size"), LINE: text})
    return hashed(typed_feed(named, keep=(CORRUPT, LINE, FILE, SIZE)))


def ingest_batch(spark: SparkSession, batch: DataFrame, root: str, on_step=None) -> Version:
    """Land the lines of the batch's new files."""
    def change(t: Transaction) -> bool | None:
        new = new_files(t, batch)
        if new is None:
            return False
        reason = F.when(F.col(CORRUPT).isNotNull(), "malformed line").when(F.col("timestamp").isNull(), "no trade date")
        rows = new[0].withColumn("_reason", reason)
        good = rows.where(F.col("_reason").isNull()).drop("_reason", CORRUPT, LINE)
        t.add("feed", good.withColumn(PARTITION, month_key(F.to_date("timestamp"))), PARTITION)
        t.add("rejects", rows.where(F.col("_reason").isNotNull())
              .select("exchange_id", F.col("_reason").alias("reason"), F.col(LINE).alias("line")))
    return update(spark, root, "ingest", change, on_step=on_step)


def run_ingest(spark: SparkSession, raw_dir: str, root: str, checkpoint: str, available_now: bool = True,
               max_files: int = MAX_FILES, into_model: bool = False, branch: str = MAIN):
    """Start the ingest query; with ``available_now`` it processes what is in ``raw_dir`` and stops."""
    def store(df: DataFrame, epoch: int) -> None:
        if into_model:
            load_files(df.sparkSession, root, df, branch=branch)
        else:
            ingest_batch(df.sparkSession, df, root)

    writer = (ingest_stream(stream_raw_lines(spark, raw_dir, max_files)).writeStream
              .option("checkpointLocation", checkpoint).foreachBatch(store))
    q = (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")).start()
    if available_now:
        q.awaitTermination()
    return q
