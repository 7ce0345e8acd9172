"""SparkSession construction and the shared scratch / store location.

Everything the engine writes (curated store, scratch tables for the
storage and streaming jobs, checkpoints) lives under the folder the
cluster names in ``spark.checkpoint.dir``. A fresh local directory is
created only when that setting is absent (tests, ad-hoc local runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every session of the engine relies on. Shuffle partitions are
# sized per deployment; AQE coalesces small shuffles and splits skewed
# join partitions at runtime.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
    # Malformed raw CSV lines are only detected when all fields are parsed.
    "spark.sql.csv.parser.columnPruning.enabled": "false",
    # Streaming dedupe state grows with the ingest rate: keep it off-heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Recurring reports reuse their compiled whole-stage code; the default
    # cache (100 classes) is smaller than the report set's working set.
    "spark.sql.codegen.cache.maxEntries": "2000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

_LOCAL_ROOT: str | None = None
_ROOTS: dict[str, str] = {}  # application id -> shared root (reading the conf is a JVM round trip)


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "derivspark", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_session_conf(spark)
    return spark


def sizing_conf(input_bytes: int, executors: int, cores_per_executor: int,
                target_partition_bytes: int = 256 << 20) -> dict:
    """Partition sizing for a given input volume: scan splits and shuffle
    partitions around ``target_partition_bytes`` (fits executor memory, spills
    gracefully), never fewer shuffle partitions than task slots; AQE then
    coalesces small shuffles and splits skewed ones at runtime."""
    slots = executors * cores_per_executor
    shuffle = max(slots, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def apply_session_conf(spark: SparkSession) -> None:
    """Pin the SQL settings the engine's semantics depend on (time zone, CSV
    malformed-line detection, streaming state store) on an existing session."""
    # (partition overwrite mode is set per write where a job needs it)
    for k in ("spark.sql.session.timeZone", "spark.sql.csv.parser.columnPruning.enabled",
              "spark.sql.streaming.stateStore.providerClass"):
        spark.conf.set(k, BASE_CONF[k])


# What a task of a build reads at most, folders that it writes side by side (more are sorted first), and
# shuffle files that go when their job ends (else they stay until the driver collects its garbage).
BOUNDED = {"spark.sql.files.maxPartitionBytes": str(32 << 20), "spark.sql.maxConcurrentOutputFileWriters": "8",
           "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def bounded_tasks(spark: SparkSession) -> Iterator[None]:
    """Tables written inside are read in small pieces and written to a few folders at once without a
    sort, so a task's memory doesn't grow with the table and nothing spills; a job's shuffle files
    don't outlive it."""
    before = {k: spark.conf.get(k, None) for k in BOUNDED}
    for k, v in BOUNDED.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shared_root(spark: SparkSession) -> str:
    """The shared folder for written tables and checkpoints.

    Reads ``spark.checkpoint.dir`` from the session; only when it is unset
    (tests, local runs) a private directory is created and registered as the
    checkpoint dir; on a cluster that would be a folder of one machine, so it is refused.
    """
    global _LOCAL_ROOT
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _ROOTS:
        return _ROOTS[app]
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset config raises
            root = None
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        if _LOCAL_ROOT is None:
            _LOCAL_ROOT = tempfile.mkdtemp(prefix="derivspark-")
            sc.setCheckpointDir(os.path.join(_LOCAL_ROOT, "checkpoints"))
        root = _LOCAL_ROOT
    elif sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    _ROOTS[app] = root.rstrip("/")
    return _ROOTS[app]


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared root for one job's output."""
    return f"{shared_root(spark)}/derivspark/scratch/{name}-{uuid.uuid4().hex[:12]}"
