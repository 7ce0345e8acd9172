"""Reader for the driver-provided parquet tables."""

from __future__ import annotations

import os
import stat

from pyspark.sql import DataFrame, SparkSession

from derivspark.sources.fs import file_stats

DEFAULT_SF_DIR = "/root/testdata/sf0.01"


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def fingerprint(spark: SparkSession, sf_dir: str, names: list[str]) -> str:
    """Identity of the input files (name, length and time of every file) so a
    derived store is rebuilt when its inputs change, on any file system."""
    parts = []
    for n in names:
        p = table_path(sf_dir, n)
        try:
            st = os.stat(p)
        except OSError:
            st = None
        if st is not None and stat.S_ISREG(st.st_mode):
            parts.append(f"{n}:{st.st_size}:{st.st_mtime_ns // 1_000_000}")
        else:
            parts.append(f"{n}:{file_stats(spark, p)}")
    return "|".join(parts)
