"""Helpers shared by the operators: staged tables, hash splits, word arrays."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from derivspark.session import scratch_dir

# ASCII white space: U+0020 and U+0009..U+000D (the same set as bytes.split()).
SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACE_RUN = "[ \\t-\\r]+"
WORD = "[^\\x20\\x09-\\x0D]+"

# Scratch column names carry this prefix, so a caller's extra columns never clash.
P = "__llm_"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back: cuts the
    lineage at a table every executor can reread, and gives Catalyst its size."""
    spark = df.sparkSession
    path = scratch_dir(spark, f"llm-{name}-{uuid.uuid4().hex[:6]}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod(key: str, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus`` (null for a null key)."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % F.lit(modulus)


def words(col: Column) -> Column:
    """Array of the maximal runs of non-space characters; empty for null or blank text."""
    trimmed = F.btrim(F.coalesce(col, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def n_words(col: Column) -> Column:
    """Number of words of a text, as long (null: 0)."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def smallest(df: DataFrame, order: str, n: int) -> DataFrame:
    """The rows with the ``n`` smallest values of a hash column (and its ties). Only that
    column is sorted; the rows themselves are filtered where they are."""
    cut = df.select(order).orderBy(order).limit(n).agg(F.max(order)).first()[0]
    return df.limit(0) if cut is None else df.filter(F.col(order) <= cut)


FILTER_SPOTS, FILTER_BITS, FILTER_MOST = 4, 16, 26  # bits set a key, bits a key, log2 of a filter's size at most (8 MB)


class KeyFilter:
    """A Bloom filter of the one column of ``keys``: ``has`` is true for every value that occurs
    there and false for nearly all others. Rows that fail it need no shuffle; those that pass
    still have to be joined. It has at most 8 MB; beyond some ten million keys it lets more
    rows pass, and loses none."""

    def __init__(self, keys: DataFrame):
        self.size = 1 << min(max((FILTER_BITS * keys.count()).bit_length(), 12), FILTER_MOST)
        low, high = F.col("h").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("h", 32)
        spots = F.array(*[(low + high * F.lit(i)).bitwiseAND(F.lit(self.size - 1)) for i in range(FILTER_SPOTS)])
        found = (keys.select(F.xxhash64(keys.columns[0]).alias("h")).select(F.explode(spots).alias("spot"))
                 .groupBy(F.shiftright("spot", 6).alias("word"))
                 .agg(F.expr("bit_or(shiftleft(1L, cast(spot & 63 as int)))").alias("bits")).toArrow())
        bits = np.zeros(self.size >> 6, np.uint64)
        bits[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
        self.shared = ship(keys).sparkSession.sparkContext.broadcast(bits)

    def has(self, h: np.ndarray) -> np.ndarray:
        """Of values by their ``xxhash64``, in a task."""
        words, h, good = self.shared.value, h.view(np.uint64), np.ones(len(h), bool)
        low, high = h & np.uint64(0xFFFFFFFF), h >> np.uint64(32)
        for i in range(FILTER_SPOTS):
            spot = (low + np.uint64(i) * high) & np.uint64(self.size - 1)
            good &= (words[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63)) & np.uint64(1)).astype(bool)
        return good


def maybe_in(keys: DataFrame | KeyFilter) -> Callable[[Column], Column]:
    """A condition on a column of the type of ``keys``' one column, by ``KeyFilter``."""
    known = keys if isinstance(keys, KeyFilter) else KeyFilter(keys)

    @F.arrow_udf("boolean")
    def passes(h: pa.Array) -> pa.Array:
        return pa.array(known.has(h.to_numpy(zero_copy_only=False)))

    return lambda col: passes(F.xxhash64(col))


_shipped: set[str] = set()


def ship(df: DataFrame) -> DataFrame:
    """Make this package importable in Python workers (once per application), so
    operators run where only the driver has it on its path. Returns ``df``."""
    sc = df.sparkSession.sparkContext
    if sc.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="derivspark-ship-")) / "derivspark_llm.zip"
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
            for f in (root / "__init__.py", root / "session.py", root / "operators/__init__.py", root / "operators/ids.py",
                      *sorted((root / "llm").glob("*.py"))):
                z.write(f, f.relative_to(root.parent))
        sc.addPyFile(str(archive))  # Spark copies it to every executor
        _shipped.add(sc.applicationId)
    return df
