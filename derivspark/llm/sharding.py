"""Extendible-hash sharding.

A row's address is the leading bits of md5(key). The directory starts at the
root; a bucket over ``max_bytes`` splits on its next address bit, and only that
bucket does, until every bucket fits. Splitting needs bucket sizes only, so the
rows are aggregated once to fine cells and the directory is found from the
cells: a bucket is the shortest prefix whose bytes fit the limit.

Rows whose whole address is equal (copies of one key) cannot be told apart by
it; where such a group is over the limit, its address continues with the bits
of a per-row number, so even a key holding a third of all rows is split.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import P, stage

ADDRESS_BITS = 60
MAX_BYTES = 32 << 20
# Cells are this many bits finer than the mean shard, so that nearly all buckets
# are found from one aggregation.
CELL_SLACK_BITS = 5


def _address(key: str, text: str) -> Column:
    name = F.coalesce(F.col(key).cast("string"), F.col(text), F.lit(""))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, ADDRESS_BITS // 4), 16, 10).cast("long")


def _fit(cells: DataFrame, group: list[str], lo: int, hi: int, limit: int) -> DataFrame:
    """For each cell (``group`` + ``p`` of ``hi`` bits, ``bytes``, ``rows``) the shortest
    prefix of ``lo``..``hi`` bits that fits: ``depth``, ``prefix`` and the bucket's sums.
    Cells that fit at no depth come back with the full depth and ``fits`` false."""
    up = (cells.withColumn("depth", F.explode(F.sequence(F.lit(lo), F.lit(hi))))
          .withColumn("prefix", F.expr(f"shiftright(p, {hi} - depth)")))
    sums = up.groupBy(*group, "depth", "prefix").agg(F.sum("bytes").alias("shard_bytes"),
                                                     F.sum("rows").alias("shard_rows"))
    ok = sums.filter((F.col("shard_bytes") <= limit) | (F.col("depth") == hi))
    best = (up.select(*group, "p", "depth", "prefix").join(ok, [*group, "depth", "prefix"])
            .groupBy(*group, "p")
            .agg(F.min(F.struct("depth", "prefix", "shard_bytes", "shard_rows")).alias("s")))
    return best.select(*group, "p", "s.*").withColumn("fits", F.col("shard_bytes") <= limit)


def shard_documents(docs: DataFrame, key: str = "doc_id", text: str = "text",
                    max_bytes: int = MAX_BYTES) -> DataFrame:
    """Every row of ``docs`` with ``n_bytes``, ``shard`` (its address bits as text,
    ``root`` for the undivided table), ``shard_depth``, ``shard_bytes``, ``shard_rows``.

    Null text has 0 bytes. Rows with a null key are addressed by their text.
    Repeated rows share a shard unless their group is over the limit; then a row
    number continues the address. A single row over the limit has a shard of
    its own. An empty table gives an empty result. Columns of ``docs`` that bear
    one of the result names are replaced.
    """
    names = ("n_bytes", "shard", "shard_depth", "shard_bytes", "shard_rows")
    rows = docs.drop(*names).withColumns({
        "n_bytes": F.coalesce(F.octet_length(text), F.lit(0)).cast("long"), P + "a": _address(key, text)})
    units = stage(rows.groupBy(F.col(P + "a").alias("a"))
                  .agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("rows")), "shard-units")
    total = units.agg(F.sum("bytes")).first()[0] or 0
    bits = min(ADDRESS_BITS, max(1, math.ceil(math.log2(max(total, 1) / max_bytes)) + CELL_SLACK_BITS))
    cells = (units.groupBy(F.shiftright("a", ADDRESS_BITS - bits).alias("p"))
             .agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")))
    first = stage(_fit(cells, [], 0, bits, max_bytes), "shard-directory")
    coarse = first.filter("fits").select("p", F.lit(bits).alias("bits"), "depth", "prefix", "shard_bytes", "shard_rows")
    out = rows.withColumn(P + "p", F.shiftright(P + "a", ADDRESS_BITS - bits))
    if first.filter("not fits").isEmpty():
        return _attach(out, coarse, docs.drop(*names).columns)

    # Oversized cells: split on, to the full address. Only their units are read.
    deep_units = (units.withColumn("c", F.shiftright("a", ADDRESS_BITS - bits))
                  .join(first.filter("not fits").select(F.col("p").alias("c")), "c", "left_semi")
                  .withColumnRenamed("a", "p").drop("c"))
    deep = stage(_fit(deep_units, [], bits, ADDRESS_BITS, max_bytes), "shard-deep")
    out = out.join(coarse.select(F.col("p").alias(P + "p"), *[F.col(c).alias(P + c) for c in coarse.columns[2:]]),
                   P + "p", "left")
    fitted = out.filter(F.col(P + "depth").isNotNull())
    rest = out.filter(F.col(P + "depth").isNull()).drop(*[P + c for c in coarse.columns[2:]])
    rest = rest.join(deep.select(F.col("p").alias(P + "a"), "fits", *[F.col(c).alias(P + c) for c in coarse.columns[2:]])
                     .withColumnRenamed("fits", P + "fits"), P + "a", "left")
    copies = rest.filter(~F.col(P + "fits") & (F.col(P + "shard_rows") > 1))
    rest = rest.filter(F.col(P + "fits") | (F.col(P + "shard_rows") <= 1)).drop(P + "fits")
    columns = docs.drop(*names).columns
    result = _finish(fitted, columns).unionByName(_finish(rest, columns))
    if deep.filter("not fits and shard_rows > 1").isEmpty():
        return result

    # Copies of one key over the limit: the address goes on with a row number's bits.
    numbered = stage(copies.drop(*[P + c for c in (*coarse.columns[2:], "fits", "p")])
                     .withColumn(P + "m", F.monotonically_increasing_id()), "shard-copies")
    more = min(40, max(1, math.ceil(math.log2(max(total, 1) / max_bytes)) + CELL_SLACK_BITS + 8))
    numbered = numbered.withColumn(P + "q", F.expr(f"shiftrightunsigned(xxhash64({P}m), {64 - more})"))
    piece = (numbered.groupBy(F.col(P + "a").alias("a"), F.col(P + "q").alias("p"))
             .agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("rows")))
    split = stage(_fit(piece, ["a"], 1, more, max_bytes), "shard-copy-directory")
    tail = (numbered.join(split.select(F.col("a").alias(P + "a"), F.col("p").alias(P + "q"),
                                       *[F.col(c).alias(P + c) for c in coarse.columns[2:]]), [P + "a", P + "q"])
            .withColumn(P + "tail", _bits(F.col(P + "prefix"), F.col(P + "depth")))
            .withColumn(P + "prefix", F.col(P + "a"))
            .withColumn(P + "depth", F.col(P + "depth") + ADDRESS_BITS))
    return result.unionByName(_finish(tail, columns))


def _bits(prefix: Column, depth: Column) -> Column:
    return F.when(depth == 0, F.lit("")).otherwise(F.lpad(F.bin(prefix), depth, F.lit("0")))


def _finish(df: DataFrame, columns: list[str]) -> DataFrame:
    long = P + "tail" in df.columns
    path = (F.concat(_bits(F.col(P + "prefix"), F.lit(ADDRESS_BITS)), P + "tail") if long
            else _bits(F.col(P + "prefix"), F.col(P + "depth")))
    return df.select(*[F.col(f"`{c}`") for c in columns], "n_bytes",
                     F.when(path == "", F.lit("root")).otherwise(path).alias("shard"),
                     F.col(P + "depth").cast("int").alias("shard_depth"),
                     F.col(P + "shard_bytes").alias("shard_bytes"), F.col(P + "shard_rows").alias("shard_rows"))


def _attach(rows: DataFrame, directory: DataFrame, columns: list[str]) -> DataFrame:
    d = directory.select(F.col("p").alias(P + "p"), *[F.col(c).alias(P + c) for c in directory.columns[2:]])
    return _finish(rows.join(d, P + "p"), columns)


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """Write the rows as one folder per shard (``shard=<bits>``)."""
    (shard_documents(docs, **options).repartition("shard")
     .write.partitionBy("shard").parquet(path))
