"""Side-by-side pivots, rolling window statistics, top-k and histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def side_by_side(df: DataFrame, group_cols: list[str], key_col: str,
                 keys: dict[str, str], measures: dict[str, str], fill=None) -> DataFrame:
    """Conditional pivot ``MAX(CASE WHEN key = k THEN m [ELSE fill] END)``.

    ``keys`` maps key value -> column prefix, ``measures`` maps measure ->
    column suffix; output columns are ``prefix + suffix``. With ``fill=None``
    a missing side is NULL, otherwise ``fill`` (note: a 0 fill hides negative
    values under MAX, as in the original). The key list is fixed, so no
    extra job is needed to discover pivot values.
    """
    aggs = []
    for value, prefix in keys.items():
        for m, suffix in measures.items():
            cell = F.when(F.col(key_col) == value, F.col(m))
            if fill is not None:
                cell = cell.otherwise(F.lit(fill))
            aggs.append(F.max(cell).alias(f"{prefix}{suffix}"))
    return df.groupBy(*group_cols).agg(*aggs)


def rolling_frame(partition_cols: list[str], order_col: str, rows: int = 7):
    """Window over the current and ``rows - 1`` preceding ROWS (trading days
    present, not calendar days). Sharing one spec lets Spark compute all
    rolling columns in a single sort + window pass."""
    return Window.partitionBy(*partition_cols).orderBy(order_col).rowsBetween(-(rows - 1), 0)


def rolling_stats(df: DataFrame, partition_cols: list[str], order_col: str, value_col: str,
                  rows: int = 7, stddev: str | None = None, mean: str | None = None,
                  count: str | None = None) -> DataFrame:
    w = rolling_frame(partition_cols, order_col, rows)
    out = df
    if stddev:
        out = out.withColumn(stddev, F.stddev_samp(value_col).over(w))
    if mean:
        out = out.withColumn(mean, F.avg(F.col(value_col).cast("double")).over(w))
    if count:
        out = out.withColumn(count, F.count(F.lit(1)).over(w))
    return out


def top_k_per_group(df: DataFrame, group_cols: list[str], order: list[Column], k: int,
                    rank_col: str | None = None) -> DataFrame:
    """ROW_NUMBER() per group <= k. Spark plans this as a WindowGroupLimit
    below the shuffle, so each task keeps only k rows per group."""
    w = Window.partitionBy(*group_cols).orderBy(*order)
    rn = F.row_number().over(w)
    name = rank_col or "_rn"
    out = df.withColumn(name, rn.cast("bigint")).where(F.col(name) <= k)
    return out if rank_col else out.drop(name)


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """ORDER BY ... LIMIT k: a per-task heap then a k-row merge
    (TakeOrderedAndProject); ``order`` must be total for a stable cut."""
    return df.orderBy(*order).limit(k)


def distinct_counts(df: DataFrame, keys: list[str], counted: dict[str, str]) -> DataFrame:
    """``keys`` and, for each name -> column of ``counted``, the number of its distinct values. Each
    column is brought to its distinct values first (per task, then per key) and counted
    after, from a scan of that column alone, where several COUNT(DISTINCT) in one aggregate would
    copy every row once a column."""
    out = None
    for name, c in counted.items():
        one = df.select(*keys, c).distinct().groupBy(*keys).agg(F.count(c).alias(name))
        if out is None:
            out = one
        else:
            other = one.select(*[F.col(k).alias(f"_{k}") for k in keys], name)
            same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
            out = out.join(other, same).drop(*[f"_{k}" for k in keys])
    return out


def pivot_discovered(df: DataFrame, keys: list[str], column: str, value: str, max_columns: int = 1000) -> DataFrame:
    """Long to wide, a column a value of ``column`` that occurs (as text, in order): a first pass finds
    the values, at most ``max_columns`` of them (an error beyond), a second one pivots with them
    known. Missing cells are NULL; rows without a value of ``column`` are left out."""
    rows = df.where(F.col(column).isNotNull()).withColumn("_name", F.col(column).cast("string"))
    names = sorted(r[0] for r in rows.select("_name").distinct().limit(max_columns + 1).collect())
    if len(names) > max_columns:
        raise ValueError(f"more than {max_columns} values of {column}: keep the long form")
    return rows.groupBy(*keys).pivot("_name", names).agg(F.first(value, ignorenulls=True))


def equal_width_histogram(values: DataFrame, value_col: str, bins: int = 50,
                          bounds: DataFrame | None = None) -> DataFrame:
    """Equal-width histogram over [min, max] (last bin closed, like numpy).

    min/max come from one global aggregate used as scalar subqueries (Spark
    merges them into a single partial+final aggregate) — over ``values``, or
    over a precomputed one-row ``bounds`` frame with columns lo, hi (e.g.
    from a roll-up, sparing a second pass over the values); each value is
    binned with column arithmetic and counted per bin (partial aggregation
    per task); every bin, empty ones included, is reported.
    """
    v = F.col(value_col).cast("double")
    if bounds is None:
        bounds = values.agg(F.min(v).alias("lo"), F.max(v).alias("hi"))
    else:
        bounds = bounds.select(F.col("lo").cast("double").alias("lo"), F.col("hi").cast("double").alias("hi"))
    lo = bounds.select("lo").scalar()
    hi = bounds.select("hi").scalar()
    width = (hi - lo) / bins
    idx = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((v - lo) / F.nullif(width, F.lit(0))), F.lit(bins - 1)))
    counts = (values.where(F.col(value_col).isNotNull())
              .select(idx.cast("int").alias("bin"))
              .groupBy("bin").agg(F.count(F.lit(1)).alias("frequency")))
    grid = values.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (grid.join(counts, "bin", "left")
            .select("bin",
                    (lo + F.col("bin") * width).alias("lo"),
                    (lo + (F.col("bin") + 1) * width).alias("hi"),
                    F.coalesce("frequency", F.lit(0)).cast("bigint").alias("frequency")))


# Uniform sampling key: xxhash64 folded onto [0, SAMPLE_MOD).
SAMPLE_MOD = 2**61 - 1


def hash_sample(df: DataFrame, n: int, key_cols: list[str]) -> DataFrame:
    """A reproducible n-row sample: the rows with the n smallest
    (pmod(xxhash64(keys), M), keys). The same input gives the same sample on
    any cluster and across task retries (unlike an arbitrary LIMIT).

    ORDER BY + LIMIT n alone would merge every task's top n in one task;
    instead the rows are counted once and only those whose hash value falls
    below a threshold sized for ~1.1 n + 1000 expected survivors are kept,
    then the exact top n of that small set is taken. If fewer than n survive
    (rare), the threshold is widened; the result is exact either way."""
    u = F.pmod(F.xxhash64(*key_cols), F.lit(SAMPLE_MOD))
    keyed = df.withColumn("_u", u)
    total = df.count()
    if total <= n:
        return df
    frac = min(1.0, (1.1 * n + 1000) / total)
    while True:
        cut = keyed.where(F.col("_u") < F.lit(int(frac * SAMPLE_MOD)))
        if frac >= 1.0 or cut.count() >= n:
            break
        frac = min(1.0, frac * 2)
    return cut.orderBy("_u", *key_cols).limit(n).drop("_u")
