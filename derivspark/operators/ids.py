"""Dense, reproducible surrogate keys without a one-partition window.

``ROW_NUMBER() OVER (ORDER BY k)`` over a whole table makes Spark move every
row into a single task. Instead the rows are range-partitioned and sorted by
the whole key once, and written with their (task, row in task) position; the
number of rows in each task (one row per range partition) becomes its start
offset, and ``offset + row`` is the id. Ids are 1..n, unique, and follow the
natural order (bucket columns, order columns; NULLs first) at every size.

Rows that agree in the whole key cannot be told apart by ranges, so with
``copies`` the input is written first and each row's place in that table
becomes the last sort column (or ``tie_col``, where the caller has such a
column): a group of copies of any size is split over tasks like any other
rows. Copies differ in nothing but their ids, so the result is the same on
every run. The written tables make retried tasks see the same rows in the
same order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from derivspark.session import scratch_dir

# monotonically_increasing_id: task number above this bit, row number below.
TASK_SHIFT = 33
# Rows that a task of a range sort takes, where the number of rows is known.
ROWS_A_TASK = 500_000


def by_range(df: DataFrame, keys: list[str], rows: int | None = None) -> DataFrame:
    """``df`` range partitioned by ``keys``: by the session's shuffle partitions, or by as many as ``rows``
    rows need, so that a task's share doesn't grow with the table."""
    n = -(-(rows or 0) // ROWS_A_TASK)
    return df.repartitionByRange(*([n] if n > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else []), *keys)


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dense_ids(df: DataFrame, order_cols: list[str], id_col: str, bucket_cols: list[str] | tuple = (),
              copies: bool = False, id_type: str = "bigint", stage_dir: str | None = None,
              tie_col: str | None = None, rows: int | None = None) -> DataFrame:
    """``df`` with ``id_col``: its rank by (``bucket_cols``, ``order_cols``). ``copies``: the
    key may repeat, in rows that are equal in every column; ``tie_col``: a column that
    differs in every row and stays the same when a task is run again, left out of the
    result (without it ``copies`` writes the rows first). ``stage_dir``: a folder for
    the written steps, which must outlive the result (default: a new scratch folder).
    ``rows``: see ``by_range``."""
    root = stage_dir or scratch_dir(df.sparkSession, f"ids-{id_col}")
    cols, keys = [c for c in df.columns if c != tie_col], [*bucket_cols, *order_cols]
    if copies and not tie_col:
        tie_col = "_copy"
        df = _written(df, f"{root}/rows").withColumn(tie_col, F.monotonically_increasing_id())
    if tie_col:
        keys.append(tie_col)
    ranked = _written(by_range(df, keys, rows).sortWithinPartitions(*keys)
                      .withColumn("_at", F.monotonically_increasing_id()).select(*cols, "_at"), f"{root}/ranked")
    ranked = ranked.withColumn("_task", F.shiftright("_at", TASK_SHIFT))
    # One row per range partition: bounded by spark.sql.shuffle.partitions.
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranked.groupBy("_task").agg(F.count(F.lit(1)).alias("_rows")) \
        .select("_task", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_off"))
    row = F.col("_at").bitwiseAND(F.lit((1 << TASK_SHIFT) - 1))
    return ranked.join(F.broadcast(offsets), "_task") \
        .select(*cols, (F.col("_off") + row + 1).cast(id_type).alias(id_col))
