"""Result sinks: CSV files with a header (written by the executors) and
console tables. Only already-limited results may be squeezed into one file
or printed; full-size results stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_result_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """One CSV folder per result; ``single_file`` (one task) is meant for
    LIMIT-ed reports only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", "true").csv(path)
    return path


def print_result(df: DataFrame, n: int | None = None) -> None:
    """Print a result: all of its rows (streamed, a partition at a time), or the first ``n``."""
    if n is not None:
        df.show(n, truncate=False)
        return
    print(" | ".join(df.columns))
    for row in df.toLocalIterator():
        print(" | ".join("NULL" if v is None else str(v) for v in row))
