"""Catalog access to the curated store, so the model can be queried with
plain SQL (``spark.sql("SELECT ... FROM trades t JOIN instruments i ...")``).

* ``register_views``: session temp views over the store (nothing written).
* ``register_tables``: external tables in a database whose location is in
  the shared folder, with the month partitions recovered; ``analyze``
  computes table and column statistics, which ``cost_based`` lets the optimizer
  order joins by.
* ``create_tables``: empty tables of the model with their column defaults, which an INSERT
  that names fewer columns fills in; ``drop_tables`` drops them, dependants first.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from derivspark.session import shared_root
from derivspark.schemas import DEFAULT_COUNTRY, DEFAULT_OPTION_TYPE, DEFAULT_STRIKE
from derivspark.sources.store import DIMENSIONS, Model

TABLES = [*DIMENSIONS, "trades", "daily"]
PARTITIONED = {"trades", "daily"}
# Columns the reports filter, join or group on.
STAT_COLUMNS = {
    "trades": ["trade_date", "instrument_id", "expiry_id", "contracts", "open_interest"],
    "daily": ["trade_date", "instrument_id"],
    "instruments": ["instrument_id", "exchange_id", "instrument_type", "symbol"],
    "expiries": ["expiry_id", "instrument_id", "expiry_date", "option_type"],
    "exchanges": ["exchange_id", "exchange_code"],
}


_NOW = "created_at TIMESTAMP DEFAULT current_timestamp()"
_MEASURE_DDL = ", ".join([
    *[f"{c} DECIMAL(12,2) DEFAULT 0" for c in ("open", "high", "low", "close", "settle_price")],
    "contracts BIGINT DEFAULT 0", "value_in_lakh DECIMAL(15,2) DEFAULT 0", "open_interest BIGINT DEFAULT 0",
    "change_in_oi BIGINT DEFAULT 0"])
# Columns of the model's tables, parents first.
TABLE_DDL = {
    "exchanges": f"exchange_id INT, exchange_code STRING, exchange_name STRING, country STRING DEFAULT '{DEFAULT_COUNTRY}', "
                 f"is_active BOOLEAN DEFAULT true, {_NOW}",
    "instruments": f"instrument_id INT, exchange_id INT, instrument_type STRING, symbol STRING, series STRING, {_NOW}",
    "expiries": f"expiry_id INT, instrument_id INT, expiry_date DATE, strike_price DECIMAL(12,2) DEFAULT {DEFAULT_STRIKE}, "
                f"option_type STRING DEFAULT '{DEFAULT_OPTION_TYPE}', is_active BOOLEAN DEFAULT true, {_NOW}",
    "trades": f"trade_id BIGINT, expiry_id INT, instrument_id INT, trade_date DATE, {_MEASURE_DDL}, timestamp TIMESTAMP_NTZ, "
              f"{_NOW}, trade_month INT",
}


def create_tables(spark: SparkSession, database: str, location: str | None = None) -> None:
    """The model's four tables, where absent, with their defaults (load time included)."""
    place = location or f"{shared_root(spark)}/derivspark/warehouse/{database}.db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{place}'")
    for t, columns in TABLE_DDL.items():
        part = " PARTITIONED BY (trade_month)" if t == "trades" else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{t} ({columns}) USING parquet{part}")


def drop_tables(spark: SparkSession, database: str) -> list[str]:
    """Drop the model's tables in dependency order, facts first; names of those that were there."""
    dropped = []
    for t in reversed(TABLE_DDL):
        if spark.catalog.tableExists(f"{database}.{t}"):
            spark.sql(f"DROP TABLE {database}.{t}")
            dropped.append(t)
    return dropped


@contextmanager
def cost_based(spark: SparkSession) -> Iterator[None]:
    """Order joins by the stored statistics of ``analyze`` while inside."""
    keys = ("spark.sql.cbo.enabled", "spark.sql.cbo.joinReorder.enabled", "spark.sql.cbo.planStats.enabled")
    before = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "true")
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def register_views(model: Model, prefix: str = "") -> list[str]:
    names = []
    for t in TABLES:
        getattr(model, t).createOrReplaceTempView(prefix + t)
        names.append(prefix + t)
    return names


def register_tables(spark: SparkSession, model: Model, database: str = "derivspark") -> list[str]:
    location = f"{shared_root(spark)}/derivspark/warehouse/{database}.db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    names = []
    for t in TABLES:
        name = f"{database}.{t}"
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: the store files are kept
        spark.catalog.createTable(name, path=f"{model.root}/{t}", source="parquet")
        if t in PARTITIONED:
            spark.catalog.recoverPartitions(name)
        names.append(name)
    return names


def analyze(spark: SparkSession, database: str = "derivspark") -> None:
    """Table statistics (size, rows) and column statistics (min/max, distinct
    counts, nulls) for the cost-based optimizer."""
    for t, cols in STAT_COLUMNS.items():
        spark.sql(f"ANALYZE TABLE {database}.{t} COMPUTE STATISTICS FOR COLUMNS {', '.join(cols)}")
