"""Curated store: the four normalised tables as Parquet.

Layout under ``<root>/``::

    exchanges/  instruments/  expiries/   small dimension tables
    trades/trade_month=YYYYMM/...          fact, range-partitioned on
                                           (period, instrument, date, id) and
                                           sorted within files, so row-group
                                           min/max stats skip by instrument/date
    daily/trade_month=YYYYMM/...           exact per (instrument, day) aggregates

The partition grain is a build parameter: month (default), week
(``trade_week=YYYYMMDD`` of the Monday) or day (``trade_day=YYYYMMDD``) —
finer grains for high volume: tighter pruning, smaller partition rewrites.
                                           (sums and counts) for symbol/day reports
    _meta/                                 row counts, written last = commit mark

The row counts recorded in ``_meta`` are the proven size bound used to
decide broadcasts of the dimensions.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from derivspark.functions.metrics import GRAINS, period_value
from derivspark.operators.joins import max_broadcast_rows, maybe_broadcast
from derivspark.plans import normalize as N
from derivspark.plans.rollup import daily_aggregates
from derivspark.session import bounded_tasks, shared_root
from derivspark.sources import fixtures
from derivspark.sources.fs import delete_path, exists, list_partitions, publish
from derivspark.sources.testdata import fingerprint
from derivspark.sources.versions import MAIN, Version, open_version

DIMENSIONS = ["exchanges", "instruments", "expiries"]
# Bumped whenever the stored layout changes, so an old store is not reused.
STORE_VERSION = 12
# Largest instrument-id list pushed into the fact scan as a literal IN.
MAX_PUSHED_KEYS = 2000


def id_in(col: str, ids: list[int]):
    """``col IN (ids)`` built as one SQL expression (one call into the JVM
    instead of one per literal); pushed into Parquet as an In filter."""
    return F.expr(f"{col} IN ({', '.join(str(int(i)) for i in ids)})") if ids else F.lit(False)


def as_date(d) -> date | None:
    if d is None or isinstance(d, date):
        return d
    return date.fromisoformat(str(d))


@dataclass
class Model:
    spark: SparkSession
    exchanges: DataFrame
    instruments: DataFrame
    expiries: DataFrame
    trades: DataFrame
    daily: DataFrame | None = None
    rows: dict = field(default_factory=dict)
    root: str | None = None
    memo: dict = field(default_factory=dict)  # per-model lookups (last date, key lists)
    grain: str = "month"
    periods: list[int] | None = None  # partition values, where they are known (stores with versions)

    @property
    def part_col(self) -> str:
        return GRAINS[self.grain]

    def period(self, d) -> int:
        return period_value(d, self.grain)

    def _date_range(self, df: DataFrame, lo, hi, hi_exclusive: bool = False) -> DataFrame:
        """lo <= trade_date <= hi (or < hi) plus the matching partition
        predicate, so the scan prunes partition folders; the date predicate
        itself is pushed into the Parquet reader."""
        lo, hi = as_date(lo), as_date(hi)
        p = F.col(self.part_col)
        if lo is not None:
            df = df.where((p >= self.period(lo)) & (F.col("trade_date") >= F.lit(lo)))
        if hi is not None:
            date_pred = F.col("trade_date") < F.lit(hi) if hi_exclusive else F.col("trade_date") <= F.lit(hi)
            df = df.where((p <= self.period(hi)) & date_pred)
        return df

    def trades_between(self, lo=None, hi=None, hi_exclusive: bool = False) -> DataFrame:
        """Trades with lo <= trade_date <= hi (or < hi), partitions pruned."""
        return self._date_range(self.trades, lo, hi, hi_exclusive)

    def daily_between(self, lo=None, hi=None) -> DataFrame:
        """Daily roll-up rows with lo <= trade_date <= hi, partitions pruned."""
        return self._date_range(self.daily, lo, hi)

    def last_trade_date(self) -> date:
        """max(trade_date), resolved in two cheap steps: the newest period
        from the partition folder names, then the max date inside that one
        partition. Returned as a literal so later filters still prune."""
        if "last_date" not in self.memo:
            periods = self.periods
            if periods is None:
                periods = [int(v) for v, _ in list_partitions(self.spark, f"{self.root}/trades", self.part_col)]
            t = self.trades.where(F.col(self.part_col) == max(periods)) if periods else self.trades
            self.memo["last_date"] = t.agg(F.max("trade_date")).first()[0]
        return self.memo["last_date"]

    def last_days(self, days: int, as_of=None) -> DataFrame:
        """Trades with trade_date >= as_of - days (as_of defaults to the
        last trade date in the data, standing in for CURRENT_DATE)."""
        as_of = as_date(as_of) or self.last_trade_date()
        return self.trades_between(as_of - timedelta(days=days))

    def instrument_keys(self, cond) -> list[int] | None:
        """Ids of the instruments matching ``cond`` when there are at most
        ``MAX_PUSHED_KEYS`` of them (else None). Resolved once per predicate
        from the small dimension."""
        memo = self.memo.setdefault("instrument_keys", {})
        k = str(cond)
        if k not in memo:
            ids = [r[0] for r in self.instruments.where(cond).select("instrument_id")
                   .limit(MAX_PUSHED_KEYS + 1).collect()]
            memo[k] = sorted(ids) if len(ids) <= MAX_PUSHED_KEYS else None
        return memo[k]

    def trades_of(self, cond, lo=None, hi=None, hi_exclusive: bool = False) -> DataFrame:
        """Trades of the instruments matching ``cond`` (and in a date range).

        When few instruments match, their ids are pushed into the Parquet
        scan as a literal IN list: fact files are sorted by instrument within
        each partition, so min/max statistics skip files and row groups of
        other instruments, and no join is needed. Otherwise a semi-join with
        the filtered dimension (checked broadcast) applies the predicate."""
        t = self.trades_between(lo, hi, hi_exclusive)
        ids = self.instrument_keys(cond)
        if ids is not None:
            return t.where(id_in("instrument_id", ids))
        keys = self.instruments.where(cond).select("instrument_id")
        return t.join(maybe_broadcast(keys, self.rows.get("instruments")), "instrument_id", "left_semi")

    def dim(self, name: str, *cols: str) -> DataFrame:
        """A projected dimension, hinted for broadcast when its recorded row
        count is under the bound."""
        df = getattr(self, name)
        if cols:
            df = df.select(*cols)
        return maybe_broadcast(df, self.rows.get(name))

    def dim_filtered(self, df: DataFrame, name: str) -> DataFrame:
        """A filtered/projected dimension: its size is bounded by the
        recorded row count of the whole dimension."""
        return maybe_broadcast(df, self.rows.get(name))

    def with_instrument(self, trades: DataFrame, *cols: str) -> DataFrame:
        cols = cols or ("symbol",)
        return trades.join(self.dim("instruments", "instrument_id", *cols), "instrument_id")

    def instrument_view(self) -> DataFrame:
        """instruments ⋈ exchanges (both bounded dimensions), built once and
        kept in memory, so a report needs one broadcast instead of two."""
        if "instrument_view" not in self.memo:
            view = self.instruments.join(self.exchanges.select("exchange_id", "exchange_code"), "exchange_id")
            if self.rows.get("instruments", 0) <= max_broadcast_rows(self.spark):
                view = view.cache()
            self.memo["instrument_view"] = view
        return self.memo["instrument_view"]

    def with_exchange(self, trades: DataFrame, *cols: str) -> DataFrame:
        """trades -> instruments -> exchanges (snowflake chain)."""
        inst = self.instrument_view().select("instrument_id", "exchange_code", *cols)
        return trades.join(maybe_broadcast(inst, self.rows.get("instruments")), "instrument_id")

    def with_contract(self, trades: DataFrame, *cols: str) -> DataFrame:
        """Explicit join with the contract dimension (the fact also carries
        these attributes; see ``normalize.build_trades(covering=True)``)."""
        cols = cols or ("expiry_date", "strike_price", "option_type")
        return trades.drop(*cols).join(self.dim("expiries", "expiry_id", *cols), "expiry_id")


_CACHE: dict[str, Model] = {}


def store_root(spark: SparkSession, sf_dir: str, grain: str = "month") -> str:
    key = f"v{STORE_VERSION}#{grain}#{sf_dir}#" + fingerprint(spark, sf_dir, fixtures.INPUT_TABLES)
    digest = hashlib.sha1(key.encode()).hexdigest()[:16]
    return f"{shared_root(spark)}/derivspark/store/{digest}"


def _write_counted(df: DataFrame, path: str, partition_by: str | None = None) -> int:
    obs = Observation(path.rsplit("/", 1)[-1])
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("compression", "zstd")
    (w.partitionBy(partition_by) if partition_by else w).parquet(path)
    return obs.get["rows"]


def write_model(spark: SparkSession, feed: DataFrame, root: str, grain: str = "month") -> dict:
    """Normalise ``feed`` and write the four tables and the daily roll-up;
    returns row counts.

    The typed feed is staged once as Parquet (the loader's temporary
    ``raw_data`` table): each table build then reads only the columns it
    needs instead of recomputing the feed, and the lineage is cut at a
    written table in the shared folder. The stage is removed at the end.
    """
    rows = {}
    stage = f"{root}/_feed"
    # Load counters are collected while the data is written (DataFrame.observe),
    # not by re-reading the written files.
    fed = Observation("feed")
    feed.observe(fed, F.count(F.lit(1)).alias("rows"),
                 F.sum(F.when(F.col("timestamp").isNull() | F.col("expiry_date").isNull(), 1).otherwise(0))
                 .alias("rejected")).write.mode("overwrite").option("compression", "zstd").parquet(stage)
    rows["feed"], rows["rejected"] = fed.get["rows"], fed.get["rejected"] or 0
    feed = spark.read.parquet(stage)
    ex = N.exchange_dim(spark)
    ex.write.mode("overwrite").parquet(f"{root}/exchanges")
    rows["exchanges"] = len(N.EXCHANGE_ROWS)

    # Both dimensions derive from the distinct contract tuples (one pass over
    # the feed; the result is small — one row per contract — and kept in
    # memory for the two builds, recomputed from lineage if a block is lost).
    contracts = N.fill_contract_keys(feed).select(*N.INSTRUMENT_KEY, *N.CONTRACT_ATTRS).distinct() \
        .persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows["instruments"] = _write_counted(N.build_instruments(contracts), f"{root}/instruments")
        inst = spark.read.parquet(f"{root}/instruments")
        rows["expiries"] = _write_counted(N.build_expiries(contracts, inst, rows["instruments"]),
                                          f"{root}/expiries")
    finally:
        contracts.unpersist()
    exp = spark.read.parquet(f"{root}/expiries")

    # One range sort on (period, instrument, date, rest, place) gives the ids and the files' layout: it
    # splits any hot instrument/day over several files (the place makes every key unique), and
    # the order within files gives tight row-group min/max statistics on instrument and date.
    part = GRAINS[grain]
    placed = feed.withColumn("_place", F.monotonically_increasing_id())  # a row's place in the written feed
    trades = N.build_trades(placed, inst, exp, lookup_rows=rows["expiries"], covering=True,
                            stage_dir=f"{root}/_ids", tie_col="_place", grain=grain, n_rows=rows["feed"])
    rows["trades"] = _write_counted(N.written_order(trades, grain), f"{root}/trades", partition_by=part)
    # Daily roll-up from the written fact (partial aggregation per task; one
    # output row per instrument and day, range-split on that unique key).
    rows["daily"] = _write_counted(
        daily_aggregates(spark.read.parquet(f"{root}/trades"), part)
        .repartitionByRange(part, "instrument_id", "trade_date")
        .sortWithinPartitions(part, "instrument_id", "trade_date"),
        f"{root}/daily", partition_by=part)

    spark.createDataFrame([(k, int(v)) for k, v in rows.items()], "table string, n_rows bigint") \
        .coalesce(1).write.mode("overwrite").parquet(f"{root}/_meta")
    delete_path(spark, stage)
    delete_path(spark, f"{root}/_ids")
    return rows


def model_of(version: Version) -> Model:
    """The model of one version of a store: later changes of the store are not seen."""
    spark, grain = version.spark, version.info["grain"]
    rows = {n: version.rows(n) for n in [*DIMENSIONS, "trades", "daily"]}
    rows.update({n: version.info[n] for n in ("feed", "rejected")})
    t = {n: version.table(n) for n in [*DIMENSIONS, "trades", "daily"]}
    for n in DIMENSIONS:
        if rows[n] <= max_broadcast_rows(spark):
            t[n] = t[n].cache()
    return Model(spark, t["exchanges"], t["instruments"], t["expiries"], t["trades"], t["daily"], rows, version.root,
                 grain=grain, periods=version.partitions("trades"))


def read_model(spark: SparkSession, root: str, version: int | None = None, branch: str = MAIN) -> Model:
    """The store at ``root``; of a store with versions a branch's latest one, or a given one."""
    held = open_version(spark, root, version, branch)
    if held.number:
        return model_of(held)
    meta = {r["table"]: r["n_rows"] for r in spark.read.parquet(f"{root}/_meta").collect()}  # a few rows
    t = {n: spark.read.parquet(f"{root}/{n}") for n in [*DIMENSIONS, "trades", "daily"]}
    # Dimensions under the broadcast bound are kept in executor memory: every
    # report joins them, and a lost block is simply re-read from Parquet.
    for n in DIMENSIONS:
        if meta.get(n, 0) <= max_broadcast_rows(spark):
            t[n] = t[n].cache()
    grain = next((g for g, c in GRAINS.items() if list_partitions(spark, f"{root}/trades", c)), "month")
    return Model(spark, t["exchanges"], t["instruments"], t["expiries"], t["trades"], t["daily"], meta, root,
                 grain=grain)


def open_model(spark: SparkSession, sf_dir: str, grain: str = "month") -> Model:
    """The curated model derived from the driver tables under ``sf_dir``;
    built and written on first use, then read back."""
    root = store_root(spark, sf_dir, grain)
    key = f"{spark.sparkContext.applicationId}:{root}"
    if key in _CACHE:
        return _CACHE[key]
    if not exists(spark, f"{root}/_meta"):
        # Built under a private name and published with one rename, so a
        # reader never sees a half-written store and concurrent builders do
        # not write into each other; the loser of a race drops its copy.
        building = f"{root}.building-{uuid.uuid4().hex[:12]}"
        with bounded_tasks(spark):
            write_model(spark, fixtures.fno_feed(spark, sf_dir), building, grain)
        if not publish(spark, building, root):
            delete_path(spark, building)
    model = read_model(spark, root)
    _CACHE[key] = model
    return model
