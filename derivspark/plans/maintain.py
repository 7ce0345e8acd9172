"""Keeping a store up to date: loads, corrections, retention and compaction, each one new
version of all its tables (``sources/versions.py``).

Tables: ``exchanges``, ``instruments``, ``expiries``, ``trades`` and ``daily`` as in
``sources/store.py``, ``rejects`` (feed lines that became no trade, with the reason) and
``deliveries`` (what was loaded; a delivery that is in it already changes nothing).

* **Loads** add new instruments and contracts, numbered after the present ones, and the facts,
  whose ids continue. ``daily`` takes the aggregates of the new rows.
* **Corrections** replace rows by ``trade_id`` where their version (``timestamp``) is not older
  than the stored row's. Only partitions that hold a row before or after are written again.
  ``daily`` takes the old rows' aggregates away and adds the new ones'; groups whose minimum or
  maximum went with an old row are computed anew from their rows.
* **Retention** takes old partitions out of the next version; no data is read or moved.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from derivspark.functions.metrics import GRAINS, period_key, period_value
from derivspark.operators.joins import maybe_broadcast
from derivspark.plans import normalize as N
from derivspark.plans.rollup import daily_aggregates, merge_daily
from derivspark.plans.storage import new_rows_with_ids
from derivspark.schemas import RAW_COLUMNS
from derivspark.sources.raw_feed import CORRUPT, read_raw_lines, typed_feed
from derivspark.sources.store import Model, model_of
from derivspark.sources.versions import MAIN, Transaction, Version, open_version, update

INSTRUMENTS = "instrument_id int, exchange_id int, instrument_type string, symbol string, series string"
EXPIRIES = "expiry_id int, instrument_id int, expiry_date date, strike_price decimal(12,2), option_type string"
DELIVERIES = "delivery string, kind string, n_lines bigint, n_trades bigint, n_rejected bigint, n_stale bigint"
REJECTS = "delivery string, exchange_id int, reason string, line string"
FACT_ORDER = ["instrument_id", "trade_date", "trade_id"]
DAILY_ORDER = ["instrument_id", "trade_date"]
LINE = "_line"
FILE, SIZE = "_file", "_file_size"
HASHES = ("_hash", "_hash_x")
LEDGER_BUCKETS = 64
Step = Callable[[str], None] | None


def reject_reason() -> F.Column:
    """Why a typed feed row becomes no trade (first reason that applies; NULL: it becomes one)."""
    key = F.lit(False)
    for c in N.INSTRUMENT_KEY:
        key |= F.col(c).isNull()
    malformed = F.col(CORRUPT).isNotNull()
    return (F.when(malformed, "malformed line").when(F.col("timestamp").isNull(), "no trade date")
            .when(F.col("expiry_date").isNull(), "no expiry date").when(key, "no instrument"))


def _with_lines(feed: DataFrame) -> DataFrame:
    """The feed with ``CORRUPT`` and ``LINE`` columns, also where it didn't come from text."""
    for c in (CORRUPT, LINE):
        if c not in feed.columns:
            feed = feed.withColumn(c, F.lit(None).cast("string"))
    return feed


def _rejected_lines(rows: DataFrame) -> DataFrame:
    """``rows`` with the text of those lines alone that become no trade."""
    return rows.withColumn(LINE, F.when(reject_reason().isNotNull(), F.col(LINE)))


def _table(base: Version, name: str, schema: str) -> DataFrame:
    return base.table(name) if name in base.tables else base.spark.createDataFrame([], schema)


def _delivered(base: Version, delivery: str) -> bool:
    if "deliveries" not in base.tables:
        return False
    return not base.table("deliveries").where(F.col("delivery") == delivery).isEmpty()


def _enter(t: Transaction, delivery: str, kind: str, lines: int, trades: int, rejected: int, stale: int) -> None:
    row = (delivery, kind, lines, trades, rejected, stale)
    t.add("deliveries", t.spark.createDataFrame([row], DELIVERIES).coalesce(1))


def _load(t: Transaction, feed: DataFrame, delivery: str, grain: str, n_staged: int | None = None) -> bool | None:
    """``n_staged``: the number of the feed's lines, if it is a table of the transaction already
    (``new_files``) that isn't written again."""
    spark, base = t.spark, t.base
    if _delivered(base, delivery):
        return False
    grain = t.info.setdefault("grain", grain)
    part = GRAINS[grain]
    rows = _with_lines(feed).withColumn("_reason", reject_reason())
    n_lines = n_staged
    if n_staged is None:
        seen = Observation("load")
        rows = t.staged(_rejected_lines(rows).observe(seen, F.count(F.lit(1)).alias("lines")), "feed")
        n_lines = seen.get["lines"]
    good = rows.where(F.col("_reason").isNull()).drop("_reason", CORRUPT, LINE)
    t.add("rejects", rows.where(F.col("_reason").isNotNull()).select(
        F.lit(delivery).alias("delivery"), "exchange_id", F.col("_reason").alias("reason"), F.col(LINE).alias("line")))
    n_rejected = t.added("rejects")
    if "exchanges" not in base.tables:
        t.add("exchanges", N.exchange_dim(spark).coalesce(1))

    # The distinct contracts, staged: both dimensions derive from them, one row a contract.
    contracts = t.staged(N.fill_contract_keys(good).select(*N.INSTRUMENT_KEY, *N.CONTRACT_ATTRS).distinct(), "contracts")
    old = _table(base, "instruments", INSTRUMENTS)
    batch = contracts.select(*N.INSTRUMENT_KEY).withColumn("series", N.series_of("instrument_type"))
    new = t.add("instruments", new_rows_with_ids(old, batch, N.INSTRUMENT_KEY, "instrument_id", ["exchange_id"],
                                                 base.rows("instruments")), sort=["instrument_id"])
    instruments = old.unionByName(new)
    n_instruments = Version(spark, t.root, 0, t.tables).rows("instruments")
    keyed = contracts.join(maybe_broadcast(instruments.select("instrument_id", *N.INSTRUMENT_KEY), n_instruments),
                           N.INSTRUMENT_KEY).select(*N.EXPIRY_KEY)
    old = _table(base, "expiries", EXPIRIES)
    new = t.add("expiries", new_rows_with_ids(old, keyed, N.EXPIRY_KEY, "expiry_id", ["instrument_id"],
                                              base.rows("expiries")), sort=["expiry_id"])
    expiries = old.unionByName(new)
    n_expiries = Version(spark, t.root, 0, t.tables).rows("expiries")

    placed = good.withColumn("_place", F.monotonically_increasing_id())  # a row's place in the staged feed
    last = t.info.get("max_trade_id", 0)
    trades = N.build_trades(placed, instruments, expiries, lookup_rows=n_expiries, covering=True,
                            stage_dir=t.scratch("ids"), tie_col="_place", grain=grain, n_rows=n_lines)
    t.unstage("feed", "batch", "contracts")  # what follows reads the numbered rows alone
    trades = trades.withColumn("trade_id", F.col("trade_id") + F.lit(last))
    written = t.add("trades", N.written_order(trades, grain), part)
    t.unstage("ids")
    n_trades = t.added("trades")
    if n_trades != n_lines - n_rejected:
        raise ValueError(f"{n_lines} lines, {n_rejected} rejected, but {n_trades} trades")
    _change_daily(t, part, plus=daily_aggregates(written, part))
    _enter(t, delivery, "load", n_lines, n_trades, n_rejected, 0)
    t.info.update(max_trade_id=last + n_trades, feed=t.info.get("feed", 0) + n_lines,
                  rejected=t.info.get("rejected", 0) + n_rejected)


def _change_daily(t: Transaction, part: str, plus: DataFrame, minus: DataFrame | None = None) -> None:
    """The next version's ``daily``: partitions that the changed rows touch are merged and written
    again (one row an instrument and day, without reading the fact), the others stay."""
    plus = t.staged(plus, "daily-plus")
    changed = plus.select(part)
    if minus is not None:
        minus = t.staged(minus, "daily-minus")
        changed = changed.union(minus.select(part))
    touched = [r[0] for r in changed.distinct().collect()]  # partition values
    if "daily" in t.base.tables:
        old = t.base.table("daily", touched)
        merged = t.staged(merge_daily(old, plus.select(*old.columns), minus.select(*old.columns) if minus is not None else None),
                          "daily-merged")
        whole = merged.where("not lost").drop("lost")
        lost = merged.where("lost").select(part, *DAILY_ORDER)
        if minus is not None and not lost.isEmpty():
            now = Version(t.spark, t.root, 0, t.tables)
            periods = [r[0] for r in lost.select(part).distinct().collect()]
            # A group's rows stand together in its partition's files; small key lists are broadcast by size.
            rows = now.table("trades", periods).join(lost, [part, *DAILY_ORDER], "left_semi")
            whole = whole.unionByName(daily_aggregates(rows, part).select(*whole.columns))
        t.drop("daily", touched)
        plus = whole
    t.add("daily", plus, part, DAILY_ORDER)


def hashed(batch: DataFrame) -> DataFrame:
    """A batch (columns ``FILE``, ``SIZE`` and the lines' own) with the ``HASHES`` of each line's columns, and the
    text of those lines alone that may become no row."""
    columns = [c for c in batch.columns if c not in (FILE, SIZE)]
    both = dict(zip(HASHES, (F.xxhash64(*columns), F.xxhash64(F.lit("x"), *columns))))
    return _rejected_lines(batch.withColumns(both))


def file_keys(batch: DataFrame) -> DataFrame:
    """One row a file of a ``hashed`` batch: its path and what identifies it: delivery
    (``delivery=<id>`` folder, else empty), name, length, checksum of its lines."""
    one, x = HASHES
    keys = batch.groupBy(FILE).agg(
        F.max(SIZE).alias("n_bytes"), F.count(F.lit(1)).alias("n_lines"),
        F.concat_ws("-", F.sum(F.col(one).cast("decimal(38,0)")), F.bit_xor(x)).alias("checksum"))
    name = F.regexp_extract(FILE, "[^/]+$", 0)
    return keys.select(FILE, F.regexp_extract(FILE, "/delivery=([^/]+)/", 1).alias("delivery"), name.alias("name"),
                       "n_bytes", "n_lines", "checksum",
                       F.pmod(F.xxhash64(name), F.lit(LEDGER_BUCKETS)).cast("int").alias("bucket"))


def new_files(t: Transaction, batch: DataFrame) -> tuple[DataFrame, int] | None:
    """The rows, staged, and their number, of the batch's files that are not in the ledger ``files`` (None: there are none);
    the files are entered in the same version. Equal files of one delivery have names of their own
    and all count; the same file sent again, at any time and under any path, doesn't. The batch's
    files are few (a micro-batch's limit) and are sent to the ledger, which is never collected."""
    batch = t.staged(batch if HASHES[0] in batch.columns else hashed(batch), "batch")
    found = t.staged(file_keys(batch), "files")
    key = ["bucket", "delivery", "name", "n_bytes", "checksum"]
    fresh = found.dropDuplicates(key)
    if "files" in t.base.tables:
        buckets = [r[0] for r in found.select("bucket").distinct().collect()]  # at most LEDGER_BUCKETS
        known = t.base.table("files", buckets).join(F.broadcast(found.select(*key)), key, "left_semi").select(*key)
        fresh = fresh.join(F.broadcast(known), key, "left_anti")
    fresh = t.staged(fresh, "fresh")
    n_fresh, n_lines = fresh.agg(F.count(F.lit(1)), F.sum("n_lines")).first()
    if not n_fresh:
        return None
    t.add("files", fresh.select(*key[1:], "n_lines", "bucket"), "bucket")
    rows = batch.drop(*HASHES)
    if n_fresh < found.count():
        rows = rows.join(F.broadcast(fresh.select(FILE)), FILE, "left_semi")
    return rows.drop(FILE, SIZE), n_lines


def load_files(spark: SparkSession, root: str, batch: DataFrame, grain: str = "month", on_step: Step = None,
               branch: str = MAIN) -> Version:
    """Add the lines of a batch's new files to the model (see ``new_files``); ``batch`` is a typed feed
    with ``FILE`` and ``SIZE`` of each line's file."""
    def change(t: Transaction) -> bool | None:
        new = new_files(t, batch)
        return False if new is None else _load(t, new[0], f"files of {t.txn}", grain, new[1])
    return update(spark, root, "load files", change, on_step=on_step, branch=branch)


def load(spark: SparkSession, root: str, feed: DataFrame, delivery: str, grain: str = "month", on_step: Step = None,
         branch: str = MAIN) -> Version:
    """Add a typed feed to the store at ``root`` (made by its first load, with partitions of ``grain``).
    ``delivery`` identifies it: loaded once, whenever and however often it is sent."""
    return update(spark, root, "load", lambda t: _load(t, feed, delivery, grain), on_step=on_step, branch=branch)


def csv_feed(spark: SparkSession, path: str, exchange_id: int | None = None) -> DataFrame:
    """Raw CSV files as a typed feed with every line, also malformed ones, and its text."""
    raw = read_raw_lines(spark, path, exchange_id)
    text = F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(*RAW_COLUMNS)))
    return typed_feed(raw.withColumn(LINE, text), keep=(CORRUPT, LINE))


def load_csv(spark: SparkSession, csv_path: str, root: str, exchange_id: int | None = None, grain: str = "month",
             delivery: str | None = None, on_step: Step = None) -> Model:
    """Load raw exchange CSV files (``exchange_id=<n>`` folders, or one exchange's files with
    ``exchange_id``) into a new store at ``root``."""
    if open_version(spark, root).number:
        raise FileExistsError(f"a store already exists at {root}")
    return model_of(load(spark, root, csv_feed(spark, csv_path, exchange_id), delivery or csv_path, grain, on_step))


def append_csv(spark: SparkSession, csv_path: str, root: str, exchange_id: int | None = None,
               delivery: str | None = None) -> Model:
    """Add raw CSV files, e.g. a trading day, to the store at ``root``. ``delivery`` (default: the
    path) tells deliveries apart; one that was loaded before changes nothing."""
    if not open_version(spark, root).number:
        raise FileNotFoundError(f"no store at {root}")
    return model_of(load(spark, root, csv_feed(spark, csv_path, exchange_id), delivery or csv_path))


def newest(batch: DataFrame, key: list[str], columns: list[str], order: list[str]) -> DataFrame:
    """One row a key: the newest version by ``order``, then by its values. Partial maxima, so many
    versions of one key are cheap."""
    version = F.struct(F.struct(F.lit(0), *order).alias("order"), F.struct(*columns).alias("row"))
    return batch.groupBy(*key).agg(F.max(version).alias("_v")).select("_v.row.*")


def _correct(t: Transaction, corrections: DataFrame, delivery: str, order: list[str]) -> bool | None:
    base = t.base
    if _delivered(base, delivery):
        return False
    part = GRAINS[t.info["grain"]]
    fact = base.table("trades")
    columns = fact.columns
    given = corrections.withColumn(part, period_key("trade_date", t.info["grain"]))
    if not given.where("trade_id is null or trade_date is null").isEmpty():
        raise ValueError("a correction without trade_id or trade_date")
    fixed = t.staged(newest(given, ["trade_id"], columns, order), "fixed")
    lo, hi, n = fixed.agg(F.min("trade_id"), F.max("trade_id"), F.count(F.lit(1))).first()
    if not n:
        return False
    # Ids rise with loads, so their range skips most files; two columns are read.
    stored = fact.where(F.col("trade_id").between(lo, hi)).select("trade_id", F.col("timestamp").alias("_stored"),
                                                                F.col(part).alias("_was"))
    paired = fixed.join(stored, "trade_id", "left")
    fresh = F.col("_stored").isNull() | F.coalesce(F.col("timestamp") >= F.col("_stored"), F.lit(False))
    taken = t.staged(paired.where(fresh), "taken")
    n_taken, top = taken.agg(F.count(F.lit(1)), F.max("trade_id")).first()
    touched = [r[0] for r in taken.select(F.explode(F.array(part, "_was")).alias("p")).where("p is not null").distinct().collect()]
    if n_taken:
        ids = taken.select("trade_id")
        was = [r[0] for r in taken.select("_was").where("_was is not null").distinct().collect()]
        before = base.table("trades", was)
        replaced = before.join(ids, "trade_id", "left_semi")
        minus = daily_aggregates(replaced, part)
        kept = base.table("trades", touched).join(ids, "trade_id", "left_anti")
        changed = taken.select(*columns)
        t.drop("trades", touched)
        t.add("trades", kept.select(*columns).unionByName(changed), part, FACT_ORDER,
              rows=n_taken + sum(r for p, _, r in base.folders("trades") if p in touched))
        _change_daily(t, part, plus=daily_aggregates(changed, part), minus=minus)
        t.info["max_trade_id"] = max(t.info["max_trade_id"], top)
    _enter(t, delivery, "correction", n, n_taken, 0, n - n_taken)


def correct(spark: SparkSession, root: str, corrections: DataFrame, delivery: str, order: list[str] | None = None,
            on_step: Step = None, branch: str = MAIN) -> Version:
    """Apply corrected rows (columns of ``trades``) by ``trade_id``; ids that are not stored are added.
    A row's version is its ``timestamp``: an older one than the stored row's is counted as stale
    and changes nothing, also in a later call; an equal one replaces it. Of several versions in one
    call the newest by ``order`` (default: ``timestamp``) counts. A delivery is applied once."""
    return update(spark, root, "correct", lambda t: _correct(t, corrections, delivery, order or ["timestamp"]),
                  on_step=on_step, branch=branch)


def keep_from(version: Version, months: int) -> int:
    """Partition value of the first day kept when ``months`` calendar months are kept, up to the
    last trade date."""
    last = model_of(version).last_trade_date()
    y, m = last.year, last.month - (months - 1)
    while m <= 0:
        y, m = y - 1, m + 12
    return period_value(date(y, m, 1), version.info["grain"])


def retain(spark: SparkSession, root: str, months: int, on_step: Step = None, branch: str = MAIN) -> Version:
    """Drop the partitions before the last ``months`` calendar months from ``trades`` and ``daily``."""
    def change(t: Transaction) -> bool | None:
        first = keep_from(t.base, months)
        old = [p for p in t.base.partitions("trades") if p < first]
        if not old:
            return False
        for name in ("trades", "daily"):
            t.drop(name, old)
    return update(spark, root, "retain", change, on_step=on_step, branch=branch)


def compact(spark: SparkSession, root: str, max_folders: int = 8, on_step: Step = None, branch: str = MAIN) -> Version:
    """Write partitions of more than ``max_folders`` folders again as one, and small tables likewise."""
    def change(t: Transaction) -> bool | None:
        changed = False
        for name, held in t.base.tables.items():
            sizes: dict = {}
            for p, _, _ in t.base.folders(name):
                sizes[p] = sizes.get(p, 0) + 1
            many = [p for p, n in sizes.items() if n > max_folders]
            if many:
                rows = t.base.table(name, many if held["partition"] else None)
                t.drop(name, many if held["partition"] else None)
                sort = {"trades": FACT_ORDER, "daily": DAILY_ORDER, "instruments": ["instrument_id"], "expiries": ["expiry_id"]}
                t.add(name, rows, held["partition"], sort.get(name), rows=sum(r for p, _, r in t.base.folders(name) if p in many))
                changed = True
        return None if changed else False
    return update(spark, root, "compact", change, on_step=on_step, branch=branch)
