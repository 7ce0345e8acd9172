"""Jobs over the normalisation step itself: the dimension and fact builds,
surrogate-key checks and data-quality reports. Each takes (spark, sf_dir)
and runs over the whole feed derived from the driver tables."""

from __future__ import annotations

import contextlib
import uuid
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from derivspark.plans import normalize as N
from derivspark.plans import quality as Q
from derivspark.sources.fixtures import fno_feed
from derivspark.sources.store import open_model


def build_instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.build_instruments(fno_feed(spark, sf_dir))


def build_expiries(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = fno_feed(spark, sf_dir)
    return N.build_expiries(feed, N.build_instruments(feed))


def build_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact build keyed through freshly built dimensions (trade ids are
    checked separately by ``surrogate_keys``)."""
    feed = fno_feed(spark, sf_dir)
    inst = N.build_instruments(feed)
    exp = N.build_expiries(feed, inst)
    return N.build_trades(feed, inst, exp, with_ids=False)


def _id_profile(df: DataFrame, table: str, id_col: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(id_col).alias("n_ids"),
                  F.min(id_col).cast("bigint").alias("min_id"), F.max(id_col).cast("bigint").alias("max_id")) \
        .select(F.lit(table).alias("table_name"), "n_rows", "n_ids", "min_id", "max_id")


def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the stored tables are dense 1..n and unique."""
    m = open_model(spark, sf_dir)
    return (_id_profile(m.instruments, "instruments", "instrument_id")
            .unionByName(_id_profile(m.expiries, "expiries", "expiry_id"))
            .unionByName(_id_profile(m.trades, "trades", "trade_id")))


def dq_check_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.check_violations(Q.dirty_feed(fno_feed(spark, sf_dir, keep_source_keys=True)))


def dq_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(contract, trade_date) keys with more than one daily row."""
    m = open_model(spark, sf_dir)
    return Q.duplicate_keys(m.trades.select("expiry_id", "trade_date"), ["expiry_id", "trade_date"])


def dq_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphan counts for every foreign key (the feed carries dirty exchange ids)."""
    m = open_model(spark, sf_dir)
    feed = Q.dirty_feed(fno_feed(spark, sf_dir, keep_source_keys=True)).select("exchange_id")
    checks = [
        ("feed.exchange_id->exchanges", feed, m.exchanges, "exchange_id", m.rows.get("exchanges")),
        ("instruments.exchange_id->exchanges", m.instruments, m.exchanges, "exchange_id", m.rows.get("exchanges")),
        ("expiries.instrument_id->instruments", m.expiries, m.instruments, "instrument_id", m.rows.get("instruments")),
        ("trades.instrument_id->instruments", m.trades, m.instruments, "instrument_id", m.rows.get("instruments")),
        ("trades.expiry_id->expiries", m.trades, m.expiries, "expiry_id", m.rows.get("expiries")),
    ]
    out = None
    for name, child, parent, fk, n in checks:
        part = Q.orphans(child.select(fk), parent, fk, parent_rows=n).agg(
            F.count(F.lit(1)).alias("n_orphans")).select(F.lit(name).alias("relation"), "n_orphans")
        out = part if out is None else out.unionByName(part)
    return out


def dq_declared_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per stored table: values of its declared key that occur twice or more, and rows with a NULL in it."""
    m, out = open_model(spark, sf_dir), None
    for name, key in Q.DECLARED_KEYS.items():
        rows = getattr(m, name).select(*key)
        null = " or ".join(f"{k} is null" for k in key)
        part = (rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
                .agg(F.count_if((F.col("n") > 1) & ~F.expr(null)).alias("n_repeated"),
                     F.coalesce(F.sum(F.when(F.expr(null), F.col("n"))), F.lit(0)).cast("bigint").alias("n_null"))
                .select(F.lit(name).alias("table_name"), "n_repeated", "n_null"))
        out = part if out is None else out.unionByName(part)
    return out


def dq_model_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CHECK and NOT NULL violations of the stored tables, one scan a table."""
    m, out = open_model(spark, sf_dir), None
    for name, rules in Q.model_rules().items():
        part = (Q.check_violations(getattr(m, name), rules, Q.MODEL_NOT_NULL[name])
                .select(F.lit(name).alias("table_name"), "rule", "violations"))
        out = part if out is None else out.unionByName(part)
    return out


# ------------------------------------------------------------------ storage ----
from derivspark.functions.metrics import round_half_up  # noqa: E402
from derivspark.plans import analytics as A  # noqa: E402
from derivspark.plans import maintain as MT  # noqa: E402
from derivspark.plans import storage as S  # noqa: E402
from derivspark.schemas import MEASURES, RAW_COLUMNS  # noqa: E402
from derivspark.session import bounded_tasks, scratch_dir  # noqa: E402
from derivspark.sources import raw_feed as RF  # noqa: E402
from derivspark.sources.catalog import create_tables  # noqa: E402
from derivspark.sources.fs import delete_path, exists, publish  # noqa: E402
from derivspark.sources.sinks import write_result_csv  # noqa: E402
from derivspark.sources.store import model_of, read_model, store_root  # noqa: E402
from derivspark.sources.testdata import read_table  # noqa: E402
from derivspark.sources.versions import MAIN, Conflict, fork, open_version  # noqa: E402

ARCHIVE_CUTOFF = "2019-09-01"
KEEP_MONTHS = 2
CORRECTION_FROM = "2019-11-01"
DELIVERY_FILES, DELIVERY_ROWS = 4, 500_000  # least files an exchange in a delivery of stream_ingest, most rows a file
EVENT_FILES = 4
NEW_DAYS = 3  # trading days that are added to the stored history
# Planted defects of load_reconciliation: every n-th order key.
TOO_LONG, BLANK_DATE, BLANK_EXPIRY, BLANK_SYMBOL = 101, 103, 109, 113


def exchange_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exchange reference rows with their instrument counts."""
    m = open_model(spark, sf_dir)
    n = m.instruments.groupBy("exchange_id").agg(F.count(F.lit(1)).alias("n_instruments"))
    return m.exchanges.join(n, "exchange_id", "left").select(
        "exchange_id", "exchange_code", "exchange_name", "country", "is_active",
        F.coalesce("n_instruments", F.lit(0)).cast("bigint").alias("n_instruments"))


def insert_if_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load the first exchange's instruments, then insert-if-new the keys of
    all exchanges' files: existing keys are skipped, new keys are numbered
    after the current maximum id."""
    feed = fno_feed(spark, sf_dir)
    path = scratch_dir(spark, "instruments")
    N.build_instruments(feed.where(F.col("exchange_id") == 1)).write.parquet(path)
    batch = feed.select(*N.INSTRUMENT_KEY).withColumn("series", N.series_of("instrument_type"))
    return S.append_if_new(spark, path, batch, N.INSTRUMENT_KEY, "instrument_id", ["exchange_id"],
                           staging=scratch_dir(spark, "instruments-new"))


def monthly_partition_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.monthly_partition_rollup(open_model(spark, sf_dir))


def archive_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = S.archive_before(open_model(spark, sf_dir), ARCHIVE_CUTOFF, scratch_dir(spark, "archive"))
    return S.partition_summary(spark.read.parquet(path))


def _maintained(spark: SparkSession, sf_dir: str, whole: bool = True) -> tuple[str, str]:
    """(root, branch) of a store with versions over the feed of ``sf_dir``, built on first use: branch
    ``main`` holds all days but the last ``NEW_DAYS``, branch ``whole`` has them added one by one."""
    root = f"{store_root(spark, sf_dir)}-versions"
    if not open_version(spark, root).number:
        feed = fno_feed(spark, sf_dir)
        MT.load(spark, root, feed.where(F.to_date("timestamp") < F.lit(_new_days(spark, sf_dir)[0])), "history")
    if not whole:
        return root, MAIN
    if not open_version(spark, root, branch="whole").number:
        with contextlib.suppress(Conflict):
            fork(open_version(spark, root, 1), "whole")
    if open_version(spark, root, branch="whole").number < 1 + NEW_DAYS:
        _add_days(spark, sf_dir, root, "whole")
    return root, "whole"


_LAST_DAY: dict = {}  # (application, store) -> last trade date


def _new_days(spark: SparkSession, sf_dir: str) -> list:
    """The last trading days, by the feed's rows that become trades (no store is built for it)."""
    key = (spark.sparkContext.applicationId, store_root(spark, sf_dir))
    if key not in _LAST_DAY:
        known = " and ".join(f"{c} is not null" for c in (*N.INSTRUMENT_KEY, "expiry_date"))
        _LAST_DAY[key] = fno_feed(spark, sf_dir).where(known).agg(F.max(F.to_date("timestamp"))).first()[0]
    last = _LAST_DAY[key]
    return [last - timedelta(days=d) for d in reversed(range(NEW_DAYS))]


def _add_days(spark: SparkSession, sf_dir: str, root: str, branch: str) -> None:
    feed = fno_feed(spark, sf_dir)
    for day in _new_days(spark, sf_dir):
        MT.load(spark, root, feed.where(F.to_date("timestamp") == F.lit(day)), f"day {day}", branch=branch)


def _own_branch(spark: SparkSession, sf_dir: str, whole: bool = True) -> tuple[str, str]:
    """A branch of the store for one job: shares the data, changes by itself."""
    root, branch = _maintained(spark, sf_dir, whole)
    name = f"job-{uuid.uuid4().hex[:12]}"
    fork(open_version(spark, root, 1 if not whole else None, branch), name)
    return root, name


def append_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last trading days added to the stored history one by one, the last one sent twice: the
    facts by their natural keys."""
    root, branch = _own_branch(spark, sf_dir, whole=False)
    for _ in range(2):  # the second round is known and changes nothing
        _add_days(spark, sf_dir, root, branch)
    m = read_model(spark, root, branch=branch)
    return m.with_instrument(m.trades, "exchange_id", "instrument_type", "symbol", "series").select(
        "exchange_id", "instrument_type", "symbol", "series", *N.CONTRACT_ATTRS, "trade_date", *MEASURES)


def _corrections(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(versions that count, older ones) of the rows with an even volume."""
    rows = rows.where("contracts % 2 = 0")
    newer = rows.withColumn("change_in_oi", F.col("change_in_oi") + 1)
    older = rows.withColumns({"change_in_oi": F.col("change_in_oi") + 9,
                              "timestamp": (F.col("timestamp") - F.expr("INTERVAL 1 DAY"))
                              .cast(rows.schema["timestamp"].dataType)})
    return newer, older


def corrected_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrections of prices, volumes and dates of the last month, in two runs, and the daily
    aggregates that the store keeps: rows with a volume that 40 divides lose their low (now their
    close), those that 30 divides have no volume, the others one more lot."""
    root, branch = _own_branch(spark, sf_dir)
    rows = open_version(spark, root, branch=branch).table("trades").where(F.col("trade_date") >= F.lit(CORRECTION_FROM).cast("date"))
    lots = F.col("contracts")
    fixed = rows.where("contracts % 20 = 0").withColumns({
        "low": F.when(lots % 40 == 0, F.col("close")).otherwise(F.col("low")),
        "contracts": F.when(lots % 30 == 0, F.lit(0)).otherwise(lots + 1)})
    MT.correct(spark, root, fixed, "prices", branch=branch)
    newer, _ = _corrections(rows.where("contracts % 20 <> 0"))
    MT.correct(spark, root, newer, "interest", branch=branch)
    m = read_model(spark, root, branch=branch)
    keys = m.instruments.select("instrument_id", "exchange_id", "instrument_type", "symbol")
    out = m.daily.join(keys, "instrument_id").drop("instrument_id")
    return out.withColumns({c: round_half_up(c, 6) for c in ("sum_pct_hl", "sum_pct_rc")})


def retention_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last months kept in a branch of the store; per month the facts and, beside them, what the
    daily aggregates of the same version say."""
    root, branch = _own_branch(spark, sf_dir)
    m = model_of(MT.retain(spark, root, KEEP_MONTHS, branch=branch))
    daily = m.daily.groupBy(S.PARTITION).agg(F.sum("n_trades").cast("bigint").alias("daily_rows"),
                                             F.sum("volume").cast("bigint").alias("daily_volume"))
    return S.partition_summary(m.trades).join(daily, S.PARTITION)


def load_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw CSV with planted defects, loaded: lines = trades + rejects, by reason."""
    feed, k = fno_feed(spark, sf_dir, keep_source_keys=True), F.col("l_orderkey")

    def blank(column, every):
        return F.when(k % every != 0, F.col(column)).otherwise(F.lit(None)).alias(column)

    holes = feed.withColumns({c: blank(c, n) for c, n in (("timestamp", BLANK_DATE), ("expiry_date", BLANK_EXPIRY),
                                                          ("symbol", BLANK_SYMBOL))})
    raw = RF.write_raw_csv(RF.render_raw(holes.where(k % TOO_LONG != 0)), scratch_dir(spark, "holes-csv"), packed=True)
    line = F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in RAW_COLUMNS], F.lit("x"), F.lit("y"))
    long_lines = RF.render_raw(feed.where(k % TOO_LONG == 0)).select("exchange_id", F.lit(1).alias("at"), line.alias("value"))
    head = spark.range(1, 4).select(F.col("id").cast("int").alias("exchange_id"), F.lit(0).alias("at"),
                                    F.lit(",".join(RAW_COLUMNS)).alias("value"))
    with bounded_tasks(spark):
        (head.unionByName(long_lines).repartition("exchange_id").sortWithinPartitions("exchange_id", "at")
         .select("value", "exchange_id").write.mode("append").partitionBy("exchange_id").options(**RF.PACKED).text(raw))
    root = scratch_dir(spark, "reconciled")

    def read_through(step):  # the job's own files, in a store that nobody else writes
        if step == "staged feed":
            delete_path(spark, raw)

    MT.load_csv(spark, raw, root, on_step=read_through)
    v = open_version(spark, root)
    rejects = v.table("rejects").groupBy(F.col("reason").alias("outcome")).agg(F.count(F.lit(1)).alias("n_lines"))
    trades = v.table("trades").agg(F.count(F.lit(1)).alias("n_lines")).select(F.lit("trade").alias("outcome"), "n_lines")
    total = v.table("deliveries").agg(F.sum("n_lines").alias("n_lines")).select(F.lit("all lines").alias("outcome"), "n_lines")
    return rejects.unionByName(trades).unionByName(total)


def column_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contracts inserted into a new table: futures with their keys alone, so that strike, option type,
    the active flag and the load time are filled in; options with strike and type."""
    m = open_model(spark, sf_dir)
    database = f"derivspark_defaults_{uuid.uuid4().hex[:12]}"
    create_tables(spark, database, scratch_dir(spark, "defaults"))
    view = f"{database}_rows"
    m.expiries.join(m.instruments.select("instrument_id", "series"), "instrument_id").createOrReplaceTempView(view)
    keys = "expiry_id, instrument_id, expiry_date"
    for columns, series in ((keys, "FUT"), (f"{keys}, strike_price, option_type", "OPT")):
        spark.sql(f"INSERT INTO {database}.expiries ({columns}) SELECT {columns} FROM {view} WHERE series = '{series}'")
    spark.catalog.dropTempView(view)
    return spark.table(f"{database}.expiries").select(
        "expiry_id", "instrument_id", "expiry_date", "strike_price", "option_type", "is_active",
        (F.col("created_at") <= F.current_timestamp()).alias("has_load_time"))


def split_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact written as one folder a year, read back."""
    path = S.split_by_year(open_model(spark, sf_dir), scratch_dir(spark, "by-year"))
    return spark.read.parquet(path).groupBy("trade_year").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("contracts").cast("bigint").alias("volume"),
        F.min("trade_date").alias("first_day"), F.max("trade_date").alias("last_day"))


def csv_result_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report written as CSV with a header, read back with its schema."""
    df = A.runner_q6_price_movement(open_model(spark, sf_dir))
    path = write_result_csv(df, scratch_dir(spark, "result-csv"))
    return spark.read.schema(df.schema).option("header", "true").csv(path)


def daily_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full build of the roll-up, then an incremental refresh of the newest
    partition (replaces that partition only); the result equals a full build."""
    m = open_model(spark, sf_dir)
    path = S.refresh_daily_rollup(m, scratch_dir(spark, "rollup"))
    S.refresh_daily_rollup(m, path, periods=[m.period(m.last_trade_date())])
    out = spark.read.parquet(path)
    # per-day floating-point sums are order-dependent: reported at 6 decimals
    return out.withColumns({c: round_half_up(c, 6) for c in ("sum_pct_hl", "sum_pct_rc")})


# ------------------------------------------------------------------- ingest ----

def _rendered_raw(spark: SparkSession, sf_dir: str) -> str:
    return RF.write_raw_csv(RF.render_raw(fno_feed(spark, sf_dir, keep_source_keys=True)),
                            scratch_dir(spark, "raw-csv"))


def ingest_raw_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RF.read_raw_csv(spark, _rendered_raw(spark, sf_dir)).select(*RAW_COLUMNS, "exchange_id")


def ingest_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RF.typed_feed(RF.read_raw_csv(spark, _rendered_raw(spark, sf_dir)))


# ---------------------------------------------------------------- streaming ----
from derivspark.streaming import bars as SB, ingest as SI, upsert as SU  # noqa: E402


def _deliveries(spark: SparkSession, sf_dir: str):
    """Two deliveries of several files an exchange, as folders of one inbox: first the newer half of
    the days, then the older ones, late. Yields the inbox after each."""
    feed = fno_feed(spark, sf_dir, keep_source_keys=True)
    inbox, outbox = scratch_dir(spark, "stream-in"), scratch_dir(spark, "stream-out-of")
    with bounded_tasks(spark):
        late, n_rows = feed.agg(F.percentile_approx(F.unix_date(F.to_date("timestamp")), 0.5), F.count(F.lit(1))).first()
    files = max(DELIVERY_FILES, -(-n_rows // DELIVERY_ROWS))  # a file's share doesn't grow with the feed
    newer = F.unix_date(F.to_date("timestamp")) >= late
    # Both are written in one pass; copies of a row are spread over the files, rows are rendered behind the shuffle.
    dealt = feed.withColumn("delivery", F.when(newer, 0).otherwise(1)).repartition(files)
    RF.write_raw_csv(RF.render_raw(dealt, keep=("delivery",)), outbox, within=("delivery",))
    for n in range(2):
        if exists(spark, f"{outbox}/delivery={n}"):
            publish(spark, f"{outbox}/delivery={n}", f"{inbox}/delivery={n}")
        else:  # a delivery without rows
            RF.write_raw_csv(RF.render_raw(feed.where("false")), f"{inbox}/delivery={n}")
        yield inbox


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries landed as they come. The second run has a new checkpoint, so it is given the first
    files again, which the ledger knows."""
    out = scratch_dir(spark, "stream-out")
    for n, inbox in enumerate(_deliveries(spark, sf_dir)):
        SI.run_ingest(spark, inbox, out, scratch_dir(spark, f"stream-ck-{n}"))
    return open_version(spark, out).table("feed").drop(SI.PARTITION)


def stream_to_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same deliveries streamed into a model: its daily aggregates by symbol."""
    out = scratch_dir(spark, "stream-model")
    for n, inbox in enumerate(_deliveries(spark, sf_dir)):
        SI.run_ingest(spark, inbox, out, scratch_dir(spark, f"model-ck-{n}"), into_model=True)
    m = read_model(spark, out)
    return m.with_exchange(m.daily, "symbol").groupBy("symbol", "exchange_code", "trade_date").agg(
        F.sum("n_trades").cast("bigint").alias("n_trades"), F.sum("volume").cast("bigint").alias("volume"),
        F.sum("value").cast("decimal(38,2)").alias("value"), F.min("day_low").alias("day_low"), F.max("day_high").alias("day_high"))


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correction streams to a branch of the store, of the rows from a date on with an even volume (so
    that others of their contract and day stay): a run with the version that counts (change_in_oi
    + 1) and an older one in a later file, then a run with the older ones alone."""
    root, branch = _own_branch(spark, sf_dir)
    rows = open_version(spark, root, branch=branch).table("trades")
    newer, older = _corrections(rows.where(F.col("trade_date") >= F.lit(CORRECTION_FROM).cast("date")))
    inbox = scratch_dir(spark, "upsert-inbox")
    newer.write.parquet(inbox)
    older.write.mode("append").parquet(inbox)
    late = scratch_dir(spark, "upsert-late")
    older.write.parquet(late)
    for n, folder in enumerate((inbox, late)):
        SU.run_corrections(spark, folder, root, scratch_dir(spark, f"upsert-ck-{n}"), branch=branch)
    m = read_model(spark, root, branch=branch)
    return m.with_instrument(m.trades, "exchange_id", "instrument_type", "symbol").select(
        "exchange_id", "instrument_type", "symbol", *N.CONTRACT_ATTRS, "trade_date", *MEASURES, "timestamp")


def stream_daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events arrive as files, a few a batch; 1-day bars per event type, closed and open."""
    events = read_table(spark, sf_dir, "events")
    inbox, out = scratch_dir(spark, "events-inbox"), scratch_dir(spark, "bars-out")
    events.repartition(EVENT_FILES).write.parquet(inbox)
    SB.run_daily_bars(spark, inbox, out, scratch_dir(spark, "bars-ck"), events.schema, max_files=EVENT_FILES // 2)
    return SB.read_bars(spark, out)
