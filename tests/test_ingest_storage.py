"""Raw feed parsing, normalisation edge cases, storage and streaming behaviour."""

import datetime as dt
import os
import time
import shutil
from decimal import Decimal

from pyspark.sql import functions as F

from derivspark.plans import normalize as N
from derivspark.plans import storage as S
from derivspark.sources.raw_feed import read_raw_csv, typed_feed
from derivspark.streaming import bars as SB
from derivspark.streaming import upsert as SU

HEADER = ("INSTRUMENT,SYMBOL,EXPIRY_DT,STRIKE_PR,OPTION_TYP,OPEN,HIGH,LOW,CLOSE,SETTLE_PR,CONTRACTS,"
          "VAL_INLAKH,OPEN_INT,CHG_IN_OI,TIMESTAMP,")
LINES = [
    "FUTIDX,NIFTY,29-AUG-2019,0,XX,100.5,101,99,100,100.2,10,1000,500,5,01-AUG-2019,",
    "OPTIDX,NIFTY,29-Aug-2019,11000,CE,1,2,0.5,1.5,1.5,1.5,10,5,-1,01-AUG-2019,",     # 1.5 contracts, mixed case
    "FUTIDX,NIFTY,,,,100,101,99,100,100,10,1000,500,5,02-AUG-2019,",                  # blank expiry
    "FUTIDX,NIFTY,29-AUG-2019,,,abc,101,99,100,100,10,1000,500,5,02-AUG-2019,",       # non-numeric open
    "FUTIDX,NIFTY,29-AUG-2019,0,XX,100,101,99,100,100,10,1000,500,5,32-AUG-2019,",    # unparsable date
    "FUTIDX,NIFTY,29-AUG-2019,0,XX,100,101,99,100,100,10,1000,500,5,03-AUG-2019,,x,y",  # too many fields
]


def _raw(spark, tmp_path):
    d = tmp_path / "raw"
    d.mkdir()
    (d / "nse.csv").write_text("\n".join([HEADER, *LINES]) + "\n")
    return read_raw_csv(spark, str(d), exchange_id=1)


def test_raw_csv_lenient_typing(spark, tmp_path):
    rows = typed_feed(_raw(spark, tmp_path)).collect()
    assert len(rows) == 5  # the over-long line is dropped
    good, frac, blank, bad_num, bad_date = rows
    assert good.expiry_date == dt.date(2019, 8, 29) and good.timestamp == dt.datetime(2019, 8, 1)
    assert good.open == Decimal("100.50") and good.contracts == 10
    assert frac.contracts == 2 and frac.expiry_date == dt.date(2019, 8, 29)
    assert blank.expiry_date is None and blank.strike_price is None and blank.option_type is None
    assert bad_num.open is None and bad_num.strike_price is None
    assert bad_date.timestamp is None


def test_normalisation_defaults_and_drops(spark, tmp_path):
    feed = typed_feed(_raw(spark, tmp_path))
    inst = N.build_instruments(feed)
    assert sorted((r.instrument_type, r.series, r.instrument_id) for r in inst.collect()) == \
        [("FUTIDX", "FUT", 1), ("OPTIDX", "OPT", 2)]
    exp = N.build_expiries(feed, inst)
    # NULL strike/option of the 4th line meet the 0 / 'XX' contract: 2 contracts
    assert sorted((r.strike_price, r.option_type) for r in exp.collect()) == \
        [(Decimal("0.00"), "XX"), (Decimal("11000.00"), "CE")]
    trades = N.build_trades(feed, inst, exp).collect()
    # blank expiry and unparsable timestamp drop out; NULL open -> 0
    assert len(trades) == 3
    assert sorted(r.trade_id for r in trades) == [1, 2, 3]
    assert min(r.open for r in trades) == Decimal("0.00")


def _small_fact(spark):
    rows = []
    for day in (dt.date(2019, 8, 5), dt.date(2019, 9, 5)):
        for e in (1, 2):
            rows.append((e, day, 10 * e, day.year * 100 + day.month))
    return spark.createDataFrame(rows, "expiry_id int, trade_date date, change_in_oi bigint, trade_month int")


def _files(path):
    out = {}
    for root, _, names in os.walk(path):
        for n in names:
            p = os.path.join(root, n)
            out[p] = (os.path.getsize(p), os.path.getmtime(p))
    return out


def test_upsert_rewrites_only_touched_partitions(spark, tmp_path):
    table = str(tmp_path / "fact")
    S.write_partitioned(_small_fact(spark), table)
    aug_before = _files(os.path.join(table, "trade_month=201908"))
    fix = spark.createDataFrame([(2, dt.date(2019, 9, 5), 99, 201909)],
                                "expiry_id int, trade_date date, change_in_oi bigint, trade_month int")
    months = SU.upsert_batch(spark, fix, table, str(tmp_path / "stage"), epoch=0,
                    key=["expiry_id", "trade_date"])
    assert months == [201909]
    assert _files(os.path.join(table, "trade_month=201908")) == aug_before
    got = {(r.expiry_id, r.trade_date): r.change_in_oi for r in spark.read.parquet(table).collect()}
    assert got[(2, dt.date(2019, 9, 5))] == 99 and got[(1, dt.date(2019, 9, 5))] == 10 and len(got) == 4
    # replaying the same batch is idempotent
    SU.upsert_batch(spark, fix, table, str(tmp_path / "stage"), epoch=0,
                    key=["expiry_id", "trade_date"])
    assert spark.read.parquet(table).count() == 4


def test_retention_drops_whole_partitions(spark, tmp_path):
    table = str(tmp_path / "fact")
    S.write_partitioned(_small_fact(spark), table)
    assert S.drop_partitions_before(spark, table, 201909) == ["201908"]
    assert {r.trade_month for r in spark.read.parquet(table).collect()} == {201909}


def test_insert_if_new_skips_existing_and_batch_duplicates(spark):
    existing = spark.createDataFrame([(1, 1, "FUTIDX", "A", "FUT"), (2, 1, "OPTIDX", "A", "OPT")],
                                     "instrument_id int, exchange_id int, instrument_type string, symbol string, "
                                     "series string")
    batch = spark.createDataFrame([(1, "FUTIDX", "A", "FUT"), (2, "FUTIDX", "B", "FUT"), (2, "FUTIDX", "B", "FUT"),
                                   (1, "FUTSTK", "C", "FUT")],
                                  "exchange_id int, instrument_type string, symbol string, series string")
    new = S.new_rows_with_ids(existing, batch, N.INSTRUMENT_KEY, "instrument_id", ["exchange_id"]).collect()
    assert sorted((r.instrument_id, r.exchange_id, r.symbol) for r in new) == [(3, 1, "C"), (4, 2, "B")]


def test_stream_bars_hold_every_event_open_days_and_late_ones(spark, tmp_path):
    from tests.conftest import SF001
    events = spark.read.parquet(f"{SF001}/events.parquet")
    inbox, root = str(tmp_path / "inbox"), str(tmp_path / "bars")
    middle = events.agg(F.percentile_approx(F.unix_date(F.to_date("ts")), 0.5)).first()[0]
    newer = F.unix_date(F.to_date("ts")) >= middle
    events.where(newer).repartition(3).write.parquet(inbox)
    SB.run_daily_bars(spark, inbox, root, str(tmp_path / "ck"), events.schema, max_files=2)
    events.where(~newer).write.mode("append").parquet(inbox)  # far later than any watermark
    SB.run_daily_bars(spark, inbox, root, str(tmp_path / "ck"), events.schema)
    want = sorted(map(tuple, SB.daily_bars(events).collect()))  # the same aggregate over all events at once
    assert sorted(map(tuple, SB.read_bars(spark, root).collect())) == want
    SB.add_events(spark, root, events, str(tmp_path / "ck"), 0)  # a batch that is tried again
    assert sorted(map(tuple, SB.read_bars(spark, root).collect())) == want


def test_bars_of_ties_and_nulls(spark, tmp_path):
    schema = "event_id long, ts timestamp_ntz, event_type string, value double"
    at = dt.datetime(2024, 1, 1, 9)
    root = str(tmp_path / "bars")
    SB.add_events(spark, root, spark.createDataFrame([(2, at, "a", 5.0), (3, at, "a", 7.0), (4, None, "a", 1.0)], schema), "s", 0)
    SB.add_events(spark, root, spark.createDataFrame([(1, at, "a", 6.0), (9, at, None, 2.0)], schema), "s", 1)
    got = {r.event_type: (r.open, r.high, r.low, r.close, r.n_events, r.total_value) for r in SB.read_bars(spark, root).collect()}
    assert got == {"a": (6.0, 7.0, 5.0, 7.0, 3, 18.0), None: (2.0, 2.0, 2.0, 2.0, 1, 2.0)}


def test_load_counters_rows_in_equal_trades_plus_rejects(spark, tmp_path):
    from derivspark.sources import store
    from derivspark.sources.fixtures import fno_feed
    from tests.conftest import SF001
    feed = fno_feed(spark, SF001)
    # two extra rows: one without timestamp, one without expiry date
    extra = feed.limit(2).withColumn("_i", F.monotonically_increasing_id())
    extra = extra.withColumn("timestamp", F.when(F.col("_i") == F.lit(0), F.lit(None)).otherwise(F.col("timestamp"))) \
        .withColumn("expiry_date", F.when(F.col("_i") != F.lit(0), F.lit(None)).otherwise(F.col("expiry_date"))) \
        .drop("_i")
    rows = store.write_model(spark, feed.unionByName(extra), str(tmp_path / "s"))
    assert rows["feed"] == rows["trades"] + rows["rejected"]
    assert rows["rejected"] == 2


def test_split_by_year(spark, tmp_path):
    from derivspark.sources.store import open_model
    from tests.conftest import SF001
    m = open_model(spark, SF001)
    path = S.split_by_year(m, str(tmp_path / "years"))
    from derivspark.sources.fs import list_partitions
    assert [v for v, _ in list_partitions(spark, path, "trade_year")] == ["2019"]
    assert spark.read.parquet(path).count() == m.trades.count()


def test_publish_is_first_writer_wins(spark, tmp_path):
    from derivspark.sources.fs import delete_path, exists, publish
    a, b, dst = tmp_path / "a", tmp_path / "b", str(tmp_path / "store")
    for d, tag in ((a, "a"), (b, "b")):
        d.mkdir()
        (d / "_meta").write_text(tag)
    assert publish(spark, str(a), dst) is True
    assert publish(spark, str(b), dst) is False       # a concurrent builder loses ...
    delete_path(spark, str(b))                         # ... and drops its copy
    assert (tmp_path / "store" / "_meta").read_text() == "a" and not exists(spark, str(b))


def test_raw_csv_load_gives_the_same_store_as_the_direct_mapping(spark, tmp_path):
    """Render the fixture rows as raw CSV (blank strike/option on half the
    futures, upper-case month names), load them back: identical tables."""
    from derivspark.sources import raw_feed as RF
    from derivspark.sources.fixtures import fno_feed
    from derivspark.plans.maintain import load_csv
    from derivspark.sources.store import open_model
    from tests.conftest import SF001
    csv = RF.write_raw_csv(RF.render_raw(fno_feed(spark, SF001, keep_source_keys=True)), str(tmp_path / "csv"))
    loaded = load_csv(spark, csv, str(tmp_path / "store"))
    direct = open_model(spark, SF001)
    for t in ["instruments", "expiries", "trades", "daily"]:
        x, y = getattr(loaded, t), getattr(direct, t)
        assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0, t


def _keyed_fact(spark):
    rows = [(1, 7, dt.date(2019, 8, 5), 10, 201908), (2, 7, dt.date(2019, 8, 5), 20, 201908),
            (3, 8, dt.date(2019, 9, 5), 30, 201909), (4, 8, dt.date(2019, 9, 6), 40, 201909)]
    return spark.createDataFrame(rows, "trade_id long, expiry_id int, trade_date date, change_in_oi bigint, trade_month int")


def test_upsert_keeps_the_other_row_of_a_contract_day_and_the_newest_version(spark, tmp_path):
    table, inbox = str(tmp_path / "fact"), str(tmp_path / "in")
    S.write_partitioned(_keyed_fact(spark), table)
    schema = spark.read.parquet(table).schema
    fix = lambda v: spark.read.parquet(table).where("trade_id = 1").withColumn("change_in_oi", F.lit(v).cast("bigint"))
    first, second = fix(11).collect(), fix(12).collect()
    for rows in (first, second):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(inbox)
        time.sleep(1.1)  # file times have whole seconds on some stores
    SU.run_upserts(spark, inbox, table, str(tmp_path / "ck"), str(tmp_path / "stage"))
    got = {r.trade_id: r.change_in_oi for r in spark.read.parquet(table).collect()}
    assert got == {1: 12, 2: 20, 3: 30, 4: 40}


def test_upsert_retry_after_a_crash_in_the_overwrite(spark, tmp_path):
    table, stage = str(tmp_path / "fact"), str(tmp_path / "stage")
    S.write_partitioned(_keyed_fact(spark), table)
    fix = spark.createDataFrame([(3, 8, dt.date(2019, 10, 1), 33, 201910)], _keyed_fact(spark).schema)
    assert SU.upsert_batch(spark, fix, table, stage, epoch=0) == [201909, 201910]
    shutil.rmtree(os.path.join(table, "trade_month=201909"))  # as a crash leaves it: old partition gone
    SU.upsert_batch(spark, fix, table, stage, epoch=0)
    got = {r.trade_id: (r.change_in_oi, r.trade_month) for r in spark.read.parquet(table).collect()}
    assert got == {1: (10, 201908), 2: (20, 201908), 3: (33, 201910), 4: (40, 201909)}


def test_upsert_takes_the_newest_timestamp_not_the_latest_file(spark):
    rows = [(1, 5, dt.datetime(2019, 8, 2), dt.datetime(2026, 1, 1)), (1, 9, dt.datetime(2019, 8, 1), dt.datetime(2026, 1, 2)),
            (2, 5, dt.datetime(2019, 8, 2), dt.datetime(2026, 1, 1)), (2, 6, dt.datetime(2019, 8, 2), dt.datetime(2026, 1, 2))]
    batch = spark.createDataFrame(rows, f"trade_id long, v int, timestamp timestamp_ntz, {SU.FILE_TIME} timestamp")
    got = {r.trade_id: r.v for r in SU.newest_versions(batch, ["trade_id"], ["trade_id", "v", "timestamp"]).collect()}
    assert got == {1: 5, 2: 6}


def test_upsert_refuses_an_older_version_in_a_later_run(spark, tmp_path):
    table = str(tmp_path / "fact")
    rows = [(1, dt.date(2019, 8, 5), 10, dt.datetime(2019, 8, 5), 201908)]
    schema = "trade_id long, trade_date date, change_in_oi bigint, timestamp timestamp_ntz, trade_month int"
    S.write_partitioned(spark.createDataFrame(rows, schema), table)
    for epoch, (day, value, want) in enumerate([(7, 1, 1), (6, 9, 1), (7, 2, 2), (8, 3, 3)]):
        fix = spark.createDataFrame([(1, dt.date(2019, 8, 5), value, dt.datetime(2019, 8, day), 201908)], schema)
        SU.upsert_batch(spark, fix, table, str(tmp_path / "stage"), epoch)
        assert [r.change_in_oi for r in spark.read.parquet(table).collect()] == [want], epoch
