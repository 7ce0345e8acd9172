"""One store through its life: loads, corrections, retention, compaction. Every change is one
version; a writer that breaks off changes nothing; a reader keeps its version."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from derivspark.plans import maintain as MT
from derivspark.plans.rollup import daily_aggregates
from derivspark.schemas import FEED
from derivspark.sources import raw_feed as RF
from derivspark.sources.fixtures import fno_feed
from derivspark.sources.store import model_of, read_model
from derivspark.sources.versions import Conflict, Transaction, open_version, update, vacuum
from tests.conftest import SF001

D = Decimal


def feed_row(symbol, day, contracts=10, high="12.00", low="8.00", close="10.00", kind="FUTIDX", expiry=dt.date(2019, 8, 29)):
    return (1, kind, symbol, expiry, None, None, D("9.00"), D(high), D(low), D(close), D("10.00"), contracts, D("5.00"),
            100, 3, dt.datetime.combine(day, dt.time()) if day else None)


DAYS = [dt.date(2019, 8, 1), dt.date(2019, 8, 2), dt.date(2019, 9, 2)]


def feed(spark, *rows):
    return spark.createDataFrame(list(rows), FEED)


def first_day(spark):
    return feed(spark, *[feed_row(s, DAYS[0], c) for s in ("A", "B") for c in (0, 5, 9)])


def later_days(spark):
    return feed(spark, feed_row("A", DAYS[1]), feed_row("C", DAYS[2]), feed_row("A", DAYS[0], 50, high="99.00"))


def content(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def daily_is_right(version):
    """The kept aggregates equal those of a full build."""
    part = "trade_month"
    return content(version.table("daily")) == content(daily_aggregates(version.table("trades"), part))


def state(version):
    return {n: content(version.table(n)) for n in ("instruments", "expiries", "trades", "daily")}


def natural(model):
    t = model.trades.join(model.instruments, "instrument_id").drop("trade_id", "expiry_id", "instrument_id")
    return content(t)


def test_days_added_one_by_one_hold_what_one_load_holds(spark, tmp_path):
    whole = fno_feed(spark, SF001)
    root, once = str(tmp_path / "days"), str(tmp_path / "once")
    cuts = ["2019-08-01", "2019-09-10", "2019-10-20", "2019-12-01"]
    for lo, hi in zip(cuts, cuts[1:]):
        part = whole.where((F.col("timestamp") >= F.lit(lo).cast("timestamp_ntz")) & (F.col("timestamp") < F.lit(hi).cast("timestamp_ntz")))
        MT.load(spark, root, part, delivery=lo)
    MT.load(spark, once, whole, delivery="all")
    days, all_at_once = read_model(spark, root), read_model(spark, once)
    assert natural(days) == natural(all_at_once)
    assert daily_is_right(open_version(spark, root))
    for name, key in (("instruments", "instrument_id"), ("expiries", "expiry_id"), ("trades", "trade_id")):
        ids = getattr(days, name).agg(F.count("*"), F.countDistinct(key), F.min(key), F.max(key)).first()
        n = getattr(all_at_once, name).count()
        assert tuple(ids) == (n, n, 1, n), name
    assert days.rows["trades"] == all_at_once.rows["trades"] and days.last_trade_date() == all_at_once.last_trade_date()


def test_a_delivery_is_loaded_once(spark, tmp_path):
    root = str(tmp_path / "s")
    MT.load(spark, root, first_day(spark), "d1")
    second = MT.load(spark, root, later_days(spark), "d2")
    again = MT.load(spark, root, later_days(spark), "d2")
    assert again.number == second.number == 2 and again.rows("trades") == 9
    assert MT.load(spark, root, later_days(spark), "d3").rows("trades") == 12  # the same rows sent anew are new rows
    assert sorted(r.delivery for r in open_version(spark, root).table("deliveries").collect()) == ["d1", "d2", "d3"]


def test_rejected_lines_are_kept_with_their_reason(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    good = "FUTIDX,NIFTY,29-AUG-2019,0,XX,100,101,99,100,100,10,1000,500,5,01-AUG-2019,"
    lines = [",".join(RF.RAW_COLUMNS[:-1]) + ",", good, good.replace("01-AUG", "32-AUG"), good.replace("29-AUG-2019", ""),
             good.replace("NIFTY", ""), good + ",x,y", "nothing", good]
    (raw / "nse.csv").write_text("\n".join(lines) + "\n")
    m = MT.load_csv(spark, str(raw), str(tmp_path / "s"), exchange_id=1)
    v = open_version(spark, str(tmp_path / "s"))
    got = sorted((r.reason, r.line) for r in v.table("rejects").collect())
    assert [r for r, _ in got] == ["malformed line", "malformed line", "no expiry date", "no instrument", "no trade date"]
    assert (good + ",x,y") in [line for _, line in got] and "nothing" in [line for _, line in got]
    assert m.rows["feed"] == m.rows["trades"] + m.rows["rejected"] == 7
    with pytest.raises(FileExistsError):
        MT.load_csv(spark, str(raw), str(tmp_path / "s"), exchange_id=1)
    assert MT.append_csv(spark, str(raw), str(tmp_path / "s"), exchange_id=1, delivery="resent").rows["trades"] == 4


def test_corrections_keep_the_aggregates_and_the_newest_version(spark, tmp_path):
    root = str(tmp_path / "s")
    MT.load(spark, root, first_day(spark).unionByName(later_days(spark)), "d1")
    t = open_version(spark, root).table("trades")

    def fix(where, **changes):
        return t.where(where).withColumns({k: F.lit(v).cast(t.schema[k].dataType) for k, v in changes.items()})

    top = t.where("high = 99").first().trade_id
    # The row with the day's extremes, a row that loses its volume, a row that moves to another month.
    moved = t.where("trade_date = '2019-08-02'").first().trade_id
    batch = fix(f"trade_id = {top}", high=D("11.00"), contracts=1).unionByName(
        fix(f"trade_id = {moved}", trade_date=dt.date(2019, 9, 9), timestamp=dt.datetime(2019, 9, 9))).unionByName(
        t.where("contracts = 5").withColumn("contracts", F.lit(0).cast("long")))
    v = MT.correct(spark, root, batch, "c1")
    assert daily_is_right(v) and v.rows("trades") == 9
    assert v.table("daily").where("day_high = 99").isEmpty() and v.table("daily").where("trade_date = '2019-08-02'").isEmpty()
    assert MT.correct(spark, root, batch, "c1").number == v.number
    stamp = F.col("timestamp")
    newer = fix(f"trade_id = {top}", close=D("1.00")).withColumn("timestamp", (stamp + F.expr("INTERVAL 5 DAY")).cast("timestamp_ntz"))
    older = fix(f"trade_id = {top}", close=D("9.00")).withColumn("timestamp", (stamp + F.expr("INTERVAL 4 DAY")).cast("timestamp_ntz"))
    MT.correct(spark, root, newer, "c2")
    v = MT.correct(spark, root, older, "c3")  # an older version in a later run
    assert [r.close for r in v.table("trades").where(f"trade_id = {top}").collect()] == [D("1.00")] and daily_is_right(v)
    log = {r.delivery: (r.n_trades, r.n_stale) for r in v.table("deliveries").collect()}
    assert log["c2"] == (1, 0) and log["c3"] == (0, 1)
    both = MT.correct(spark, root, newer.unionByName(older).withColumn("trade_id", F.lit(77).cast("long")), "c4")
    assert [r.close for r in both.table("trades").where("trade_id = 77").collect()] == [D("1.00")] and daily_is_right(both)
    assert MT.load(spark, root, first_day(spark), "d9").table("trades").agg(F.max("trade_id")).first()[0] == 77 + 6
    with pytest.raises(ValueError):
        MT.correct(spark, root, fix("contracts = 9", trade_date=None), "c5")


def test_corrections_of_a_real_feed_equal_a_full_build(spark, tmp_path):
    root = str(tmp_path / "s")
    MT.load(spark, root, fno_feed(spark, SF001), "all")
    t = open_version(spark, root).table("trades")
    batch = t.where("trade_id % 7 = 0").withColumns({
        "high": (F.col("high") - 100).cast("decimal(12,2)"), "contracts": F.when(F.col("trade_id") % 2 == 0, F.lit(0)).otherwise(
            F.col("contracts") + 1), "low": F.when(F.col("trade_id") % 3 == 0, F.lit(0)).otherwise(F.col("low")).cast("decimal(12,2)")})
    v = MT.correct(spark, root, batch, "c")
    assert daily_is_right(v)


def test_a_reader_keeps_its_version(spark, tmp_path):
    root = str(tmp_path / "s")
    reader = model_of(MT.load(spark, root, first_day(spark), "d1"))
    before = (content(reader.trades), content(reader.daily), content(reader.instruments))
    MT.load(spark, root, later_days(spark), "d2")
    t = open_version(spark, root).table("trades")
    MT.correct(spark, root, t.withColumn("contracts", F.col("contracts") + 1), "c1")
    v = MT.retain(spark, root, 1)
    assert v.partitions("trades") == v.partitions("daily") == [201909] and v.rows("trades") == 1 and daily_is_right(v)
    MT.compact(spark, root, max_folders=0)
    assert (content(reader.trades), content(reader.daily), content(reader.instruments)) == before
    assert content(read_model(spark, root, version=1).trades) == before[0]


class Broken(Exception):
    pass


def crash_at(step):
    seen = [0]

    def hook(name):
        if seen[0] == step:
            raise Broken(name)
        seen[0] += 1
    return hook


OPERATIONS = {
    "load": lambda spark, root, hook: MT.load(spark, root, later_days(spark), "d2", on_step=hook),
    "correct": lambda spark, root, hook: MT.correct(
        spark, root, open_version(spark, root, 1).table("trades").withColumn("high", F.lit(7).cast("decimal(12,2)")), "c1", on_step=hook),
    "retain": lambda spark, root, hook: MT.retain(spark, root, 1, on_step=hook),
    "compact": lambda spark, root, hook: MT.compact(spark, root, 0, on_step=hook),
}


@pytest.mark.parametrize("name", sorted(OPERATIONS))
def test_a_crash_at_any_step_changes_nothing_or_everything(spark, tmp_path, name):
    run, root, clean = OPERATIONS[name], str(tmp_path / "s"), str(tmp_path / "clean")
    start = first_day(spark).unionByName(feed(spark, feed_row("A", DAYS[2])))
    for r in (root, clean):
        MT.load(spark, r, start, "d1")
    want = state(run(spark, clean, None))
    before = state(open_version(spark, root))
    for step in range(100):
        try:
            run(spark, root, crash_at(step))
        except Broken as e:
            v = open_version(spark, root)
            assert v.number == (2 if str(e) == "after publish" else 1), str(e)
            if v.number == 2:
                break
            if step % 3 == 0:
                assert state(v) == before, str(e)
        else:
            raise AssertionError("never reached its end")
    assert state(run(spark, root, None) if name in ("load", "correct") else open_version(spark, root)) == want
    assert daily_is_right(open_version(spark, root))
    gone = vacuum(spark, root, keep_versions=1, min_age_hours=-1)
    assert gone and state(open_version(spark, root)) == want


def test_of_two_writers_one_starts_again(spark, tmp_path):
    root = str(tmp_path / "s")
    base = MT.load(spark, root, first_day(spark), "d1")
    slow = Transaction(base)
    slow.add("rejects", spark.createDataFrame([("x", 1, "r", "l")], MT.REJECTS))
    MT.load(spark, root, later_days(spark), "d2")
    with pytest.raises(Conflict):
        slow.publish("slow")
    tries = []

    def change(t):
        tries.append(t.base.number)
        if len(tries) == 1:
            MT.load(spark, root, feed(spark, feed_row("Z", DAYS[2])), "d3")
        t.add("rejects", spark.createDataFrame([("y", 1, "r", "l")], MT.REJECTS))
    v = update(spark, root, "twice", change)
    assert tries == [2, 3] and v.number == 4 and v.rows("trades") == 10 and v.rows("rejects") == 1
