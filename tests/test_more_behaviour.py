"""Wide heat-map pivot, DQ quarantine and replay-safe stream ingest."""

from pyspark.sql import functions as F

from derivspark.plans import analytics as A
from derivspark.plans import maintain as MT
from derivspark.plans import quality as Q
from derivspark.sources import raw_feed as RF
from derivspark.sources.fixtures import NIFTY, fno_feed
from derivspark.sources.store import open_model, read_model
from derivspark.sources.versions import open_version
from derivspark.streaming import ingest as SI
from tests.conftest import SF001, SF01


def test_heatmap_matrix_is_the_long_form_pivoted(spark):
    m = open_model(spark, SF01)
    long = A.chart_volatility_heatmap(m, symbol=NIFTY)
    wide = A.heatmap_matrix(long)
    cells = {(r.strike_price, r.trade_date): r.volatility for r in long.collect()}
    dates = [c for c in wide.columns if c != "strike_price"]
    assert len(dates) == len({d for _, d in cells}) and wide.count() == len({k for k, _ in cells})
    for r in wide.collect():
        for d in dates:
            v = r[d]
            key = (r.strike_price, next(k for s, k in cells if str(k) == d))
            assert v == cells.get(key)


def test_quarantine_lists_failed_rules(spark):
    dirty = Q.dirty_feed(fno_feed(spark, SF001, keep_source_keys=True))
    bad = Q.quarantine(dirty)
    counts = {r.rule: r.violations for r in Q.check_violations(dirty).collect()}
    exploded = bad.select(F.explode("failed_rules").alias("rule")).groupBy("rule").count().collect()
    assert {r.rule: r["count"] for r in exploded} == {k: v for k, v in counts.items()
                                                       if v and not k.startswith("not_null")}


def _inbox(spark, tmp_path):
    """Two raw lines of exchange 1, and a writer of files made of them."""
    raw = tmp_path / "raw"
    RF.write_raw_csv(RF.render_raw(fno_feed(spark, SF001, keep_source_keys=True).where("exchange_id = 1").limit(2)).coalesce(1), str(raw))
    folder = raw / "exchange_id=1"
    first = next(folder.glob("*.csv"))
    head, a, b = first.read_text().splitlines()
    first.unlink()

    def put(name, *lines, into="raw/exchange_id=1"):
        (tmp_path / into).mkdir(parents=True, exist_ok=True)
        (tmp_path / into / name).write_text("\n".join([head, *lines]) + "\n")
    return str(raw), a, b, put


def _copies(spark, root):
    rows = open_version(spark, root).table("feed")
    return sorted(r["count"] for r in rows.groupBy(*rows.columns).count().collect())


def test_stream_ingest_stores_every_file_once(spark, tmp_path):
    raw, a, b, put = _inbox(spark, tmp_path)
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    put("p1.csv", a, a, b), put("p2.csv", a, a, b)  # equal files of one delivery: both count
    SI.run_ingest(spark, raw, out, ck)
    assert _copies(spark, out) == [2, 4]
    SI.run_ingest(spark, raw, out, str(tmp_path / "ck2"))  # everything again: known
    assert _copies(spark, out) == [2, 4] and open_version(spark, out).number == 1
    put("p3.csv", a), put("p1.csv", a, a, b, b)  # a later file, and a known name with other content
    SI.run_ingest(spark, raw, out, str(tmp_path / "ck3"))
    assert _copies(spark, out) == [4, 7]
    put("p3.csv", a, into="elsewhere/exchange_id=1")  # sent again from another place
    SI.run_ingest(spark, str(tmp_path / "elsewhere"), out, str(tmp_path / "ck4"))
    assert _copies(spark, out) == [4, 7]
    put("late.csv", a + ",x", "junk", b.replace("2019", "x"))
    SI.run_ingest(spark, raw, out, ck)
    v = open_version(spark, out)
    assert _copies(spark, out) == [4, 7] and v.rows("files") == 5
    assert sorted(r.reason for r in v.table("rejects").collect()) == ["malformed line", "malformed line", "no trade date"]


def test_the_same_file_in_a_new_delivery_is_new(spark, tmp_path):
    _, a, b, put = _inbox(spark, tmp_path)
    out, inbox = str(tmp_path / "out"), str(tmp_path / "in")
    put("p.csv", a, b, into="in/delivery=1/exchange_id=1")
    SI.run_ingest(spark, inbox, out, str(tmp_path / "ck"))
    put("p.csv", a, b, into="in/delivery=2/exchange_id=1")
    SI.run_ingest(spark, inbox, out, str(tmp_path / "ck"))
    SI.run_ingest(spark, inbox, out, str(tmp_path / "ck2"))
    assert _copies(spark, out) == [2, 2]


class Broken(Exception):
    pass


def test_a_batch_that_broke_off_is_neither_lost_nor_doubled(spark, tmp_path):
    raw, a, b, put = _inbox(spark, tmp_path)
    put("p.csv", a, b, b)
    batch = SI.ingest_stream(RF.read_raw_lines(spark, raw)).cache()
    root = str(tmp_path / "out")
    for step in range(20):
        seen = [0]

        def hook(name):
            seen[0] += 1
            if seen[0] > step:
                raise Broken(name)
        try:
            SI.ingest_batch(spark, batch, root, on_step=hook)
        except Broken as e:
            if str(e) == "after publish":
                break
            assert open_version(spark, root).number == 0
    assert SI.ingest_batch(spark, batch, root).number == 1 and _copies(spark, root) == [1, 2]


def test_streaming_into_the_model_equals_a_load(spark, tmp_path):
    raw, model, once = (str(tmp_path / n) for n in ("raw", "model", "once"))
    feed = fno_feed(spark, SF001, keep_source_keys=True)
    RF.write_raw_csv(RF.render_raw(feed), raw)
    SI.run_ingest(spark, raw, model, str(tmp_path / "ck"), into_model=True)
    SI.run_ingest(spark, raw, model, str(tmp_path / "ck2"), into_model=True)  # known files
    MT.load_csv(spark, raw, once)
    streamed, loaded = read_model(spark, model), read_model(spark, once)
    assert open_version(spark, model).number == 1
    for t in ("instruments", "expiries", "trades", "daily"):
        x, y = getattr(streamed, t), getattr(loaded, t)
        assert x.exceptAll(y).isEmpty() and y.exceptAll(x).isEmpty(), t
