"""Findings of round 4: loads keep little on disk, streams into the model do each step once."""

import os
import time

import pytest
from pyspark.sql import functions as F

from derivspark.plans import maintain as MT
from derivspark.plans import model_jobs as MJ
from derivspark.schemas import RAW_COLUMNS
from derivspark.session import bounded_tasks
from derivspark.sources import raw_feed as RF
from derivspark.streaming import ingest as SI

GOOD = "FUTIDX,NIFTY,29-AUG-2019,0,XX,100,101,99,100,100,10,1000,500,5,01-AUG-2019,"
LINES = [GOOD, GOOD, GOOD.replace("01-AUG", "32-AUG"), GOOD.replace("29-AUG-2019", ""), GOOD.replace("NIFTY", ""), GOOD + ",x,y", "nothing",
         GOOD.replace("NIFTY", '"A, ""B"""'), GOOD.replace("FUTIDX", ""), GOOD.replace(",10,", ",1.5,")]
REASONS = ["malformed line", "malformed line", "no expiry date", "no instrument", "no instrument", "no trade date"]


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw" / "delivery=7" / "exchange_id=1"
    folder.mkdir(parents=True)
    for name in ("a.csv", "b.csv"):
        (folder / name).write_text("\n".join([",".join(RAW_COLUMNS[:-1]) + ",", *LINES]) + "\n")
    return str(tmp_path / "raw")


def tables(root, which="_scratch"):
    """Scratch tables of the transactions under ``root``."""
    top = f"{root}/{which}"
    return {n for txn in (os.listdir(top) if os.path.isdir(top) else []) for n in os.listdir(f"{top}/{txn}")}


def lines_of(spark, path):
    return [r[0] for r in spark.read.parquet(path).where(f"{MT.LINE} is not null").select(MT.LINE).collect()]


def watch(spark, root, at):
    """A hook that notes the scratch tables at each step, and the line texts kept in ``at`` when it is staged."""
    seen, kept = {}, []

    def hook(name):
        seen.setdefault(name, tables(root))
        if name == f"staged {at}":
            txn = os.listdir(f"{root}/_scratch")[0]
            kept.extend(lines_of(spark, f"{root}/_scratch/{txn}/{at}"))
    return hook, seen, kept


def test_a_load_keeps_only_rejected_lines_and_what_is_still_read(spark, tmp_path, raw):
    root = str(tmp_path / "s")
    hook, seen, kept = watch(spark, root, "feed")
    v = MT.load(spark, root, MT.csv_feed(spark, raw), "d1", on_step=hook)
    assert len(kept) == 2 * len(REASONS) and GOOD not in kept
    assert "feed" not in seen["wrote trades"] and "ids" not in seen["staged daily-plus"]
    assert sorted(r.reason for r in v.table("rejects").collect()) == sorted(2 * REASONS)
    assert sorted(r.line for r in v.table("rejects").collect()) == sorted(kept)
    assert v.rows("trades") == 2 * (len(LINES) - len(REASONS)) == v.info["feed"] - v.info["rejected"]


def test_streamed_files_are_staged_once(spark, tmp_path, raw):
    root = str(tmp_path / "s")
    batch = SI.ingest_stream(RF.read_raw_lines(spark, raw))
    hook, seen, kept = watch(spark, root, "batch")
    v = MT.load_files(spark, root, batch, on_step=hook)
    assert "staged feed" not in seen and "batch" not in seen["wrote trades"]
    assert len(kept) == 2 * len(REASONS) and sorted(r.line for r in v.table("rejects").collect()) == sorted(kept)
    once = MT.load(spark, str(tmp_path / "once"), MT.csv_feed(spark, raw), "d1")
    for name in ("instruments", "expiries", "trades", "daily"):
        x, y = v.table(name), once.table(name)
        assert x.exceptAll(y).isEmpty() and y.exceptAll(x).isEmpty(), name
    assert MT.load_files(spark, root, batch).number == 1  # known files
    with open(f"{raw}/delivery=7/exchange_id=1/c.csv", "w") as f:
        f.write(",".join(RAW_COLUMNS[:-1]) + ",\n" + GOOD + "\n" + GOOD + ",x\n")
    more = MT.load_files(spark, root, SI.ingest_stream(RF.read_raw_lines(spark, raw)))  # known and new ones together
    assert more.rows("trades") == v.rows("trades") + 1 and more.rows("rejects") == v.rows("rejects") + 1
    assert more.info["feed"] == v.info["feed"] + 2


def test_the_ledger_knows_files_by_the_same_checksum_as_before(spark, raw):
    lines = RF.read_raw_lines(spark, raw)
    text = F.coalesce(F.col(RF.CORRUPT), F.to_csv(F.struct(*RAW_COLUMNS)))
    named = lines.withColumns({MT.FILE: F.col("_metadata.file_path"), MT.SIZE: F.col("_metadata.file_size"), MT.LINE: text})
    typed = RF.typed_feed(named, keep=(RF.CORRUPT, MT.LINE, MT.FILE, MT.SIZE))
    columns = [c for c in typed.columns if c not in (MT.FILE, MT.SIZE)]
    want = typed.groupBy(MT.FILE).agg(F.concat_ws(
        "-", F.sum(F.xxhash64(*columns).cast("decimal(38,0)")), F.bit_xor(F.xxhash64(F.lit("x"), *columns))).alias("checksum"))
    got = MT.file_keys(SI.ingest_stream(lines)).select(MT.FILE, "checksum")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 2


def _tables(spark, path, days):
    """The input tables of a feed with a line for each of ``days`` (days after the first trade date)."""
    rows = [(d, 1, 1, n % 7, 10.0, 1000.0 + n, 0.01, 0.02, "ANR"[n % 3], "O") for n, d in enumerate(days)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string") \
        .coalesce(1).write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame([(1, "Brand#2")], "p_partkey long, p_brand string").write.parquet(f"{path}/part.parquet")
    spark.createDataFrame([(1, 1)], "s_suppkey long, s_nationkey int").write.parquet(f"{path}/supplier.parquet")
    spark.createDataFrame([(1, 1)], "n_nationkey int, n_regionkey int").write.parquet(f"{path}/nation.parquet")
    return path


@pytest.mark.parametrize("days", [[0, 1, 2, 2, 5, 5, 5, 9], [3, 3, 3]])
def test_both_deliveries_are_written_in_one_pass(spark, tmp_path, monkeypatch, days):
    path, written = _tables(spark, str(tmp_path), days), []
    write = RF.write_raw_csv
    monkeypatch.setattr(RF, "write_raw_csv", lambda raw, *a, **k: written.append(raw.count()) or write(raw, *a, **k))
    got = [spark.read.schema(RF.RAW_SCHEMA).option("header", "true").csv(f"{inbox}/delivery={n}").count()
           for n, inbox in enumerate(MJ._deliveries(spark, path))]
    assert got == ([6, 2] if len(days) > 3 else [3, 0])
    assert written[0] == len(days) and sum(written[1:]) == 0
    out = MJ.stream_to_model(spark, path).agg(F.sum("n_trades")).first()[0]
    assert out == len(days)


def _shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (found.apply(i).getName() for i in range(found.size())) if name.startswith("shuffle_")}


def test_a_build_leaves_no_shuffle_files(spark, tmp_path):
    before = _shuffle_files(spark)
    rows = spark.range(1000).repartition(3, "id")
    with bounded_tasks(spark):
        rows.write.parquet(str(tmp_path / "t"))
    until = time.time() + 20
    while (left := _shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left and spark.read.parquet(str(tmp_path / "t")).count() == 1000


def test_the_reconciled_raw_files_are_packed_and_go_when_read(spark, tmp_path, monkeypatch):
    path, folders, files = _tables(spark, str(tmp_path), [0, 1, 101, 103, 109, 113, 202]), [], []
    load = MT.load_csv

    def noted(spark, raw, *a, **k):
        folders.append(raw.removeprefix("file:"))
        files.extend(n for _, _, names in os.walk(folders[0]) for n in names if n.startswith("part-"))
        return load(spark, raw, *a, **k)

    monkeypatch.setattr(MT, "load_csv", noted)
    got = {r.outcome: r.n_lines for r in MJ.load_reconciliation(spark, path).collect()}
    assert got == {"all lines": 7, "trade": 1, "malformed line": 3, "no trade date": 1, "no expiry date": 1, "no instrument": 1}
    assert files and all(n.endswith(".gz") for n in files) and not os.path.exists(folders[0])
