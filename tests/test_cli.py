"""Raw CSV -> store -> reports, charts and statistics through the command line."""

import pytest
from pyspark.sql import functions as F

from derivspark import cli
from derivspark.sources import raw_feed as RF
from derivspark.sources.fixtures import BANKNIFTY, NIFTY, fno_feed
from derivspark.sources.store import read_model
from derivspark.sources.testdata import fingerprint
from conftest import SF001

SYMBOLS = f"{NIFTY},{BANKNIFTY}"


def _lines(folder):
    files = list(folder.glob("*.csv"))
    return [line for f in files for line in f.read_text().splitlines()]


def test_raw_csv_to_reports_charts_and_statistics(spark, tmp_path, capsys):
    raw, store, out = (str(tmp_path / n) for n in ("raw", "store", "out"))
    RF.write_raw_csv(RF.render_raw(fno_feed(spark, SF001, keep_source_keys=True)), raw)
    cli.main(["load-csv", "--csv", raw, "--store", store])
    for form in ("runner", "full"):
        cli.main(["reports", "--store", store, "--out", out, "--form", form, "--symbols", SYMBOLS])
    cli.main(["charts", "--store", store, "--out", out, "--symbols", SYMBOLS])
    cli.main(["stats", "--store", store])
    printed = capsys.readouterr().out
    for key in [*cli.REPORTS["runner"], *cli.REPORTS["full"], *cli.CHARTS]:
        assert f"== {key}\n" in printed
        assert (tmp_path / "out" / key / "_SUCCESS").exists()
    assert "Total Trades | 6,0" in printed or "Total Trades | 5,9" in printed
    days = _lines(tmp_path / "out" / "chart_oi_trends")
    assert len(days) > 50
    assert all(line.split(",")[1][:4] in ("2019", "trad") or line.split(",")[0][:4] in ("2019", "trad") for line in days)
    with pytest.raises(FileExistsError):
        cli.main(["load-csv", "--csv", raw, "--store", store])


def test_a_command_without_its_input_is_refused():
    for command in ("reports", "append-csv", "retain", "vacuum"):
        with pytest.raises(SystemExit):
            cli.main([command])


def test_a_store_kept_up_to_date(spark, tmp_path, capsys):
    raw, more, fixes, store = (str(tmp_path / n) for n in ("raw", "more", "fixes", "store"))
    feed = fno_feed(spark, SF001, keep_source_keys=True)
    old = "to_date(timestamp) < '2019-11-14'"
    RF.write_raw_csv(RF.render_raw(feed.where(old)), raw)
    RF.write_raw_csv(RF.render_raw(feed.where(f"not ({old})")), more)
    cli.main(["load-csv", "--csv", raw, "--store", store])
    for _ in range(2):
        cli.main(["append-csv", "--csv", more, "--store", store, "--delivery", "last days"])
    model = read_model(spark, store)
    assert model.rows["trades"] == feed.count()
    model.trades.where("trade_id = 1").withColumn("contracts", F.lit(4242).cast("long")).write.parquet(fixes)
    cli.main(["correct", "--csv", fixes, "--store", store])
    cli.main(["retain", "--store", store, "--months", "1"])
    cli.main(["compact", "--store", store])
    cli.main(["rejects", "--store", store])
    cli.main(["vacuum", "--store", store])
    cli.main(["stats", "--store", store])
    now = read_model(spark, store)
    assert now.periods == [201911] and 0 < now.rows["trades"] < model.rows["trades"]
    assert model.trades.count() == model.rows["trades"]  # the earlier reader's version is still there
    assert "'n_trades': 1" in capsys.readouterr().out


def test_changed_input_changes_the_fingerprint(spark, tmp_path):
    spark.range(5).write.parquet(f"{tmp_path}/t.parquet")
    first = fingerprint(spark, str(tmp_path), ["t"])
    assert fingerprint(spark, str(tmp_path), ["t"]) == first
    spark.range(1).write.mode("append").parquet(f"{tmp_path}/t.parquet")
    assert fingerprint(spark, str(tmp_path), ["t"]) != first
