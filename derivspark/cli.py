"""Command line: build a store, run the reports, export chart data.

    python -m derivspark.cli load     --sf-dir DIR
    python -m derivspark.cli load-csv --csv DIR --store DIR [--exchange-id N] [--grain month|week|day]
    python -m derivspark.cli append-csv --csv DIR --store DIR [--exchange-id N] [--delivery NAME]
    python -m derivspark.cli correct  --csv PARQUET_DIR --store DIR [--delivery NAME]
    python -m derivspark.cli retain   --store DIR --months N
    python -m derivspark.cli compact  --store DIR
    python -m derivspark.cli vacuum   --store DIR
    python -m derivspark.cli rejects  --store DIR [--out OUT]
    python -m derivspark.cli reports  (--store DIR | --sf-dir DIR) [--out OUT] [--form runner|full]
    python -m derivspark.cli charts   (--store DIR | --sf-dir DIR) [--out OUT]
    python -m derivspark.cli stats    (--store DIR | --sf-dir DIR)

Results are printed whole and written as CSV with a header, with their own types
(DATE, DECIMAL). ``--symbols`` names the two index symbols of the symbol reports:
NIFTY,BANKNIFTY on a store, their stand-ins on the test tables. ``append-csv`` adds a delivery (e.g. a
trading day) once; ``correct`` replaces trades by id unless the stored version is newer; both, and
``retain``, make one new version of the store, and running reports keep the one they opened.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from derivspark.plans import analytics as A
from derivspark.session import get_spark
from derivspark.sources import fixtures
from derivspark.sources.sinks import print_result, write_result_csv
from derivspark.plans.maintain import append_csv, compact, correct, load_csv, retain
from derivspark.sources.store import open_model, read_model
from derivspark.sources.versions import open_version, vacuum

REPORTS = {
    "runner": ["runner_q1_oi_change", "runner_q2_volatility", "runner_q3_cross_exchange", "runner_q4_option_chain",
               "runner_q5_max_volume", "runner_q6_price_movement", "runner_q7_active_expiries"],
    "full": ["full_q1_oi_change", "full_q2_volatility", "full_q3_cross_exchange", "full_q4_option_chain",
             "full_q5_max_volume", "full_q6_price_movement", "full_q7_active_expiries"],
}
CHARTS = ["chart_oi_trends", "chart_volume_histogram", "chart_volatility_heatmap", "chart_option_chain"]
ONE_SYMBOL = {"full_q2_volatility", "runner_q4_option_chain", "chart_volatility_heatmap", "chart_option_chain"}
TWO_SYMBOLS = {"full_q4_option_chain", "chart_oi_trends"}


def parameters(key: str, symbols: list[str]) -> dict:
    if key in ONE_SYMBOL:
        return {"symbol": symbols[0]}
    return {"symbols": symbols} if key in TWO_SYMBOLS else {}


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="derivspark")
    ap.add_argument("command", choices=["load", "load-csv", "append-csv", "correct", "retain", "compact", "vacuum", "rejects",
                                        "reports", "charts", "stats"])
    ap.add_argument("--sf-dir")
    ap.add_argument("--csv")
    ap.add_argument("--store")
    ap.add_argument("--exchange-id", type=int, default=None)
    ap.add_argument("--grain", choices=["month", "week", "day"], default="month")
    ap.add_argument("--out", default=None)
    ap.add_argument("--form", choices=sorted(REPORTS), default="runner")
    ap.add_argument("--symbols", default=None)
    ap.add_argument("--delivery", default=None)
    ap.add_argument("--months", type=int, default=None)
    ap.add_argument("--master", default=None)
    a = ap.parse_args(argv)
    files = a.csv and a.store
    needed = {"load": a.sf_dir, "load-csv": files, "append-csv": files, "correct": files, "retain": a.store and a.months,
              "compact": a.store, "vacuum": a.store, "rejects": a.store}.get(a.command, a.store or a.sf_dir)
    if not needed:
        ap.error(f"{a.command} needs its input folder")
    spark = get_spark(a.master)
    if a.command == "load-csv":
        print(load_csv(spark, a.csv, a.store, a.exchange_id, a.grain).rows)
        return
    if a.command == "append-csv":
        print(append_csv(spark, a.csv, a.store, a.exchange_id, a.delivery).rows)
        return
    if a.command == "correct":
        v = correct(spark, a.store, spark.read.parquet(a.csv), a.delivery or a.csv)
        print(v.table("deliveries").where(F.col("delivery") == (a.delivery or a.csv)).first().asDict())
        return
    if a.command in ("retain", "compact"):
        v = retain(spark, a.store, a.months) if a.command == "retain" else compact(spark, a.store)
        print({"version": v.number, "trades": v.rows("trades"), "partitions": v.partitions("trades")})
        return
    if a.command == "vacuum":
        print(f"{len(vacuum(spark, a.store))} files and folders removed")
        return
    if a.command == "rejects":
        rejects = open_version(spark, a.store).table("rejects")
        print_result(rejects.groupBy("delivery", "reason").count().orderBy("delivery", "reason"))
        if a.out:
            write_result_csv(rejects, f"{a.out}/rejects")
        return
    if a.command == "load":
        print(open_model(spark, a.sf_dir).rows)
        return
    model = read_model(spark, a.store) if a.store else open_model(spark, a.sf_dir)
    named = [A.NIFTY, A.BANKNIFTY] if a.store else [fixtures.NIFTY, fixtures.BANKNIFTY]
    symbols = a.symbols.split(",") if a.symbols else named
    keys = {"reports": REPORTS[a.form], "charts": CHARTS, "stats": ["db_statistics"]}[a.command]
    for key in keys:
        df = getattr(A, key)(model, **parameters(key, symbols))
        print(f"== {key}")
        print_result(df)
        if a.out:  # reports end in a limit; chart data may be large
            write_result_csv(df, f"{a.out}/{key}", single_file=a.command == "reports")


if __name__ == "__main__":
    main()
