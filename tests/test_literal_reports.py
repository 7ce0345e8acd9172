"""Reports over a tiny store built from literal feed rows (edge cases)."""

import datetime as dt
from decimal import Decimal as D

import pytest

from derivspark.plans import analytics as A
from derivspark.schemas import FEED
from derivspark.sources.store import read_model, write_model

DAY1, DAY2 = dt.datetime(2019, 8, 1), dt.datetime(2019, 8, 2)
EXP = dt.date(2019, 8, 29)


def row(ex, itype, sym, strike, opt, close, contracts, ts, settle=None, oi=100, chg=5):
    c = D(close)
    return (ex, itype, sym, EXP, D(strike) if strike is not None else None, opt, c, c + 1, c - 1, c,
            D(settle) if settle else c, contracts, c * contracts, oi, chg, ts)


@pytest.fixture(scope="module")
def model(spark, tmp_path_factory):
    rows = [
        # futures on one exchange only (NSE): no BSE / MCX side
        row(1, "FUTIDX", "IDX1", "0", "XX", "100.00", 10, DAY1, settle="101.00"),
        row(1, "FUTIDX", "IDX1", None, None, "102.00", 20, DAY2, settle="103.00"),  # NULL strike/option
        # a zero-volume day for STK1 on DAY2
        row(1, "FUTSTK", "STK1", "0", "XX", "50.00", 5, DAY1),
        row(1, "FUTSTK", "STK1", "0", "XX", "51.00", 0, DAY2),
        # options: CE without PE at one strike
        row(2, "OPTIDX", "IDX1", "11000", "CE", "10.00", 7, DAY1),
        row(2, "OPTIDX", "IDX1", "11100", "CE", "8.00", 3, DAY1),
        row(2, "OPTIDX", "IDX1", "11100", "PE", "12.00", 6, DAY1),
    ]
    path = str(tmp_path_factory.mktemp("literal") / "store")
    write_model(spark, spark.createDataFrame(rows, FEED), path)
    return read_model(spark, path)


def test_null_strike_rows_join_the_zero_strike_contract(model):
    assert model.expiries.count() == 5  # IDX1 future (one contract), STK1 future, three options
    assert model.trades.count() == 7


def test_cross_exchange_with_one_exchange_only(model):
    out = {r.trade_date.date() if hasattr(r.trade_date, "date") else r.trade_date: r
           for r in A.full_q3_cross_exchange(model).where("symbol = 'IDX1'").collect()}
    r = out[dt.date(2019, 8, 1)]
    assert r.nse_settle_price == 101.0 and r.bse_settle_price is None and r.mcx_settle_price is None
    assert r.nse_bse_spread == 0.0 and r.spread_pct == 0.0 and r.bse_volume is None


def test_zero_volume_day_drops_out_of_the_nonzero_report(model):
    allv = {(r.symbol, r.trade_date) for r in A.bench_b1_volume(model, "2019-08-01", "2019-08-31", k=100).collect()}
    nonz = {(r.symbol, r.trade_date) for r in
            A.bench_b1_volume(model, "2019-08-01", "2019-08-31", k=100, nonzero=True).collect()}
    assert ("STK1", dt.date(2019, 8, 2)) in allv and ("STK1", dt.date(2019, 8, 2)) not in nonz
    five = A.full_q5_max_volume(model, days=30).where("symbol = 'STK1'").collect()
    assert [r.daily_volume for r in five] == [5]


def test_option_chain_side_missing(model):
    chain = {r.strike_price: r for r in A.full_q4_option_chain(model, symbols=["IDX1"], day="2019-08-01").collect()}
    assert chain[D("11000.00")].put_price is None and chain[D("11000.00")].pcr_volume is None
    assert chain[D("11100.00")].pcr_volume == 2.0
    runner = {r.strike_price: r for r in A.runner_q4_option_chain(model, symbol="IDX1", expiry_from="2019-08-01")
              .collect()}
    assert runner[D("11000.00")].PE_volume == 0 and runner[D("11000.00")].CE_volume == 7
