"""Deterministic mapping of the driver's TPC-H-shaped tables onto the
end-of-day futures & options feed (one row per contract per day).

``lineitem ⋈ part ⋈ supplier ⋈ nation`` (all inner, no fan-out): each
lineitem row becomes one typed feed row. The mapping is pure column
arithmetic, so it runs inside the scan stage; only the joins shuffle, and
Spark picks broadcast vs. shuffle join from the table sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from derivspark.schemas import PRICE, VALUE
from derivspark.sources.testdata import read_table

# Fixed values of the mapping --------------------------------------------------
FIRST_TRADE_DATE = "2019-08-01"
TRADE_DATE_SPAN = 107                      # trade_date = first + l_orderkey % 107
EXPIRY_BY_LINE = ["2019-08-29", "2019-09-26", "2019-10-31", "2019-11-28"]  # l_linenumber % 4
STRIKE_BASE, STRIKE_STEP, STRIKE_SPAN = 10700, 100, 7
INDEX_BRAND_MAX = 5                        # Brand#1..5 are index symbols
OPTION_BY_FLAG = {"A": "CE", "R": "PE", "N": "XX"}
OI_SPAN, OI_STEP = 5000, 10
CHG_OI_SPAN, CHG_OI_SHIFT = 21, 10
PRICE_SPREAD = 1000
VOLUME_PER_QTY = 10
# Symbols that play the index names in the named analytics.
NIFTY = "Brand#2"
BANKNIFTY = "Brand#3"
# ------------------------------------------------------------------------------

INPUT_TABLES = ["lineitem", "part", "supplier", "nation"]


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    supp = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # nation has a fixed 25 rows: a proven size bound for a broadcast.
    nation = F.broadcast(read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"))
    return (li.join(part, li.l_partkey == part.p_partkey)
              .join(supp, li.l_suppkey == supp.s_suppkey)
              .join(nation, F.col("s_nationkey") == nation.n_nationkey))


def fno_feed(spark: SparkSession, sf_dir: str, keep_source_keys: bool = False) -> DataFrame:
    """Typed feed rows (``schemas.FEED`` columns) derived from lineitem."""
    j = _joined(spark, sf_dir)
    px = F.col("l_extendedprice").cast(PRICE)
    d = F.col("l_discount").cast(PRICE)
    tx = F.col("l_tax").cast(PRICE)
    qty = F.col("l_quantity").cast("int")
    bno = F.substring("p_brand", 7, 100).cast("int")
    flag = F.col("l_returnflag")
    line = F.col("l_linenumber")

    expiry = F.element_at(F.array(*[F.lit(x).cast("date") for x in EXPIRY_BY_LINE]),
                          (line % 4 + 1).cast("int"))
    option_type = F.when(flag == "A", OPTION_BY_FLAG["A"]).when(flag == "R", OPTION_BY_FLAG["R"]) \
        .otherwise(OPTION_BY_FLAG["N"])
    strike = F.when(flag == "N", F.lit(0)) \
        .otherwise(STRIKE_BASE + STRIKE_STEP * (F.col("l_partkey") % STRIKE_SPAN)).cast(PRICE)
    trade_date = F.date_add(F.lit(FIRST_TRADE_DATE).cast("date"),
                            (F.col("l_orderkey") % TRADE_DATE_SPAN).cast("int"))
    high = (px + d * PRICE_SPREAD * qty).cast(PRICE)
    low = (px - tx * PRICE_SPREAD * qty).cast(PRICE)
    contracts = F.when((F.col("l_linestatus") == "O") & (line == 1), F.lit(0)) \
        .otherwise(qty * VOLUME_PER_QTY).cast("bigint")

    cols = [
        (F.col("n_regionkey") % 3 + 1).cast("int").alias("exchange_id"),
        F.concat(F.when(flag == "N", "FUT").otherwise("OPT"),
                 F.when(bno <= INDEX_BRAND_MAX, "IDX").otherwise("STK")).alias("instrument_type"),
        F.col("p_brand").alias("symbol"),
        expiry.alias("expiry_date"),
        strike.alias("strike_price"),
        option_type.alias("option_type"),
        F.when(line % 2 == 0, low).otherwise(high).alias("open"),
        high.alias("high"),
        low.alias("low"),
        px.alias("close"),
        (px + tx).cast(PRICE).alias("settle_price"),
        contracts.alias("contracts"),
        (px * contracts).cast(VALUE).alias("value_in_lakh"),
        ((F.col("l_partkey") % OI_SPAN) * OI_STEP).cast("bigint").alias("open_interest"),
        (((F.col("l_suppkey") % CHG_OI_SPAN) - CHG_OI_SHIFT) * qty).cast("bigint").alias("change_in_oi"),
        trade_date.cast("timestamp_ntz").alias("timestamp"),
    ]
    if keep_source_keys:
        cols += [F.col("l_orderkey"), F.col("l_linenumber")]
    return j.select(*cols)
