"""Curated table schemas and the fixed reference values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the original project's for identical results)
# ---------------------------------------------------------------------------
# Exchange reference rows: (exchange_id, exchange_code, exchange_name, country, is_active)
EXCHANGE_ROWS = [
    (1, "NSE", "National Stock Exchange of India", "India", True),
    (2, "BSE", "Bombay Stock Exchange", "India", True),
    (3, "MCX", "Multi Commodity Exchange of India", "India", True),
]
INSTRUMENT_TYPES = ["FUTIDX", "OPTIDX", "FUTSTK", "OPTSTK"]
SERIES_VALUES = ["FUT", "OPT"]
OPTION_TYPES = ["CE", "PE", "XX"]
# Raw feed date format, e.g. 29-AUG-2019 (month name, any case).
RAW_DATE_FORMAT = "dd-MMM-yyyy"
# Raw feed header (15 mapped columns plus one trailing unnamed column).
RAW_COLUMNS = [
    "INSTRUMENT", "SYMBOL", "EXPIRY_DT", "STRIKE_PR", "OPTION_TYP", "OPEN", "HIGH",
    "LOW", "CLOSE", "SETTLE_PR", "CONTRACTS", "VAL_INLAKH", "OPEN_INT", "CHG_IN_OI",
    "TIMESTAMP", "_EXTRA",
]
DEFAULT_COUNTRY = "India"
DEFAULT_STRIKE = 0
DEFAULT_OPTION_TYPE = "XX"
# ---------------------------------------------------------------------------

PRICE = T.DecimalType(12, 2)
VALUE = T.DecimalType(15, 2)

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

EXCHANGES = T.StructType([
    T.StructField("exchange_id", T.IntegerType(), False),
    T.StructField("exchange_code", T.StringType(), False),
    T.StructField("exchange_name", T.StringType(), False),
    T.StructField("country", T.StringType(), True),
    T.StructField("is_active", T.BooleanType(), True),
])

# Typed feed = the raw feed after the lenient typed projection, plus the
# exchange the file belongs to.
FEED = T.StructType([
    T.StructField("exchange_id", T.IntegerType(), True),
    T.StructField("instrument_type", T.StringType(), True),
    T.StructField("symbol", T.StringType(), True),
    T.StructField("expiry_date", T.DateType(), True),
    T.StructField("strike_price", PRICE, True),
    T.StructField("option_type", T.StringType(), True),
    T.StructField("open", PRICE, True),
    T.StructField("high", PRICE, True),
    T.StructField("low", PRICE, True),
    T.StructField("close", PRICE, True),
    T.StructField("settle_price", PRICE, True),
    T.StructField("contracts", T.LongType(), True),
    T.StructField("value_in_lakh", VALUE, True),
    T.StructField("open_interest", T.LongType(), True),
    T.StructField("change_in_oi", T.LongType(), True),
    T.StructField("timestamp", T.TimestampNTZType(), True),
])

MEASURES = ["open", "high", "low", "close", "settle_price", "contracts",
            "value_in_lakh", "open_interest", "change_in_oi"]

TRADE_COLUMNS = ["trade_id", "expiry_id", "instrument_id", "trade_date", *MEASURES,
                 "timestamp"]
