"""Raw exchange feed: CSV scan and lenient typed projection.

The feed is read with a declared all-string schema (no inference pass over
the data), malformed lines are dropped, and every field is converted with
a lenient cast: a value that does not parse becomes NULL instead of failing
the job. The exchange a file belongs to is not in the file: files live in
``exchange_id=<n>`` folders, so partition discovery supplies it (or it is
passed explicitly with ``exchange_id``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from derivspark.schemas import PRICE, RAW_COLUMNS, RAW_DATE_FORMAT, RAW_SCHEMA, VALUE
from derivspark.session import bounded_tasks

RAW_WITH_EXCHANGE = T.StructType(RAW_SCHEMA.fields + [T.StructField("exchange_id", T.IntegerType(), True)])
CSV_OPTIONS = {"header": "true", "mode": "DROPMALFORMED"}
CORRUPT = "_corrupt"  # text of a line that has too few or too many fields
LINE_OPTIONS = {"header": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
# A line's field count is only checked when every field is tokenized; with
# CSV column pruning on, a line with extra fields would pass as well-formed.
# The loader needs all fields anyway, so pruning is switched off.
NO_CSV_PRUNING = ("spark.sql.csv.parser.columnPruning.enabled", "false")


def read_raw_csv(spark: SparkSession, path: str, exchange_id: int | None = None) -> DataFrame:
    """Scan raw CSV files, dropping malformed lines; the exchange comes from
    ``exchange_id=<n>`` folders, or from the argument for a single
    exchange's files."""
    spark.conf.set(*NO_CSV_PRUNING)
    if exchange_id is None:
        return spark.read.schema(RAW_WITH_EXCHANGE).options(**CSV_OPTIONS).csv(path)
    return spark.read.schema(RAW_SCHEMA).options(**CSV_OPTIONS).csv(path) \
        .withColumn("exchange_id", F.lit(exchange_id).cast("int"))


def read_raw_lines(spark: SparkSession, path: str, exchange_id: int | None = None) -> DataFrame:
    """Scan raw CSV files keeping every line: a malformed one has its text in ``CORRUPT`` (NULL
    otherwise), so that it can be counted and stored with the reason."""
    spark.conf.set(*NO_CSV_PRUNING)
    schema = RAW_SCHEMA if exchange_id is not None else RAW_WITH_EXCHANGE
    schema = T.StructType([*RAW_SCHEMA.fields, T.StructField(CORRUPT, T.StringType(), True),
                           *schema.fields[len(RAW_SCHEMA.fields):]])
    raw = spark.read.schema(schema).options(**LINE_OPTIONS).csv(path)
    return raw if exchange_id is None else raw.withColumn("exchange_id", F.lit(exchange_id).cast("int"))


def stream_raw_lines(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """The files of ``exchange_id=<n>`` folders as a stream, malformed lines with their text in ``CORRUPT``."""
    spark.conf.set(*NO_CSV_PRUNING)
    schema = T.StructType([*RAW_SCHEMA.fields, T.StructField(CORRUPT, T.StringType(), True), RAW_WITH_EXCHANGE["exchange_id"]])
    return spark.readStream.schema(schema).options(**LINE_OPTIONS).option("maxFilesPerTrigger", max_files).csv(path)


def lenient_decimal(c: str, dtype: T.DecimalType) -> Column:
    return F.col(c).try_cast(dtype)


def lenient_bigint(c: str) -> Column:
    """Text -> BIGINT rounding a fractional value half away from zero
    ('1.5' -> 2) and giving NULL for non-numbers."""
    return F.round(F.col(c).try_cast(T.DecimalType(38, 10)), 0).try_cast(T.LongType())


def lenient_date(c: str) -> Column:
    """'dd-MMM-yyyy' (month name in any case) -> DATE, NULL if unparsable."""
    return F.try_to_date(F.col(c), RAW_DATE_FORMAT)


def typed_feed(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The typed projection of the raw columns (schemas.FEED order), then ``keep`` as they are."""
    return raw.select(
        F.col("exchange_id").cast("int").alias("exchange_id"),
        F.col("INSTRUMENT").alias("instrument_type"),
        F.col("SYMBOL").alias("symbol"),
        lenient_date("EXPIRY_DT").alias("expiry_date"),
        lenient_decimal("STRIKE_PR", PRICE).alias("strike_price"),
        F.col("OPTION_TYP").alias("option_type"),
        lenient_decimal("OPEN", PRICE).alias("open"),
        lenient_decimal("HIGH", PRICE).alias("high"),
        lenient_decimal("LOW", PRICE).alias("low"),
        lenient_decimal("CLOSE", PRICE).alias("close"),
        lenient_decimal("SETTLE_PR", PRICE).alias("settle_price"),
        lenient_bigint("CONTRACTS").alias("contracts"),
        lenient_decimal("VAL_INLAKH", VALUE).alias("value_in_lakh"),
        lenient_bigint("OPEN_INT").alias("open_interest"),
        lenient_bigint("CHG_IN_OI").alias("change_in_oi"),
        lenient_date("TIMESTAMP").cast("timestamp_ntz").alias("timestamp"),
        *keep,
    )


def raw_date(c: str) -> Column:
    return F.upper(F.date_format(F.col(c), RAW_DATE_FORMAT))


def render_raw(feed_with_keys: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Feed rows rendered back to the raw text columns, then ``keep`` as they are. For half of the
    futures (even l_orderkey) strike and option type are left blank, so the
    loader has to make NULL and the 0 / 'XX' defaults meet."""
    blank = F.col("instrument_type").startswith("FUT") & (F.col("l_orderkey") % 2 == 0)
    text = {
        "INSTRUMENT": F.col("instrument_type"),
        "SYMBOL": F.col("symbol"),
        "EXPIRY_DT": raw_date("expiry_date"),
        "STRIKE_PR": F.when(~blank, F.col("strike_price").cast("string")),
        "OPTION_TYP": F.when(~blank, F.col("option_type")),
        "OPEN": F.col("open").cast("string"),
        "HIGH": F.col("high").cast("string"),
        "LOW": F.col("low").cast("string"),
        "CLOSE": F.col("close").cast("string"),
        "SETTLE_PR": F.col("settle_price").cast("string"),
        "CONTRACTS": F.col("contracts").cast("string"),
        "VAL_INLAKH": F.col("value_in_lakh").cast("string"),
        "OPEN_INT": F.col("open_interest").cast("string"),
        "CHG_IN_OI": F.col("change_in_oi").cast("string"),
        "TIMESTAMP": raw_date("timestamp"),
        "_EXTRA": F.lit(None).cast("string"),
    }
    return feed_with_keys.select(*[text[c].alias(c) for c in RAW_COLUMNS], "exchange_id", *keep)


def write_raw_csv(raw: DataFrame, path: str, within: tuple[str, ...] = (), packed: bool = False) -> str:
    """One CSV folder per exchange (``exchange_id=<n>``), header row; ``within``: columns whose folders hold
    those of the exchanges; ``packed``: the files are gzipped."""
    with bounded_tasks(raw.sparkSession):
        raw.write.mode("overwrite").partitionBy(*within, "exchange_id").options(header="true", **(PACKED if packed else {})).csv(path)
    return path
