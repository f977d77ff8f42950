"""What a run reads besides bars (vendor folders, instruments, the universe) and what it writes (results, audits).

Everything is a DataFrame; a reader takes any number of files, and a writer's reader gives back what was written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Folders of the vendor tree that count.
SOURCES = ["DHAN", "UPSTOX", "KITE"]
EXCHANGES = ["NSE", "BSE"]
PRODUCT_CLASSES = ["EQUITY", "ETF", "INDEX", "INDEX_EQUITY", "FUTURES", "OPTIONS"]
#: What stands for an absent or unreadable figure of an instrument.
LOT_SIZE, TICK_SIZE, PRICE_BAND_PCT, LISTED = 1, 0.05, 20.0, "2000-01-01"
DATES = ["dd-MMM-yy", "dd-MM-yyyy", "dd/MM/yyyy", "yyyy-MM-dd"]
_FIGURES = ("success_score", "weight", "weighted_score")
_RESULT = "symbol test_id source exchange product_class timeframe layer category severity gate_type status success_score weight weighted_score details last_run".split()
RESULT_SCHEMA = T.StructType([T.StructField(c, T.DoubleType() if c in _FIGURES else T.StringType()) for c in _RESULT])


def files(spark: SparkSession, root: str, mode: str = "Both") -> DataFrame:
    """(timeframe, source, exchange, product_class, symbol, path, length, reason) of every vendor file; reason is null for a file that counts.

    Only names and lengths are read, by tasks; Spark's scan leaves out empty files. ``mode`` is EOD, Intraday or Both.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(root).select("path", "length")
    part = F.reverse(F.split(F.url_decode("path"), "/"))
    keyed = listed.select("path", "length", *[F.upper(F.trim(x)).alias(c) for c, x in (("symbol", F.regexp_replace(part[0], r"(?i)\.csv$", "")), ("product_class", part[1]), ("exchange", part[2]), ("source", part[3]), ("timeframe", part[4]))])
    wanted = {"EOD": ["EOD"], "Intraday": ["INTRADAY"]}.get(mode, ["EOD", "INTRADAY"])
    known = {"timeframe": wanted, "source": SOURCES, "exchange": EXCHANGES, "product_class": PRODUCT_CLASSES}
    reason = F.coalesce(*[F.when(~F.col(c).isin(v), F.lit(f"unknown {c}")) for c, v in known.items()], F.when(F.col("symbol") == "", F.lit("no symbol")))
    return keyed.select("timeframe", "source", "exchange", "product_class", "symbol", "path", "length", reason.alias("reason"))


def discover(spark: SparkSession, root: str, mode: str = "Both") -> DataFrame:
    """(symbol): the symbols of all files that count, once each, in order."""
    return files(spark, root, mode).where("reason IS NULL").select("symbol").distinct().orderBy("symbol")


def missing(spark: SparkSession, root: str, expected: DataFrame) -> DataFrame:
    """Rows of ``expected`` (timeframe, source, exchange, product_class, symbol; upper case) without a file that counts, with the reason."""
    keys = ["timeframe", "source", "exchange", "product_class", "symbol"]
    have = files(spark, root).groupBy(*keys).agg(F.max(F.col("reason").isNull()).alias("found"), F.max("reason").alias("reason"))
    joined = expected.select(*keys).join(have, keys, "left").where(~F.coalesce("found", F.lit(False)))
    return joined.select(*keys, F.coalesce("reason", F.lit("no file, or an empty one")).alias("reason"))


def _table(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("header", True).option("inferSchema", False).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path)
    raw = raw.toDF(*[c.strip() for c in raw.columns])
    return raw.select(*[F.trim(F.col(f"`{c}`")).alias(c) for c in raw.columns])


def instruments(spark: SparkSession, path: str) -> DataFrame:
    """One row an instrument file's line: symbol, kind, exchanges, product_classes, figures with defaults, dates, prefixes.

    A listing date that can't be read is 2000-01-01; two-digit years are of this century. Without a symbol of either
    exchange an instrument counts for both.
    """
    df = _table(spark, path)

    def text(name: str, default: str = "") -> Column:
        return F.coalesce(F.nullif(F.col(f"`{name}`"), F.lit("")), F.lit(default)) if name in df.columns else F.lit(default)

    def figure(name: str, default: float) -> Column:
        value = text(name).try_cast("double")
        return F.coalesce(F.when(~F.isnan(value), value), F.lit(float(default)))

    nse, bse = text("nse_symbol"), text("bse_symbol")
    listed = F.coalesce(*[F.try_to_timestamp(text("listing_date"), F.lit(f)).cast("date") for f in DATES], F.lit(LISTED).cast("date"))
    both = F.filter(F.array(F.when(nse != "", F.lit("NSE")), F.when(bse != "", F.lit("BSE"))), lambda x: x.isNotNull())
    return df.select(
        F.col("Symbol").alias("symbol"),
        F.coalesce(F.nullif(text("display_name"), F.lit("")), F.col("Symbol")).alias("display_name"),
        F.lower(text("instrument_type", "Equity")).alias("type"),
        text("instrument_type", "Equity").alias("instrument_type"),
        F.when(F.size(both) > 0, both).otherwise(F.array(*map(F.lit, EXCHANGES))).alias("exchanges"),
        F.transform(F.split(text("product_classes", "EQUITY"), ","), lambda x: F.trim(x)).alias("product_classes"),
        figure("lot_size", LOT_SIZE).cast("int").alias("lot_size"),
        figure("tick_size", TICK_SIZE).alias("tick_size"),
        figure("price_band_pct", PRICE_BAND_PCT).alias("price_band_pct"),
        text("PAID UP VALUE").alias("paid_up_value"),
        text("ISIN").alias("isin"),
        listed.alias("listing_date"),
        nse.alias("nse_symbol"),
        bse.alias("bse_symbol"),
        text("file_prefix_nse").alias("file_prefix_nse"),
        text("file_prefix_bse").alias("file_prefix_bse"),
    )


def universe(spark: SparkSession, path: str) -> DataFrame:
    """(place, symbol, industry) of a universe file; headers in any case, symbols in upper case, empty ones left out.

    ``place`` ascends as the file's lines do.
    """
    df = _table(spark, path)
    found = {c.lower(): c for c in df.columns}
    if "symbol" not in found:
        raise ValueError(f"no Symbol column among {df.columns}")
    industry = F.col(f"`{found['industry']}`") if "industry" in found else F.lit(None).cast("string")
    rows = df.select(F.monotonically_increasing_id().alias("place"), F.upper(F.col(f"`{found['symbol']}`")).alias("symbol"), industry.alias("industry"))
    return rows.where("symbol IS NOT NULL AND symbol <> ''")


def write_results(results: DataFrame, path: str) -> None:
    """Results as CSV with the sixteen fixed columns; what ``results`` lacks is filled with a default, other columns are left out."""
    fill = {"string": F.lit(""), "double": F.lit(0.0)}
    cols = [F.coalesce(F.col(f.name).cast(f.dataType), fill[f.dataType.simpleString()]) if f.name in results.columns else fill[f.dataType.simpleString()] for f in RESULT_SCHEMA.fields]
    results.select(*[c.alias(f.name) for c, f in zip(cols, RESULT_SCHEMA.fields, strict=True)]).write.mode("append").option("header", True).option("emptyValue", "").csv(path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`write_results` wrote, with its types; empty text reads as null."""
    return spark.read.schema(RESULT_SCHEMA).option("header", True).csv(path)


def write_audit(audit: DataFrame, path: str) -> None:
    """An audit (a row for each changed cell) as JSON and as CSV, with a summary: actions, changes and mean confidence."""
    audit.write.mode("append").json(f"{path}/json")
    audit.write.mode("append").option("header", True).csv(f"{path}/csv")
    summary = audit.groupBy("action").agg(F.count("*").alias("changes"), F.avg("confidence").alias("confidence")) if "confidence" in audit.columns else audit.groupBy("action").agg(F.count("*").alias("changes"))
    summary.write.mode("append").json(f"{path}/summary")
