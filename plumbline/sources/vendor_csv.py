"""Vendor files: one CSV for each timeframe, source, exchange, product and symbol, read as one typed relation.

Path: ``{root}/{timeframe}/{source}/{exchange}/{product_class}/{SYMBOL}.csv``. Every column is read as a string and cast
afterwards, so a bad cell is a null and not a failed read. Keys come from the path, lower-cased where folders vary.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.functions.semantics import cleaned, number

KEYS = ["symbol", "timeframe", "exchange", "source", "product_class"]
FIELDS = ["open", "high", "low", "close", "adj_close", "volume", "open_interest"]
FORMATS = ["d-M-yyyy H:m:s", "d-M-yyyy", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd"]


def keyed(raw: DataFrame) -> DataFrame:
    """``raw`` with the keys of its file's path."""
    parts = F.reverse(F.split(F.url_decode(F.input_file_name()), "/"))
    at = {"symbol": F.regexp_replace(parts[0], r"(?i)\.csv$", ""), "product_class": F.upper(parts[1]), "exchange": F.upper(parts[2]), "source": F.lower(parts[3]), "timeframe": F.lower(parts[4])}
    return raw.withColumns(at)


def normalise(raw: DataFrame) -> DataFrame:
    """Typed bars: header names trimmed and lower-cased, absent columns defaulted, bad timestamps dropped, extras kept.

    row_seq is the order of arrival; it decides which of several equal timestamps is first.
    """
    df = raw.toDF(*[c.strip().lower() for c in raw.columns])
    stamp = next((c for c in ("datetimestamp", "date", "ts") if c in df.columns), None)
    if stamp is None:
        return df.limit(0).withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    when = F.coalesce(*[F.try_to_timestamp(cleaned(F.col(stamp)), F.lit(f)) for f in FORMATS]).cast("timestamp_ntz")
    df = df.withColumn("ts", when).withColumn("row_seq", F.monotonically_increasing_id()).where("ts IS NOT NULL")
    for c in FIELDS:
        if c in df.columns:
            df = df.withColumn(c, number(cleaned(F.col(c))))
    defaults = {"adj_close": F.col("close") if "close" in df.columns else F.lit(None).cast("double"), "volume": F.lit(0.0), "open_interest": F.lit(0.0)}
    for c in FIELDS:
        if c not in df.columns:
            df = df.withColumn(c, defaults.get(c, F.lit(None).cast("double")))
    rest = [c for c in df.columns if c not in {*KEYS, "ts", *FIELDS, "row_seq", stamp}]
    return df.select(*[c for c in KEYS if c in df.columns], "ts", *FIELDS, *rest, "row_seq")


def read_bars(spark: SparkSession, root: str, timeframe: str = "*") -> DataFrame:
    """All vendor files under ``root``; the scan lists files in parallel and no file is opened on the driver."""
    raw = spark.read.option("header", True).option("inferSchema", False).option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").csv(f"{root}/{timeframe}" if timeframe != "*" else root)
    return normalise(keyed(raw))


def deduplicated(bars: DataFrame) -> DataFrame:
    """The first row of every key and timestamp, in order of arrival."""
    w = W.partitionBy(*KEYS, "ts").orderBy("row_seq")
    return bars.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def available(bars: DataFrame, expected: DataFrame) -> DataFrame:
    """``expected`` keys with found (boolean) and rows; what is missing stays with found = false."""
    have = bars.groupBy(*KEYS).agg(F.count("*").alias("rows"))
    return expected.join(have, KEYS, "left").withColumn("found", F.col("rows").isNotNull())


def prevalidate(bars: DataFrame) -> DataFrame:
    """(keys, name, status): five quick verdicts of each frame, from one aggregation."""
    w = W.partitionBy(*KEYS)
    rows = bars.withColumn("_same", F.count("*").over(W.partitionBy(*KEYS, "ts"))).withColumn("_late", F.col("ts") < F.lag("ts").over(w.orderBy("row_seq")))
    a = rows.groupBy(*KEYS).agg(
        F.count("*").alias("n"),
        F.sum(F.expr("int(open is null or high is null or low is null or close is null)")).alias("nulls"),
        F.sum(F.expr("int(_same > 1)")).alias("dups"),
        F.sum(F.coalesce(F.col("_late").cast("int"), F.lit(0))).alias("late"),
        F.sum(F.expr("int(coalesce(high < low, false))")).alias("inverted"),
    )
    return a.selectExpr(*KEYS, "stack(5, 'rows', if(n > 0, 'OK', 'FAIL'), 'nulls', if(nulls = 0, 'OK', 'WARN'), 'duplicates', if(dups = 0, 'OK', 'WARN'), 'order', if(late = 0, 'OK', 'WARN'), 'range', if(inverted = 0, 'OK', 'FAIL')) as (name, status)")


def write_bars(bars: DataFrame, path: str, run_id: str) -> None:
    """Sink of repaired or merged bars, a folder for each key, as CSV with a header."""
    bars.withColumn("run_id", F.lit(run_id)).write.mode("append").option("header", True).partitionBy("run_id", "timeframe", "source", "exchange", "product_class", "symbol").csv(path)


def append_run(spark: SparkSession, record: DataFrame, path: str) -> None:
    """Add a run to the index unless its run_id is there."""
    try:
        known = spark.read.parquet(path).select("run_id")
        record = record.join(known, "run_id", "left_anti")
    except Exception as e:  # the index does not exist before the first run
        if "PATH_NOT_FOUND" not in str(e):
            raise
    record.write.mode("append").parquet(path)
