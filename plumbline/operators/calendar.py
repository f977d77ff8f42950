"""Trading calendars as tables: (exchange, d, trading), joined wherever days are counted.

An exchange's own closed days and special sessions come from a file; other weekdays trade. A join on exchange and date
takes them off, so a check never computes dates per row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FRAME = ["symbol", "exchange", "source"]


def closed_days(spark: SparkSession, path: str) -> DataFrame:
    """(exchange, d, open) of a CSV file with Exchange and Date columns; an Open column of yes marks a special session.

    Exchange names are upper-cased; a line without a readable date is left out; of repeated days one is kept, a special
    session before a closure.
    """
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    raw = raw.toDF(*[c.strip().lower() for c in raw.columns])
    opened = F.lower(F.trim("open")).isin("yes", "y", "true", "1") if "open" in raw.columns else F.lit(False)
    day = F.coalesce(*[F.try_to_timestamp(F.trim("date"), F.lit(f)).cast("date") for f in ("yyyy-MM-dd", "dd-MM-yyyy", "dd/MM/yyyy")])
    rows = raw.select(F.upper(F.trim("exchange")).alias("exchange"), day.alias("d"), F.coalesce(opened, F.lit(False)).alias("open")).where("d IS NOT NULL AND exchange IS NOT NULL")
    return rows.groupBy("exchange", "d").agg(F.max("open").alias("open"))


def calendar(spans: DataFrame, closed: DataFrame) -> DataFrame:
    """(exchange, d, trading) of each date of ``spans`` (exchange, lo, hi); spans of one exchange may overlap."""
    whole = spans.groupBy("exchange").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo <= hi")
    days = whole.select("exchange", F.explode(F.sequence("lo", "hi")).alias("d"))
    trading = F.when(F.col("open").isNull(), F.weekday("d") < 5).otherwise(F.col("open"))
    return days.join(closed, ["exchange", "d"], "left").select("exchange", "d", trading.alias("trading"))


def spans(bars: DataFrame) -> DataFrame:
    return bars.where("d IS NOT NULL").groupBy(*FRAME).agg(F.min("d").alias("lo"), F.max("d").alias("hi"))


def _due(bars: DataFrame, days: DataFrame) -> DataFrame:
    """(frame, d): the trading days between a frame's first and last bar."""
    own = spans(bars)
    trading = days.where("trading").select(F.col("exchange").alias("_x"), "d")
    return own.join(trading, (F.col("exchange") == F.col("_x")) & F.col("d").between(F.col("lo"), F.col("hi"))).select(*FRAME, "d")


def missing_days(bars: DataFrame, days: DataFrame) -> DataFrame:
    """(frame, d): trading days without a bar."""
    return _due(bars, days).join(bars.select(*FRAME, "d").distinct(), [*FRAME, "d"], "left_anti")


def extra_days(bars: DataFrame, days: DataFrame) -> DataFrame:
    """(frame, d): dates with a bar that aren't trading days of the calendar."""
    return bars.where("d IS NOT NULL").select(*FRAME, "d").distinct().join(days.where("trading").select("exchange", "d"), ["exchange", "d"], "left_anti").select(*FRAME, "d")


def counted(bars: DataFrame, days: DataFrame) -> DataFrame:
    """(frame, expected, found, missing, extra) by frame, from one join of bars and calendar each way."""
    due = _due(bars, days).groupBy(*FRAME).agg(F.count("*").alias("expected"))
    have = bars.where("d IS NOT NULL").select(*FRAME, "d").distinct().join(days, ["exchange", "d"], "left")
    own = have.groupBy(*FRAME).agg(F.sum(F.coalesce(F.col("trading").cast("long"), F.lit(0))).alias("found"), F.sum(F.when(F.coalesce("trading", F.lit(False)), 0).otherwise(1)).alias("extra"))
    out = own.join(due, FRAME, "left").withColumn("expected", F.coalesce("expected", F.lit(0)))
    return out.select(*FRAME, "expected", "found", (F.col("expected") - F.col("found")).alias("missing"), "extra")
