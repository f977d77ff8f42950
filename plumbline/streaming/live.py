"""Live checks as Structured Streaming plans.

Input: a stream of ticks (symbol, source, event_id, ts, close, ...). Watermarks bound the state; late ticks beyond them are
dropped. Checks with state of their own (halts, the last n ticks, the circuit breaker) are in ``state``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WATERMARK = "5 minutes"
HALT = "300 seconds"
#: Length of the stretches of time by which two feeds are joined, in ranges that a pair may be apart.
STRETCH = 6


def watermarked(ticks: DataFrame) -> DataFrame:
    """The stream with the watermark that the plans below need; a stream has one only."""
    return ticks.withWatermark("ts", WATERMARK)


def deduplicated(ticks: DataFrame) -> DataFrame:
    """Each event of a watermarked stream once; state is kept for the watermark only."""
    return ticks.dropDuplicatesWithinWatermark(["symbol", "source", "event_id"])


def minute_bars(ticks: DataFrame) -> DataFrame:
    """Tumbling one-minute bars, emitted when the watermark passes their end."""
    return (
        ticks.groupBy(F.window("ts", "1 minute"), "symbol", "source")
        .agg(F.min_by("close", "ts").alias("open"), F.max("close").alias("high"), F.min("close").alias("low"), F.max_by("close", "ts").alias("close"), F.count("*").alias("ticks"), F.sum(outside_session().cast("long")).alias("outside"))
        .select("symbol", "source", F.col("window.start").alias("ts"), "open", "high", "low", "close", "ticks", "outside")
    )


def sessions(ticks: DataFrame) -> DataFrame:
    """Spans of ticks without a gap of HALT; more than one a day is a halt."""
    return ticks.groupBy(F.session_window("ts", HALT), "symbol", "source").agg(F.count("*").alias("ticks")).select("symbol", "source", F.col("session_window.start").alias("first"), F.col("session_window.end").alias("closed"), "ticks")


def feed_agreement(one: DataFrame, two: DataFrame, tolerance: float = 0.003, within: str = "60 seconds", late: str = WATERMARK) -> DataFrame:
    """Ticks of two feeds of a symbol at most ``within`` apart whose closes differ by more than ``tolerance``.

    Each side gets its own watermark, and the time range bounds how long a tick can wait for a partner: Spark drops ticks
    from the join's state once the other side's watermark has passed their range, and late ticks meet nothing. The join is
    by symbol and stretch of time (``STRETCH`` ranges), so a tick is compared with those near it and not with all of its
    symbol that wait; one of the second feed near the end of a stretch stands in the next one too, and a pair meets in the
    stretch of its first tick only. Rows with a null close, symbol or time never agree or disagree.
    """
    a = one.select(F.col("symbol"), F.col("ts").alias("ts"), F.col("event_id").alias("event"), F.col("close").alias("a")).withWatermark("ts", late)
    b = two.select(F.col("symbol").alias("other_symbol"), F.col("ts").alias("other_ts"), F.col("event_id").alias("other_event"), F.col("close").alias("b")).withWatermark("other_ts", late)
    stretch = f"{STRETCH} * unix_micros(timestamp'1970-01-01 00:00:00Z' + interval {within})"
    a = a.withColumn("stretch", F.expr(f"unix_micros(ts) div ({stretch})"))
    lo, hi = (f"unix_micros(other_ts {sign} interval {within}) div ({stretch})" for sign in "-+")
    b = b.withColumn("other_stretch", F.explode(F.expr(f"sequence({lo}, {hi})")))
    near = F.expr(f"symbol = other_symbol AND stretch = other_stretch AND other_ts >= ts - interval {within} AND other_ts <= ts + interval {within}")
    return a.join(b, near).where((F.col("b") != 0) & (F.abs(F.col("a") / F.col("b") - 1) > tolerance)).select("symbol", "event", "other_event", "a", "b")


def outside_session() -> Column:
    at = F.hour("ts") * 60 + F.minute("ts")
    return (at < 555) | (at > 930)
