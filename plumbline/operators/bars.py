"""General operators over any bar relation, as DataFrame functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def resample(bars: DataFrame, bucket, keys: list[str], order: str = "ts") -> DataFrame:
    """OHLCV of each key and bucket; null prices are skipped, equal timestamps fall to row order."""
    seen = bars.where(F.col("close").isNotNull())
    return seen.groupBy(*keys, bucket.alias("bucket")).agg(F.min_by("open", order).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", order).alias("close"), F.sum("volume").alias("volume"), F.count("*").alias("n"))


def missing_weekdays(bars: DataFrame, keys: list[str], day: str = "d") -> DataFrame:
    """Weekdays between a frame's first and last day without a bar; the grid is made per frame, in the tasks."""
    span = bars.groupBy(*keys).agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    grid = span.select(*keys, F.explode(F.sequence("lo", "hi")).alias(day)).where(F.weekday(day) < 5)
    return grid.join(bars.select(*keys, day).distinct(), [*keys, day], "left_anti")


def runs(bars: DataFrame, keys: list[str], value: str, order: str = "d") -> DataFrame:
    """(keys, value, start, end, length) of the runs of equal values; nulls don't extend a run."""
    w = W.partitionBy(*keys).orderBy(order)
    new = F.when(F.col(value) == F.lag(value).over(w), 0).otherwise(1)
    marked = bars.withColumn("_new", new).withColumn("_run", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "_run").agg(F.first(value).alias("value"), F.min(order).alias("start"), F.max(order).alias("end"), F.count(value).alias("length")).drop("_run")


def as_of(left: DataFrame, right: DataFrame, keys: list[str], on: str, fields: list[str]) -> DataFrame:
    """``left`` with the last ``fields`` of ``right`` at or before its ``on``: one union and one window, no range join."""
    cols = [*keys, on]
    both = left.select(*left.columns, *[F.lit(None).cast(right.schema[f].dataType).alias(f"_{f}") for f in fields], F.lit(1).alias("_side")).unionByName(
        right.select(*cols, *[F.col(f).alias(f"_{f}") for f in fields], F.lit(0).alias("_side")), allowMissingColumns=True
    )
    w = W.partitionBy(*keys).orderBy(on, "_side").rowsBetween(W.unboundedPreceding, 0)
    return both.withColumns({f: F.last(f"_{f}", ignorenulls=True).over(w) for f in fields}).where("_side = 1").drop("_side", *[f"_{f}" for f in fields])


def jaccard(bars: DataFrame, keys: list[str], member: str, stamp: str) -> DataFrame:
    """Overlap of timestamps of every two members of a key, from counts of one equi-join."""
    t = bars.select(*keys, member, stamp).distinct()
    size = t.groupBy(*keys, member).agg(F.count("*").alias("n"))
    pair = t.alias("a").join(t.alias("b"), [*keys, stamp]).where(F.col(f"a.{member}") < F.col(f"b.{member}"))
    both = pair.groupBy(*keys, F.col(f"a.{member}").alias("one"), F.col(f"b.{member}").alias("two")).agg(F.count("*").alias("common"))
    one, two = size.withColumnRenamed(member, "one").withColumnRenamed("n", "n1"), size.withColumnRenamed(member, "two").withColumnRenamed("n", "n2")
    return both.join(one, [*keys, "one"]).join(two, [*keys, "two"]).withColumn("jaccard", F.col("common") / (F.col("n1") + F.col("n2") - F.col("common")))


def aligned(bars: DataFrame, keys: list[str], member: str, stamp: str, fields: list[str], order: str) -> DataFrame:
    """(keys, one, two, stamp, fields of both) where two members have a stamp in common, of repeated stamps the first in ``order``."""
    first = F.row_number().over(W.partitionBy(*keys, member, stamp).orderBy(order)) == 1
    once = bars.where(F.col(stamp).isNotNull()).withColumn("_first", first).where("_first").select(*keys, member, stamp, *fields)
    one = once.withColumnsRenamed({member: "one"} | {f: f"{f}_one" for f in fields})
    two = once.withColumnsRenamed({member: "two"} | {f: f"{f}_two" for f in fields})
    return one.join(two, [*keys, stamp]).where("one < two")


def in_all(bars: DataFrame, keys: list[str], member: str, stamp: str) -> DataFrame:
    """(keys, stamp): the intersection of all members' stamps, by counting members and not by joining them in turn."""
    seen = bars.where(F.col(stamp).isNotNull()).select(*keys, member, stamp).distinct()
    members = seen.groupBy(*keys).agg(F.count_distinct(member).alias("_members"))
    return seen.groupBy(*keys, stamp).agg(F.count("*").alias("_n")).join(members, keys).where("_n = _members").select(*keys, stamp)


def contained(bars: DataFrame, keys: list[str], member: str, stamp: str) -> DataFrame:
    """(keys, one, two, rows, common, subset) for every two members in either direction that share a stamp: is one's set in two's."""
    seen = bars.where(F.col(stamp).isNotNull()).select(*keys, member, stamp).distinct()
    size = seen.groupBy(*keys, F.col(member).alias("one")).agg(F.count("*").alias("rows"))
    one, two = seen.withColumnRenamed(member, "one"), seen.withColumnRenamed(member, "two")
    common = one.join(two, [*keys, stamp]).where("one <> two").groupBy(*keys, "one", "two").agg(F.count("*").alias("common"))
    return common.join(size, [*keys, "one"]).select(*keys, "one", "two", "rows", "common", (F.col("common") == F.col("rows")).alias("subset"))


def known_elsewhere(bars: DataFrame, others: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``bars`` whose ``on`` stands in ``others`` (a semi join: a row never comes twice)."""
    return bars.join(others.select(*on).distinct(), on, "left_semi")
