"""What a chart asks of bars: aggregates by pixel of a view, and axis ranges; times of a zone; measures as JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def viewport(bars: DataFrame, keys: list[str], order: str, value: str, lo: int, hi: int, pixels: int) -> DataFrame:
    """(keys, pixel, first, last, low, high, rows) of the rows with ``order`` (a number) from lo to hi: one aggregation.

    A pixel is drawn from these four values and shows the same extremes as all of its rows. Rows with a null order or value
    take no part; a key without rows in the view has no row.
    """
    if hi <= lo or pixels < 1:
        raise ValueError("a view needs a range and a pixel")
    at = F.least(F.floor((F.col(order) - lo) * pixels / (hi - lo)).cast("int"), F.lit(pixels - 1)).alias("pixel")
    seen = bars.where(F.col(order).between(lo, hi) & F.col(value).isNotNull())
    return seen.groupBy(*keys, at).agg(
        F.min_by(value, F.struct(order, value)).alias("first"), F.max_by(value, F.struct(order, value)).alias("last"), F.min(value).alias("low"), F.max(value).alias("high"), F.count("*").alias("rows")
    )


def axis_ranges(bars: DataFrame, keys: list[str], order: str, lo: int, hi: int) -> DataFrame:
    """(keys, price_min, price_max, volume_max, rows) of a view; of all rows of a key with fewer than two in the view."""
    inside = F.coalesce(F.col(order).between(lo, hi), F.lit(False))
    of = lambda f, c: (f(F.when(inside, F.col(c))), f(F.col(c)))
    pairs = {"price_min": of(F.min, "low"), "price_max": of(F.max, "high"), "volume_max": of(F.max, "volume")}
    many = F.sum(inside.cast("long"))
    made = bars.groupBy(*keys).agg(many.alias("rows"), *[x.alias(f"{n}_{k}") for n, p in pairs.items() for k, x in zip(("view", "all"), p)])
    return made.select(*keys, "rows", *[F.when(F.col("rows") >= 2, F.col(f"{n}_view")).otherwise(F.col(f"{n}_all")).alias(n) for n in pairs])


def shifted(ts: Column, source: str, target: str) -> Column:
    """A zoneless time of ``source`` as the zoneless time of ``target``, whatever the session's zone.

    A time that ``source`` skips is moved on by the gap, one that it has twice is the earlier instant (Java's zone rules).
    """
    return F.convert_timezone(F.lit(source), F.lit(target), ts.cast("timestamp_ntz"))


def wall_time(text: Column, zone: str) -> Column:
    """The zoneless time in ``zone`` of a vendor's text; null where it can't be read.

    Dates are yyyy-MM-dd or dd-MM-yyyy, with a time or without. Text that ends in Z or an offset (+05:30) is that instant;
    other text is a time of ``zone``, and one that the zone skips is moved on by the gap.
    """
    cut = F.regexp_replace(F.trim(text), r"^(\d{1,2})-(\d{1,2})-(\d{4})", "$3-$2-$1")
    offset = r"\s*(Z|[+-]\d\d:?\d\d)$"
    told = F.when(cut.rlike(r"\d:\d\d(:\d\d(\.\d+)?)?" + offset), F.replace(F.regexp_extract(cut, offset, 1), F.lit("Z"), F.lit("+00:00")))
    minutes = (F.substring(told, 2, 2).cast("int") * 60 + F.substring(told, -2, 2).cast("int")) * F.when(F.startswith(told, F.lit("-")), -1).otherwise(1)
    wall = F.when(told.isNull(), cut).otherwise(F.regexp_replace(cut, offset, "")).try_cast("timestamp_ntz")
    utc = wall - F.make_dt_interval(mins=minutes)
    return F.when(told.isNotNull(), shifted(utc, "UTC", zone)).otherwise(shifted(shifted(wall, zone, "UTC"), "UTC", zone))


def measures(**named: Column) -> Column:
    """Measures of a check as JSON, in order of name; null measures are left out."""
    return F.to_json(F.struct(*[named[k].alias(k) for k in sorted(named)]))


def measure(payload: Column, name: str, kind: str = "double") -> Column:
    """One measure of :func:`measures`; null where it is absent or doesn't read as ``kind``."""
    return F.get_json_object(payload, f"$.{name}").try_cast(kind)
