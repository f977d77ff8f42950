"""Queries of the calendar and chart operators over the tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import bars as ops
from plumbline.operators import calendar, views
from plumbline.plans import dialect
from plumbline.plans.checks import HOLIDAYS, TRADING
from plumbline.sources.bars import DAILY, K

KEYS = K.split(", ")
#: A view of three years on 240 pixels, in days since 1970.
VIEW = (8766, 9861, 240)
ZONE, ZONE_MINUTES = "Asia/Kolkata", 330


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialect.query(f"WITH {DAILY.strip()} SELECT * FROM bars")(spark, sf_dir)


def calendar_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = _daily(spark, sf_dir)
    spans = calendar.spans(bars)
    days = spans.groupBy("exchange").agg(F.explode(F.sequence(F.min("lo"), F.max("hi"))).alias("d"))
    closed = days.where(F.struct(F.month("d"), F.day("d")).isin([F.struct(F.lit(m), F.lit(d)) for m, d in HOLIDAYS])).withColumn("open", F.lit(False))
    return calendar.counted(bars, calendar.calendar(spans, closed))


def viewport_closes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.viewport(_daily(spark, sf_dir).withColumn("day", F.datediff("d", F.lit("1970-01-01"))), KEYS, "day", "close", *VIEW)


def viewport_axes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.axis_ranges(_daily(spark, sf_dir).withColumn("day", F.datediff("d", F.lit("1970-01-01"))), KEYS, "day", *VIEW[:2])


def local_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks by day of the exchange's zone, from times of UTC."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("at", views.shifted(F.col("ts"), "UTC", ZONE))
    hhmm = F.hour("at") * 60 + F.minute("at")
    return events.groupBy(F.col("event_type").alias("source"), F.to_date("at").alias("d")).agg(F.count("*").alias("ticks"), F.min(hhmm).alias("first"), F.max(hhmm).alias("last"), F.sum(hhmm.between(555, 930).cast("long")).alias("in_session"))


def check_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several measures of a frame as one payload, and what is read back from it."""
    count = lambda cond: F.sum(F.coalesce(F.expr(cond).cast("long"), F.lit(0)))
    made = _daily(spark, sf_dir).groupBy(*KEYS).agg(
        views.measures(rows=F.count("*"), nulls=count("close IS NULL"), inverted=count("high < low"), negative=count("open < 0"), absent=F.max(F.lit(None).cast("long"))).alias("payload")
    )
    return made.select(*KEYS, "payload", *[views.measure(F.col("payload"), x, "long").alias(x) for x in ("rows", "nulls", "inverted", "absent")])


def source_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far each source's dates lie in another's, and how many dates all sources have."""
    bars, keys = _daily(spark, sf_dir), ["symbol", "exchange"]
    whole = ops.in_all(bars, keys, "source", "d").groupBy(*keys).agg(F.count("*").alias("in_all"))
    return ops.contained(bars, keys, "source", "d").join(whole, keys, "left").withColumn("in_all", F.coalesce("in_all", F.lit(0)))


def aligned_closes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of sources on common dates: how many, and how many closes agree within a tenth."""
    pairs = ops.aligned(_daily(spark, sf_dir), ["symbol", "exchange"], "source", "d", ["close"], "close")
    near = F.sum(F.coalesce((F.abs(F.col("close_one") / F.nullif("close_two", F.lit(0.0)) - 1) <= 0.1).cast("long"), F.lit(0)))
    return pairs.groupBy("symbol", "exchange", "one", "two").agg(F.count("*").alias("rows"), near.alias("near"))


def orders_on_shipping_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of days on which lines were shipped as well, by status."""
    orders, lines = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("orders", "lineitem"))
    return ops.known_elsewhere(orders.withColumn("d", F.col("o_orderdate").cast("date")), lines.select(F.col("l_shipdate").cast("date").alias("d")), ["d"]).groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("orders"))


QUERIES = {"calendar_days": calendar_days, "viewport_closes": viewport_closes, "viewport_axes": viewport_axes, "local_days": local_days, "check_measures": check_measures, "source_overlap": source_overlap, "aligned_closes": aligned_closes, "orders_on_shipping_days": orders_on_shipping_days}
_LO, _HI, _PIXELS = VIEW
_VIEWED = f"WITH {DAILY.strip()}, v AS (SELECT *, date_diff('day', DATE '1970-01-01', d) AS day FROM bars)"
SQL = {
    name: dialect.oracle(text)
    for name, text in {
        "calendar_days": f"WITH {DAILY.strip()}, {TRADING} SELECT {K}, cast(expected AS bigint) AS expected, found, cast(missing AS bigint) AS missing, days - found AS extra FROM frame_days",
        "viewport_closes": f"""{_VIEWED} SELECT {K}, cast(least(floor((day - {_LO}) * {_PIXELS}e0 / {_HI - _LO}), {_PIXELS - 1}) AS int) AS pixel, arg_min(close, day) AS first, arg_max(close, day) AS last, min(close) AS low, max(close) AS high, count(*) AS rows
            FROM v WHERE close IS NOT NULL AND day BETWEEN {_LO} AND {_HI} GROUP BY ALL""",
        "viewport_axes": f"""{_VIEWED}, a AS (SELECT {K}, count(*) FILTER (inside) AS rows, min(low) FILTER (inside) AS l, min(low) AS la, max(high) FILTER (inside) AS h, max(high) AS ha, max(volume) FILTER (inside) AS x, max(volume) AS xa FROM (SELECT *, day BETWEEN {_LO} AND {_HI} AS inside FROM v) GROUP BY ALL)
            SELECT {K}, rows, CASE WHEN rows >= 2 THEN l ELSE la END AS price_min, CASE WHEN rows >= 2 THEN h ELSE ha END AS price_max, CASE WHEN rows >= 2 THEN x ELSE xa END AS volume_max FROM a""",
        "local_days": f"""WITH e AS (SELECT event_type AS source, ts + INTERVAL {ZONE_MINUTES} MINUTE AS moved FROM events), m AS (SELECT source, cast(moved AS date) AS d, cast(hour(moved) * 60 + minute(moved) AS int) AS hhmm FROM e)
            SELECT source, d, count(*) AS ticks, min(hhmm) AS first, max(hhmm) AS last, count(*) FILTER (hhmm BETWEEN 555 AND 930) AS in_session FROM m GROUP BY ALL""",
        "source_overlap": f"""WITH {DAILY.strip()}, t AS (SELECT DISTINCT {K}, d FROM bars), n AS (SELECT symbol, exchange, count(DISTINCT source) AS k FROM t GROUP BY ALL),
            a AS (SELECT symbol, exchange, count(*) AS in_all FROM (SELECT symbol, exchange, d FROM t JOIN n USING (symbol, exchange) GROUP BY ALL HAVING count(*) = max(k)) GROUP BY ALL),
            p AS (SELECT x.symbol, x.exchange, x.source AS one, y.source AS two, count(*) AS common FROM t x JOIN t y ON x.symbol = y.symbol AND x.exchange = y.exchange AND x.d = y.d AND x.source <> y.source GROUP BY ALL)
            SELECT p.*, s.rows, common = s.rows AS subset, coalesce(in_all, 0) AS in_all FROM p JOIN (SELECT symbol, exchange, source, count(*) AS rows FROM t GROUP BY ALL) s ON p.symbol = s.symbol AND p.exchange = s.exchange AND p.one = s.source LEFT JOIN a ON p.symbol = a.symbol AND p.exchange = a.exchange""",
        "aligned_closes": f"""WITH {DAILY.strip()} SELECT x.symbol, x.exchange, x.source AS one, y.source AS two, count(*) AS rows, count(*) FILTER (abs(x.close / nullif(y.close, 0) - 1) <= 0.1) AS near
            FROM bars x JOIN bars y ON x.symbol = y.symbol AND x.exchange = y.exchange AND x.d = y.d AND x.source < y.source GROUP BY ALL""",
        "orders_on_shipping_days": "SELECT o_orderstatus AS status, count(*) AS orders FROM orders WHERE cast(o_orderdate AS date) IN (SELECT cast(l_shipdate AS date) FROM lineitem) GROUP BY ALL",
        "check_measures": f"""WITH {DAILY.strip()}, c AS (SELECT {K}, count(*) AS rows, count(*) FILTER (close IS NULL) AS nulls, count(*) FILTER (high < low) AS inverted, count(*) FILTER (open < 0) AS negative FROM bars GROUP BY ALL)
            SELECT {K}, '{{"inverted":' || inverted || ',"negative":' || negative || ',"nulls":' || nulls || ',"rows":' || rows || '}}' AS payload, rows, nulls, inverted, cast(NULL AS bigint) AS absent FROM c""",
    }.items()
}
