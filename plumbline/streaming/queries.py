"""Streams over the events table, run until the data at hand are read, and the SQL of what they find.

A query starts the stream with the available-now trigger into the shared folder and reads its sink. The SQL sees the
same ticks at once: those up to the watermark, which is five minutes behind the newest tick.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.plans import dialect
from plumbline.plans.market import LIVE
from plumbline.sources.shared import shared_dir
from plumbline.streaming import live, state

FEED = f"WITH {LIVE.strip()} SELECT symbol, source, event_id, cast(ts AS timestamp) AS ts, close, bid, ask, volume, open_interest, hhmm FROM feed"
#: Results of each tick for the circuit breaker: outside the session (hard) and a wide spread (soft).
RESULTS = "stack(2, 'LT-007', 'Hard', if(hhmm < 555 OR hhmm > 930, 'Fail', 'Pass'), 'LT-014', 'Soft', if(ask - bid > 0.155, 'Fail', 'Pass')) AS (check_id, gate, status)"
LIMIT = 3
#: The two feeds that are compared.
FEEDS = ("click", "view")


def feed(spark: SparkSession, sf_dir: str, files_at_once: int = 1000) -> DataFrame:
    """The ticks of the events table as a stream."""
    table = f"{sf_dir}/events.parquet"
    events = spark.readStream.schema(spark.read.parquet(table).schema).option("maxFilesPerTrigger", files_at_once).parquet(f"{table}*")
    return spark.sql(dialect.render(FEED, "spark"), events=events)


def drained(stream: DataFrame, name: str) -> DataFrame:
    """What the stream makes of the data that are there now."""
    spark = stream.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    query = stream.writeStream.option("path", f"{path}/rows").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")


def _query(name: str, plan: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: drained(plan(live.watermarked(feed(state.with_rocks(spark), sf_dir))), name)


def _breaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = state.with_rocks(spark)
    own.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")  # batches for timers alone would never end
    return drained(state.breaker(feed(own, sf_dir).select("symbol", "source", F.expr(RESULTS)), LIMIT), "live_breaker")


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = state.with_rocks(spark)
    one, two = (feed(own, sf_dir).where(F.col("source") == x) for x in FEEDS)
    return drained(live.feed_agreement(one, two), "live_feed_agreement")


QUERIES = {
    "live_halts": _query("live_halts", state.halts),
    "live_last_ticks": _query("live_last_ticks", state.last_ticks),
    "live_breaker": _breaker,
    "live_feed_agreement": _pairs,
}

_FINAL = f"""{LIVE.strip()},
t AS (SELECT symbol, source, event_id, @MICROS(ts) AS us, close, volume, open_interest, ask - bid AS spread, hhmm FROM feed),
w AS (SELECT (max(us) // 1000 - 300000) * 1000 AS wm FROM t),
f AS (SELECT t.*, wm FROM t CROSS JOIN w WHERE us <= wm)"""
_BY = "PARTITION BY symbol, source ORDER BY us, event_id"
_R20, _R60 = (f"({_BY} ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)" for k in (20, state.RING))
_HALTS = f"""WITH {_FINAL}, g AS (SELECT *, lead(us) OVER ({_BY}) AS next_us FROM f), h AS (SELECT *, coalesce(next_us, wm) - us AS gap FROM g)
SELECT symbol, source, 'SILENT' AS kind, event_id, cast(NULL AS double) AS seconds FROM h WHERE gap > {state.SILENT_S}000000
UNION ALL SELECT symbol, source, 'HALT', event_id, NULL FROM h WHERE gap > {state.HALT_S}000000
UNION ALL SELECT symbol, source, 'RESUMED', event_id, (gap // 1000) / 1e3 FROM h WHERE gap > {state.HALT_S}000000 AND next_us IS NOT NULL"""
_LAST = f"""WITH {_FINAL},
a AS (SELECT *, row_number() OVER ({_BY}) AS n, close / nullif(lag(close) OVER ({_BY}), 0) - 1 AS ret, nullif(lag(open_interest) OVER ({_BY}), 0) AS prev_oi, first_value(close) OVER ({_BY}) AS first_close,
  avg(close) OVER {_R20} AS c20, stddev_samp(close) OVER {_R20} AS s20, avg(volume) OVER {_R20} AS v20, stddev_samp(volume) OVER {_R20} AS vs20, avg(close) OVER {_R60} AS c60, avg(spread) OVER {_R60} AS sp, stddev_samp(spread) OVER {_R60} AS sps,
  quantile_cont(close, 0.25) OVER {_R60} AS q1, quantile_cont(close, 0.75) OVER {_R60} AS q3, CASE WHEN close = lag(close) OVER ({_BY}) THEN 0 ELSE 1 END AS moved FROM f),
b AS (SELECT *, sum(moved) OVER ({_BY} ROWS UNBOUNDED PRECEDING) AS run, stddev_samp(ret) OVER ({_BY} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS r5, stddev_samp(ret) OVER ({_BY} ROWS BETWEEN 58 PRECEDING AND CURRENT ROW) AS r60 FROM a),
c AS (SELECT *, us - min(us) OVER (PARTITION BY symbol, source, run) AS held FROM b),
d AS (SELECT symbol, source, event_id, unnest([
  {{'check_id': 'LT-004', 'value': CASE WHEN n >= 10 THEN abs(close - c20) / nullif(s20, 0) END, 'most': 3e0}},
  {{'check_id': 'LT-006', 'value': CASE WHEN n >= 10 THEN abs(volume - v20) / nullif(vs20, 0) END, 'most': 4e0}},
  {{'check_id': 'LT-009', 'value': abs(open_interest / prev_oi - 1), 'most': 0.05e0}},
  {{'check_id': 'LT-011', 'value': CASE WHEN n >= 60 THEN abs(c20 / nullif(c60, 0) - 1) END, 'most': 0.03e0}},
  {{'check_id': 'LT-014', 'value': CASE WHEN n >= 5 THEN abs(spread - sp) / greatest(sps, 0.001e0) END, 'most': 3e0}},
  {{'check_id': 'LT-016', 'value': CASE WHEN n >= 20 THEN greatest(q1 - close, close - q3) - 3 * (q3 - q1) END, 'most': 0e0}},
  {{'check_id': 'LT-018', 'value': CASE WHEN n >= 60 THEN r5 / greatest(r60, 1e-8) END, 'most': 3e0}},
  {{'check_id': 'MICRO-002', 'value': CASE WHEN n > 1 THEN abs(close / nullif(first_close, 0) - 1) END, 'most': 0.2e0}},
  {{'check_id': 'MICRO-003', 'value': held / 1e6, 'most': 120e0}}]) AS x FROM c)
SELECT symbol, source, event_id, x.check_id AS check_id, round(x.value, 4) AS value FROM d WHERE x.value > x.most"""
_BREAKER = f"""WITH {LIVE.strip()}, c AS (SELECT symbol, source, sum(CASE WHEN hhmm < 555 OR hhmm > 930 THEN 1 ELSE 0 END) AS hard, sum(CASE WHEN ask - bid > 0.155 THEN 1 ELSE 0 END) AS soft FROM feed GROUP BY 1, 2)
SELECT symbol, source, 'QUARANTINE' AS action FROM c WHERE hard + soft > {LIMIT} UNION ALL SELECT symbol, source, 'FREEZE' FROM c WHERE hard > {LIMIT}"""
_AGREEMENT = f"""WITH {LIVE.strip()} SELECT x.symbol, x.event_id AS event, y.event_id AS other_event, x.close AS a, y.close AS b FROM feed x JOIN feed y
ON x.symbol = y.symbol AND x.source = '{FEEDS[0]}' AND y.source = '{FEEDS[1]}' AND y.ts BETWEEN x.ts - INTERVAL 60 SECOND AND x.ts + INTERVAL 60 SECOND WHERE y.close <> 0 AND abs(x.close / y.close - 1) > 0.003"""
SQL = {name: dialect.oracle(text) for name, text in {"live_halts": _HALTS, "live_last_ticks": _LAST, "live_breaker": _BREAKER, "live_feed_agreement": _AGREEMENT}.items()}
