"""Bars as SQL over the driver's tables: daily bars from lineitem, one-minute bars from events.

``DAILY`` is a cube of 3 symbols x 2 exchanges x 3 sources with a few deterministic faults, so that every check has
something to find. ``MINUTE`` has a source for each event type. Both carry the columns of the bar model.
"""

from __future__ import annotations

K = "symbol, exchange, source"

#: Total order of the raw rows of a day, which lineitem's key alone is not.
_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"

DAILY_CLEAN = f"""
daily_clean AS (
  SELECT concat('S', cast(l_suppkey % 3 as string)) AS symbol, l_linestatus AS exchange, l_returnflag AS source, cast(l_shipdate as date) AS d,
    @ARGMIN(l_extendedprice, {_ORDER}) AS open, max(l_extendedprice) AS high, min(l_extendedprice) AS low,
    @ARGMAX(l_extendedprice, {_ORDER}) AS close, sum(l_quantity) AS volume, cast(count(*) as double) AS open_interest
  FROM {{lineitem}} GROUP BY 1, 2, 3, 4)"""

#: The same rows for Spark: first and last row of a day are chosen among those of its least and greatest order, found
#: before. A choice over all rows would sort each task's input, as structs don't fit a hash aggregate. Nulls come first.
_DAILY_CLEAN_SPARK = f"""
daily_rows AS (
  SELECT concat('S', cast(l_suppkey % 3 as string)) AS symbol, l_linestatus AS exchange, l_returnflag AS source, cast(l_shipdate as date) AS d,
    coalesce(l_orderkey, -9223372036854775808) AS nth, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity FROM {{lineitem}}),
daily_sums AS (
  SELECT symbol, exchange, source, d, min(nth) AS least, max(nth) AS greatest, max(l_extendedprice) AS high, min(l_extendedprice) AS low,
    sum(l_quantity) AS volume, cast(count(*) as double) AS open_interest FROM daily_rows GROUP BY 1, 2, 3, 4),
daily_ends AS (
  SELECT /*+ BROADCAST(s) */ r.symbol, r.exchange, r.source, r.d, @ARGMIN(l_extendedprice, {_ORDER}) AS open, @ARGMAX(l_extendedprice, {_ORDER}) AS close
  FROM daily_rows r JOIN daily_sums s ON r.symbol <=> s.symbol AND r.exchange <=> s.exchange AND r.source <=> s.source AND r.d <=> s.d AND (nth = least OR nth = greatest) GROUP BY 1, 2, 3, 4),
daily_clean AS (
  SELECT s.symbol, s.exchange, s.source, s.d, open, high, low, close, volume, open_interest
  FROM daily_sums s JOIN daily_ends e ON e.symbol <=> s.symbol AND e.exchange <=> s.exchange AND e.source <=> s.source AND e.d <=> s.d)"""

#: Faults by day number: null close, swapped range, fifty-fold volume, negative open, zero volume, absent adj_close.
DAILY = f"""{DAILY_CLEAN},
daily_numbered AS (SELECT *, @DAYS(d, DATE '1992-01-01') + 7 * length(symbol) + ascii(source) + ascii(exchange) AS nr FROM daily_clean),
bars AS (
  SELECT symbol, exchange, source, d,
    CASE WHEN nr % 79 = 0 THEN -open ELSE open END AS open,
    CASE WHEN nr % 89 = 0 THEN low ELSE high END AS high,
    CASE WHEN nr % 89 = 0 THEN high ELSE low END AS low,
    CASE WHEN nr % 97 = 0 THEN NULL ELSE close END AS close,
    CASE WHEN nr % 101 = 0 THEN NULL WHEN nr % 97 = 0 THEN open WHEN nr < 900 THEN close * 0.99 ELSE close END AS adj_close,
    CASE WHEN nr % 73 = 0 THEN 0 WHEN nr % 83 = 0 THEN volume * 50 ELSE volume END AS volume,
    CASE WHEN nr % 103 = 0 THEN -open_interest ELSE open_interest END AS open_interest
  FROM daily_numbered)"""

DAILY_SPARK = DAILY.replace(DAILY_CLEAN, _DAILY_CLEAN_SPARK)

MINUTE = """
minutes AS (
  SELECT 'E' AS symbol, 'X' AS exchange, event_type AS source, @TRUNC(minute, ts) AS ts, cast(@TRUNC(day, ts) as date) AS d,
    @ARGMIN(value, ts, event_id) AS open, max(value) AS high, min(value) AS low, @ARGMAX(value, ts, event_id) AS close,
    sum(cast(user_id % 50 as double)) AS volume, cast(count(*) as double) AS open_interest
  FROM {events} GROUP BY 1, 2, 3, 4, 5)"""
