"""Derivative, fund, live and reference-data checks, calendars, charts, and the scorecards over all results."""

from __future__ import annotations

from plumbline.plans import more
from plumbline.plans.checks import CONSENSUS, EOD, FIELD_CHECKS, HOLIDAY_ROWS, INSTRUMENTS, INTRADAY, LIMIT, PAIR_ROWS, PAIRS, RELATION, WT, Family, n, share
from plumbline.sources.bars import DAILY, DAILY_CLEAN, MINUTE, K

#: An option chain over lineitem: strikes of 5,000, two expiries, calls and puts near their intrinsic value.
OPTIONS = """
options AS (
  SELECT 'OPT' AS symbol, l_linestatus AS exchange, l_returnflag AS source, cast(l_shipdate AS date) AS d, floor(l_extendedprice / 5000) * 5000 AS strike_price,
    CASE WHEN l_linenumber % 2 = 0 THEN 'CE' ELSE 'PE' END AS option_type, @ADDDAYS(cast(l_shipdate AS date), 1 + l_orderkey % 30) AS expiry_date, l_extendedprice AS underlying_close, 0.05 AS tick,
    CASE WHEN l_orderkey % 97 = 0 THEN 0e0 ELSE greatest(0e0, CASE WHEN l_linenumber % 2 = 0 THEN l_extendedprice - floor(l_extendedprice / 5000) * 5000 ELSE floor(l_extendedprice / 5000) * 5000 - l_extendedprice END) + l_tax * 100 END AS close,
    CASE WHEN l_orderkey % 89 = 0 THEN 500e0 ELSE 10 + 100 * l_discount END AS implied_volatility FROM {lineitem})"""

#: The same figures without joining calls with puts row by row (their number grows with the square of a strike's) and
#: without a window over a whole frame: means of both sides by strike, means of a frame as small tables.
_OPTIONS_SPARK = f"""{OPTIONS},
sides AS (SELECT {K}, d, strike_price, expiry_date, avg(CASE WHEN option_type = 'CE' THEN close END) AS c, avg(CASE WHEN option_type = 'PE' THEN close END) AS p, count_if(option_type = 'CE') AS calls, count_if(option_type = 'PE') AS puts
  FROM options WHERE exchange IS NOT NULL AND source IS NOT NULL AND d IS NOT NULL AND strike_price IS NOT NULL AND expiry_date IS NOT NULL GROUP BY {K}, d, strike_price, expiry_date),
pairs AS (SELECT * FROM sides WHERE calls > 0 AND puts > 0),
means AS (SELECT {K}, avg(c) AS mc FROM pairs GROUP BY {K}),
parity AS (SELECT /*+ BROADCAST(means) */ {K}, count(*) AS n_pairs, {share("abs((c - p) - (mc - strike_price)) > 0.1")} AS off FROM pairs JOIN means USING ({K}) GROUP BY {K}),
strikes AS (SELECT DISTINCT {K}, expiry_date, strike_price FROM options),
steps AS (SELECT *, lead(strike_price) OVER (PARTITION BY {K}, expiry_date ORDER BY strike_price) - strike_price AS step FROM strikes),
modal AS (SELECT {K}, expiry_date, @MODE(step) AS m, count(*) AS k FROM steps GROUP BY {K}, expiry_date),
chain AS (SELECT steps.symbol, steps.exchange, steps.source, steps.expiry_date, avg(CASE WHEN step IS NULL THEN NULL WHEN abs(step - m) <= 0.1 * m THEN 1e0 ELSE 0e0 END) AS even FROM steps JOIN modal USING ({K}, expiry_date) WHERE k >= 3 GROUP BY 1, 2, 3, 4),
even AS (SELECT {K}, min(even) AS even FROM chain GROUP BY {K}),
a AS (SELECT {K}, {n("(option_type = 'CE' AND close < greatest(0e0, underlying_close - strike_price) - 0.01) OR (option_type = 'PE' AND close < greatest(0e0, strike_price - underlying_close) - 0.01)")} AS below,
  {n("close <= 0 AND @DAYS(expiry_date, d) > 1")} AS zero_price, CASE WHEN avg(implied_volatility) > 1 THEN {share("implied_volatility / 100 < 0.005 OR implied_volatility / 100 > 3")} ELSE {share("implied_volatility < 0.005 OR implied_volatility > 3")} END AS odd_iv FROM options GROUP BY {K}),
b AS (SELECT a.*, n_pairs, off, even FROM a LEFT JOIN parity USING ({K}) LEFT JOIN even USING ({K}))"""

DERIVATIVES = Family(
    "checks_derivatives",
    f"""{OPTIONS},
pairs AS (SELECT c.symbol, c.exchange, c.source, c.d, c.strike_price, c.expiry_date, avg(c.close) AS c, avg(p.close) AS p FROM options c JOIN options p ON c.exchange = p.exchange AND c.source = p.source AND c.d = p.d AND c.strike_price = p.strike_price AND c.expiry_date = p.expiry_date
  AND c.option_type = 'CE' AND p.option_type = 'PE' GROUP BY 1, 2, 3, 4, 5, 6),
mean_c AS (SELECT pairs.*, avg(c) OVER (PARTITION BY {K}) AS mc FROM pairs),
parity AS (SELECT {K}, count(*) AS n_pairs, {share("abs((c - p) - (mc - strike_price)) > 0.1")} AS off FROM mean_c GROUP BY {K}),
strikes AS (SELECT DISTINCT {K}, expiry_date, strike_price FROM options),
steps AS (SELECT *, lead(strike_price) OVER (PARTITION BY {K}, expiry_date ORDER BY strike_price) - strike_price AS step FROM strikes),
modal AS (SELECT {K}, expiry_date, @MODE(step) AS m, count(*) AS k FROM steps GROUP BY {K}, expiry_date),
chain AS (SELECT steps.symbol, steps.exchange, steps.source, steps.expiry_date, avg(CASE WHEN step IS NULL THEN NULL WHEN abs(step - m) <= 0.1 * m THEN 1e0 ELSE 0e0 END) AS even FROM steps JOIN modal USING ({K}, expiry_date) WHERE k >= 3 GROUP BY 1, 2, 3, 4),
even AS (SELECT {K}, min(even) AS even FROM chain GROUP BY {K}),
iv AS (SELECT *, CASE WHEN avg(implied_volatility) OVER (PARTITION BY {K}) > 1 THEN implied_volatility / 100 ELSE implied_volatility END AS v FROM options),
a AS (SELECT {K}, {n("(option_type = 'CE' AND close < greatest(0e0, underlying_close - strike_price) - 0.01) OR (option_type = 'PE' AND close < greatest(0e0, strike_price - underlying_close) - 0.01)")} AS below,
  {n("close <= 0 AND @DAYS(expiry_date, d) > 1")} AS zero_price, {share("v < 0.005 OR v > 3")} AS odd_iv FROM iv GROUP BY {K}),
b AS (SELECT a.*, n_pairs, off, even FROM a LEFT JOIN parity USING ({K}) LEFT JOIN even USING ({K}))""",
    "b",
    K,
    (
        ("DERIV-001", "EOD Hard High 5", "below", "below > 0"),
        ("DERIV-002", "EOD Hard High 5", "zero_price", "zero_price > 0"),
        ("DERIV-003", "EOD Soft Medium 3", "off", "n_pairs >= 5 AND off > 0.005"),
        ("DERIV-004", "EOD Soft Medium 3", "odd_iv", "odd_iv > 0.005"),
        ("DERIV-005", "EOD Soft Medium 3", "even", "even < 0.95"),
    ),
    _OPTIONS_SPARK,
)

#: An index over the other symbols, of the close weighted by volume: source N from all sources' bars, A and R from their own,
#: those of R two per cent off.
INDEX = f"""
parts AS (SELECT exchange, d, source AS of, sum(close * volume) / nullif(sum(volume), 0) AS weighted, sum(volume) AS volume FROM bars WHERE close > 0 AND volume > 0 GROUP BY exchange, d, source),
whole AS (SELECT exchange, d, sum(weighted * volume) / sum(volume) AS weighted FROM parts GROUP BY exchange, d),
constituents AS (SELECT exchange, d, of AS source, weighted FROM parts WHERE of IN ('A', 'R') UNION ALL SELECT exchange, d, 'N', weighted FROM whole),
indexes AS (SELECT 'IX' AS symbol, exchange, source, d, weighted * CASE WHEN source = 'R' THEN 1.02e0 ELSE 1e0 END AS close, weighted FROM constituents)"""
FUNDS = Family(
    "checks_funds",
    f"""{DAILY},
{INSTRUMENTS.strip()},
{INDEX.strip()},
{HOLIDAY_ROWS},
calendar AS (SELECT exchange, cast(one_day AS date) AS d FROM (SELECT exchange, @DAYSEQ(lo, hi) AS one_day FROM (SELECT exchange, min(d) AS lo, max(d) AS hi FROM indexes GROUP BY exchange) e) g
  LEFT JOIN holidays h ON month(one_day) = h.m AND day(one_day) = h.dm WHERE h.m IS NULL AND @WEEKDAY(one_day) < 5),
due AS (SELECT exchange, count(*) AS k FROM calendar GROUP BY exchange),
m AS (SELECT {K}, @PCT(volume, 0.5) AS med_v FROM bars GROUP BY {K}),
a AS (SELECT b.symbol, b.exchange, b.source, {share("abs(close / nullif(adj_close, 0) - 1) > 0.02")} AS premium, {share("volume < 0.01 * med_v")} AS thin FROM bars b JOIN m USING ({K}) GROUP BY 1, 2, 3),
i AS (SELECT x.symbol, x.exchange, x.source, avg(abs(close - weighted) / nullif(close, 0)) AS apart, max(k) - count(DISTINCT c.d) AS absent
  FROM indexes x JOIN due ON x.exchange = due.exchange LEFT JOIN calendar c ON x.exchange = c.exchange AND x.d = c.d GROUP BY 1, 2, 3),
t AS (SELECT a.symbol, a.exchange, a.source, kind, premium, thin, cast(NULL AS double) AS apart, cast(NULL AS bigint) AS absent FROM a JOIN instruments ON a.symbol = instruments.symbol
  UNION ALL SELECT symbol, exchange, source, 'Index', NULL, NULL, apart, absent FROM i)""",
    "t",
    K,
    (
        ("ETF-001", "EOD Soft Medium 3", "CASE WHEN kind = 'ETF' THEN premium END", "kind = 'ETF' AND premium > 0.005"),
        ("ETF-002", "EOD Soft Low 2", "CASE WHEN kind = 'ETF' THEN thin END", "kind = 'ETF' AND thin > 0.05"),
        ("IDX-001", "EOD Hard High 4", "apart", "apart > 0.001"),
        ("IDX-002", "EOD Hard High 5", "absent", "absent > 0"),
    ),
)

#: A snapshot of a live feed: events with an arrival time and a session flag.
LIVE = """
feed AS (
  SELECT 'E' AS symbol, 'X' AS exchange, event_type AS source, event_id, ts, @MICROS(ts) / 1e6 AS sec, @MICROS(ts) / 1e6 + (user_id % 9) / 10e0 AS arrived, value AS close, value - 0.05 AS bid, value + 0.05 + (event_id % 7) / 100e0 AS ask,
    cast(user_id % 50 AS double) AS volume, cast(1000 + event_id % 13 AS double) AS open_interest, hour(ts) * 60 + minute(ts) AS hhmm,
    CASE WHEN hour(ts) * 60 + minute(ts) < 555 THEN 'pre_open' WHEN hour(ts) * 60 + minute(ts) <= 930 THEN 'normal' ELSE 'post_close' END AS session_flag FROM {events})"""
WL = f"(PARTITION BY {K} ORDER BY ts, event_id)"


def _last(k: int) -> str:
    return f"(PARTITION BY {K} ORDER BY ts, event_id ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"


def live_checks(drift_ms: float | None = LIMIT["clock_drift_ms"]) -> Family:
    """Checks of a feed's snapshot; ``drift_ms`` is what the time service reports, absent it LT-019 is skipped."""
    drift = "CAST(NULL AS double)" if drift_ms is None else f"{float(drift_ms)}e0"
    return Family("checks_live", _LIVE_BASE, "b", K, (*_LIVE_ROWS, ("LT-019", "Live Hard Critical 5", drift, f"abs({drift}) > 1000")), _LIVE_SPARK)


_LIVE_BASE = f"""{LIVE},
f1 AS (SELECT *, lag(sec) OVER {WL} AS prev_sec, lag(close) OVER {WL} AS prev_close, lag(nullif(open_interest, 0)) OVER {WL} AS prev_oi, count(*) OVER (PARTITION BY {K}, ts) AS same_ts, row_number() OVER {WL} AS up, row_number() OVER (PARTITION BY {K} ORDER BY ts DESC, event_id DESC) AS down,
  avg(close) OVER {_last(20)} AS c20, stddev_samp(close) OVER {_last(20)} AS s20, count(close) OVER {_last(20)} AS n20, avg(volume) OVER {_last(20)} AS v20, stddev_samp(volume) OVER {_last(20)} AS vs20, avg(close) OVER {_last(60)} AS c60,
  first_value(close) OVER {WL} AS first_close, avg(ask - bid) OVER (PARTITION BY {K}) AS sp_mean, stddev_samp(ask - bid) OVER (PARTITION BY {K}) AS sp_sd FROM feed),
f2 AS (SELECT *, close / nullif(prev_close, 0) - 1 AS ret, sum(CASE WHEN close = prev_close THEN 0 ELSE 1 END) OVER (PARTITION BY {K} ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM f1),
f3 AS (SELECT *, max(sec) OVER (PARTITION BY {K}, run) - min(sec) OVER (PARTITION BY {K}, run) AS held, stddev_samp(ret) OVER {_last(5)} AS r5, stddev_samp(ret) OVER {_last(60)} AS r60 FROM f2),
q AS (SELECT {K}, @PCT(close, 0.25) AS q1, @PCT(close, 0.75) AS q3, @PCT(arrived - sec, 0.5) AS latency, max(arrived) AS last_arrival FROM feed GROUP BY {K}),
clock AS (SELECT symbol, max(ts) AS now_ts FROM feed GROUP BY symbol),
a AS (SELECT {K}, count(*) AS n, max(last_arrival) AS last_arrival, max(latency) AS latency, {n("n20 >= 5 AND abs((close - c20) / nullif(s20, 0)) > 3")} AS spikes, {n("same_ts > 1")} AS dups, {n("n20 >= 5 AND abs((volume - v20) / nullif(vs20, 0)) > 4")} AS v_spikes,
  {n("hhmm < 555 OR hhmm > 930")} AS outside, {n("abs(open_interest / prev_oi - 1) > 0.05")} AS oi_jumps, max(sec - prev_sec) AS max_gap, max(CASE WHEN down = 1 THEN abs(c20 / nullif(c60, 0) - 1) END) AS drift,
  {n("abs((ask - bid - sp_mean) / greatest(sp_sd, 0.001e0)) > 3")} AS spreads, max(sec) AS last_sec, {n("close < q1 - 3 * (q3 - q1) OR close > q3 + 3 * (q3 - q1)")} AS extreme, max(CASE WHEN down = 1 THEN r5 / greatest(r60, 1e-8) END) AS vol_ratio,
  {n("((close % 0.05) + 0.05) % 0.05 > 0.0005")} AS off_tick, {n("close < first_close * 0.8 OR close > first_close * 1.2")} AS band, max(held) AS held, {n("session_flag NOT IN ('pre_open', 'normal', 'closing_auction', 'post_close') OR (hhmm BETWEEN 540 AND 554 AND session_flag <> 'pre_open')")} AS bad_flags,
  count(DISTINCT CASE WHEN @TRUNC(day, ts) = @TRUNC(day, now_ts) THEN hhmm END) AS minutes_seen, max(hour(now_ts) * 60 + minute(now_ts) - 555) AS elapsed FROM f3 JOIN q USING ({K}) JOIN clock USING (symbol) GROUP BY {K}),
b AS (SELECT a.*, max(last_sec) OVER (PARTITION BY symbol) AS now_sec FROM a)"""
#: Ticks of a block, and those before it that its windows look back on.
_BLOCK, _BACK = 8192, 60
_WB = f"PARTITION BY {K}, block ORDER BY nr"


def _back(k: int) -> str:
    return f"({_WB} ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"


#: The same figures in blocks: ticks are numbered by hour and by sums over the hours before, a block has a frame's next
#: ``_BLOCK`` ticks and a copy of the ``_BACK`` before them (``ahead`` 1), so no window or sort holds a whole frame. A run
#: of equal closes that goes on from a block to the next is held from the last start before.
_LIVE_SPARK = f"""{LIVE},
hourly AS (SELECT *, coalesce(cast(floor(sec / 3600e0) AS bigint), -1) AS at_hour FROM feed),
sizes AS (SELECT {K}, at_hour, count(*) AS k FROM hourly GROUP BY {K}, at_hour),
starts AS (SELECT {K}, at_hour, coalesce(sum(k) OVER (PARTITION BY {K} ORDER BY at_hour ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sizes),
placed AS (SELECT *, row_number() OVER (PARTITION BY {K}, at_hour ORDER BY ts, event_id) AS place, count(*) OVER (PARTITION BY {K}, at_hour, ts) AS same_ts FROM hourly),
numbered AS (SELECT /*+ BROADCAST(starts) */ placed.*, before + place AS nr FROM placed JOIN starts USING ({K}, at_hour)),
dealt AS (SELECT *, explode(CASE WHEN (nr - 1) % {_BLOCK} >= {_BLOCK - _BACK} THEN array(0, 1) ELSE array(0) END) AS ahead FROM numbered),
blocks AS (SELECT *, (nr - 1) div {_BLOCK} + ahead AS block FROM dealt),
f1 AS (SELECT *, lag(sec) OVER ({_WB}) AS prev_sec, lag(close) OVER ({_WB}) AS prev_close, lag(nullif(open_interest, 0)) OVER ({_WB}) AS prev_oi,
  avg(close) OVER {_back(20)} AS c20, stddev_samp(close) OVER {_back(20)} AS s20, count(close) OVER {_back(20)} AS n20, avg(volume) OVER {_back(20)} AS v20, stddev_samp(volume) OVER {_back(20)} AS vs20, avg(close) OVER {_back(60)} AS c60 FROM blocks),
f2 AS (SELECT *, close / nullif(prev_close, 0) - 1 AS ret, CASE WHEN ahead = 1 OR close = prev_close THEN NULL ELSE sec END AS begun FROM f1),
f3 AS (SELECT *, max(begun) OVER ({_WB} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS held_from, stddev_samp(ret) OVER {_back(5)} AS r5, stddev_samp(ret) OVER {_back(60)} AS r60 FROM f2),
q AS (SELECT {K}, count(*) AS total, avg(ask - bid) AS sp_mean, stddev_samp(ask - bid) AS sp_sd, @ARGMIN(close, ts, event_id) AS first_close, @PCT(close, 0.25) AS q1, @PCT(close, 0.75) AS q3, @PCT(arrived - sec, 0.5) AS latency, max(arrived) AS last_arrival FROM feed GROUP BY {K}),
clock AS (SELECT symbol, max(ts) AS now_ts FROM feed GROUP BY symbol),
seen AS (SELECT /*+ BROADCAST(clock) */ {K}, count(DISTINCT CASE WHEN @TRUNC(day, ts) = @TRUNC(day, now_ts) THEN hhmm END) AS minutes_seen, max(hour(now_ts) * 60 + minute(now_ts) - 555) AS elapsed FROM feed JOIN clock USING (symbol) GROUP BY {K}),
parts AS (SELECT /*+ BROADCAST(q) */ {K}, block, count(*) AS n, {n("n20 >= 5 AND abs((close - c20) / nullif(s20, 0)) > 3")} AS spikes, {n("same_ts > 1")} AS dups, {n("n20 >= 5 AND abs((volume - v20) / nullif(vs20, 0)) > 4")} AS v_spikes,
  {n("hhmm < 555 OR hhmm > 930")} AS outside, {n("abs(open_interest / prev_oi - 1) > 0.05")} AS oi_jumps, max(sec - prev_sec) AS max_gap, max(CASE WHEN nr = total THEN abs(c20 / nullif(c60, 0) - 1) END) AS drift,
  {n("abs((ask - bid - sp_mean) / greatest(sp_sd, 0.001e0)) > 3")} AS spreads, max(sec) AS last_sec, {n("close < q1 - 3 * (q3 - q1) OR close > q3 + 3 * (q3 - q1)")} AS extreme, max(CASE WHEN nr = total THEN r5 / greatest(r60, 1e-8) END) AS vol_ratio,
  {n("((close % 0.05) + 0.05) % 0.05 > 0.0005")} AS off_tick, {n("close < first_close * 0.8 OR close > first_close * 1.2")} AS band, {n("session_flag NOT IN ('pre_open', 'normal', 'closing_auction', 'post_close') OR (hhmm BETWEEN 540 AND 554 AND session_flag <> 'pre_open')")} AS bad_flags,
  max(sec - held_from) AS held, max(CASE WHEN held_from IS NULL THEN sec END) AS went_on, max(begun) AS last_begun FROM f3 JOIN q USING ({K}) WHERE ahead = 0 GROUP BY {K}, block),
runs AS (SELECT *, went_on - last_value(last_begun) IGNORE NULLS OVER (PARTITION BY {K} ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS held_on FROM parts),
sums AS (SELECT {K}, sum(n) AS n, sum(spikes) AS spikes, sum(dups) AS dups, sum(v_spikes) AS v_spikes, sum(outside) AS outside, sum(oi_jumps) AS oi_jumps, max(max_gap) AS max_gap, max(drift) AS drift, sum(spreads) AS spreads, max(last_sec) AS last_sec,
  sum(extreme) AS extreme, max(vol_ratio) AS vol_ratio, sum(off_tick) AS off_tick, sum(band) AS band, sum(bad_flags) AS bad_flags, greatest(max(held), max(held_on)) AS held FROM runs GROUP BY {K}),
a AS (SELECT sums.*, latency, last_arrival, minutes_seen, elapsed FROM sums JOIN q USING ({K}) JOIN seen USING ({K})),
b AS (SELECT a.*, max(last_sec) OVER (PARTITION BY symbol) AS now_sec FROM a)"""
_LIVE_ROWS = (
    ("LT-001", "Live Hard Critical 5", "now_sec - last_arrival", "now_sec - last_arrival > 5"),
    ("LT-002", "Live Hard Critical 5", "latency", "latency > 0.5"),
    ("LT-003", "Live Hard Critical 5", "greatest(elapsed - minutes_seen, 0)", "elapsed - minutes_seen > 2"),
    ("LT-004", "Live Soft High 4", "spikes", "n >= 10 AND spikes > 0"),
    ("LT-005", "Live Hard Critical 5", "dups", "dups > 0"),
    ("LT-006", "Live Soft Medium 3", "v_spikes", "n >= 10 AND v_spikes > 0"),
    ("LT-007", "Live Hard Critical 5", "outside", "outside > 0"),
    ("LT-009", "Live Soft Medium 3", "oi_jumps", "oi_jumps > 0"),
    ("LT-010", "Live Hard Critical 5", "max_gap", "max_gap > 300"),
    ("LT-011", "Live Soft Medium 3", "drift", "n >= 60 AND drift > 0.03"),
    ("LT-014", "Live Soft Medium 3", "spreads", "spreads > 0"),
    ("LT-015", "Live Hard Critical 5", "now_sec - last_sec", "now_sec - last_sec > 120"),
    ("LT-016", "Live Soft High 4", "extreme", "n >= 20 AND extreme > 0"),
    ("LT-017", "Live Hard Critical 5", "0", "false"),
    ("LT-018", "Live Soft Medium 3", "vol_ratio", "n >= 60 AND vol_ratio > 3"),
    ("MICRO-001", "Live Hard High 5", "off_tick", "off_tick > 0"),
    ("MICRO-002", "Live Hard High 5", "band", "band > 0"),
    ("MICRO-003", "Live Hard High 5", "held", "held > 120"),
    ("MICRO-004", "Live Soft Medium 3", "bad_flags", "bad_flags > 0"),
)
LIVE_CHECKS = live_checks()

#: Feed pairs by minute (LT-008), and intraday agreement of sources (SRC-I*, XREF-002).
FEED_PAIRS = Family(
    "checks_feed_pairs",
    f"""{MINUTE},
m AS (SELECT *, close / nullif(lag(close) OVER (PARTITION BY {K} ORDER BY ts), 0) - 1 AS ret FROM minutes),
p AS (SELECT a.symbol, a.exchange, concat(a.source, '-', b.source) AS source, a.ts, a.open AS ao, b.open AS bo, a.high AS ah, b.high AS bh, a.low AS al, b.low AS bl, a.close AS ac, b.close AS bc, a.volume AS av, b.volume AS bv, a.ret AS ar, b.ret AS br
  FROM m a JOIN m b ON a.symbol = b.symbol AND a.exchange = b.exchange AND a.ts = b.ts AND a.source < b.source),
sizes AS (SELECT source, count(*) AS k, count(DISTINCT d) AS days, min(d) AS first_d FROM minutes GROUP BY source),
two AS (SELECT a.source AS s1, b.source AS s2, a.k + b.k AS k2, abs(@DAYS(a.first_d, b.first_d)) AS start_gap FROM sizes a JOIN sizes b ON a.source < b.source),
a AS (SELECT symbol, exchange, source, count(*) AS n, {share("abs(ac / nullif(bc, 0) - 1) > 0.005")} AS c, {share("abs(ao / nullif(bo, 0) - 1) > 0.005")} AS o, {share("abs(ah / nullif(bh, 0) - 1) > 0.005")} AS h, {share("abs(al / nullif(bl, 0) - 1) > 0.005")} AS l,
  avg(CASE WHEN av > 0 AND bv > 0 THEN CASE WHEN abs(av / bv - 1) > 0.05 THEN 1e0 ELSE 0e0 END END) AS v, corr(ar, br) AS r, count(ar + br) AS rn, max(abs(ac / nullif(bc, 0) - 1)) AS worst FROM p GROUP BY symbol, exchange, source),
t AS (SELECT a.*, n / ((k2 - n) * 1e0) AS jaccard, start_gap FROM a JOIN two ON a.source = concat(s1, '-', s2))""",
    "t",
    K,
    (
        ("LT-008", "Live Hard Critical 5", "worst", "n >= 5 AND worst > 0.003"),
        ("SRC-I008", "SOURCE Soft High 4", "c", "n >= 100 AND c > 0.01"),
        ("SRC-I009", "SOURCE Soft Medium 3", "greatest(o, h, l)", "n >= 100 AND greatest(o, h, l) > 0.01"),
        ("SRC-I010", "SOURCE Soft Low 2", "v", "v > 0.05"),
        ("SRC-I012", "SOURCE Soft Low 2", "r", "rn >= 100 AND r < 0.95"),
        ("SRC-I015", "SOURCE Soft High 4", "c", "c > 0.005"),
        ("XREF-002", "Reconciliation Soft Medium 3", "jaccard", "jaccard < 0.8"),
        ("INT-042", "INTRADAY Soft Medium 3", "start_gap", "start_gap > 30"),
    ),
)

#: One-way analysis of variance of returns by source: F statistic and its degrees of freedom.
ANOVA = f"""WITH {PAIR_ROWS.strip()},
g AS (SELECT symbol, exchange, source, count(lr) AS k, avg(lr) AS m, var_samp(lr) AS v FROM r WHERE lr IS NOT NULL GROUP BY 1, 2, 3 HAVING count(lr) > 30),
t AS (SELECT symbol, exchange, count(*) AS groups, sum(k) AS n, sum(k * m) / sum(k) AS grand, sum((k - 1) * v) AS within FROM g GROUP BY 1, 2),
s AS (SELECT g.symbol, g.exchange, sum(k * (m - grand) * (m - grand)) AS between_ss FROM g JOIN t USING (symbol, exchange) GROUP BY 1, 2)
SELECT symbol, exchange, groups, cast(n AS bigint) AS n, round((between_ss / (groups - 1)) / (within / (n - groups)), 6) AS f_stat FROM t JOIN s USING (symbol, exchange) WHERE groups >= 2"""

WEEKLY = f"""WITH {DAILY.strip()}, w AS (SELECT {K}, cast(@TRUNC(week, d) AS date) AS week, @ARGMIN(open, d) AS open, max(high) AS high, min(low) AS low, @ARGMAX(close, d) AS close, sum(volume) AS volume, count(*) AS days FROM bars WHERE close IS NOT NULL GROUP BY 1, 2, 3, 4)
SELECT * FROM w"""
FIVE = f"""WITH {MINUTE.strip()} SELECT {K}, cast(floor(@MICROS(ts) / 300000000e0) AS bigint) AS bucket, @ARGMIN(open, ts) AS open, max(high) AS high, min(low) AS low, @ARGMAX(close, ts) AS close, sum(volume) AS volume FROM minutes GROUP BY 1, 2, 3, 4"""
CALENDAR = f"""WITH {DAILY_CLEAN.strip()}, span AS (SELECT min(d) AS lo, max(d) AS hi FROM daily_clean), days AS (SELECT @DAYSEQ(lo, hi) AS d FROM span),
holidays AS (SELECT d FROM days WHERE (month(d) = 1 AND day(d) = 26) OR (month(d) = 8 AND day(d) = 15) OR (month(d) = 10 AND day(d) = 2)),
trading AS (SELECT days.d FROM days LEFT JOIN holidays ON days.d = holidays.d WHERE holidays.d IS NULL AND @WEEKDAY(days.d) < 5),
own AS (SELECT DISTINCT {K}, d FROM daily_clean)
SELECT {K}, sum(CASE WHEN t.d IS NOT NULL THEN 1 ELSE 0 END) AS on_calendar, sum(CASE WHEN t.d IS NULL THEN 1 ELSE 0 END) AS extra, (SELECT count(*) FROM trading) - sum(CASE WHEN t.d IS NOT NULL THEN 1 ELSE 0 END) AS missing
FROM own LEFT JOIN trading t ON own.d = t.d GROUP BY {K}"""
CHART = f"""WITH {DAILY.strip()}, c AS (SELECT *, first_value(close) OVER {WT} AS c0, lag(close) OVER {WT} AS pc, avg(volume) OVER (PARTITION BY {K} ORDER BY d ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS v20, count(volume) OVER (PARTITION BY {K} ORDER BY d ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS k FROM bars)
SELECT {K}, d, round(close / nullif(pc, 0) - 1, 8) AS ret, round(close / nullif(c0, 0) - 1, 8) AS cumret, close >= open AS up, CASE WHEN k >= 20 THEN round(v20, 6) END AS vma20 FROM c"""
_COUNTED = f"""{LIVE}, f AS (SELECT {K}, cast(@TRUNC(day, ts) AS date) AS d, sum(CASE WHEN hhmm < 555 OR hhmm > 930 THEN 1 ELSE 0 END) AS fails, sum(CASE WHEN arrived - sec > 0.5 THEN 1 ELSE 0 END) AS late FROM feed GROUP BY 1, 2, 3, 4),
r AS (SELECT *, sum(fails) OVER (PARTITION BY {K} ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total FROM f)"""
QUARANTINE = f"""WITH {_COUNTED.strip()} SELECT {K}, d, cast(fails AS bigint) AS fails, cast(total AS bigint) AS total_fails, total > 3 AS quarantined, late > 3 AS frozen FROM r"""
FINGERPRINT = f"""WITH {DAILY.strip()}, {INSTRUMENTS.strip()} SELECT {K}, count(*) AS n_rows, min(d) AS first_d, max(d) AS last_d, cast(round(sum(close) * 100) AS bigint) % 1000000 AS fingerprint, round(@DAYS(max(d), min(d)) / 365.25e0, 4) AS years FROM bars GROUP BY {K}"""

#: Persistent failures of a live feed: quarantine and freeze.
COUNTERS = Family(
    "checks_live_counters",
    f"""{_COUNTED},
t AS (SELECT {K}, max(total) AS fails, max(late) AS late FROM r GROUP BY {K})""",
    "t",
    K,
    (("LT-012", "Live Hard Critical 5", "fails", "fails > 3"), ("LT-020", "Live Hard Critical 5", "late", "late > 3")),
)
FAMILIES = (DERIVATIVES, FUNDS, LIVE_CHECKS, FEED_PAIRS, COUNTERS)
SCORED = (EOD, INTRADAY, PAIRS, CONSENSUS, RELATION, *FAMILIES, *more.FAMILIES)
#: Layer, gate, severity and weight of the field checks, whose plans make their ids by arithmetic.
FIELD_META = {"checks_eod_fields": ("EOD", 24), "checks_intraday_fields": ("INTRADAY", 20)}


def told() -> list[tuple[str, str]]:
    """(check id, 'layer gate severity weight') of every check of the results."""
    some = [(i, m) for f in SCORED for i, m, _, _ in f.rows]
    return some + [(f"{layer[:3]}-{first + k:03d}", f"{layer} Soft {('Medium 3', 'Low 2', 'Low 2')[k % 3]}") for layer, first in FIELD_META.values() for k in range(18)]


def results(engine: str) -> str:
    """Common table expressions up to ``results``: every family's verdicts with their metadata."""
    plans = [(f.name, f.text(engine)) for f in SCORED] + [*FIELD_CHECKS.items()]
    body = " UNION ALL ".join(f"SELECT symbol, exchange, source, check_id, value, failed FROM ({text}) {name}" for name, text in plans)
    meta = " UNION ALL ".join("SELECT '{}' AS id, '{}' AS layer, '{}' AS gate, '{}' AS severity, {} AS weight".format(i, *m.rsplit(" ", 3)) for i, m in told())
    status = "CASE WHEN value IS NULL THEN 'Skip' WHEN failed THEN 'Fail' ELSE 'Pass' END"
    return f"""verdicts AS ({body}), specs AS ({meta}),
results AS (SELECT v.*, layer, gate, severity, weight, {status} AS status, CASE WHEN {status} = 'Pass' THEN weight ELSE 0 END AS weighted FROM verdicts v JOIN specs ON check_id = id)"""


_RANK = "CASE severity WHEN 'Critical' THEN 0 WHEN 'High' THEN 1 WHEN 'Medium' THEN 2 ELSE 3 END"
SCORECARDS = {
    "check_results": "SELECT symbol, exchange, source, check_id, layer, gate, severity, weight, status, weighted, value FROM results",
    "market_scorecard": """SELECT coalesce(symbol, 'TOTAL') AS symbol, count(*) AS checks, sum(CASE WHEN status = 'Pass' THEN 1 ELSE 0 END) AS passed, sum(CASE WHEN status = 'Fail' THEN 1 ELSE 0 END) AS failed, sum(CASE WHEN status = 'Skip' THEN 1 ELSE 0 END) AS skipped,
      round(sum(CASE WHEN status = 'Pass' THEN 1e0 ELSE 0e0 END) / greatest(sum(CASE WHEN status IN ('Pass', 'Fail') THEN 1 ELSE 0 END), 1), 6) AS pass_rate, round(sum(weighted) * 1e0 / sum(weight), 6) AS weighted_score,
      CASE WHEN sum(CASE WHEN status = 'Fail' AND gate = 'Hard' THEN 1 ELSE 0 END) > 0 THEN 'BLOCKED' WHEN sum(CASE WHEN status = 'Fail' THEN 1 ELSE 0 END) > 0 THEN 'WARN' ELSE 'OK' END AS verdict FROM results GROUP BY ROLLUP(symbol)""",
    "layer_rates": "SELECT symbol, layer, count(*) AS checks, round(sum(CASE WHEN status = 'Pass' THEN 1e0 ELSE 0e0 END) / greatest(sum(CASE WHEN status IN ('Pass', 'Fail') THEN 1 ELSE 0 END), 1), 6) AS pass_rate FROM results GROUP BY symbol, layer",
    "top_failures": f"SELECT symbol, check_id, exchange, source, severity, place FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY {_RANK}, check_id, exchange, source) AS place FROM results WHERE status = 'Fail') x WHERE place <= 8",
    "systemic_failures": "SELECT check_id, count(DISTINCT symbol) AS symbols, count(*) AS frames FROM results WHERE status = 'Fail' GROUP BY check_id",
    "source_scores": "SELECT source, exchange, sum(weighted) AS earned, sum(weight) AS possible, round(sum(weighted) * 1e0 / sum(weight), 6) AS score FROM results GROUP BY source, exchange",
    "run_record": """SELECT count(DISTINCT symbol) AS symbols, count(*) AS results, round(100e0 * sum(CASE WHEN status = 'Pass' THEN 1 ELSE 0 END) / count(*), 4) AS pass_pct, sum(CASE WHEN status = 'Fail' AND gate = 'Hard' THEN 1 ELSE 0 END) AS hard_fails, sum(CASE WHEN status = 'Fail' AND severity = 'Critical' THEN 1 ELSE 0 END) AS critical_fails,
      CASE WHEN sum(CASE WHEN status = 'Fail' AND gate = 'Hard' THEN 1 ELSE 0 END) > 0 THEN 'BLOCKED' WHEN sum(CASE WHEN status = 'Fail' THEN 1 ELSE 0 END) > 0 THEN 'WARN' ELSE 'CLEAN' END AS run_status FROM results""",
}
PLANS = {
    "anova_f_stat": ANOVA, "weekly_resample": WEEKLY, "five_minute_resample": FIVE, "trading_calendar": CALENDAR, "chart_columns": CHART, "live_quarantine": QUARANTINE, "fingerprints": FINGERPRINT,
    "bars_daily": f"WITH {DAILY.strip()} SELECT * FROM bars", "bars_minute": f"WITH {MINUTE.strip()} SELECT symbol, exchange, source, hour(ts) * 60 + minute(ts) AS hhmm, d, open, high, low, close, volume, open_interest FROM minutes",
}
