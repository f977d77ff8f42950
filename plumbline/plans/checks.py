"""The check catalogue: families of checks, each one fused plan over one relation.

A family has common table expressions, an aggregated relation with its keys, and rows (id, metadata, value, failed).
Metadata is layer, gate, severity and weight. ``value`` is the measured figure and ``failed`` the verdict; a missing
figure (no rows to judge) does not fail. All thresholds are in ``LIMIT``.
"""

from __future__ import annotations

from dataclasses import dataclass

from plumbline.plans import dialect
from plumbline.sources.bars import DAILY, MINUTE, K

#: In-code default thresholds.
LIMIT = {
    "stale_days": 5, "return_pct": 25, "gap_days": 10, "volume_z": 5, "price_z": 5, "history_years": 2, "bars_per_day": 375, "day_share": 0.9,
    "outside_pct": 0.1, "bar_range_pct": 15, "flat_bars": 30, "tick": 0.05, "lot": 25, "as_of": "1998-12-31", "live_as_of": "2024-01-31", "clock_drift_ms": None,
}
WT = f"(PARTITION BY {K} ORDER BY d)"
PK = f"(PARTITION BY {K})"


@dataclass(frozen=True)
class Family:
    name: str
    base: str
    source: str
    keys: str
    rows: tuple
    #: The common table expressions for Spark, where they aren't those of the comparison engine.
    spark: str | None = None

    def text(self, engine: str) -> str:
        body = dialect.unpivot([(i, v, f) for i, _, v, f in self.rows], self.keys, self.source, engine)
        base = self.spark if engine == "spark" and self.spark else self.base
        return f"WITH {base.strip()} {body}"


def n(cond: str) -> str:
    """How many rows meet a condition; null counts as not met."""
    return f"sum(CASE WHEN {cond} THEN 1 ELSE 0 END)"


def share(cond: str) -> str:
    """Share of all rows that meet a condition; null stays in the denominator."""
    return f"avg(CASE WHEN {cond} THEN 1e0 ELSE 0e0 END)"


#: Symbols' reference data, as an instrument file would give it.
INSTRUMENTS = """
instruments AS (
  SELECT 'S0' AS symbol, 'Equity' AS kind, 0.05 AS tick, 1 AS lot, DATE '1991-06-01' AS listed, 'IN0000000000' AS isin, 20 AS band_pct, '500000' AS bse_code, 'S0' AS nse_symbol, 'First' AS display_name, 'BSE_S0' AS prefix_bse, 'NSE_S0' AS prefix_nse, '1991-2001' AS eod_data UNION ALL
  SELECT 'S1', 'Futures', 0.05, 25, DATE '1990-01-01', 'TBD', CAST(NULL AS int), 'TBD', 'S1', 'Second', '', 'NSE_S1', 'TBD' UNION ALL
  SELECT 'S2', 'ETF', 0.01, 1, CAST(NULL AS date), 'IN0000000002', 10, '500002', 'TBD', NULL, 'BSE_S2', 'TBD', '1992-2001')"""
#: What a run's configuration has: sources, groups of thresholds, sessions.
CONFIG = {"source": ["A", "N", "R"], "threshold": ["eod", "intraday", "cross_source", "relation"], "session": ["regular"]}
CONFIG_ROWS = "config AS (" + " UNION ALL ".join(f"SELECT '{k}' AS part, '{v}' AS name" for k, vs in CONFIG.items() for v in vs) + ")"

#: Days on which every exchange is closed: month and day. A file of an exchange's own days is read by ``operators.calendar``.
HOLIDAYS = ((1, 26), (8, 15), (10, 2))
HOLIDAY_ROWS = "holidays AS (" + " UNION ALL ".join(f"SELECT {m} AS m, {d} AS dm" for m, d in HOLIDAYS) + ")"
#: The trading calendar as a table, a row for each exchange and date of its bars' span, and by frame the days that it
#: should have (expected), those that it has of them (found), and all that it has (days).
TRADING = f"""{HOLIDAY_ROWS},
calendar AS (SELECT exchange, cast(one_day AS date) AS d, CASE WHEN h.m IS NULL AND @WEEKDAY(one_day) < 5 THEN 1 ELSE 0 END AS trading
  FROM (SELECT exchange, @DAYSEQ(lo, hi) AS one_day FROM (SELECT exchange, min(d) AS lo, max(d) AS hi FROM bars GROUP BY exchange) e) g LEFT JOIN holidays h ON month(one_day) = h.m AND day(one_day) = h.dm),
frame_spans AS (SELECT {K}, min(d) AS lo, max(d) AS hi FROM bars GROUP BY {K}),
frame_due AS (SELECT s.symbol, s.exchange, s.source, sum(trading) AS expected FROM frame_spans s JOIN calendar c ON s.exchange = c.exchange AND c.d BETWEEN s.lo AND s.hi GROUP BY 1, 2, 3),
frame_have AS (SELECT b.symbol, b.exchange, b.source, count(DISTINCT b.d) AS days, count(DISTINCT CASE WHEN trading = 1 THEN b.d END) AS found FROM bars b JOIN calendar c ON b.exchange = c.exchange AND b.d = c.d GROUP BY 1, 2, 3),
frame_days AS (SELECT h.*, expected, expected - found AS missing FROM frame_have h JOIN frame_due USING ({K}))"""
#: Return from which a day is beyond the limits, by kind of instrument.
RETURN_LIMIT = "CASE kind WHEN 'ETF' THEN 0.20e0 WHEN 'Futures' THEN 0.40e0 ELSE 0.25e0 END"

EOD_ROWS = f"""{DAILY},
w1 AS (SELECT *, lag(close) OVER {WT} AS prev_close, lag(d) OVER {WT} AS prev_d, lead(close) OVER {WT} AS next_close,
  @LASTNN(close) OVER (PARTITION BY {K} ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pad,
  count(*) OVER (PARTITION BY {K}, d) AS same_d FROM bars),
w2 AS (SELECT *, lag(pad) OVER {WT} AS pad_prev, CASE WHEN close > 0 AND prev_close > 0 THEN ln(close / prev_close) END AS lr,
  CASE WHEN close = prev_close THEN 0 ELSE 1 END AS changed, adj_close / nullif(close, 0) AS factor FROM w1),
w3 AS (SELECT *, pad / nullif(pad_prev, 0) - 1 AS ret, lag(factor) OVER {WT} AS prev_factor,
  sum(changed) OVER (PARTITION BY {K} ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run,
  open / nullif(prev_close, 0) - 1 AS gap FROM w2),
w4 AS (SELECT *, count(close) OVER (PARTITION BY {K}, run) AS run_len,
  avg(nullif(volume, 0)) OVER {PK} AS v_mean, stddev_samp(nullif(volume, 0)) OVER {PK} AS v_sd, count(nullif(volume, 0)) OVER {PK} AS v_n,
  avg(lr) OVER {PK} AS r_mean, stddev_samp(lr) OVER {PK} AS r_sd, count(lr) OVER {PK} AS r_n, max(open_interest) OVER {PK} AS oi_max,
  avg(volume) OVER {PK} AS va_mean, stddev_samp(volume) OVER {PK} AS va_sd,
  avg(volume) OVER (PARTITION BY {K} ORDER BY d ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS v20, count(volume) OVER (PARTITION BY {K} ORDER BY d ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS v20_n,
  @PCT(close, 0.5) OVER (PARTITION BY {K} ORDER BY d ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS med30,
  count(close) OVER (PARTITION BY {K} ORDER BY d ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS med30_n,
  count(*) OVER {PK} AS n_rows FROM w3),
w5 AS (SELECT *, lag(CASE WHEN med30_n >= 15 THEN med30 END, 30) OVER {WT} AS med30_before FROM w4),
{INSTRUMENTS.strip()},
w AS (SELECT w5.*, kind, tick, lot, listed FROM w5 JOIN instruments USING (symbol))"""

#: Every check of one daily frame, in one pass.
EOD = Family(
    "checks_eod",
    f"""{EOD_ROWS},
{TRADING},
a AS (SELECT {K}, max(kind) AS kind, count(*) AS n, min(d) AS first_d, max(d) AS last_d, max(listed) AS listed,
  {n("open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL OR volume IS NULL")} AS nulls, {n("same_d > 1")} AS dups,
  {n("open <= 0")} + {n("high <= 0")} + {n("low <= 0")} + {n("close <= 0")} AS nonpos, {n("high < low")} AS inverted, {n("close < low OR close > high")} AS close_out,
  {n("volume < 0")} AS neg_vol, {share("volume = 0")} AS zero_vol, {n(f"run_len >= {LIMIT['stale_days']}")} AS stale, {n("abs(ret) > 0.25")} AS jumps, {n(f"abs(ret) > {RETURN_LIMIT}")} AS beyond, max(abs(ret)) AS max_ret,
  {n("open < low OR open > high")} AS open_out, {share("adj_close IS NULL")} AS adj_null, {n("open_interest < 0")} AS neg_oi,
  {n(f"@DAYS(d, prev_d) > {LIMIT['gap_days']}")} AS gaps, max(v_n) AS v_n, max(v_sd) AS v_sd, {share("v_sd > 0 AND abs((nullif(volume, 0) - v_mean) / nullif(v_sd, 0)) > 5")} AS v_out,
  max(r_n) AS r_n, {share("abs((lr - r_mean) / nullif(r_sd, 0)) > 5")} AS r_out, @DAYS(max(d), min(d)) / 365.25e0 AS years,
  {share("((close % tick) + tick) % tick > tick * 0.01")} AS off_tick, {share("lot > 1 AND volume % lot <> 0")} AS off_lot,
  {share("open = high AND high = low AND low = close AND volume > 0")} AS flat, {n("open_interest IS NULL OR open_interest = 0")} AS no_oi,
  {n("open_interest > 0 AND open_interest < 0.01 * oi_max")} AS low_oi, max(CASE WHEN med30_n >= 15 THEN med30 / nullif(med30_before, 0) END) AS scale_up, min(CASE WHEN med30_n >= 15 THEN med30 / nullif(med30_before, 0) END) AS scale_down,
  {n("adj_close > close * 1.001")} AS adj_high, {share("abs(gap) > 0.10")} AS gap_share, {share("open_interest <= 0")} AS oi_nonpos, {share("open_interest <> 0")} AS oi_some,
  {n("abs(factor / nullif(prev_factor, 0) - 1) > 0.10")} AS factor_moves, count(factor) AS factors, {n("factor < 0.01 OR factor > 100")} AS factor_out,
  {n("ret < -0.30 AND v20_n >= 5 AND volume > 2 * v20")} AS splits, {n("gap BETWEEN -0.05 AND -0.005")} AS dividends, {n("gap BETWEEN -0.20 AND -0.05")} AS rights,
  max(CASE WHEN close > 0 THEN close END) / min(CASE WHEN close > 0 THEN close END) AS price_span, @KURT(ret) AS kurt, count(ret) AS rets, {share("open = next_close")} AS ahead,
  sum(close) AS close_sum, {n("(volume - va_mean) / CASE WHEN va_sd > 1 THEN va_sd ELSE 1 END > 3")} AS vol_events, count(DISTINCT d) AS days,
  {n("open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL")} AS null_ohlc, {n("open <= 0 OR high <= 0 OR low <= 0 OR close <= 0")} AS bad_price,
  1 - avg(((CASE WHEN open IS NULL THEN 1e0 ELSE 0e0 END) + (CASE WHEN high IS NULL THEN 1e0 ELSE 0e0 END) + (CASE WHEN low IS NULL THEN 1e0 ELSE 0e0 END) + (CASE WHEN close IS NULL THEN 1e0 ELSE 0e0 END)) / 4) AS complete,
  {share("high >= low AND close BETWEEN low AND high AND open BETWEEN low AND high")} AS valid
  FROM w GROUP BY {K}),
b AS (SELECT a.*, expected, missing, @DAYS(DATE '{LIMIT["as_of"]}', last_d) AS stale_days,
  CASE WHEN kind IN ('Futures', 'Options') THEN true ELSE false END AS derivative FROM a JOIN (SELECT {K}, expected, missing FROM frame_days) x USING ({K}))""",
    "b",
    K,
    (
        ("EOD-001", "EOD Hard Critical 5", "nulls", "nulls > 0"),
        ("EOD-002", "EOD Soft High 5", "missing", "missing >= 1"),
        ("EOD-003", "EOD Soft Critical 5", "dups", "dups > 0"),
        ("EOD-004", "EOD Hard Critical 5", "nonpos", "nonpos > 0"),
        ("EOD-005", "EOD Hard Critical 5", "inverted", "inverted > 0"),
        ("EOD-006", "EOD Hard Critical 5", "close_out", "close_out > 0"),
        ("EOD-007", "EOD Soft Medium 3", "zero_vol", "neg_vol > 0 OR zero_vol > 0.01"),
        ("EOD-008", "EOD Soft Medium 3", "stale", "stale > 0"),
        ("EOD-009", "EOD Soft High 4", "max_ret", "jumps > 0"),
        ("EOD-010", "EOD Soft High 4", "open_out", "open_out > 0"),
        ("EOD-011", "EOD Soft Medium 3", "adj_null", "adj_null > 0.05"),
        ("EOD-012", "EOD Soft Low 2", "neg_oi", "neg_oi > 0"),
        ("EOD-013", "EOD Soft Medium 3", "gaps", "gaps > 0"),
        ("EOD-014", "EOD Soft Low 2", "v_out", "v_n >= 30 AND v_out > 0.005"),
        ("EOD-015", "EOD Soft Low 2", "r_out", "r_n >= 30 AND r_out > 0.005"),
        ("EOD-016", "EOD Soft Medium 3", "years", f"years < {LIMIT['history_years']}"),
        ("EOD-017", "EOD Soft High 4", "beyond", "beyond > 0"),
        ("EOD-018", "EOD Soft Low 2", "off_tick", "off_tick > 0.01"),
        ("EOD-019", "EOD Soft Low 1", "off_lot", "derivative AND off_lot > 0.01"),
        ("EOD-020", "EOD Soft Medium 3", "flat", "flat > 0.005"),
        ("EOD-021", "EOD Hard Critical 5", "no_oi", "derivative AND no_oi > 0"),
        ("EOD-022", "EOD Soft Medium 3", "low_oi", "low_oi > 5"),
        ("EOD-023", "EOD Soft Low 2", "scale_up", "n >= 60 AND (scale_up > 5 OR scale_down < 0.2)"),
        ("EOD-042", "EOD Soft Medium 3", "adj_high", "adj_high > 0"),
        ("EOD-043", "EOD Hard Critical 5", "CASE WHEN derivative THEN 1 ELSE 0 END", "derivative"),
        ("EOD-044", "EOD Soft Medium 3", "gap_share", "gap_share > 0.01"),
        ("EOD-047", "EOD Soft Medium 3", "CASE WHEN derivative THEN oi_nonpos ELSE oi_some END", "derivative AND oi_nonpos > 0.10"),
        ("BT-003", "TIMEFRAME Soft High 4", "factor_moves", "factors >= 20 AND factor_moves > 5"),
        ("BT-004", "TIMEFRAME Soft Medium 3", "splits", "false"),
        ("BT-005", "TIMEFRAME Soft Low 2", "dividends", "false"),
        ("BT-007", "TIMEFRAME Soft Medium 3", "@DAYS(first_d, listed)", "@DAYS(first_d, listed) > 365"),
        ("BT-008", "TIMEFRAME Soft Low 2", "stale_days", "stale_days > 90"),
        ("BT-009", "TIMEFRAME Soft Low 2", "rights", "false"),
        ("BT-010", "Calendar Soft Medium 3", "cast(days as double) / expected", "cast(days as double) / expected < 0.8"),
        ("BT-013", "TIMEFRAME Soft Low 1", "cast(round(close_sum * 100) as bigint) % 1000000", "false"),
        ("BT-014", "TIMEFRAME Soft Medium 3", "price_span", "n >= 10 AND price_span > 1000"),
        ("BT-022", "TIMEFRAME Soft Low 2", "kurt", "rets >= 30 AND abs(kurt) > 50"),
        ("BT-028", "TIMEFRAME Hard Critical 5", "ahead", "ahead > 0.05"),
        ("BT-029", "TIMEFRAME Soft High 4", "dups", "dups > 0"),
        ("SYM-003", "SYMBOL Soft Medium 3", "@DAYS(first_d, listed)", "@DAYS(first_d, listed) > 365"),
        ("CA-001", "EOD Soft High 4", "jumps", "jumps > 3"),
        ("CA-002", "EOD Soft Medium 3", "factor_out", "n >= 10 AND factor_out > 0"),
        ("CA-003", "EOD Soft Low 2", "vol_events", "false"),
        ("BST-001", "BEAST_GATES Hard Critical 5", "null_ohlc + inverted + bad_price", "null_ohlc + inverted + bad_price > 0"),
        ("GOV-003", "Governance Soft High 4", "stale_days", "stale_days > 3"),
        ("GOV-004", "Governance Soft High 4", "null_ohlc + inverted + close_out", "null_ohlc + inverted + close_out > 0"),
        ("SRC-002", "SOURCE Soft High 4", "0.5e0 * complete + 0.3e0 * valid + 0.2e0 * greatest(0, 1 - stale_days / 365e0)", "0.5e0 * complete + 0.3e0 * valid + 0.2e0 * greatest(0, 1 - stale_days / 365e0) < 0.75"),
    ),
)

_FIELDS = ("open", "high", "low", "close", "volume", "open_interest")


def _fields(prefix: str, first: int, base: str, relation: str, low: float, high: float, null_max: float, out_max: float, least: int) -> str:
    """Null share, range share and top-tail share or trend of the six fields, from one read of the bars.

    Each bar becomes six rows; bounds are windows over a field, counts are summed by year and everything else comes from the years.
    """
    own = f"(PARTITION BY {K}, pos)"
    last = "round(recent, 6)" if prefix == "EOD" else "round(tail, 6)"
    last_failed = "past > 0 AND recent > 3 * past" if prefix == "EOD" else "tail > 0.02"
    return f"""{base},
long AS (SELECT {K}, d, pos, CASE pos {" ".join(f"WHEN {i} THEN {f}" for i, f in enumerate(_FIELDS))} END AS x FROM (SELECT {K}, d, {", ".join(_FIELDS)}, @INTSEQ(0, {len(_FIELDS) - 1}) AS pos FROM {relation}) bar),
bound AS (SELECT *, @PCT(x, {low}) OVER {own} AS p_lo, @PCT(x, {high}) OVER {own} AS p_hi, @PCT(x, 0.99) OVER {own} AS p99 FROM long),
yearly AS (SELECT {K}, pos, year(d) AS y, count(*) AS k, count(x) AS k_x, {n("x < 0.5 * p_lo OR x > 2 * p_hi")} AS out_k, {n("x > 1.5 * p99 OR x IS NULL")} AS odd_k FROM bound GROUP BY {K}, pos, year(d)),
ranked AS (SELECT *, odd_k / (k * 1e0) AS odd, row_number() OVER (PARTITION BY {K}, pos ORDER BY y) AS up, row_number() OVER (PARTITION BY {K}, pos ORDER BY y DESC) AS down, count(*) OVER {own} AS many FROM yearly),
f AS (SELECT {K}, pos, 1 - sum(k_x) / (sum(k) * 1e0) AS nulls, sum(k_x) AS n_x, sum(out_k) / (sum(k) * 1e0) AS outside, sum(odd_k) / (sum(k) * 1e0) AS tail,
  avg(CASE WHEN down <= 3 THEN odd END) AS recent, avg(CASE WHEN up <= greatest(1, many - 3) THEN odd END) AS past FROM ranked GROUP BY {K}, pos),
g AS (SELECT *, @INTSEQ(0, 2) AS part FROM f)
SELECT {K}, concat('{prefix}-', lpad(cast({first} + 3 * pos + part as string), 3, '0')) AS check_id, CASE part WHEN 0 THEN round(nulls, 6) WHEN 1 THEN round(outside, 6) ELSE {last} END AS value,
  coalesce(CASE part WHEN 0 THEN nulls > {null_max} WHEN 1 THEN n_x >= {least} AND outside > {out_max} ELSE {last_failed} END, false) AS failed FROM g"""


FIELD_CHECKS = {
    "checks_eod_fields": "WITH " + _fields("EOD", 24, DAILY.strip(), "bars", 0.01, 0.99, 0.01, 0.02, 10),
    "checks_intraday_fields": "WITH " + _fields("INT", 20, MINUTE.strip(), "minutes", 0.001, 0.999, 0.005, 0.01, 30),
}

WM = f"(PARTITION BY {K} ORDER BY ts)"
MINUTE_ROWS = f"""{MINUTE},
m1 AS (SELECT *, hour(ts) * 60 + minute(ts) AS hhmm, lag(ts) OVER {WM} AS prev_ts, lag(ts) OVER (PARTITION BY {K}, d ORDER BY ts) AS day_prev, lag(close) OVER {WM} AS prev_close,
  lead(open) OVER {WM} AS next_open, lag(open_interest) OVER {WM} AS prev_oi, max(open_interest) OVER (PARTITION BY {K}, d) - min(open_interest) OVER (PARTITION BY {K}, d) AS oi_range,
  count(*) OVER (PARTITION BY {K}, ts) AS same_ts FROM minutes),
m2 AS (SELECT *, hhmm BETWEEN 555 AND 930 AS inside, sum(CASE WHEN close = prev_close THEN 0 ELSE 1 END) OVER (PARTITION BY {K} ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM m1),
m AS (SELECT *, count(close) OVER (PARTITION BY {K}, run) AS run_len, lag(CASE WHEN inside THEN ts END) OVER (PARTITION BY {K}, d, inside ORDER BY ts) AS in_prev FROM m2)"""

INTRADAY = Family(
    "checks_intraday",
    f"""{MINUTE_ROWS},
days AS (SELECT {K}, d, {n("inside")} AS bars_in, count(*) AS bars_all, max(CASE WHEN inside THEN (@MICROS(ts) - @MICROS(in_prev)) / 60000000e0 END) AS max_gap, max(CASE WHEN hhmm = 555 THEN 1 ELSE 0 END) AS opens,
  max(CASE WHEN hhmm >= 925 THEN 1 ELSE 0 END) AS closes, sum(close * volume) / greatest(sum(volume), 1) AS vwap, min(low) AS low, max(high) AS high FROM m GROUP BY {K}, d),
buckets AS (SELECT {K}, floor(@MICROS(ts) / 300000000e0) AS b, max(high) AS high, min(low) AS low FROM m GROUP BY 1, 2, 3, 4),
five AS (SELECT {K}, {n("high < low")} AS five_bad FROM buckets GROUP BY {K}),
per_day AS (SELECT {K}, {share(f"bars_in < {LIMIT['day_share'] * LIMIT['bars_per_day']}")} AS sparse, {share("max_gap > 5")} AS gappy, max(max_gap) AS max_gap, {share("opens = 0")} AS no_open, {share("closes = 0")} AS no_close,
  {share("bars_all < 300")} AS short_days, {n("vwap < low OR vwap > high")} AS vwap_out, {share("bars_all >= 337")} AS full_days FROM days GROUP BY {K}),
a AS (SELECT {K}, count(*) AS n, {n("same_ts > 1")} AS dups, {n("prev_ts >= ts")} AS disorder, {share("NOT inside")} AS outside, {n("high < open OR high < close OR low > open OR low > close OR high < low")} AS ohlc,
  {n("open <= 0")} + {n("high <= 0")} + {n("low <= 0")} + {n("close <= 0")} AS nonpos, {n("volume < 0")} AS neg_vol, {share("hhmm BETWEEN 180 AND 359")} AS utc_like, {share("(high - low) / nullif(close, 0) > 0.15")} AS wide,
  {n("abs(open_interest - prev_oi) > 0.5 * oi_range AND oi_range > 0")} AS oi_moves, {n("close < low OR close > high")} AS close_out, {n("open < low OR open > high")} AS open_out,
  {share("abs(next_open / nullif(close, 0) - 1) > 0.05")} AS jumps, {share("hhmm BETWEEN 540 AND 554")} AS preopen, {n("open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL OR volume IS NULL")} AS nulls,
  {n(f"run_len >= {LIMIT['flat_bars']}")} AS stale, avg(CASE WHEN hhmm = 555 THEN CASE WHEN volume = 0 THEN 1e0 ELSE 0e0 END END) AS zero_open, {share("hhmm BETWEEN 180 AND 419")} AS utc_wide,
  {share("((close % 0.05) + 0.05) % 0.05 > 0.0005")} AS off_tick, {n("second(ts) <> 0")} AS off_minute, avg(CASE WHEN inside AND in_prev IS NOT NULL THEN CASE WHEN @MICROS(ts) - @MICROS(in_prev) <> 60000000 THEN 1e0 ELSE 0e0 END END) AS off_step,
  {n("abs(open_interest / nullif(prev_oi, 0) - 1) > 0.20")} AS oi_jumps FROM m GROUP BY {K}),
b AS (SELECT * FROM a JOIN per_day USING ({K}) JOIN five USING ({K}))""",
    "b",
    K,
    (
        ("INT-001", "INTRADAY Soft High 4", "sparse", "sparse > 0.05"),
        ("INT-002", "INTRADAY Hard Critical 5", "dups", "dups > 0"),
        ("INT-003", "INTRADAY Hard Critical 5", "disorder", "disorder > 0"),
        ("INT-004", "INTRADAY Soft Medium 3", "outside", f"outside * 100 > {LIMIT['outside_pct']}"),
        ("INT-005", "INTRADAY Hard Critical 5", "ohlc", "ohlc > 0"),
        ("INT-006", "INTRADAY Hard Critical 5", "nonpos", "nonpos > 0"),
        ("INT-007", "INTRADAY Soft Medium 3", "neg_vol", "neg_vol > 0"),
        ("INT-008", "INTRADAY Hard Critical 5", "utc_like", "utc_like > 0.5"),
        ("INT-009", "INTRADAY Soft Medium 3", "max_gap", "gappy > 0.001"),
        ("INT-010", "INTRADAY Soft High 4", "wide", "wide > 0.001"),
        ("INT-011", "INTRADAY Soft Low 2", "oi_moves", "oi_moves > 10"),
        ("INT-012", "INTRADAY Soft Medium 3", "five_bad", "five_bad > 0"),
        ("INT-013", "INTRADAY Hard Critical 5", "close_out", "close_out > 0"),
        ("INT-014", "INTRADAY Soft High 4", "open_out", "open_out > 0"),
        ("INT-015", "INTRADAY Soft High 4", "jumps", "jumps > 0.0001"),
        ("INT-016", "INTRADAY Soft Low 2", "preopen", "preopen > 0.0005"),
        ("INT-017", "INTRADAY Soft High 4", "nulls", "nulls > 0"),
        ("INT-018", "INTRADAY Hard Critical 5", "dups", "dups > 0"),
        ("INT-019", "INTRADAY Soft Medium 3", "stale", "stale > 0"),
        ("INT-038", "INTRADAY Soft High 4", "greatest(no_open, no_close)", "no_open > 0.01 OR no_close > 0.01"),
        ("INT-040", "INTRADAY Soft Low 1", "preopen", "false"),
        ("INT-041", "INTRADAY Soft Low 2", "zero_open", "zero_open > 0.05"),
        ("BT-012", "TIMEFRAME Soft Medium 3", "utc_wide", "utc_wide > 0.5"),
        ("BT-023", "TIMEFRAME Soft Low 2", "off_tick", "off_tick > 0.01"),
        ("TF-001", "TIMEFRAME Soft Medium 3", "off_minute", "off_minute > 0"),
        ("TF-003", "TIMEFRAME Soft Medium 3", "off_step", "off_step > 0.001"),
        ("TF-005", "TIMEFRAME Soft Medium 3", "short_days", "short_days > 0.05"),
        ("BST-003", "BEAST_GATES Soft High 4", "full_days", "full_days < 0.9"),
        ("AGG-002", "Aggregation Soft Low 2", "vwap_out", "vwap_out > 0"),
        ("DERIV-006", "INTRADAY Soft Medium 3", "oi_jumps", "oi_jumps > 5"),
    ),
)

#: Pairs of sources of one exchange, by date; each pair once.
PAIR_ROWS = f"""{DAILY},
r AS (SELECT *, CASE WHEN close > 0 AND lag(close) OVER {WT} > 0 THEN ln(close / lag(close) OVER {WT}) END AS lr FROM bars),
p AS (SELECT a.symbol, a.exchange, concat(a.source, '-', b.source) AS source, a.d, a.open AS ao, b.open AS bo, a.high AS ah, b.high AS bh, a.low AS al, b.low AS bl, a.close AS ac, b.close AS bc, a.volume AS av, b.volume AS bv, a.lr AS ar, b.lr AS br
  FROM r a JOIN r b ON a.symbol = b.symbol AND a.exchange = b.exchange AND a.d = b.d AND a.source < b.source)"""


def _off(a: str, b: str, tol: float) -> str:
    return f"abs({a} / nullif({b}, 0) - 1) > {tol}"


PAIRS = Family(
    "checks_source_pairs",
    f"""{PAIR_ROWS},
a AS (SELECT {K}, count(*) AS n, {share(_off("ac", "bc", 0.001))} AS c, {share(_off("ao", "bo", 0.001))} AS o, {share(_off("ah", "bh", 0.001))} AS h, {share(_off("al", "bl", 0.001))} AS l,
  avg(CASE WHEN av > 0 AND bv > 0 THEN CASE WHEN {_off("av", "bv", 0.05)} THEN 1e0 ELSE 0e0 END END) AS v, corr(ar, br) AS r, count(ar + br) AS rn,
  {share(_off("ac", "bc", 0.005))} AS c5, {share(_off("ao", "bo", 0.005))} AS o5, {share(_off("ah", "bh", 0.005))} AS h5, {share(_off("al", "bl", 0.005))} AS l5, max(abs(ac / nullif(bc, 0) - 1)) AS worst,
  @PCT(av / nullif(bv, 0), 0.99) AS v99 FROM p GROUP BY {K})""",
    "a",
    K,
    (
        ("SRC-E002", "SOURCE Soft High 5", "c", "c > 0.005"),
        ("SRC-E003", "SOURCE Soft Medium 4", "greatest(o, h, l)", "o > 0.01 OR h > 0.01 OR l > 0.01"),
        ("SRC-E004", "SOURCE Soft Low 2", "v", "v > 0.05"),
        ("SRC-E006", "SOURCE Soft Low 2", "r", "rn >= 30 AND r < 0.99"),
        ("SRC-003", "SOURCE Soft Medium 3", "o5", "n >= 100 AND o5 > 0.01"),
        ("SRC-004", "SOURCE Soft Medium 3", "h5", "n >= 100 AND h5 > 0.01"),
        ("SRC-005", "SOURCE Soft Medium 3", "l5", "n >= 100 AND l5 > 0.01"),
        ("SRC-006", "SOURCE Soft Medium 3", "c5", "n >= 100 AND c5 > 0.01"),
        ("SRC-007", "SOURCE Soft Medium 3", "v", "n >= 100 AND v > 0.01"),
        ("BT-020", "TIMEFRAME Soft Low 2", "v99", "n >= 10 AND v99 > 10"),
    ),
)

#: Checks over all sources of a symbol and exchange.
CONSENSUS = Family(
    "checks_consensus",
    f"""{DAILY},
srcs AS (SELECT symbol, exchange, count(DISTINCT source) AS k FROM bars GROUP BY symbol, exchange),
per_day AS (SELECT symbol, exchange, d, count(close) AS have, @PCT(close, 0.5) AS med, avg(close) AS mean, stddev_samp(close) AS sd FROM bars GROUP BY symbol, exchange, d),
common AS (SELECT per_day.* FROM per_day JOIN srcs USING (symbol, exchange) WHERE have = k),
dev AS (SELECT bars.symbol, bars.exchange, source, {share("abs(close / nullif(med, 0) - 1) > 0.01")} AS off, count(*) AS n FROM bars JOIN common USING (symbol, exchange, d) GROUP BY 1, 2, 3),
mad AS (SELECT symbol, exchange, d, avg(abs(close - mean)) AS ad, max(mean) AS mean FROM bars JOIN common USING (symbol, exchange, d) GROUP BY 1, 2, 3),
rel AS (SELECT symbol, exchange, avg(ad) / nullif(avg(mean), 0) AS spread, count(*) AS common_n FROM mad GROUP BY 1, 2),
cv AS (SELECT symbol, exchange, avg(sd / nullif(mean, 0)) AS cv FROM common GROUP BY 1, 2),
uni AS (SELECT symbol, exchange, count(DISTINCT d) AS all_days FROM bars GROUP BY 1, 2),
{TRADING},
own AS (SELECT s.symbol, s.exchange, s.source, days, lo AS first_d, @DAYS(hi, lo) / 365.25e0 AS years, missing FROM frame_spans s JOIN frame_days USING ({K})),
agg AS (SELECT symbol, exchange, max(1 - cast(days as double) / all_days) AS missed, @DAYS(max(first_d), min(first_d)) AS start_spread, count(*) AS sources, max(years) AS years, sum(CASE WHEN years >= 2 AND missing < 0.05e0 * (days + missing) THEN 1 ELSE 0 END) AS long_frames
  FROM own JOIN uni USING (symbol, exchange) GROUP BY 1, 2),
worst AS (SELECT symbol, exchange, max(off) AS off, max(n) AS n FROM dev GROUP BY 1, 2),
t AS (SELECT *, 'all' AS source FROM agg JOIN worst USING (symbol, exchange) JOIN rel USING (symbol, exchange) JOIN cv USING (symbol, exchange))""",
    "t",
    K,
    (
        ("SRC-E001", "SOURCE Soft High 4", "missed", "missed > 0.05"),
        ("SRC-E013", "SOURCE Soft Low 2", "start_spread", "start_spread > 730"),
        ("SRC-001", "SOURCE Soft Medium 3", "off", "n >= 10 AND off > 0.005"),
        ("BT-019", "TIMEFRAME Soft Medium 3", "spread", "common_n >= 10 AND spread > 0.02"),
        ("XREF-001", "Reconciliation Soft Medium 3", "cv", "common_n >= 10 AND cv > 0.05"),
        ("SYM-007", "SYMBOL Soft Medium 3", "sources", "sources < 1"),
        ("GOV-002", "Governance Hard Critical 5", "sources", "sources < 2"),
        ("BST-004", "BEAST_GATES Soft High 4", "sources", "sources < 2"),
        ("BST-002", "BEAST_GATES Hard Critical 5", "years", "years < 2"),
        ("BT-030", "Coverage Hard Critical 5", "long_frames", "long_frames < 2"),
    ),
)

#: Daily bars against days of one-minute bars; the daily side is the day's aggregate with a few planted differences.
RELATION_ROWS = f"""{MINUTE},
agg AS (SELECT {K}, d, @ARGMIN(open, ts) AS io, max(high) AS ih, min(low) AS il, @ARGMAX(close, ts) AS ic, sum(volume) AS iv FROM minutes GROUP BY {K}, d),
eod AS (SELECT {K}, d, io * 1.001 AS open, CASE WHEN day(d) % 11 = 0 THEN ih * 0.99 ELSE ih END AS high, CASE WHEN day(d) % 13 = 0 THEN il * 1.02 ELSE il END AS low,
  CASE WHEN day(d) % 7 = 0 THEN ic * 1.01 ELSE ic END AS close, iv * 1.01 AS volume FROM agg WHERE day(d) <> 5),
j AS (SELECT e.symbol, e.exchange, e.source, e.d, open, high, low, close, volume, io, ih, il, ic, iv, close - ic AS diff,
  close / nullif(lag(close) OVER (PARTITION BY e.symbol, e.exchange, e.source ORDER BY e.d), 0) - 1 AS er, ic / nullif(lag(ic) OVER (PARTITION BY e.symbol, e.exchange, e.source ORDER BY e.d), 0) - 1 AS ir
  FROM eod e JOIN agg i ON e.symbol = i.symbol AND e.exchange = i.exchange AND e.source = i.source AND e.d = i.d),
sides AS (SELECT {K}, d, max(e) AS e, max(i) AS i FROM (SELECT {K}, d, 1 AS e, 0 AS i FROM eod UNION ALL SELECT {K}, d, 0, 1 FROM agg) u GROUP BY {K}, d)"""
RELATION = Family(
    "checks_relation",
    f"""{RELATION_ROWS},
s AS (SELECT {K}, {share("e <> i")} AS asym, avg(CASE WHEN e = 1 THEN CASE WHEN i = 0 THEN 1e0 ELSE 0e0 END END) AS no_bars, avg(CASE WHEN i = 1 THEN CASE WHEN e = 1 THEN 1e0 ELSE 0e0 END END) AS overlap FROM sides GROUP BY {K}),
a AS (SELECT {K}, count(*) AS n, {share(_off("close", "ic", 0.005))} AS c, {n("high < ih * (1 - 0.001)")} AS h, {n("low > il * (1 + 0.001)")} AS l, {share(_off("open", "io", 0.005))} AS o,
  avg(CASE WHEN volume > 0 AND iv > 0 THEN CASE WHEN {_off("volume", "iv", 0.02)} THEN 1e0 ELSE 0e0 END END) AS v, avg(diff) / nullif(stddev_samp(diff) / sqrt(count(diff)), 0) AS t_stat, corr(er, ir) AS r, count(er + ir) AS rn,
  {share("NOT (" + _off("high", "ih", 0.001) + ")")} AS h_ok, {share("NOT (" + _off("low", "il", 0.001) + ")")} AS l_ok, avg(diff) AS bias, stddev_pop(diff) AS sd, avg(close) AS mean_close, {share("abs(diff) > 0.1")} AS ticks_off,
  avg(CASE WHEN iv / nullif(volume, 0) BETWEEN 0.95 AND 1.05 THEN 1e0 ELSE 0e0 END) AS vol_ok, @PCT(close, 0.5) / nullif(@PCT(ic, 0.5), 0) AS med_ratio FROM j GROUP BY {K}),
b AS (SELECT * FROM a JOIN s USING ({K}))""",
    "b",
    K,
    (
        ("REL-001", "RELATION Soft High 5", "c", "c > 0.01"),
        ("REL-002", "RELATION Soft High 5", "h", "h > 0"),
        ("REL-003", "RELATION Soft High 5", "l", "l > 0"),
        ("REL-004", "RELATION Soft Medium 4", "o", "o > 0.01"),
        ("REL-005", "RELATION Soft Medium 4", "v", "v > 0.05"),
        ("REL-006", "RELATION Soft Medium 3", "t_stat", "n >= 30 AND abs(t_stat) > 3.66"),
        ("REL-007", "RELATION Soft Medium 3", "r", "rn >= 30 AND r < 0.98"),
        ("REL-008", "RELATION Soft Medium 3", "asym", "asym > 0.05"),
        ("REL-009", "RELATION Soft High 4", "least(1 - c, 1 - o, h_ok, l_ok, 1 - v)", "n >= 10 AND least(1 - c, 1 - o, h_ok, l_ok, 1 - v) < 0.95"),
        ("REL-010", "RELATION Soft Low 2", "bias + 1.96 * sd", "n >= 30 AND abs(bias) / nullif(mean_close, 0) > 0.005"),
        ("REL-011", "RELATION Soft Low 2", "ticks_off", "ticks_off > 0.01"),
        ("REL-012", "RELATION Soft Medium 3", "no_bars", "no_bars > 0.05"),
        ("BT-016", "TIMEFRAME Soft Medium 3", "overlap", "n > 20 AND overlap < 0.8"),
        ("BT-017", "TIMEFRAME Soft High 4", "med_ratio", "med_ratio > 5 OR med_ratio < 0.2"),
        ("AGG-003", "Aggregation Soft Low 2", "vol_ok", "n >= 10 AND vol_ok < 0.95"),
    ),
)

FAMILIES = (EOD, INTRADAY, PAIRS, CONSENSUS, RELATION)
