"""Repair rules over daily and one-minute bars, with a cell-level audit.

Rules run in ascending priority; each is a few expressions over the previous rule's columns, so a chain of rules is
one plan. Capping a return by the already capped previous close folds over each frame's sorted rows, which are the bars
of one instrument. Rules below the least confidence are flagged and not applied.
"""

from __future__ import annotations

from plumbline.sources.bars import DAILY, MINUTE, K

WT = f"(PARTITION BY {K} ORDER BY d)"
BACK = f"(PARTITION BY {K} ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
AHEAD = f"(PARTITION BY {K} ORDER BY d ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"

#: rule id: (priority, confidence, what it does)
RULES = {
    "RECT-EOD-024": (1, 0.99, "trim strings"), "RECT-EOD-020": (3, 0.99, "drop future dates, sort"), "RECT-EOD-003": (5, 0.98, "one row for a date, the lowest close"),
    "RECT-EOD-001": (10, 0.95, "fill null prices forward, then backward; null volume 0"), "RECT-EOD-005": (12, 0.99, "swap high and low"), "RECT-EOD-010": (13, 0.90, "widen the range to open and close"),
    "RECT-EOD-006": (14, 0.92, "clamp close and open to the range"), "RECT-EOD-004": (15, 0.90, "negative prices to absolute, zeros filled"), "RECT-EOD-002": (20, 0.85, "insert missing weekdays"),
    "RECT-EOD-007": (25, 0.80, "bad volume to the centred median of five"), "RECT-EOD-008": (30, 0.70, "flag stale runs"), "RECT-EOD-009": (35, 0.75, "cap returns at 20 %"),
    "RECT-EOD-011": (40, 0.85, "absent adj_close is close"), "RECT-EOD-012": (42, 0.95, "open interest absolute, null 0"), "RECT-EOD-014": (45, 0.70, "winsorize volume at 4 deviations"),
    "RECT-EOD-015": (46, 0.65, "winsorize returns at 4 deviations"), "RECT-INT-020": (1, 0.99, "trim strings"), "RECT-INT-002": (5, 0.99, "drop null timestamps"),
    "RECT-INT-003": (6, 0.98, "one row for a timestamp"), "RECT-INT-010": (7, 0.92, "sort"), "RECT-INT-007": (8, 0.95, "drop bars outside the session"), "RECT-INT-019": (9, 0.95, "drop weekends"),
    "RECT-INT-005": (12, 0.95, "swap high and low, clamp close"), "RECT-INT-006": (14, 0.90, "negative prices to absolute"), "RECT-INT-004": (15, 0.90, "fill nulls within the day"),
    "RECT-INT-001": (20, 0.85, "insert missing minutes, 50 a day at most"), "RECT-INT-011": (45, 0.70, "cap volume at 4 deviations"),
}
MIN_CONFIDENCE = 0.70
#: Return from which a close is capped, missing weekdays of a frame from which none is inserted, and minutes inserted a day.
CAP = 0.20
MAX_INSERTED = 250
MAX_MINUTES = 50


def _filled(c: str) -> str:
    return f"coalesce({c}, @LASTNN({c}) OVER {BACK}, @FIRSTNN({c}) OVER {AHEAD}) AS {c}"


def _noted(rule: str, *changed: str) -> str:
    """The log with a note of how many of the conditions ``changed`` hold for a row, where any does."""
    k = " + ".join(f"CASE WHEN {c} THEN 1 ELSE 0 END" for c in changed)
    return f"concat(log, CASE WHEN {k} > 0 THEN concat('{rule}:', cast({k} AS string), ';') ELSE '' END) AS log"


def eod_chain(as_of: str = "1998-12-31", base: str = DAILY) -> str:
    """Common table expressions from ``bars`` to ``repaired``, one step for each applied rule, in order of priority.

    Every step reads the one before it once. ``log`` notes rule and number of changed cells of each row, as text.
    """
    ohlc = ("open", "high", "low", "close")
    return f"""{base + "," if base else ""}
r024 AS (SELECT trim(symbol) AS symbol, trim(exchange) AS exchange, trim(source) AS source, d, open, high, low, close, adj_close, volume, open_interest, '' AS log FROM bars),
r020 AS (SELECT * FROM r024 WHERE d IS NOT NULL AND d <= DATE '{as_of}'),
r003 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {K}, d ORDER BY close NULLS LAST) AS rn FROM r020) x WHERE rn = 1),
r001 AS (SELECT {K}, d, {", ".join(map(_filled, ohlc))}, adj_close, coalesce(volume, 0) AS volume, open_interest, {_noted("RECT-EOD-001", *[f"{c} IS NULL" for c in (*ohlc, "volume")])} FROM r003),
r005 AS (SELECT {K}, d, open, CASE WHEN high < low THEN low ELSE high END AS high, CASE WHEN high < low THEN high ELSE low END AS low, close, adj_close, volume, open_interest, {_noted("RECT-EOD-005", "high < low", "high < low")} FROM r001),
r010 AS (SELECT {K}, d, open, greatest(high, open, close) AS high, least(low, open, close) AS low, close, adj_close, volume, open_interest, {_noted("RECT-EOD-010", "high < greatest(open, close)", "low > least(open, close)")} FROM r005),
r006 AS (SELECT {K}, d, greatest(low, least(high, open)) AS open, high, low, greatest(low, least(high, close)) AS close, adj_close, volume, open_interest, {_noted("RECT-EOD-006", "open < low OR open > high", "close < low OR close > high")} FROM r010),
r004a AS (SELECT {K}, d, {", ".join(f"nullif(abs({c}), 0) AS {c}" for c in ohlc)}, adj_close, volume, open_interest, {_noted("RECT-EOD-004", *[f"{c} <= 0" for c in ohlc])} FROM r006),
r004 AS (SELECT {K}, d, {", ".join(map(_filled, ohlc))}, adj_close, volume, open_interest, log FROM r004a),
ahead AS (SELECT *, lead(d) OVER {WT} AS next_d FROM r004),
grid AS (SELECT *, @DAYSEQ(d, coalesce(@ADDDAYS(next_d, -1), d)) AS day FROM ahead),
weekdays AS (SELECT *, CASE WHEN day = d THEN 0 ELSE 1 END AS inserted FROM grid WHERE day = d OR @WEEKDAY(day) < 5),
counted AS (SELECT *, sum(inserted) OVER (PARTITION BY {K}) AS missing FROM weekdays),
r002 AS (SELECT {K}, cast(day AS date) AS d, CASE WHEN inserted = 1 THEN close ELSE open END AS open, CASE WHEN inserted = 1 THEN close ELSE high END AS high, CASE WHEN inserted = 1 THEN close ELSE low END AS low, close,
  CASE WHEN inserted = 0 THEN adj_close END AS adj_close, CASE WHEN inserted = 1 THEN 0 ELSE volume END AS volume, CASE WHEN inserted = 0 THEN open_interest END AS open_interest, inserted, CASE WHEN inserted = 1 THEN 'RECT-EOD-002:1;' ELSE log END AS log
  FROM counted WHERE inserted = 0 OR missing <= {MAX_INSERTED}),
r007 AS (SELECT {K}, d, open, high, low, close, adj_close, CASE WHEN volume <= 0 OR volume IS NULL THEN greatest(coalesce(floor(med5 + 0.5e0), 0e0), 0e0) ELSE volume END AS volume, open_interest, inserted, {_noted("RECT-EOD-007", "(volume <= 0 OR volume IS NULL) AND med5 >= 0.5")},
  lag(close) OVER {WT} AS before FROM (SELECT *, @PCT(volume, 0.5) OVER (PARTITION BY {K} ORDER BY d ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS med5 FROM r002) x),
way AS (SELECT *, CASE WHEN before > 0 AND close / before - 1 > {CAP} THEN 1 WHEN before > 0 AND close / before - 1 < -{CAP} THEN -1 ELSE 0 END AS dir FROM r007),
r009 AS (@CAPPED(way, {CAP})),
r012 AS (SELECT {K}, d, open, high, low, close, coalesce(adj_close, close) AS adj_close, volume, coalesce(abs(open_interest), 0) AS open_interest, inserted,
  concat(log, CASE WHEN dir <> 0 THEN 'RECT-EOD-009:1;' ELSE '' END, CASE WHEN adj_close IS NULL THEN 'RECT-EOD-011:1;' ELSE '' END, CASE WHEN open_interest < 0 OR open_interest IS NULL THEN 'RECT-EOD-012:1;' ELSE '' END) AS log FROM r009),
repaired AS (SELECT {K}, d, open, high, low, close, adj_close,
  CASE WHEN (volume - m) / nullif(s, 0) > 4 THEN floor(m + 4 * s) WHEN (volume - m) / nullif(s, 0) < -4 THEN floor(greatest(0e0, m - 4 * s)) ELSE volume END AS volume, open_interest, inserted, {_noted("RECT-EOD-014", "abs((volume - m) / nullif(s, 0)) > 4")}
  FROM (SELECT *, avg(volume) OVER (PARTITION BY {K}) AS m, stddev_samp(volume) OVER (PARTITION BY {K}) AS s FROM r012) x)"""


EOD_REPAIRED = f"WITH {eod_chain().strip()} SELECT {K}, d, round(open, 4) AS open, round(high, 4) AS high, round(low, 4) AS low, round(close, 4) AS close, round(adj_close, 4) AS adj_close, round(volume, 2) AS volume, open_interest, inserted FROM repaired"

_CELLS = ("open", "high", "low", "close", "adj_close", "volume", "open_interest")


def _cell(side: str) -> str:
    return "CASE pos " + " ".join(f"WHEN {i} THEN {side}{c}" for i, c in enumerate(_CELLS)) + " END"


#: One audit row for each changed cell, inserted row and field: one join of the repaired with the raw bars.
AUDIT = f"""WITH {eod_chain().strip()},
cells0 AS (SELECT r.symbol, r.exchange, r.source, r.d, inserted, {", ".join(f"r.{c} AS n_{c}, b.{c} AS o_{c}" for c in _CELLS)}, @INTSEQ(0, {len(_CELLS) - 1}) AS pos
  FROM repaired r LEFT JOIN bars b ON r.symbol = b.symbol AND r.exchange = b.exchange AND r.source = b.source AND r.d = b.d),
cells AS (SELECT {K}, d, CASE pos {" ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(_CELLS))} END AS field, {_cell("o_")} AS old_value, {_cell("n_")} AS new_value, inserted FROM cells0)
SELECT {K}, d, field, round(old_value, 4) AS old_value, round(new_value, 4) AS new_value, CASE WHEN inserted = 1 THEN 'inserted' ELSE 'changed' END AS action
FROM cells WHERE old_value IS DISTINCT FROM new_value"""

AUDIT_SUMMARY = f"WITH audit AS ({AUDIT}) SELECT {K}, field, action, count(*) AS changes FROM audit GROUP BY {K}, field, action"

#: By rule: cells and rows that it changed, with its confidence, from the rows' logs.
RULE_AUDIT = f"""WITH {eod_chain().strip()},
notes AS (SELECT {K}, d, @SPLIT(log) AS note FROM repaired WHERE log <> ''),
named AS (SELECT {K}, d, substr(note, 1, 12) AS rule_id, cast(substr(note, 14) AS bigint) AS cells FROM notes WHERE note <> ''),
rules AS ({" UNION ALL ".join(f"SELECT '{r}' AS rule_id, {p} AS priority, {c:.2f} AS confidence, '{w}' AS reason" for r, (p, c, w) in RULES.items() if r.startswith("RECT-EOD"))})
SELECT {K}, named.rule_id, max(priority) AS priority, cast(max(confidence) AS double) AS confidence, max(reason) AS reason, cast(sum(cells) AS bigint) AS changes, count(*) AS rows_modified
FROM named JOIN rules ON named.rule_id = rules.rule_id GROUP BY {K}, named.rule_id"""

#: Rules that only flag: stale runs, and returns of four deviations, whose confidence is below the least one.
FLAGGED = f"""WITH {DAILY.strip()},
p AS (SELECT *, @LASTNN(close) OVER {BACK} AS pad FROM bars),
q AS (SELECT *, pad / nullif(lag(pad) OVER {WT}, 0) - 1 AS ret FROM p),
z AS (SELECT *, (ret - avg(ret) OVER (PARTITION BY {K})) / nullif(stddev_samp(ret) OVER (PARTITION BY {K}), 0) AS z, count(ret) OVER (PARTITION BY {K}) AS n FROM q)
SELECT {K}, 'RECT-EOD-015' AS rule_id, {RULES["RECT-EOD-015"][1]} < {MIN_CONFIDENCE} AS below_confidence, cast(sum(CASE WHEN n >= 10 AND abs(z) > 4 THEN 1 ELSE 0 END) AS bigint) AS flagged FROM z GROUP BY {K}"""

#: Stale runs: rows whose four prices all equal the previous row's, in runs of three or more.
STALE = f"""WITH {DAILY.strip()},
f AS (SELECT *, CASE WHEN open = lag(open) OVER {WT} AND high = lag(high) OVER {WT} AND low = lag(low) OVER {WT} AND close = lag(close) OVER {WT} THEN 1 ELSE 0 END AS same FROM bars),
g AS (SELECT *, sum(1 - same) OVER {BACK} AS run FROM f),
h AS (SELECT {K}, run, sum(same) AS stale FROM g GROUP BY {K}, run)
SELECT {K}, cast(max(stale) AS bigint) AS longest, cast(sum(CASE WHEN stale >= 3 THEN stale ELSE 0 END) AS bigint) AS flagged FROM h GROUP BY {K}"""

_DAY = f"(PARTITION BY {K}, d ORDER BY ts ROWS BETWEEN"


def _within_day(c: str) -> str:
    return f"coalesce({c}, @LASTNN({c}) OVER {_DAY} UNBOUNDED PRECEDING AND CURRENT ROW), @FIRSTNN({c}) OVER {_DAY} CURRENT ROW AND UNBOUNDED FOLLOWING))"


#: Rules in order of priority: trim, null timestamps, repeated timestamps, session, weekends, inversion with the close clamped,
#: negative prices, fills of each column within its day, missing minutes (``MAX_MINUTES`` a day), volume caps.
INTRADAY_REPAIRED = f"""WITH {MINUTE.strip()},
s1 AS (SELECT trim(symbol) AS symbol, trim(exchange) AS exchange, trim(source) AS source, ts, d, open, high, low, close, volume, hour(ts) * 60 + minute(ts) AS hhmm,
  row_number() OVER (PARTITION BY {K}, ts ORDER BY open, high, low, close, volume) AS rn FROM minutes WHERE ts IS NOT NULL),
s2 AS (SELECT * FROM s1 WHERE rn = 1 AND hhmm BETWEEN 555 AND 930 AND @WEEKDAY(d) < 5),
s5 AS (SELECT {K}, ts, d, hhmm, open, CASE WHEN high < low THEN low ELSE high END AS high, CASE WHEN high < low THEN high ELSE low END AS low,
  CASE WHEN close IS NULL OR high IS NULL OR low IS NULL THEN close ELSE greatest(least(high, low), least(greatest(high, low), close)) END AS close, volume FROM s2),
s6 AS (SELECT {K}, ts, d, hhmm, abs(open) AS open, abs(high) AS high, abs(low) AS low, abs(close) AS close, volume FROM s5),
s4 AS (SELECT {K}, ts, d, hhmm, {", ".join(f"{_within_day(c)} AS {c}" for c in ("open", "high", "low", "close"))}, coalesce({_within_day("volume")}, 0) AS volume FROM s6),
ahead AS (SELECT *, coalesce(lead(hhmm) OVER (PARTITION BY {K}, d ORDER BY hhmm), 930) AS next_m FROM s4),
grid AS (SELECT *, @INTSEQ(hhmm, greatest(hhmm, next_m - 1)) AS m FROM ahead),
nth AS (SELECT *, CASE WHEN m = hhmm THEN 0 ELSE 1 END AS inserted FROM grid),
kept AS (SELECT * FROM (SELECT *, sum(inserted) OVER (PARTITION BY {K}, d ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS so_far FROM nth) y WHERE inserted = 0 OR so_far <= {MAX_MINUTES}),
x AS (SELECT {K}, d, m AS hhmm, CASE WHEN inserted = 1 THEN close ELSE open END AS open, CASE WHEN inserted = 1 THEN close ELSE high END AS high, CASE WHEN inserted = 1 THEN close ELSE low END AS low, close, CASE WHEN inserted = 1 THEN 0 ELSE volume END AS volume, inserted FROM kept),
y AS (SELECT *, avg(volume) OVER (PARTITION BY {K}) AS m, stddev_samp(volume) OVER (PARTITION BY {K}) AS s FROM x)
SELECT {K}, d, hhmm, open, high, low, close, round(CASE WHEN (volume - m) / nullif(s, 0) > 4 THEN least(volume, floor(m + 4 * s)) WHEN (volume - m) / nullif(s, 0) < -4 THEN greatest(volume, 0e0) ELSE volume END, 2) AS volume, inserted FROM y"""

PLANS = {"repair_eod": EOD_REPAIRED, "repair_audit": AUDIT, "repair_summary": AUDIT_SUMMARY, "repair_rules": RULE_AUDIT, "repair_flags": FLAGGED, "repair_stale_runs": STALE, "repair_intraday": INTRADAY_REPAIRED}
