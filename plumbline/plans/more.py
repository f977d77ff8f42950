"""Checks over frames, schemas, reference data and runs that need relations of their own, and the declared checks that have no rule."""

from __future__ import annotations

from plumbline.plans.checks import CONFIG_ROWS, INSTRUMENTS, LIMIT, WT, Family, n, share
from plumbline.sources.bars import DAILY, MINUTE, K

#: Declared checks without a rule: they report and pass. (id, metadata)
DECLARED = [
    ("EOD-045", "EOD Soft Low 1"), ("BT-018", "TIMEFRAME Soft Low 2"), ("BT-025", "TIMEFRAME Soft Medium 3"), ("BT-026", "TIMEFRAME Soft Low 2"), ("BT-027", "TIMEFRAME Soft Medium 3"), ("PERF-001", "Performance Soft Low 1"), ("INT-039", "INTRADAY Soft Low 2"),
    *[(f"PF-{i:03d}", "PORTFOLIO Soft Low 2") for i in (3, 6, 7)], *[(f"PTF-{i:03d}", "Coverage Soft Low 2") for i in (1, 2, 3)],
]

#: The feed before it is typed: text cells, tags and stamps, with a fault of each kind in some frames.
RAW = f"""{DAILY},
raw0 AS (SELECT bars.*, @DAYS(d, DATE '1992-01-01') AS nr, @DAYS(d, DATE '1970-01-01') AS day_nr FROM bars),
raw AS (SELECT {K}, d, day_nr, CASE WHEN symbol = 'S1' AND exchange = 'O' AND nr % 211 = 0 THEN 'x' ELSE cast(open AS string) END AS open, cast(high AS string) AS high, cast(low AS string) AS low, cast(close AS string) AS close,
  cast(volume AS string) AS volume, CASE WHEN symbol = 'S2' AND exchange = 'F' THEN NULL ELSE cast(open_interest AS string) END AS open_interest,
  CASE WHEN symbol = 'S2' AND exchange = 'O' THEN 'S2X' ELSE symbol END AS symbol_tag, CASE WHEN symbol = 'S1' AND source = 'R' THEN concat(exchange, '?') ELSE exchange END AS exchange_tag,
  CASE WHEN symbol = 'S0' AND source = 'N' THEN NULL WHEN symbol = 'S0' THEN 'Equity' WHEN symbol = 'S1' THEN 'Futures' ELSE 'Index' END AS type_tag,
  CASE WHEN symbol = 'S0' AND nr % 307 = 0 THEN cast(d AS timestamp) + INTERVAL '330' MINUTE ELSE cast(d AS timestamp) END AS stamp,
  day_nr * 86400 - 19800 + CASE WHEN symbol = 'S1' AND nr % 401 = 0 THEN 259200 ELSE 0 END AS epoch FROM raw0)"""
_CANONICAL = ("open", "high", "low", "close", "volume", "open_interest")
_ABSENT = " + ".join(f"CASE WHEN count({c}) = 0 THEN 1 ELSE 0 END" for c in _CANONICAL)

#: Columns, types, tags and stamps of each frame of the feed. Epochs (seconds of the day's start in India) come from source A only.
SCHEMA = Family(
    "checks_schema",
    f"""{RAW},
{INSTRUMENTS.strip()},
a AS (SELECT {K}, {_ABSENT} AS absent, CASE WHEN count(type_tag) = 0 THEN 1 ELSE 0 END AS no_type, {" + ".join(n(f"{c} IS NOT NULL AND try_cast({c} AS double) IS NULL") for c in _CANONICAL)} AS not_numbers,
  {n("symbol_tag = symbol")} AS symbol_ok, {n("exchange_tag = exchange")} AS exchange_ok, @ARGMIN(type_tag, d) AS first_type, {n("@TRUNC(day, stamp) <> stamp")} AS off_midnight,
  max(abs(floor((epoch + 19800) / 86400e0) - day_nr)) AS apart FROM raw GROUP BY {K}),
t AS (SELECT a.*, kind FROM a JOIN instruments USING (symbol))""",
    "t",
    K,
    (
        ("BT-001", "TIMEFRAME Soft High 4", "absent", "absent > 0"),
        ("BT-002", "TIMEFRAME Soft Medium 3", "not_numbers", "not_numbers > 0"),
        ("SRC-E014", "SOURCE Soft Medium 3", "absent + no_type", "absent + no_type > 0"),
        ("SYM-004", "SYMBOL Soft Low 2", "symbol_ok", "symbol_ok = 0"),
        ("SYM-005", "SYMBOL Soft Low 2", "exchange_ok", "exchange_ok = 0"),
        ("SYM-006", "SYMBOL Soft Low 2", "CASE WHEN first_type = kind THEN 0 WHEN first_type IS NOT NULL THEN 1 END", "first_type <> kind"),
        ("TF-002", "TIMEFRAME Soft Medium 3", "off_midnight", "off_midnight > 0"),
        ("BT-011", "TIMEFRAME Soft Medium 3", "off_midnight", "off_midnight > 0"),
        ("EOD-046", "EOD Soft Medium 3", "CASE WHEN source = 'A' THEN apart END", "source = 'A' AND apart > 1"),
    ),
)

#: Reference data of each symbol and the run's configuration; rows stand for all sources and exchanges.
_FIELD_OF = [("lot", 1), ("tick", 2), ("band_pct", 3), ("bse_code", 4), ("nse_symbol", 5), ("isin", 6), ("listed", 7), ("display_name", 8), ("kind", 9), ("prefix_bse", 10), ("prefix_nse", 11), ("eod_data", 12)]


def _unset(column: str) -> str:
    return f"{column} IS NULL OR cast({column} AS string) IN ('', 'TBD', '0')"


def _flag(cond: str) -> tuple[str, str]:
    return f"CASE WHEN {cond} THEN 1 ELSE 0 END", cond


REFERENCE = Family(
    "reference_data",
    f"""{DAILY},
{INSTRUMENTS.strip()},
{CONFIG_ROWS},
required AS (SELECT 'source' AS part, 'A' AS name UNION ALL SELECT 'source', 'N' UNION ALL SELECT 'source', 'R' UNION ALL SELECT 'threshold', 'eod' UNION ALL SELECT 'threshold', 'intraday' UNION ALL SELECT 'session', 'regular'),
gone AS (SELECT sum(CASE WHEN r.part = 'source' AND c.name IS NULL THEN 1 ELSE 0 END) AS no_source, sum(CASE WHEN r.part = 'threshold' AND c.name IS NULL THEN 1 ELSE 0 END) AS no_threshold,
  sum(CASE WHEN r.part = 'session' AND c.name IS NULL THEN 1 ELSE 0 END) AS no_session FROM required r LEFT JOIN config c ON r.part = c.part AND r.name = c.name),
have AS (SELECT symbol, 1 AS one, count(DISTINCT CASE WHEN (month(d) = 1 AND day(d) = 26) OR (month(d) = 8 AND day(d) = 15) OR (month(d) = 10 AND day(d) = 2) THEN d END) AS holidays FROM bars GROUP BY symbol),
t AS (SELECT have.symbol, 'all' AS exchange, 'all' AS source, kind, tick, lot, listed, isin, band_pct, bse_code, nse_symbol, display_name, prefix_bse, prefix_nse, eod_data, holidays, no_source, no_threshold, no_session
  FROM have LEFT JOIN instruments ON have.symbol = instruments.symbol JOIN (SELECT 1 AS one, gone.* FROM gone) g ON have.one = g.one)""",
    "t",
    K,
    (
        ("SYM-001", "SYMBOL Soft High 4", *_flag("kind IS NULL")),
        ("SYM-002", "SYMBOL Soft Medium 3", *_flag(" OR ".join(_unset(c) for c in ("isin", "listed", "lot", "tick")))),
        ("BT-006", "TIMEFRAME Soft Medium 3", *_flag("kind IS NULL OR kind NOT IN ('Equity', 'ETF', 'Index')")),
        *[(f"INST-{i:03d}", "UNKNOWN Soft Low 1", *_flag(_unset(c))) for c, i in _FIELD_OF],
        ("RD-001", "Reference_Data Soft Low 2", "no_source", "no_source > 0"),
        ("RD-002", "Reference_Data Soft Low 2", *_flag("kind IS NULL OR kind NOT IN ('Equity', 'ETF')")),
        ("RD-003", "Reference_Data Soft Low 2", "holidays", "holidays < 10"),
        ("RD-004", "Reference_Data Soft Low 2", "no_threshold", "no_threshold > 0"),
        ("RD-005", "Reference_Data Soft Low 2", "no_session", "no_session > 0"),
        ("AGG-001", "Aggregation Soft Low 2", "CAST(NULL AS double)", "false"),
    ),
)

WEEKS = Family(
    "checks_weekly",
    f"""{DAILY},
weeks AS (SELECT {K}, cast(@TRUNC(week, d) AS date) AS week, @ARGMIN(open, d) AS open, max(high) AS high, min(low) AS low FROM bars WHERE close IS NOT NULL GROUP BY 1, 2, 3, 4),
t AS (SELECT {K}, {n("high < low")} AS inverted, {n("high < open")} AS open_out FROM weeks GROUP BY {K})""",
    "t",
    K,
    (("BT-021", "TIMEFRAME Soft Medium 3", "inverted", "inverted > 0"), ("BT-024", "TIMEFRAME Soft Medium 3", "open_out", "open_out > 0")),
)


def _anova(check_id: str, base: str, relation: str, ret: str, least: int) -> Family:
    """One-way analysis of variance of returns by source: the tail probability of F, which has a finite form for an odd number of sources.

    For an even number of sources only the verdict is given, by the Wilson-Hilferty deviate against that of 0.001.
    """
    x, b = "(d2 / (d2 + d1 * f))", "(d2 / 2e0)"
    tail = f"CASE d1 WHEN 2 THEN pow({x}, {b}) WHEN 4 THEN pow({x}, {b}) * (1 + {b} * (1 - {x})) END"
    deviate = "((1 - 2 / (9e0 * d2)) * pow(f, 1 / 3e0) - (1 - 2 / (9e0 * d1))) / sqrt(2 / (9e0 * d1) + pow(f, 2 / 3e0) * 2 / (9e0 * d2))"
    return Family(
        f"checks_anova_{'daily' if check_id == 'SRC-E005' else 'intraday'}",
        f"""{base},
g AS (SELECT symbol, exchange, source, count({ret}) AS k, avg({ret}) AS m, var_samp({ret}) AS v FROM {relation} WHERE {ret} IS NOT NULL GROUP BY 1, 2, 3 HAVING count({ret}) > {least}),
h AS (SELECT *, sum(k * m) OVER (PARTITION BY symbol, exchange) / sum(k) OVER (PARTITION BY symbol, exchange) AS grand FROM g),
s AS (SELECT symbol, exchange, count(*) - 1 AS d1, sum(k) - count(*) AS d2, (sum(k * (m - grand) * (m - grand)) / nullif(count(*) - 1, 0)) / nullif(sum((k - 1) * v) / nullif(sum(k) - count(*), 0), 0) AS f FROM h GROUP BY symbol, exchange),
t AS (SELECT symbol, exchange, 'all' AS source, {tail} AS p, {deviate} AS z FROM s WHERE d1 >= 1 AND f IS NOT NULL)""",
        "t",
        K,
        ((check_id, "SOURCE Soft Medium 3", "p", "CASE WHEN p IS NOT NULL THEN p < 0.001 ELSE z > 3.0902 END"),),
    )


ANOVA_FAMILIES = (
    _anova("SRC-E005", f"{DAILY},\nr AS (SELECT *, CASE WHEN close > 0 AND lag(close) OVER {WT} > 0 THEN ln(close / lag(close) OVER {WT}) END AS lr FROM bars)", "r", "lr", 30),
    _anova("SRC-I011", f"{MINUTE},\nr AS (SELECT *, close / nullif(lag(close) OVER (PARTITION BY {K} ORDER BY ts), 0) - 1 AS lr FROM minutes)", "r", "lr", 100),
)

FRAMES = Family(
    "checks_frames",
    f"""{DAILY},
cut AS (SELECT {K}, @PCT(volume, 0.01) AS p01 FROM bars GROUP BY {K}),
low AS (SELECT b.symbol, b.exchange, b.source, b.d, CASE WHEN volume < p01 THEN 1 ELSE 0 END AS thin, lag(b.d) OVER (PARTITION BY b.symbol, b.exchange, b.source ORDER BY b.d) AS before FROM bars b JOIN cut USING ({K})),
marked AS (SELECT *, sum(CASE WHEN thin = 1 THEN 0 ELSE 1 END) OVER (PARTITION BY {K} ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM low),
runs AS (SELECT {K}, run, sum(thin) AS k FROM marked GROUP BY {K}, run),
longest AS (SELECT {K}, max(k) AS k FROM runs GROUP BY {K}),
orderly AS (SELECT {K}, {n("before > d")} AS late FROM low GROUP BY {K}),
a AS (SELECT {K}, count(*) AS n, max(d) AS last_d, {n("high < low")} AS inverted,
  1 - avg(((CASE WHEN open IS NULL THEN 1e0 ELSE 0e0 END) + (CASE WHEN high IS NULL THEN 1e0 ELSE 0e0 END) + (CASE WHEN low IS NULL THEN 1e0 ELSE 0e0 END) + (CASE WHEN close IS NULL THEN 1e0 ELSE 0e0 END)) / 4) AS complete,
  {share("high >= low AND close BETWEEN low AND high AND open BETWEEN low AND high")} AS valid, {share("close IS NULL")} AS no_close, stddev_samp(close) / nullif(avg(close), 0) AS spread, sum(close * volume) AS turnover FROM bars GROUP BY {K}),
b AS (SELECT a.*, k, late, @DAYS(DATE '{LIMIT["as_of"]}', last_d) AS age, turnover / sum(turnover) OVER () AS weight_share, avg(spread) OVER () AS mean_spread FROM a JOIN longest USING ({K}) JOIN orderly USING ({K})),
c AS (SELECT *, 0.5e0 * complete + 0.3e0 * valid + 0.2e0 * greatest(0, 1 - age / 365e0) AS health FROM b),
t AS (SELECT *, avg(health) OVER () AS mean_health FROM c)""",
    "t",
    K,
    (
        ("TF-004", "TIMEFRAME Soft High 4", "late", "late > 0"),
        ("BT-015", "TIMEFRAME Soft Medium 3", "k", "k >= 10"),
        ("GOV-001", "Governance Soft Critical 5", "mean_health", "mean_health < 0.90"),
        ("GOV-005", "Governance Soft Info 1", "n", "false"),
        ("BST-005", "BEAST_GATES Hard Critical 5", "age", "n = 0 OR age > 10 OR inverted > 0"),
        ("PERF-002", "Performance Soft Low 1", "n", "false"),
        ("SYM-008", "SYMBOL Soft Low 2", "n", "false"),
        ("PF-001", "PORTFOLIO Soft Low 2", "weight_share", "weight_share > 0.5"),
        ("PF-002", "PORTFOLIO Soft Low 2", "no_close", "no_close > 0.05"),
        ("PF-004", "PORTFOLIO Soft Low 2", "spread", "spread > 3 * mean_spread"),
        ("PF-005", "PORTFOLIO Soft Low 2", "age", "age > 90"),
        ("PF-008", "PORTFOLIO Soft Low 2", "health", "health < 0.5"),
        *[(i, m, "0", "false") for i, m in DECLARED],
    ),
)

#: Days of one-minute bars per source against the union of days, and clocks of the feed against a daily epoch.
DAYS = Family(
    "checks_intraday_days",
    f"""{MINUTE},
days AS (SELECT DISTINCT {K}, d FROM minutes WHERE NOT (source = 'view' AND day(d) % 9 = 0)),
whole AS (SELECT symbol, exchange, count(DISTINCT d) AS k FROM days GROUP BY symbol, exchange),
own AS (SELECT {K}, count(*) AS k_own FROM days GROUP BY {K}),
clock AS (SELECT {K}, {n("volume IS NULL OR close IS NULL OR ts IS NULL")} AS bad FROM minutes GROUP BY {K}),
t AS (SELECT own.*, k, bad FROM own JOIN whole USING (symbol, exchange) JOIN clock USING ({K}))""",
    "t",
    K,
    (
        ("SRC-I007", "SOURCE Soft High 4", "1 - k_own / (k * 1e0)", "1 - k_own / (k * 1e0) > 0.05"),
        ("LT-013", "Live Hard Critical 5", "bad", "bad > 0"),
    ),
)

ANOVA_INTRADAY = f"""WITH {MINUTE.strip()},
r AS (SELECT *, close / nullif(lag(close) OVER (PARTITION BY {K} ORDER BY ts), 0) - 1 AS ret FROM minutes),
g AS (SELECT symbol, exchange, source, count(ret) AS k, avg(ret) AS m, var_samp(ret) AS v FROM r WHERE ret IS NOT NULL GROUP BY 1, 2, 3 HAVING count(ret) > 100),
t AS (SELECT symbol, exchange, count(*) AS groups, sum(k) AS n, sum(k * m) / sum(k) AS grand, sum((k - 1) * v) AS inner_ss FROM g GROUP BY 1, 2),
s AS (SELECT g.symbol, g.exchange, sum(k * (m - grand) * (m - grand)) AS outer_ss FROM g JOIN t USING (symbol, exchange) GROUP BY 1, 2)
SELECT symbol, exchange, groups, cast(n AS bigint) AS n, round((outer_ss / (groups - 1)) / (inner_ss / (n - groups)), 6) AS f_stat FROM t JOIN s USING (symbol, exchange) WHERE groups >= 2"""

GAPS = f"""WITH {DAILY.strip()}, g AS (SELECT {K}, d, @DAYS(d, lag(d) OVER {WT}) AS gap, row_number() OVER {WT} AS nr FROM bars),
top AS (SELECT *, row_number() OVER (PARTITION BY {K} ORDER BY gap DESC, d) AS place FROM g WHERE gap IS NOT NULL)
SELECT {K}, d, gap, place FROM top WHERE place <= 5"""
STATISTICS = f"""WITH {DAILY.strip()}, r AS (SELECT {K}, close / nullif(lag(close) OVER {WT}, 0) - 1 AS ret, volume FROM bars)
SELECT {K}, count(ret) AS n, round(avg(ret), 6) AS mean, round(stddev_samp(ret), 6) AS sd, round(@PCT(ret, 0.01), 6) AS p01, round(@PCT(ret, 0.5), 6) AS median, round(@PCT(ret, 0.99), 6) AS p99, round(@KURT(ret), 4) AS kurtosis FROM r GROUP BY {K}"""

FAMILIES = (SCHEMA, REFERENCE, WEEKS, *ANOVA_FAMILIES, FRAMES, DAYS)
PLANS = {"anova_intraday": ANOVA_INTRADAY, "largest_gaps": GAPS, "return_statistics": STATISTICS}
