"""Window scoring, best-source selection and the merged series.

Windows are consecutive periods of N months from the first month of a symbol's data. Bars are summed by month, and so
is the agreement of pairs of sources, which meet once, by date. Only those sums are given to the ten frequencies; the
window index is arithmetic on months, not a join.
"""

from __future__ import annotations

from plumbline.plans.repairs import eod_chain
from plumbline.sources.bars import DAILY, MINUTE, K

#: (name, months); 0 months is the whole range.
FREQUENCIES = [("monthly", 1), ("quarterly", 3), ("half_yearly", 6), ("yearly", 12), ("2_yearly", 24), ("3_yearly", 36), ("5_yearly", 60), ("10_yearly", 120), ("15_yearly", 180), ("all", 0)]
WEIGHTS = {
    "completeness": 0.10, "no_duplicates": 0.05, "ohlc_consistency": 0.10, "volume_quality": 0.10, "price_continuity": 0.10, "coverage": 0.10, "adj_close_valid": 0.10, "oi_valid": 0.05, "src_e002": 0.15, "src_e003": 0.15,
}

_FREQ = "CASE freq_ord " + " ".join(f"WHEN {i} THEN '{f}'" for i, (f, _) in enumerate(FREQUENCIES)) + " END AS freq"
_MONTHS = "CASE freq_ord " + " ".join(f"WHEN {i} THEN {m}" for i, (_, m) in enumerate(FREQUENCIES)) + " END AS months"
_W = f"{K}, freq, idx"


def _rolled(relation: str, columns: str) -> str:
    """Rows by month (month number mi) as rows by window, ten for each: there are few of them."""
    return f"""SELECT *, CASE WHEN months = 0 THEN 0 ELSE cast(floor(mi / (months * 1e0)) AS int) END AS idx FROM (SELECT *, {_FREQ}, {_MONTHS} FROM (SELECT {columns}, @INTSEQ(0, {len(FREQUENCIES) - 1}) AS freq_ord FROM {relation}) e) f"""


def _off(field: str) -> str:
    return f"sum(CASE WHEN abs(a{field} / nullif(b{field}, 0) - 1) > 0.001 THEN 1 ELSE 0 END)"


def scores(base: str = DAILY, bars: str = "bars", at: str = "d", jump: float = 0.20, per_day: int = 1) -> str:
    """Common table expressions up to ``scores`` for the relation ``bars`` of ``base`` with the time column ``at``.

    Bars and pairs of bars are summed by month first; windows sum months. A window's first bar has no return, so the
    return into each month is counted apart and taken off where the window begins. One-minute bars (``per_day`` over 1)
    have no adj_close, which counts as valid, and their clean points don't look at the open.
    """
    minute = per_day > 1
    no_adj = "0" if minute else "sum(CASE WHEN adj_close IS NULL THEN 1 ELSE 0 END)"
    clean = "close IS NOT NULL AND high >= low AND close BETWEEN low AND high" + ("" if minute else " AND open IS NOT NULL AND open BETWEEN low AND high")
    return f"""{base},
origin AS (SELECT symbol, min(d) AS first_d, max(d) AS last_d, year(min(d)) * 12 + month(min(d)) AS m0 FROM {bars} GROUP BY symbol),
x AS (SELECT b.*, year(d) * 12 + month(d) - m0 AS mi FROM {bars} b JOIN origin o ON b.symbol = o.symbol),
y AS (SELECT *, close / nullif(lag(close) OVER (PARTITION BY {K} ORDER BY {at}), 0) - 1 AS ret, row_number() OVER (PARTITION BY {K}, mi ORDER BY {at}) AS nr FROM x),
by_month AS (SELECT {K}, mi, count(*) AS k, count(DISTINCT {at}) AS k_d, count(open) + count(high) + count(low) + count(close) AS cells, count(close) AS k_close,
  sum(CASE WHEN high >= low AND close BETWEEN low AND high AND open BETWEEN low AND high THEN 1 ELSE 0 END) AS ok, sum(CASE WHEN volume = 0 OR volume IS NULL THEN 1 ELSE 0 END) AS no_volume,
  {no_adj} AS no_adj, sum(CASE WHEN open_interest < 0 THEN 1 ELSE 0 END) AS bad_oi,
  sum(CASE WHEN {clean} THEN 1 ELSE 0 END) AS clean,
  count(ret) AS rets, sum(CASE WHEN abs(ret) > {jump} THEN 1 ELSE 0 END) AS jumps, count(CASE WHEN nr = 1 THEN ret END) AS rets_in, sum(CASE WHEN nr = 1 AND abs(ret) > {jump} THEN 1 ELSE 0 END) AS jumps_in FROM y GROUP BY {K}, mi),
w0 AS ({_rolled("by_month", "*")}),
w AS (SELECT *, row_number() OVER (PARTITION BY {_W} ORDER BY mi) AS nth FROM w0),
pairs AS (SELECT a.symbol, a.mi, a.source AS s1, a.exchange AS e1, b.source AS s2, b.exchange AS e2, a.open AS ao, b.open AS bo, a.high AS ah, b.high AS bh, a.low AS al, b.low AS bl, a.close AS ac, b.close AS bc
  FROM x a JOIN x b ON a.symbol = b.symbol AND a.{at} = b.{at} AND a.source < b.source),
pair_month AS (SELECT symbol, mi, s1, e1, s2, e2, count(*) AS k, {_off("c")} AS c, {_off("o")} AS o, {_off("h")} AS h, {_off("l")} AS l FROM pairs GROUP BY symbol, mi, s1, e1, s2, e2),
pair_window AS ({_rolled("pair_month", "*")}),
breach AS (SELECT symbol, freq, idx, s1, e1, s2, e2, 100e0 * sum(c) / sum(k) AS c, (100e0 * sum(o) / sum(k) + 100e0 * sum(h) / sum(k) + 100e0 * sum(l) / sum(k)) / 3 AS ohl FROM pair_window GROUP BY symbol, freq, idx, s1, e1, s2, e2),
sided AS (SELECT *, @INTSEQ(1, 2) AS side FROM breach),
agree AS (SELECT symbol, exchange, source, freq, idx, round(greatest(0e0, 1 - avg(c) / 100), 4) AS src_e002, round(greatest(0e0, 1 - avg(ohl) / 100), 4) AS src_e003
  FROM (SELECT symbol, freq, idx, CASE side WHEN 1 THEN e1 ELSE e2 END AS exchange, CASE side WHEN 1 THEN s1 ELSE s2 END AS source, c, ohl FROM sided) s GROUP BY {_W}),
base AS (SELECT {_W}, freq_ord, months, sum(k) AS n_rows, sum(cells) / (4e0 * sum(k)) AS completeness, sum(k_d) / (sum(k) * 1e0) AS no_duplicates, sum(ok) / (sum(k) * 1e0) AS ohlc_consistency, 1 - sum(no_volume) / (sum(k) * 1e0) AS volume_quality,
  CASE WHEN sum(k) = 1 THEN 0e0 WHEN sum(k_close) <= 1 THEN 1e0 ELSE 1 - (sum(jumps) - sum(CASE WHEN nth = 1 THEN jumps_in ELSE 0 END)) / (greatest(sum(rets) - sum(CASE WHEN nth = 1 THEN rets_in ELSE 0 END), 1) * 1e0) END AS price_continuity,
  1 - sum(no_adj) / (sum(k) * 1e0) AS adj_close_valid, 1 - sum(bad_oi) / (sum(k) * 1e0) AS oi_valid, sum(clean) AS n_clean_points FROM w GROUP BY {_W}, freq_ord, months),
period AS (SELECT symbol, freq, freq_ord, months, idx, CASE WHEN months = 0 THEN first_d ELSE cast(@ADDMONTHS(cast(@TRUNC(month, first_d) AS date), idx * months) AS date) END AS window_start,
  CASE WHEN months = 0 THEN last_d ELSE least(last_d, cast(@ADDDAYS(cast(@ADDMONTHS(cast(@TRUNC(month, first_d) AS date), (idx + 1) * months) AS date), -1) AS date)) END AS window_end
  FROM (SELECT symbol, freq, freq_ord, months, idx FROM base GROUP BY symbol, freq, freq_ord, months, idx) w JOIN origin USING (symbol)),
expected AS (SELECT symbol, freq, idx, window_start, window_end, greatest(1, {per_day} * (
  cast(floor((@DAYS(window_end, window_start) + 1) / 7e0) AS int) * 5 + CASE WHEN @WEEKDAY(window_start) + (@DAYS(window_end, window_start) + 1) % 7 <= 5 THEN (@DAYS(window_end, window_start) + 1) % 7
    WHEN @WEEKDAY(window_start) >= 5 THEN greatest(0, (@DAYS(window_end, window_start) + 1) % 7 - (7 - @WEEKDAY(window_start)))
    ELSE (@DAYS(window_end, window_start) + 1) % 7 - least(2, @WEEKDAY(window_start) + (@DAYS(window_end, window_start) + 1) % 7 - 5) END)) AS n_expected FROM period),
scored AS (SELECT base.*, window_start, window_end, n_expected, least(n_rows / (n_expected * 1e0), 1e0) AS coverage, coalesce(src_e002, -1e0) AS src_e002, coalesce(src_e003, -1e0) AS src_e003
  FROM base JOIN expected USING (symbol, freq, idx) LEFT JOIN agree USING ({_W})),
scores AS (SELECT *, {" + ".join(f"{w}e0 * {c}" for c, w in WEIGHTS.items())} AS composite_score FROM scored)"""

SCORES = scores()
SCORE_COLUMNS = ", ".join(f"round({c}, 6) AS {c}" for c in (*WEIGHTS, "composite_score"))
WINDOW_SCORES = f"WITH {SCORES.strip()} SELECT {K}, freq, window_start, window_end, cast(n_rows AS bigint) AS n_rows, n_expected, cast(n_clean_points AS bigint) AS n_clean_points, {SCORE_COLUMNS} FROM scores"

#: One-minute bars: returns beyond 5 %, 375 bars a day.
SCORES_INTRADAY = scores(MINUTE, "minutes", "ts", 0.05, 375)
WINDOW_SCORES_INTRADAY = f"WITH {SCORES_INTRADAY.strip()} SELECT {K}, freq, window_start, window_end, cast(n_rows AS bigint) AS n_rows, n_expected, cast(n_clean_points AS bigint) AS n_clean_points, {SCORE_COLUMNS} FROM scores"

#: A window's name, from its start.
_LABEL = (
    "CASE WHEN freq = 'all' THEN 'all' WHEN freq = 'monthly' THEN @DAYNAME(window_start, MMM-yyyy) WHEN freq = 'quarterly' THEN concat('Q', cast(quarter(window_start) AS string), '-', cast(year(window_start) AS string))"
    " WHEN freq = 'half_yearly' THEN concat('H', CASE WHEN month(window_start) <= 6 THEN '1' ELSE '2' END, '-', cast(year(window_start) AS string)) WHEN months = 12 THEN cast(year(window_start) AS string)"
    " ELSE concat(cast(year(window_start) AS string), '-', cast(year(window_start) + cast(floor(months / 12e0) AS int) - 1 AS string)) END"
)
WINDOW_LABELS = f"WITH {SCORES.strip()} SELECT symbol, freq, window_start, window_end, {_LABEL} AS label FROM period"

#: Frames without a row in a window of their symbol: they get a row of zeros.
EMPTY_WINDOWS = f"""WITH {SCORES.strip()},
frames AS (SELECT {K} FROM base WHERE freq = 'all' GROUP BY {K})
SELECT f.symbol, f.exchange, f.source, p.freq, p.window_start, 0 AS n_rows, 0 AS n_clean_points, 0e0 AS composite_score
FROM frames f JOIN period p ON f.symbol = p.symbol LEFT JOIN base b ON f.symbol = b.symbol AND f.exchange = b.exchange AND f.source = b.source AND p.freq = b.freq AND p.idx = b.idx WHERE b.symbol IS NULL"""

#: Ties by score and clean points go to the source that scores higher in the containing window of the next coarser
#: frequency that decides, then to exchange and source in order. ``above`` has a frame's scores in the containing windows,
#: from fine to coarse, as text of equal width, so that texts compare as the scores do one after the other.
def selection(before: str = SCORES) -> str:
    """Common table expressions from ``scores`` (made by ``before``) to ``ranked`` and ``best``."""
    return f"""{before},
above AS (SELECT s.symbol, s.exchange, s.source, s.freq, s.idx, @JOINED(c.freq_ord, lpad(cast(cast(round((c.composite_score + 1) * 1000000000) AS bigint) AS string), 12, '0')) AS coarse
  FROM scores s JOIN scores c ON s.symbol = c.symbol AND s.exchange = c.exchange AND s.source = c.source AND c.freq_ord > s.freq_ord AND c.idx = CASE WHEN c.months = 0 THEN 0 ELSE cast(floor(s.idx * s.months / (c.months * 1e0)) AS int) END
  GROUP BY s.symbol, s.exchange, s.source, s.freq, s.idx),
ranked AS (SELECT s.*, row_number() OVER (PARTITION BY s.symbol, s.freq, s.idx ORDER BY round(composite_score, 9) DESC, n_clean_points DESC, coalesce(coarse, '') DESC, s.exchange, s.source) AS place,
  count(*) OVER (PARTITION BY s.symbol, s.freq, s.idx) AS n_candidates
  FROM scores s LEFT JOIN above a ON s.symbol = a.symbol AND s.exchange = a.exchange AND s.source = a.source AND s.freq = a.freq AND s.idx = a.idx),
best AS (SELECT * FROM ranked WHERE place = 1)"""


#: Plans over scores that are stored already, and bars beside them, where ``before`` has both.
def best_sources(before: str = SCORES) -> str:
    return f"WITH {selection(before).strip()} SELECT symbol, freq, window_start, window_end, source AS best_source, exchange AS best_exchange, round(composite_score, 6) AS best_score, cast(n_clean_points AS bigint) AS best_clean_points, n_candidates FROM best"


def candidates(before: str = SCORES) -> str:
    """All candidates of each window in order of preference, as exchange/source=score in ten thousandths."""
    return f"""WITH {selection(before).strip()} SELECT symbol, freq, window_start, count(*) AS n_candidates, @JOINED(place, concat(exchange, '/', source, '=', cast(cast(round(composite_score * 10000) AS bigint) AS string))) AS all_candidates
FROM ranked GROUP BY symbol, freq, window_start"""


def finest(windows: list[str], default: str = "quarterly") -> str:
    """The frequency to merge by: the finest of those asked for."""
    order = [f for f, _ in FREQUENCIES]
    return min(windows, key=order.index) if windows else default


def merge(before: str = SCORES, freq: str = "quarterly") -> str:
    """Common table expressions up to ``merged``: the winner's repaired bars of every window, stitched, with provenance.

    A symbol without a selection at ``freq`` is merged by year, and without that by its whole range.
    """
    return f"""{selection(before)},
{eod_chain(base="").strip()},
ways AS (SELECT *, CASE freq WHEN '{freq}' THEN 0 WHEN 'yearly' THEN 1 ELSE 2 END AS way FROM best WHERE freq IN ('{freq}', 'yearly', 'all')),
taken AS (SELECT * FROM (SELECT *, min(way) OVER (PARTITION BY symbol) AS first_way FROM ways) u WHERE way = first_way),
merged AS (SELECT b.symbol, b.d, open, high, low, close, volume, b.source AS _source, b.exchange AS _exchange, s.freq AS _window_freq, window_start AS _window_start, window_end AS _window_end, composite_score AS _dq_score,
  row_number() OVER (PARTITION BY b.symbol, b.d ORDER BY window_start) AS keep
  FROM repaired b JOIN taken s ON b.symbol = s.symbol AND b.source = s.source AND b.exchange = s.exchange AND b.d BETWEEN s.window_start AND s.window_end)"""


def final_series(before: str = SCORES) -> str:
    return f"WITH {merge(before).strip()} SELECT symbol, d, open, high, low, close, volume, _source, _exchange, _window_freq, _window_start, _window_end, round(_dq_score, 6) AS _dq_score FROM merged WHERE keep = 1"


def provenance(before: str = SCORES) -> str:
    return f"WITH {merge(before).strip()} SELECT symbol, _window_start, max(_source) AS source, max(_exchange) AS exchange, round(max(_dq_score), 6) AS score, count(*) AS n_rows FROM merged WHERE keep = 1 GROUP BY symbol, _window_start"


def fallback_series(before: str = SCORES) -> str:
    """A merge frequency that nothing is selected at, so years stand in."""
    return f"WITH {merge(before, 'weekly').strip()} SELECT symbol, d, round(close, 4) AS close, _source, _exchange, _window_freq, _window_start FROM merged WHERE keep = 1"


#: For Spark these read the scores of a folder's tables from one stored table.
OVER_SCORES = {"best_sources": best_sources, "window_candidates": candidates, "final_series": final_series, "provenance": provenance, "fallback_series": fallback_series}
STORED_SCORES = f"{DAILY},\nscores AS (SELECT * FROM {{scores}})"
ALL_SCORES = f"WITH {SCORES.strip()} SELECT * FROM scores"
PLANS = {"window_scores": WINDOW_SCORES, "window_scores_intraday": WINDOW_SCORES_INTRADAY, "window_labels": WINDOW_LABELS, "empty_windows": EMPTY_WINDOWS}
