"""Relational plans written once as SQL and rendered for Spark or for the comparison engine.

A plan is text with ``{table}`` for inputs and a few ``@NAME(args)`` macros where the two SQL dialects differ.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plumbline.sources.bars import DAILY, DAILY_SPARK, MINUTE
from plumbline.sources.shared import once

_KEYS = "symbol, exchange, source"
_ROW = ("d", "open", "high", "low", "close", "adj_close", "volume", "open_interest", "inserted", "log", "dir")


def _capped_spark(table: str, cap: str) -> str:
    """Rows of ``table`` with each close that moves too far (dir 1 or -1) cut to the previous, already cut, close.

    Only far returns that follow each other depend on the row before, so they are numbered by run and folded in it.
    """
    cells = ", ".join(f"CASE WHEN dir <> 0 THEN aggregate(way, base, (acc, x) -> CASE WHEN x = 0 THEN acc ELSE round(acc * (1 + x * {cap}e0), 2) END) ELSE close END AS close" if c == "close" else c for c in _ROW)
    run = f"(PARTITION BY {_KEYS}, run ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"""SELECT {_KEYS}, {cells} FROM (SELECT *, collect_list(dir) OVER {run} AS way, first_value(close) OVER {run} AS base
    FROM (SELECT *, sum(CASE WHEN dir = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY {_KEYS} ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM {table}) f) g"""


def _capped_duckdb(table: str, cap: str) -> str:
    last = ", ".join(f"close := CASE WHEN x[1].dir <> 0 THEN round(acc[-1].close * (1 + x[1].dir * {cap}e0), 2) ELSE x[1].close END" if c == "close" else f"{c} := x[1].{c}" for c in _ROW)
    rows = f"list(struct_pack({', '.join(f'{c} := {c}' for c in _ROW)}) ORDER BY d)"
    return f"""SELECT {_KEYS}, {", ".join(f"z.{c} AS {c}" for c in _ROW)} FROM (SELECT {_KEYS}, unnest(list_reduce(list_transform(arr, lambda x: [x]), lambda acc, x: list_append(acc, struct_pack({last})))) AS z
    FROM (SELECT {_KEYS}, {rows} AS arr FROM {table} GROUP BY {_KEYS}) f) g"""


_MACROS: dict[str, dict[str, Callable[..., str]]] = {
    "spark": {
        "DAYS": lambda a, b: f"datediff({a}, {b})",
        "PCT": lambda x, q: f"percentile({x}, {q})",
        "LASTNN": lambda x: f"last_value({x}) IGNORE NULLS",
        "FIRSTNN": lambda x: f"first_value({x}) IGNORE NULLS",
        "WEEKDAY": lambda d: f"weekday({d})",
        "KURT": lambda x: f"kurtosis({x})",
        "SKEW": lambda x: f"skewness({x})",
        "MICROS": lambda t: f"unix_micros(cast({t} as timestamp))",
        "ADDDAYS": lambda d, n: f"date_add({d}, cast({n} as int))",
        "ADDMONTHS": lambda d, n: f"add_months({d}, cast({n} as int))",
        "DAYSEQ": lambda a, b: f"explode(sequence({a}, {b}, interval 1 day))",
        "INTSEQ": lambda a, b: f"explode(sequence({a}, {b}))",
        "ARGMIN": lambda x, *k: f"min_by({x}, struct({', '.join(k)}))",
        "ARGMAX": lambda x, *k: f"max_by({x}, struct({', '.join(k)}))",
        "DAYNAME": lambda d, f: f"date_format({d}, '{f}')",
        "STRUCTLIST": lambda order, *x: f"array_sort(collect_list(struct({order}, {', '.join(x)})))",
        "MODE": lambda x: f"mode({x}, true)",
        "JSON": lambda x, k: f"get_json_object({x}, '$.{k}')",
        "TRUNC": lambda u, t: f"date_trunc('{u}', {t})",
        "SPLIT": lambda x: f"explode(split({x}, ';'))",
        "JOINED": lambda order, x: f"array_join(transform(array_sort(collect_list(struct({order} AS o, {x} AS x))), e -> e.x), ';')",
        "CAPPED": _capped_spark,
    },
    "duckdb": {
        "DAYS": lambda a, b: f"date_diff('day', {b}, {a})",
        "PCT": lambda x, q: f"quantile_cont({x}, {q})",
        "LASTNN": lambda x: f"last_value({x} IGNORE NULLS)",
        "FIRSTNN": lambda x: f"first_value({x} IGNORE NULLS)",
        "WEEKDAY": lambda d: f"(isodow({d}) - 1)",
        "KURT": lambda x: f"kurtosis_pop({x})",
        "SKEW": lambda x: f"(avg({x}*{x}*{x}) - 3*avg({x})*avg({x}*{x}) + 2*avg({x})*avg({x})*avg({x})) / nullif(pow(var_pop({x}), 1.5), 0)",
        "MICROS": lambda t: f"epoch_us({t})",
        "ADDDAYS": lambda d, n: f"({d} + cast({n} as int))",
        "ADDMONTHS": lambda d, n: f"cast({d} + to_months(cast({n} as int)) as date)",
        "DAYSEQ": lambda a, b: f"cast(unnest(generate_series(cast({a} as timestamp), cast({b} as timestamp), interval 1 day)) as date)",
        "INTSEQ": lambda a, b: f"unnest(generate_series({a}, {b}))",
        "ARGMIN": lambda x, *k: f"arg_min({x}, row({', '.join(k)}))",
        "ARGMAX": lambda x, *k: f"arg_max({x}, row({', '.join(k)}))",
        "DAYNAME": lambda d, f: f"strftime({d}, '{ {'MMM-yyyy': '%b-%Y', 'yyyy': '%Y'}[f] }')",
        "MODE": lambda x: f"mode({x} ORDER BY {x})",
        "JSON": lambda x, k: f"json_extract_string({x}, '$.{k}')",
        "TRUNC": lambda u, t: f"date_trunc('{u}', {t})",
        "SPLIT": lambda x: f"unnest(string_split({x}, ';'))",
        "JOINED": lambda order, x: f"string_agg({x}, ';' ORDER BY {order})",
        "CAPPED": _capped_duckdb,
    },
}


def _arguments(text: str) -> list[str]:
    out, depth, last = [], 0, 0
    for i, c in enumerate(text):
        depth += (c == "(") - (c == ")")
        if c == "," and depth == 0:
            out.append(text[last:i].strip())
            last = i + 1
    return [*out, text[last:].strip()]


def render(text: str, engine: str) -> str:
    """``text`` with its macros written out for ``engine`` (spark or duckdb), innermost last."""
    while (at := text.find("@")) >= 0:
        start = text.index("(", at)
        depth, end = 1, start + 1
        while depth:
            depth += (text[end] == "(") - (text[end] == ")")
            end += 1
        text = text[:at] + _MACROS[engine][text[at + 1 : start]](*_arguments(text[start + 1 : end - 1])) + text[end:]
    return text


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
#: Relations that most plans begin with: their text, the relation that it ends in, the text for Spark. Each is made once
#: for a folder and stored.
BASES = {"daily_bars": (DAILY.strip(), "bars", DAILY_SPARK.strip()), "minute_bars": (MINUTE.strip(), "minutes", MINUTE.strip())}


def _over(spark: SparkSession, sf_dir: str, text: str, tables: dict[str, DataFrame]) -> DataFrame:
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in text}
    return spark.sql(render(text, "spark"), **used, **tables)


def query(text: str, **more: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The Spark query of a plan over the Parquet tables of a folder, and over the tables that ``more`` makes of it.

    A plan's base relation is read from its stored table, so a session scans a folder's tables once for all plans.
    """
    bases = [name for name, (base, _, _) in BASES.items() if base in text]
    for name in bases:
        base, relation, _ = BASES[name]
        text = text.replace(base, f"{relation} AS (SELECT * FROM {{{name}}})")

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = {t: made(spark, sf_dir) for t, made in more.items()}
        for name in bases:
            _, relation, base = BASES[name]
            tables[name] = once(spark, sf_dir, name, lambda base=base, relation=relation: _over(spark, sf_dir, f"WITH {base} SELECT * FROM {relation}", {}))
        return _over(spark, sf_dir, text, tables)

    return run


def oracle(text: str) -> str:
    out = render(text, "duckdb")
    for t in TABLES:
        out = out.replace("{" + t + "}", t)
    return out


def unpivot(rows: list[tuple[str, str, str]], keys: str, source: str, engine: str) -> str:
    """(keys, check_id, value, failed) from columns of one aggregated row: a ``stack``, so the source is read once."""
    if engine == "spark":
        body = ", ".join(f"'{i}', nullif(round(cast({v} as double), 4), cast('NaN' as double)), coalesce({f}, false)" for i, v, f in rows)
        return f"SELECT {keys}, stack({len(rows)}, {body}) AS (check_id, value, failed) FROM {source}"
    return " UNION ALL ".join(f"SELECT {keys}, '{i}' AS check_id, nullif(round(cast({v} as double), 4), cast('NaN' as double)) AS value, coalesce({f}, false) AS failed FROM {source}" for i, v, f in rows)
