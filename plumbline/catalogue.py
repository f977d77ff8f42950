"""Queries of the market-data engine and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plumbline.operators import queries as charts
from plumbline.plans import checks, dialect, executor, market, more, outcomes, registry, repairs, windows
from plumbline.sources.shared import once
from plumbline.streaming import queries as streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _family(f: checks.Family) -> None:
    QUERIES[f.name] = dialect.query(f.text("spark"))
    SQL[f.name] = dialect.oracle(f.text("duckdb"))


def _plan(name: str, text: str) -> None:
    QUERIES[name] = dialect.query(text)
    SQL[name] = dialect.oracle(text)


for _f in (*checks.FAMILIES, *market.FAMILIES, *more.FAMILIES):
    _family(_f)
for _name, _text in checks.FIELD_CHECKS.items():
    _plan(_name, _text)
for _name, _text in (repairs.PLANS | windows.PLANS | market.PLANS | more.PLANS).items():
    _plan(_name, _text)


def _once(name: str, text: str) -> Callable[[SparkSession, str], DataFrame]:
    """The rows of a plan over a folder's tables, stored for all plans that read them."""
    return lambda spark, sf_dir: once(spark, sf_dir, name, lambda: dialect.query(text)(spark, sf_dir))


results = _once("results", f"WITH {market.results('spark')} SELECT * FROM results")
scores = _once("scores", windows.ALL_SCORES)
for _name, _made in windows.OVER_SCORES.items():
    QUERIES[_name] = dialect.query(_made(windows.STORED_SCORES), scores=scores)
    SQL[_name] = dialect.oracle(_made())
for _name, _text in market.SCORECARDS.items():
    QUERIES[_name] = dialect.query(_text.replace("FROM results", "FROM {results}"), results=results)
    SQL[_name] = dialect.oracle(f"WITH {market.results('duckdb')} {_text}")


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    present, kinds = (dialect.query(text)(spark, sf_dir) for text in (outcomes.PRESENT, outcomes.KINDS))
    return outcomes.outcomes(results(spark, sf_dir), present, outcomes.specs_of(spark, market.told()), outcomes.EXPECTED, kinds)


QUERIES["outcomes"] = _outcomes
SQL["outcomes"] = dialect.oracle(f"WITH {market.results('duckdb')}, {outcomes.OUTCOMES_SQL} SELECT * FROM outcomes")
QUERIES["outcome_totals"] = lambda spark, sf_dir: outcomes.totals(_outcomes(spark, sf_dir))
SQL["outcome_totals"] = dialect.oracle(f"WITH {market.results('duckdb')}, {outcomes.OUTCOMES_SQL} {outcomes.TOTALS_SQL}")
for _more in (executor, registry, charts, streams):
    QUERIES |= _more.QUERIES
    SQL |= _more.SQL
