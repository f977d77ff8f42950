"""Outcomes of a run: five statuses on the grid of what was expected, two scopes, totals, root causes.

Expected are, for every symbol, the frames of the configuration (time frame, exchange, source) with the checks that judge
a frame, and once each check that looks across frames (source cross, exchange all). Results meet this grid in an outer
join, so a frame without data and a check without a result are rows too.

* Data_Not_Present: the frame has no bars. Skip: there was nothing to judge, or no live feed.
* Redo_As_Results_Unclear: there are bars, but no result came; it earns half of the weight.
* Pass earns the weight, Fail nothing.

Defined cases: no results give a grid of Data_Not_Present and Redo; several results of a check for one place (pairs of
sources, say) are one outcome that fails if any does; results outside the grid have no row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.semantics import RUN_CAUSES, result_score, root_cause
from plumbline.plans.checks import CONFIG, INSTRUMENTS
from plumbline.sources.bars import DAILY, MINUTE

#: Layers whose checks look across frames.
CROSS_LAYERS = [
    "CROSS_SOURCE", "RELATION", "SOURCE", "GOVERNANCE", "BEAST_GATES", "COVERAGE", "SYMBOL", "UNKNOWN", "REFERENCE DATA", "LIVE", "LIVE INTEGRITY", "AGGREGATION", "RECONCILIATION", "PORTFOLIO", "PERFORMANCE", "CALENDAR",
]
#: Statuses.
PASS, FAIL, REDO, SKIP, ABSENT = "Pass", "Fail", "Redo_As_Results_Unclear", "Skip", "Data_Not_Present"
#: What a run expects of each symbol: (time frame, exchange, source).
EXPECTED = [("EOD", x, s) for x in ("F", "O") for s in CONFIG["source"]] + [("INTRADAY", "X", s) for s in ("click", "error", "purchase", "signup", "view")]
PRODUCTS = {"Equity": "EQUITY", "ETF": "ETF", "Futures": "FUTURES"}
SPEC = "check_id string, layer string, gate string, severity string, weight double"
PRESENT = f"WITH {DAILY.strip()}, {MINUTE.strip()} SELECT DISTINCT symbol, exchange, source, 'EOD' AS timeframe FROM bars UNION ALL SELECT DISTINCT symbol, exchange, source, 'INTRADAY' FROM minutes"
KINDS = f"WITH {INSTRUMENTS.strip()} SELECT symbol, kind FROM instruments"


def scope(layer: Column) -> Column:
    """cross, INTRADAY or EOD: where a check of a layer is judged."""
    name = F.upper(F.replace(layer, F.lit("_"), F.lit(" ")))
    known = [x.replace("_", " ") for x in CROSS_LAYERS]
    return F.when(name.isin(known), "cross").when(name == "INTRADAY", "INTRADAY").otherwise("EOD")


def outcomes(results: DataFrame, present: DataFrame, specs: DataFrame, expected: Sequence[tuple[str, str, str]], kinds: DataFrame) -> DataFrame:
    """One row for each place and check of the grid.

    ``results`` (symbol, exchange, source, check_id, value, failed), ``present`` (symbol, exchange, source, timeframe) of
    the frames with bars, ``specs`` as ``SPEC``, ``kinds`` (symbol, kind) for product classes.
    """
    checks = specs.withColumn("scope", scope(F.col("layer")))
    product = F.create_map(*[F.lit(x) for kv in PRODUCTS.items() for x in kv])
    symbols = present.select("symbol").distinct().join(kinds, "symbol", "left").select("symbol", F.coalesce(product[F.col("kind")], F.lit("EQUITY")).alias("product_class"))
    places = [F.struct(F.lit(t).alias("timeframe"), F.lit(x).alias("exchange"), F.lit(s).alias("source")) for t, x, s in expected]
    frames = symbols.select("symbol", "product_class", F.explode(F.array(*places)).alias("at")).select("symbol", "product_class", "at.*").withColumn("scope", F.col("timeframe"))
    across = symbols.select("symbol", F.lit("").alias("product_class"), F.lit("Both").alias("timeframe"), F.lit("all").alias("exchange"), F.lit("cross").alias("source"), F.lit("cross").alias("scope"))
    grid = frames.unionByName(across).join(F.broadcast(checks), "scope")

    told = results.join(F.broadcast(checks.select("check_id", "scope")), "check_id")
    crossed = F.col("scope") == "cross"
    told = told.groupBy("symbol", F.when(crossed, "all").otherwise(F.col("exchange")).alias("exchange"), F.when(crossed, "cross").otherwise(F.col("source")).alias("source"), "check_id").agg(
        F.count("*").alias("n"), F.max("value").alias("value"), F.max("failed").alias("failed")
    )
    here = present.select("symbol", "exchange", "source", "timeframe").distinct().withColumn("here", F.lit(True))
    rows = grid.join(told, ["symbol", "exchange", "source", "check_id"], "left").join(here, ["symbol", "exchange", "source", "timeframe"], "left")
    live = F.upper("layer").startswith("LIVE")
    status = (
        F.when((F.col("scope") != "cross") & F.col("here").isNull(), ABSENT)
        .when(F.col("n").isNull(), F.when(live, SKIP).otherwise(REDO))
        .when(F.col("failed"), FAIL)
        .when(F.col("value").isNull(), SKIP)
        .otherwise(PASS)
    )
    where = F.concat(F.lit("source="), "source", F.lit(" exchange="), "exchange", F.lit(" timeframe="), "timeframe")
    details = (
        F.when(F.col("status") == ABSENT, F.concat(F.lit("Data not available: "), where))
        .when(F.col("status") == REDO, F.lit("No result came"))
        .when(F.col("status") == SKIP, F.when(F.col("n").isNull(), "No live feed").otherwise("Nothing to judge"))
        .when(F.col("status") == FAIL, F.concat(F.lit("Outside the threshold: "), where))
        .otherwise("")
    )
    rows = rows.withColumn("status", status).withColumn("details", details)
    cause = root_cause(F.col("check_id"), F.col("status"), F.when(F.col("status") == ABSENT, F.concat(F.lit(f"{ABSENT} "), "details")).otherwise(F.col("details")), RUN_CAUSES)
    return rows.select(
        "symbol", "product_class", "source", "exchange", "timeframe", "check_id", "layer", "gate", "severity", "weight", "status",
        F.when(F.col("status") == PASS, 1.0).when(F.col("status") == REDO, 0.5).otherwise(0.0).alias("success_score"),
        result_score(F.when(F.col("status") == REDO, "Redo").otherwise(F.col("status")), F.col("weight")).alias("weighted_score"),
        "details", F.when(F.col("status").isin(PASS, SKIP), "OK").otherwise(cause).alias("cause"),
    )


def totals(rows: DataFrame) -> DataFrame:
    """By symbol and product class, and TOTAL; outcomes across frames have no product class and count toward TOTAL only."""
    one = lambda s: F.sum((F.col("status") == s).cast("long"))
    sets = rows.withColumn("product", F.nullif("product_class", F.lit(""))).groupingSets([["symbol", "product"], []], "symbol", "product")
    made = sets.agg(
        F.grouping_id().alias("level"), F.count("*").alias("checks"), one(PASS).alias("passed"), one(FAIL).alias("failed"), one(SKIP).alias("skipped"), one(REDO).alias("redo"), one(ABSENT).alias("absent"),
        F.sum("weighted_score").alias("earned"), F.sum("weight").alias("possible"),
    )
    made = made.where("level > 0 OR product IS NOT NULL")
    judged = F.col("passed") + F.col("failed")
    return made.select(
        F.when(F.col("level") > 0, "TOTAL").otherwise(F.col("symbol")).alias("symbol"), F.coalesce("product", F.lit("")).alias("product_class"), "checks", "passed", "failed", "skipped", "redo", "absent",
        F.round(F.col("passed") / F.nullif(judged, F.lit(0)), 6).alias("pass_rate"), F.round(F.col("earned") / F.nullif(F.col("possible"), F.lit(0.0)), 6).alias("weighted_rate"),
    )


def specs_of(spark: SparkSession, told: Sequence[tuple[str, str]]) -> DataFrame:
    """``SPEC`` rows of (check id, 'layer gate severity weight') pairs."""
    return spark.createDataFrame([(i, *m.rsplit(" ", 3)[:3], float(m.rsplit(" ", 3)[3])) for i, m in dict(told).items()], SPEC)


_VALUES = ", ".join(f"('{t}', '{x}', '{s}')" for t, x, s in EXPECTED)
_CROSS = ", ".join(f"'{x.replace('_', ' ')}'" for x in CROSS_LAYERS)
#: For the comparison engine, after the common table expressions of the results.
OUTCOMES_SQL = f"""{DAILY.strip()}, {MINUTE.strip()}, {INSTRUMENTS.strip()},
present AS (SELECT DISTINCT symbol, exchange, source, 'EOD' AS timeframe FROM bars UNION ALL SELECT DISTINCT symbol, exchange, source, 'INTRADAY' FROM minutes),
symbols AS (SELECT symbol, CASE kind WHEN 'ETF' THEN 'ETF' WHEN 'Futures' THEN 'FUTURES' ELSE 'EQUITY' END AS product_class FROM (SELECT DISTINCT symbol FROM present) LEFT JOIN instruments USING (symbol)),
config AS (SELECT * FROM (VALUES {_VALUES}) AS t(timeframe, exchange, source)),
judged AS (SELECT *, CASE WHEN upper(replace(layer, '_', ' ')) IN ({_CROSS}) THEN 'cross' WHEN upper(layer) = 'INTRADAY' THEN 'INTRADAY' ELSE 'EOD' END AS place FROM specs),
grid AS (SELECT symbol, product_class, source, exchange, timeframe, judged.* FROM symbols CROSS JOIN config JOIN judged ON place = timeframe UNION ALL SELECT symbol, '', 'cross', 'all', 'Both', judged.* FROM symbols CROSS JOIN judged WHERE place = 'cross'),
told AS (SELECT symbol, exchange, source, check_id, max(value) AS value, bool_or(failed) AS failed FROM verdicts JOIN judged ON id = check_id WHERE place <> 'cross' GROUP BY ALL
  UNION ALL SELECT symbol, 'all', 'cross', check_id, max(value), bool_or(failed) FROM verdicts JOIN judged ON id = check_id WHERE place = 'cross' GROUP BY ALL),
s AS (SELECT g.*, CASE WHEN place <> 'cross' AND p.symbol IS NULL THEN 'Data_Not_Present' WHEN t.check_id IS NULL AND layer LIKE 'Live%' THEN 'Skip' WHEN t.check_id IS NULL THEN 'Redo_As_Results_Unclear'
  WHEN failed THEN 'Fail' WHEN value IS NULL THEN 'Skip' ELSE 'Pass' END AS status, t.check_id IS NULL AS no_result, 'source=' || g.source || ' exchange=' || g.exchange || ' timeframe=' || g.timeframe AS spot
  FROM grid g LEFT JOIN told t ON g.symbol = t.symbol AND g.exchange = t.exchange AND g.source = t.source AND g.id = t.check_id LEFT JOIN present p ON g.symbol = p.symbol AND g.exchange = p.exchange AND g.source = p.source AND g.timeframe = p.timeframe),
outcomes AS (SELECT symbol, product_class, source, exchange, timeframe, id AS check_id, layer, gate, severity, cast(weight AS double) AS weight, status,
  CASE status WHEN 'Pass' THEN 1e0 WHEN 'Redo_As_Results_Unclear' THEN 0.5e0 ELSE 0e0 END AS success_score, weight * CASE status WHEN 'Pass' THEN 1e0 WHEN 'Redo_As_Results_Unclear' THEN 0.5e0 ELSE 0e0 END AS weighted_score,
  CASE status WHEN 'Data_Not_Present' THEN 'Data not available: ' || spot WHEN 'Redo_As_Results_Unclear' THEN 'No result came' WHEN 'Skip' THEN CASE WHEN no_result THEN 'No live feed' ELSE 'Nothing to judge' END WHEN 'Fail' THEN 'Outside the threshold: ' || spot ELSE '' END AS details,
  CASE WHEN status IN ('Pass', 'Skip') THEN 'OK' WHEN status = 'Data_Not_Present' THEN 'DATA_MISSING' WHEN id IN ('BST-005', 'GOV-003', 'BT-008') THEN 'DATA_STALE' WHEN id IN ('EOD-018', 'BT-023', 'INT-011', 'EOD-014') THEN 'SYNTHETIC_ARTIFACT' ELSE 'DATA_QUALITY' END AS cause FROM s)"""
TOTALS_SQL = """SELECT coalesce(symbol, 'TOTAL') AS symbol, coalesce(product_class, '') AS product_class, count(*) AS checks, count(*) FILTER (status = 'Pass') AS passed, count(*) FILTER (status = 'Fail') AS failed, count(*) FILTER (status = 'Skip') AS skipped,
  count(*) FILTER (status = 'Redo_As_Results_Unclear') AS redo, count(*) FILTER (status = 'Data_Not_Present') AS absent, round(count(*) FILTER (status = 'Pass') / nullif(count(*) FILTER (status IN ('Pass', 'Fail')), 0), 6) AS pass_rate, round(sum(weighted_score) / sum(weight), 6) AS weighted_rate
FROM outcomes GROUP BY GROUPING SETS ((symbol, product_class), ()) HAVING product_class IS NULL OR product_class <> ''"""
