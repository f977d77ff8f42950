"""The rule executor: a registry of repair rules, composed into one plan for a configuration.

A rule says which cells it would change and to what, or which rows it would drop or insert. The executor takes the rules
of a frame type that the configuration asks for, in order of priority, and adds each to the plan: changes are measured
first; a rule whose confidence is too low, or whose changes in a frame are more than the configuration allows, is flagged
there and leaves the frame as it was. Every row carries a log of (rule, cells, applied), from which the audit is made in
one aggregation. Windows are over frames (one instrument's bars of a source), so the whole chain needs one shuffle.

Defined cases: an empty table gives no bars and no audit; a frame whose rows are all dropped has no audit; nulls are
changed only by the rules that fill them; other columns than the bar's are not returned.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.plans import dialect, repairs
from plumbline.sources.bars import DAILY, MINUTE

KEYS = ["symbol", "exchange", "source"]
PRICES = ["open", "high", "low", "close"]
ENTRY = "array<struct<rule:string,cells:int,applied:boolean>>"
Cells = dict[str, tuple[Column, Column]]
SESSION = (555, 930)


@dataclass(frozen=True)
class Config:
    """What a run asks for. ``off`` and ``confidence`` are by rule; ``rules`` limits the run to some."""

    rules: frozenset[str] | None = None
    off: frozenset[str] = frozenset()
    confidence: dict[str, float] = field(default_factory=dict)
    min_confidence: float = repairs.MIN_CONFIDENCE
    max_changes: int | None = 500
    dry_run: bool = False
    as_of: str = "1998-12-31"


@dataclass(frozen=True)
class Rule:
    rule_id: str
    #: cells, drop, insert, flag or keys.
    kind: str
    make: Callable

    @property
    def priority(self) -> int:
        return repairs.RULES[self.rule_id][0]

    @property
    def timeframe(self) -> str:
        return "EOD" if "-EOD-" in self.rule_id else "INTRADAY"


REGISTRY: dict[str, Rule] = {}


def rule(rule_id: str, kind: str = "cells"):
    """Registers what a rule makes of (bars, window in order, configuration)."""

    def kept(make: Callable) -> Callable:
        REGISTRY[rule_id] = Rule(rule_id, kind, make)
        return make

    return kept


def chosen(timeframe: str, config: Config) -> list[Rule]:
    """The rules of a frame type that a configuration runs, in order."""
    unknown = ((config.rules or frozenset()) | config.off | config.confidence.keys()) - REGISTRY.keys()
    if unknown:
        raise ValueError(f"no such rules: {sorted(unknown)}")
    some = [r for r in REGISTRY.values() if r.timeframe == timeframe and r.rule_id not in config.off and (config.rules is None or r.rule_id in config.rules)]
    return sorted(some, key=lambda r: r.priority)


def _whole():
    return W.partitionBy(*KEYS)


def _filled(c: Column, w) -> Column:
    back, ahead = w.rowsBetween(W.unboundedPreceding, 0), w.rowsBetween(0, W.unboundedFollowing)
    return F.coalesce(c, F.last(c, True).over(back), F.first(c, True).over(ahead))


def _trim(df: DataFrame, w, config: Config) -> DataFrame:
    cut = reduce(lambda a, b: a | b, [F.col(c) != F.trim(c) for c in KEYS])
    return df.withColumn("_k", F.coalesce(cut.cast("int"), F.lit(0))).withColumns({c: F.trim(c) for c in KEYS})


@rule("RECT-EOD-020", "drop")
def _future(df, w, config):
    return F.coalesce(F.col("d") > F.lit(config.as_of).cast("date"), F.lit(True))


@rule("RECT-EOD-003", "drop")
def _repeated_dates(df, w, config):
    return F.row_number().over(W.partitionBy(*KEYS, "d").orderBy(F.col("close").asc_nulls_last())) > 1


@rule("RECT-EOD-001")
def _nulls(df, w, config) -> Cells:
    return {c: (F.col(c).isNull(), _filled(F.col(c), w)) for c in PRICES} | {"volume": (F.col("volume").isNull(), F.coalesce("volume", F.lit(0.0)))}


@rule("RECT-EOD-005")
def _inverted(df, w, config) -> Cells:
    bad = F.col("high") < F.col("low")
    return {"high": (bad, F.when(bad, F.col("low")).otherwise(F.col("high"))), "low": (bad, F.when(bad, F.col("high")).otherwise(F.col("low")))}


@rule("RECT-EOD-010")
def _narrow(df, w, config) -> Cells:
    return {"high": (F.col("high") < F.greatest("open", "close"), F.greatest("high", "open", "close")), "low": (F.col("low") > F.least("open", "close"), F.least("low", "open", "close"))}


@rule("RECT-EOD-006")
def _outside(df, w, config) -> Cells:
    return {c: ((F.col(c) < F.col("low")) | (F.col(c) > F.col("high")), F.greatest("low", F.least("high", c))) for c in ("open", "close")}


@rule("RECT-EOD-004")
def _negative(df, w, config) -> Cells:
    return {c: (F.col(c) <= 0, _filled(F.nullif(F.abs(c), F.lit(0.0)), w)) for c in PRICES}


@rule("RECT-EOD-002", "insert")
def _missing_days(df, w, config):
    """Weekdays between two bars, flat at the close before, unless a frame lacks more than ``MAX_INSERTED``."""
    last = F.coalesce(F.date_sub(F.lead("d").over(w), 1), F.col("d"))
    grid = df.withColumn("_last", last).withColumn("_day", F.explode(F.sequence("d", "_last")))
    grid = grid.withColumn("_new", (F.col("_day") != F.col("d")).cast("int")).where("_new = 0 OR weekday(_day) < 5")
    flat = {c: F.col("close") for c in ("open", "high", "low")} | {"adj_close": F.lit(None).cast("double"), "volume": F.lit(0.0), "open_interest": F.lit(None).cast("double")}
    return grid.withColumn("_total", F.sum("_new").over(_whole())), {"d": F.col("_day")} | flat, repairs.MAX_INSERTED


@rule("RECT-EOD-007")
def _volume(df, w, config) -> Cells:
    bad = (F.col("volume") <= 0) | F.col("volume").isNull()
    median = F.percentile("volume", 0.5).over(w.rowsBetween(-2, 2))
    return {"volume": (bad & (median >= 0.5), F.when(bad, F.greatest(F.coalesce(F.floor(median + 0.5).cast("double"), F.lit(0.0)), F.lit(0.0))).otherwise(F.col("volume")))}


@rule("RECT-EOD-008", "flag")
def _stale(df, w, config):
    same = reduce(lambda a, b: a & b, [F.col(c) == F.lag(c).over(w) for c in PRICES])
    df = df.withColumn("_same", F.coalesce(same.cast("int"), F.lit(0)))
    df = df.withColumn("_run", F.sum(1 - F.col("_same")).over(w.rowsBetween(W.unboundedPreceding, 0)))
    return df.withColumn("_k", F.when(F.sum("_same").over(W.partitionBy(*KEYS, "_run")) >= 3, F.col("_same")).otherwise(0))


@rule("RECT-EOD-009")
def _far_returns(df, w, config):
    """Closes that move too far are cut to the previous, already cut, close: only runs of far returns are folded."""
    cap, before = repairs.CAP, F.lag("close").over(w)
    move = F.when(before > 0, F.col("close") / before - 1)
    df = df.withColumn("_dir", F.when(move > cap, 1).when(move < -cap, -1).otherwise(0))
    df = df.withColumn("_run", F.sum((F.col("_dir") == 0).cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0)))
    run = W.partitionBy(*KEYS, "_run").orderBy("d").rowsBetween(W.unboundedPreceding, 0)
    df = df.withColumn("_way", F.collect_list("_dir").over(run)).withColumn("_base", F.first("close").over(run))
    cut = F.aggregate("_way", F.col("_base"), lambda acc, x: F.when(x == 0, acc).otherwise(F.round(acc * (1 + x * F.lit(cap)), 2)))
    return df, {"close": (F.col("_dir") != 0, F.when(F.col("_dir") != 0, cut).otherwise(F.col("close")))}


@rule("RECT-EOD-011")
def _adjusted(df, w, config) -> Cells:
    return {"adj_close": (F.col("adj_close").isNull(), F.coalesce("adj_close", "close"))}


@rule("RECT-EOD-012")
def _interest(df, w, config) -> Cells:
    return {"open_interest": ((F.col("open_interest") < 0) | F.col("open_interest").isNull(), F.coalesce(F.abs("open_interest"), F.lit(0.0)))}


def _deviations(c: str) -> tuple[Column, Column, Column]:
    mean, sd = F.avg(c).over(_whole()), F.stddev_samp(c).over(_whole())
    return mean, sd, (F.col(c) - mean) / F.nullif(sd, F.lit(0.0))


@rule("RECT-EOD-014")
def _volume_tails(df, w, config) -> Cells:
    mean, sd, z = _deviations("volume")
    cut = F.when(z > 4, F.floor(mean + 4 * sd).cast("double")).when(z < -4, F.floor(F.greatest(F.lit(0.0), mean - 4 * sd)).cast("double")).otherwise(F.col("volume"))
    return {"volume": (F.abs(z) > 4, cut)}


@rule("RECT-EOD-015")
def _return_tails(df, w, config):
    """Returns beyond four deviations are cut to them; its confidence is below the least one unless a run says otherwise."""
    df = df.withColumn("_before", F.lag("close").over(w)).withColumn("_ret", F.col("close") / F.nullif("_before", F.lit(0.0)) - 1)
    mean, sd, z = _deviations("_ret")
    far = (F.abs(z) > 4) & (F.count("_ret").over(_whole()) >= 10)
    return df, {"close": (far, F.when(far, F.round(F.col("_before") * (1 + mean + F.signum(z) * 4 * sd), 2)).otherwise(F.col("close")))}


@rule("RECT-INT-002", "drop")
def _no_time(df, w, config):
    return F.col("ts").isNull()


@rule("RECT-INT-003", "drop")
def _repeated_times(df, w, config):
    return F.row_number().over(W.partitionBy(*KEYS, "ts").orderBy(*PRICES, "volume")) > 1


@rule("RECT-INT-010", "flag")
def _disordered(df, w, config):
    """Bars are sorted by every window; what is told is how many came before an earlier one."""
    return df.withColumn("_k", F.lit(0))


@rule("RECT-INT-007", "drop")
def _off_session(df, w, config):
    return ~F.col("hhmm").between(*SESSION)


@rule("RECT-INT-019", "drop")
def _weekends(df, w, config):
    return F.weekday("d") >= 5


@rule("RECT-INT-005")
def _inverted_minutes(df, w, config) -> Cells:
    bad, lo, hi = F.col("high") < F.col("low"), F.least("high", "low"), F.greatest("high", "low")
    known = F.col("close").isNotNull() & F.col("high").isNotNull() & F.col("low").isNotNull()
    close = F.when(known, F.greatest(lo, F.least(hi, "close"))).otherwise(F.col("close"))
    return {"high": (bad, F.when(bad, F.col("low")).otherwise(F.col("high"))), "low": (bad, F.when(bad, F.col("high")).otherwise(F.col("low"))), "close": (close != F.col("close"), close)}


@rule("RECT-INT-006")
def _negative_minutes(df, w, config) -> Cells:
    return {c: (F.col(c) < 0, F.abs(c)) for c in PRICES}


@rule("RECT-INT-004")
def _nulls_of_the_day(df, w, config) -> Cells:
    day = W.partitionBy(*KEYS, "d").orderBy("hhmm")
    return {c: (F.col(c).isNull(), F.coalesce(_filled(F.col(c), day), *([F.lit(0.0)] if c == "volume" else []))) for c in (*PRICES, "volume")}


@rule("RECT-INT-001", "insert")
def _missing_minutes(df, w, config):
    """Minutes up to the next bar or the session's end, flat at the close before, ``MAX_MINUTES`` a day."""
    day = W.partitionBy(*KEYS, "d").orderBy("hhmm")
    last = F.greatest("hhmm", F.coalesce(F.lead("hhmm").over(day), F.lit(SESSION[1])) - 1)
    grid = df.withColumn("_last", last).withColumn("_day", F.explode(F.sequence("hhmm", "_last"))).withColumn("_new", (F.col("_day") != F.col("hhmm")).cast("int"))
    so_far = F.sum("_new").over(W.partitionBy(*KEYS, "d").orderBy("_day").rowsBetween(W.unboundedPreceding, 0))
    grid = grid.withColumn("_so_far", so_far).where(f"_new = 0 OR _so_far <= {repairs.MAX_MINUTES}").drop("_so_far")
    flat = {c: F.col("close") for c in ("open", "high", "low")} | {"volume": F.lit(0.0)}
    return grid.withColumn("_total", F.sum("_new").over(_whole())), {"hhmm": F.col("_day")} | flat, None


@rule("RECT-INT-011")
def _volume_tails_of_minutes(df, w, config) -> Cells:
    mean, sd, z = _deviations("volume")
    cut = F.when(z > 4, F.least(F.col("volume"), F.floor(mean + 4 * sd).cast("double"))).when(z < -4, F.greatest(F.col("volume"), F.lit(0.0))).otherwise(F.col("volume"))
    return {"volume": (cut != F.col("volume"), cut)}


rule("RECT-EOD-024", "keys")(_trim)
rule("RECT-INT-020", "keys")(_trim)


def _logged(df: DataFrame, r: Rule, applied: Column, log: str = "log") -> DataFrame:
    """The log with an entry where the rule has ``_k`` cells; helper columns go."""
    entry = F.array(F.struct(F.lit(r.rule_id).alias("rule"), F.col("_k").cast("int").alias("cells"), applied.alias("applied")))
    df = df.withColumn(log, F.when(F.col("_k") > 0, F.concat(log, entry)).otherwise(F.col(log)))
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def applied(bars: DataFrame, timeframe: str, config: Config) -> DataFrame:
    """Bars after the rules, with ``inserted``, ``log``, and ``told``: what was dropped, the same for all rows of a frame."""
    at = "d" if timeframe == "EOD" else "hhmm"
    w = W.partitionBy(*KEYS).orderBy(*(["d"] if timeframe == "EOD" else ["d", "hhmm"]))
    df = bars.withColumn("inserted", F.lit(0)).withColumn("log", F.array().cast(ENTRY)).withColumn("told", F.array().cast(ENTRY))
    for r in chosen(timeframe, config):
        sure = config.confidence.get(r.rule_id, repairs.RULES[r.rule_id][1]) >= config.min_confidence
        few = lambda total: F.lit(sure) if config.max_changes is None else F.lit(sure) & (F.coalesce(total, F.lit(0)) <= config.max_changes)  # noqa: E731, B023
        if r.kind == "keys":  # keys are trimmed before frames are made of them
            df = _logged(r.make(df, w, config), r, F.lit(True)) if sure else df
        elif r.kind == "flag":
            df = _logged(r.make(df, w, config), r, F.lit(False))
        elif r.kind == "drop":
            df = df.withColumn("_drop", r.make(df, w, config).cast("int")).withColumn("_total", F.sum("_drop").over(_whole())).withColumn("_ok", few(F.col("_total")))
            df = _logged(df.where("NOT _ok OR _drop = 0").withColumn("_k", F.col("_total")), r, F.col("_ok"), "told")
        elif r.kind == "insert":
            grid, cells, most = r.make(df, w, config)
            ok = few(F.col("_total")) & (F.lit(True) if most is None else F.col("_total") <= most)
            grid = grid.withColumn("_ok", ok).withColumn("_first", F.row_number().over(_whole().orderBy("_new", at)) == 1).where("_new = 0 OR _ok")
            new = F.col("_new") == 1
            values = {c: F.when(new, x).otherwise(F.col(c)) for c, x in cells.items()}
            grid = grid.withColumns(values | {"inserted": F.when(new, 1).otherwise(F.col("inserted")), "log": F.when(new, F.array().cast(ENTRY)).otherwise(F.col("log"))})
            df = _logged(grid.withColumn("_k", F.when(F.col("_ok"), F.col("_new")).otherwise(F.when(F.col("_first"), F.col("_total")).otherwise(0))), r, F.col("_ok"))
        else:
            made = r.make(df, w, config)
            df, cells = made if isinstance(made, tuple) else (df, made)
            df = df.withColumns({f"_is_{c}": F.coalesce(changed.cast("int"), F.lit(0)) for c, (changed, _) in cells.items()} | {f"_to_{c}": new for c, (_, new) in cells.items()})
            df = df.withColumn("_k", reduce(lambda a, b: a + b, [F.col(f"_is_{c}") for c in cells]))
            df = df.withColumn("_ok", few(F.sum("_k").over(_whole()) if config.max_changes is not None else F.lit(0)))
            df = _logged(df.withColumns({c: F.when(F.col("_ok"), F.col(f"_to_{c}")).otherwise(F.col(c)) for c in cells}), r, F.col("_ok"))
    return df


def audit(done: DataFrame, timeframe: str, config: Config) -> DataFrame:
    """(keys, rule_id, priority, confidence, reason, action, changes, rows_modified) of each frame and rule that ran.

    ``action`` is FIXED, FLAGGED (measured, not applied) or UNCHANGED.
    """
    ran = [F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.priority).alias("priority"), F.lit(config.confidence.get(r.rule_id, repairs.RULES[r.rule_id][1])).alias("confidence"), F.lit(repairs.RULES[r.rule_id][2]).alias("reason")) for r in chosen(timeframe, config)]
    frames = done.groupBy(*KEYS).agg(F.count("*").alias("_n")).select(*KEYS, F.explode(F.array(*ran)).alias("r")).select(*KEYS, "r.*")
    dropped = done.groupBy(*KEYS).agg(F.first("told").alias("told")).select(*KEYS, F.explode("told").alias("e")).withColumn("rows", F.col("e.cells"))
    entries = done.select(*KEYS, F.explode("log").alias("e")).withColumn("rows", F.lit(1)).unionByName(dropped)
    notes = entries.groupBy(*KEYS, F.col("e.rule").alias("rule_id")).agg(F.sum("e.cells").alias("changes"), F.sum("rows").alias("rows_modified"), F.max("e.applied").alias("applied"))
    action = F.when(F.col("changes").isNull(), "UNCHANGED").when(F.col("applied"), "FIXED").otherwise("FLAGGED")
    out = frames.join(notes, [*KEYS, "rule_id"], "left").withColumn("action", action)
    return out.select(*KEYS, "rule_id", "priority", "confidence", "reason", "action", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("changes", "rows_modified")])


def run(bars: DataFrame, timeframe: str = "EOD", config: Config = Config(), path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(bars after the rules, audit); both written under ``path`` if it is given, but for a dry run."""
    done = applied(bars, timeframe, config)
    told = audit(done, timeframe, config)
    if path and not config.dry_run:
        done.drop("log", "told").write.mode("overwrite").partitionBy(*KEYS).parquet(f"{path}/bars")
        told.write.mode("overwrite").parquet(f"{path}/audit")
    return done, told


#: As many changes as there are: the plans of the comparison have no such limit.
WITHOUT_LIMIT = Config(max_changes=None)


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialect.query(f"WITH {DAILY.strip()} SELECT * FROM bars")(spark, sf_dir).drop("nr")


def _minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialect.query(f"WITH {MINUTE.strip()} SELECT *, hour(ts) * 60 + minute(ts) AS hhmm FROM minutes")(spark, sf_dir)


def executed_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = applied(_daily(spark, sf_dir), "EOD", WITHOUT_LIMIT)
    return done.select(*KEYS, "d", *[F.round(c, 4).alias(c) for c in (*PRICES, "adj_close")], F.round("volume", 2).alias("volume"), "open_interest", "inserted")


def executed_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = applied(_minutes(spark, sf_dir), "INTRADAY", WITHOUT_LIMIT)
    return done.select(*KEYS, "d", "hhmm", *PRICES, F.round("volume", 2).alias("volume"), "inserted")


def executed_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = applied(_daily(spark, sf_dir), "EOD", WITHOUT_LIMIT)
    return audit(done, "EOD", WITHOUT_LIMIT).where("action = 'FIXED'").drop("action")


_LATE = f"SELECT symbol, exchange, source, 'RECT-EOD-020' AS rule_id, {repairs.RULES['RECT-EOD-020'][0]} AS priority, cast({repairs.RULES['RECT-EOD-020'][1]} AS double) AS confidence, '{repairs.RULES['RECT-EOD-020'][2]}' AS reason, count(*) AS changes, count(*) AS rows_modified"
#: The comparison's audit is of changed rows; the rows it drops for their dates are counted beside it.
RULES_SQL = f"SELECT * FROM ({repairs.RULE_AUDIT}) x UNION ALL SELECT * FROM (WITH {DAILY.strip()} {_LATE} FROM bars WHERE d > DATE '{Config().as_of}' GROUP BY 1, 2, 3) y"
QUERIES = {"executed_bars": executed_bars, "executed_minutes": executed_minutes, "executed_rules": executed_rules}
SQL = {name: dialect.oracle(text) for name, text in {"executed_bars": repairs.EOD_REPAIRED, "executed_minutes": repairs.INTRADAY_REPAIRED, "executed_rules": RULES_SQL}.items()}
