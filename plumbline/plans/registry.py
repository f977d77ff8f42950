"""The check registry: every check with its metadata, and plans of only those that a run asks for.

A selection is made when the plan is composed: families without a chosen check aren't planned at all, and of the others
only the chosen figures are unpivoted, so Catalyst prunes what they alone need.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.plans import dialect, market
from plumbline.plans.checks import FIELD_CHECKS, INSTRUMENTS
from plumbline.plans.outcomes import PRODUCTS


@dataclass(frozen=True)
class Check:
    check_id: str
    layer: str
    gate: str
    severity: str
    weight: float
    #: The plan that computes it.
    family: str

    @property
    def mode(self) -> str:
        """EOD, Intraday or Both: which kind of bars a check looks at."""
        layer = self.layer.upper()
        return "Intraday" if layer in ("INTRADAY", "LIVE", "LIVE_INTEGRITY") else "EOD" if layer == "EOD" else "Both"


def _made() -> dict[str, Check]:
    of = {i: f.name for f in market.SCORED for i, *_ in f.rows}
    of |= {f"{layer[:3]}-{first + k:03d}": name for name, (layer, first) in market.FIELD_META.items() for k in range(18)}
    out = {}
    for check_id, meta in market.told():
        layer, gate, severity, weight = meta.rsplit(" ", 3)
        out.setdefault(check_id, Check(check_id, layer, gate, severity, float(weight), of[check_id]))
    return out


REGISTRY: dict[str, Check] = _made()


def chosen(ids: Iterable[str] | None = None, layer: str | None = None, mode: str | None = None, gate: str | None = None) -> list[Check]:
    """Checks in order of registration; layers in any case, ``mode`` EOD or Intraday takes those for both kinds too."""
    some = None if ids is None else set(ids)
    if some is not None and some - REGISTRY.keys():
        raise ValueError(f"no such checks: {sorted(some - REGISTRY.keys())}")
    if mode not in (None, "Both", "EOD", "Intraday") or gate not in (None, "Hard", "Soft"):
        raise ValueError("mode is EOD, Intraday or Both, gate Hard or Soft")
    return [
        c
        for c in REGISTRY.values()
        if (some is None or c.check_id in some) and (layer is None or c.layer.upper() == layer.upper()) and (mode in (None, "Both") or c.mode in ("Both", mode)) and (gate is None or c.gate == gate)
    ]


def plan(checks: list[Check]) -> str:
    """The text of one Spark plan for these checks: symbol, exchange, source, check_id, value, failed."""
    wanted = {c.check_id for c in checks}
    texts = []
    for f in market.SCORED:
        rows = tuple(r for r in f.rows if r[0] in wanted)
        if rows:
            texts.append((f.name, replace(f, rows=rows).text("spark"), ""))
    for name, text in FIELD_CHECKS.items():
        own = sorted(c.check_id for c in checks if c.family == name)
        if own:
            texts.append((name, text, " WHERE check_id IN (" + ", ".join(f"'{i}'" for i in own) + ")"))
    if not texts:
        return "SELECT '' AS symbol, '' AS exchange, '' AS source, '' AS check_id, 0e0 AS value, false AS failed WHERE false"
    return " UNION ALL ".join(f"SELECT symbol, exchange, source, check_id, value, failed FROM ({text}) {name}{where}" for name, text, where in texts)


def run(spark: SparkSession, sf_dir: str, products: Iterable[str] | None = None, **selection) -> DataFrame:
    """Results of the chosen checks with their metadata and status; ``products`` keeps symbols of these product classes."""
    checks = chosen(**selection)
    got = dialect.query(plan(checks))(spark, sf_dir)
    if products is not None:
        kinds = dialect.query(f"WITH {INSTRUMENTS.strip()} SELECT symbol, kind FROM instruments")(spark, sf_dir)
        kept = kinds.where(F.col("kind").isin([k for k, p in PRODUCTS.items() if p in set(products)]))
        got = got.join(F.broadcast(kept.select("symbol")), "symbol", "left_semi")
    meta = spark.createDataFrame([(c.check_id, c.layer, c.gate, c.severity, c.weight) for c in checks], "check_id string, layer string, gate string, severity string, weight double")
    status = F.when(F.col("value").isNull(), "Skip").when(F.col("failed"), "Fail").otherwise("Pass")
    return got.join(F.broadcast(meta), "check_id").select("symbol", "exchange", "source", "check_id", "layer", "gate", "severity", "weight", status.alias("status"), "value")


def hard_daily_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What blocks a run on daily bars: checks with a hard gate, of shares and funds."""
    return run(spark, sf_dir, products=["EQUITY", "ETF"], gate="Hard", mode="EOD")


QUERIES = {"hard_daily_checks": hard_daily_checks}
SQL = {
    "hard_daily_checks": dialect.oracle(f"""WITH {market.results("duckdb")}, {INSTRUMENTS.strip()}
        SELECT symbol, exchange, source, check_id, layer, gate, severity, cast(weight AS double) AS weight, CASE WHEN value IS NULL THEN 'Skip' WHEN failed THEN 'Fail' ELSE 'Pass' END AS status, value
        FROM results JOIN instruments USING (symbol) WHERE kind IN ('Equity', 'ETF') AND gate = 'Hard' AND upper(layer) NOT IN ('INTRADAY', 'LIVE', 'LIVE_INTEGRITY')""")
}
