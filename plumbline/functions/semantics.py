"""Column helpers for the semantics on which results depend: missing values, ratios, returns, runs."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Spellings of a missing cell.
NULL_TOKENS = ["", "NA", "N/A", "null", "NULL", "None", "none", "-", "--", "#N/A", "nan", "NaN"]


def cleaned(c: Column) -> Column:
    """A trimmed string with missing-value spellings as null."""
    return F.when(~F.trim(c).isin(NULL_TOKENS), F.trim(c))


def number(c: Column) -> Column:
    """A double; what doesn't parse, and NaN, is null."""
    x = c.try_cast("double")
    return F.when(~F.isnan(x), x)


def ratio(a: Column, b: Column) -> Column:
    """a / b; division by zero is infinite with a's sign, 0 / 0 null."""
    inf = F.lit(float("inf"))
    return F.when(b == 0, F.when(a > 0, inf).when(a < 0, -inf)).otherwise(a / F.nullif(b, F.lit(0)))


def share(cond: Column) -> Column:
    """Share of all rows that meet a condition; null counts as not met and stays in the denominator."""
    return F.avg(F.coalesce(cond, F.lit(False)).cast("double"))


def frame(*keys: str, order: tuple[str, ...] = ("d",)) -> WindowSpec:
    return W.partitionBy(*keys).orderBy(*order)


def padded_return(c: Column, w: WindowSpec) -> Column:
    """Return against the last known value: gaps are filled forward first, so a gap's row returns 0."""
    pad = F.last(c, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0))
    before = F.last(c, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, -1))
    return ratio(pad, before) - 1


def plain_return(c: Column, w: WindowSpec) -> Column:
    return ratio(c, F.lag(c).over(w)) - 1


def starts_run(c: Column, w: WindowSpec) -> Column:
    """1 where a value differs from the one before; null differs from everything, itself included."""
    return F.when(c == F.lag(c).over(w), 0).otherwise(1)


def off_grid(c: Column, step: Column) -> Column:
    """The remainder of c by step with the step's sign, as a share of the step."""
    return F.pmod(c, step) / step


#: Outcomes, and the check ids that stand for two of them.
STALE_CHECKS = ["BST-005", "GOV-003", "BT-008"]
ARTIFACT_CHECKS = ["EOD-018", "BT-023", "INT-011", "EOD-014"]


#: Words in a result's details that tell its cause: of a run's summary, and of the report, which has no runtime errors.
RUN_CAUSES = {"missing": ["data_not_present", "file not found", "no data"], "config": ["tbd", "not configured", r"instruments\.yaml"], "runtime": ["runtime_error"]}
REPORT_CAUSES = {"missing": ["data_not_present", "file not found"], "config": ["tbd", "not configured", r"instruments\.yaml"], "runtime": []}


def root_cause(check_id: Column, status: Column, details: Column, words: dict[str, list[str]] = REPORT_CAUSES) -> Column:
    """The outcome of a result; the first rule that holds decides. A run's summary tells failures only, so that anything else is DATA_QUALITY."""
    has = lambda some: F.lower(F.coalesce(details, F.lit(""))).rlike("|".join(some)) if some else F.lit(False)
    rules = [
        (has(words["missing"]), "DATA_MISSING"),
        (has(["stale"]) | F.upper(check_id).isin(STALE_CHECKS), "DATA_STALE"),
        (F.upper(check_id).isin(ARTIFACT_CHECKS), "SYNTHETIC_ARTIFACT"),
        (has(words["config"]), "CONFIG_MISMATCH"),
        (has(words["runtime"]), "RUNTIME_ERROR"),
        (F.lit(True) if words is RUN_CAUSES else status == "Fail", "DATA_QUALITY"),
    ]
    return F.coalesce(*[F.when(F.coalesce(c, F.lit(False)), F.lit(x)) for c, x in rules], F.lit("OK"))


def result_score(status: Column, weight: Column) -> Column:
    """A pass earns the weight, a redo half of it, anything else nothing."""
    return F.when(status == "Pass", weight.cast("double")).when(status == "Redo", 0.5 * weight).otherwise(0.0)
