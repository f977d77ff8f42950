"""Statuses, scopes and totals on a grid written by hand."""

from pyspark.sql import functions as F

from plumbline import catalogue
from plumbline.functions import semantics as sem
from plumbline.plans import outcomes

RESULT = "symbol string, exchange string, source string, check_id string, value double, failed boolean"
EXPECTED = [("EOD", "N", "a"), ("EOD", "N", "b"), ("INTRADAY", "N", "a")]
SPECS = [("E1", "EOD", "Hard", "High", 4.0), ("GOV-003", "EOD", "Soft", "Low", 2.0), ("I1", "INTRADAY", "Soft", "Low", 1.0), ("X1", "Cross_Source", "Soft", "Low", 3.0), ("L1", "Live", "Hard", "High", 5.0)]


def grid(spark, results):
    present = spark.createDataFrame([("S", "N", "a", "EOD"), ("S", "N", "a", "EOD"), ("T", "N", "b", "EOD"), ("T", "N", "a", "INTRADAY")], "symbol string, exchange string, source string, timeframe string")
    kinds = spark.createDataFrame([("S", "ETF")], "symbol string, kind string")
    return outcomes.outcomes(spark.createDataFrame(results, RESULT), present, spark.createDataFrame(SPECS, outcomes.SPEC), EXPECTED, kinds)


def test_statuses_and_scores(spark):
    results = [
        ("S", "N", "a", "E1", 0.0, False), ("S", "N", "a", "GOV-003", 9.0, True), ("T", "N", "b", "E1", None, False), ("T", "N", "a", "I1", 1.0, True),
        ("S", "N", "a-b", "X1", 0.0, False), ("S", "N", "b-c", "X1", 1.0, True), ("Z", "N", "a", "E1", 0.0, False),
    ]
    rows = {(r.symbol, r.timeframe, r.source, r.check_id): r for r in grid(spark, results).collect()}
    assert len(rows) == 2 * (2 * 2 + 1 + 2)  # Z is not expected
    got = {k: (r.status, r.weighted_score, r.cause) for k, r in rows.items()}
    assert got["S", "EOD", "a", "E1"] == ("Pass", 4.0, "OK")
    assert got["S", "EOD", "a", "GOV-003"] == ("Fail", 0.0, "DATA_STALE")
    assert got["S", "EOD", "b", "E1"] == ("Data_Not_Present", 0.0, "DATA_MISSING")
    assert got["S", "INTRADAY", "a", "I1"] == ("Data_Not_Present", 0.0, "DATA_MISSING")
    assert got["T", "EOD", "b", "E1"] == ("Skip", 0.0, "OK")
    assert got["T", "EOD", "b", "GOV-003"] == ("Redo_As_Results_Unclear", 1.0, "DATA_STALE")
    assert got["T", "INTRADAY", "a", "I1"] == ("Fail", 0.0, "DATA_QUALITY")
    assert got["S", "Both", "cross", "X1"] == ("Fail", 0.0, "DATA_QUALITY")  # one of two pairs of sources
    assert got["T", "Both", "cross", "X1"] == ("Redo_As_Results_Unclear", 1.5, "DATA_QUALITY")
    assert got["S", "Both", "cross", "L1"] == ("Skip", 0.0, "OK")
    assert rows["S", "EOD", "b", "E1"].details == "Data not available: source=b exchange=N timeframe=EOD"
    assert rows["S", "EOD", "a", "E1"].product_class == "ETF" and rows["T", "EOD", "b", "E1"].product_class == "EQUITY" and rows["S", "Both", "cross", "X1"].product_class == ""


def test_totals_count_cross_rows_once(spark):
    results = [("S", "N", "a", "E1", 0.0, False), ("S", "N", "a-b", "X1", 1.0, True)]
    out = {(r.symbol, r.product_class): r for r in outcomes.totals(grid(spark, results)).collect()}
    assert set(out) == {("S", "ETF"), ("T", "EQUITY"), ("TOTAL", "")}
    s, total = out["S", "ETF"], out["TOTAL", ""]
    assert (s.checks, s.passed, s.failed, s.redo, s.absent, s.skipped) == (5, 1, 0, 1, 3, 0) and s.pass_rate == 1.0
    assert s.weighted_rate == round((4 + 1) / (4 + 2 + 4 + 2 + 1), 6)
    assert total.checks == 14 and total.failed == 1 and total.pass_rate == 0.5 and total.skipped == 2
    assert out["T", "EQUITY"].pass_rate is None


def test_no_results(spark):
    rows = grid(spark, []).groupBy("status").count().collect()
    assert {r.status: r["count"] for r in rows} == {"Data_Not_Present": 5, "Redo_As_Results_Unclear": 7, "Skip": 2}


def test_absent_frames_and_causes_of_the_tables(spark):
    rows = catalogue.QUERIES["outcomes"](spark, "/root/testdata/sf0.001")
    by = {r.status: r["count"] for r in rows.groupBy("status").count().collect()}
    assert set(by) == {"Pass", "Fail", "Skip", "Redo_As_Results_Unclear", "Data_Not_Present"}
    assert rows.where("status = 'Data_Not_Present' AND symbol = 'E' AND timeframe = 'EOD'").count() > 0
    assert rows.groupBy("symbol", "exchange", "source", "timeframe", "check_id").count().where("count > 1").count() == 0
    assert {"DATA_MISSING", "DATA_STALE", "DATA_QUALITY", "OK"} <= {r.cause for r in rows.select("cause").distinct().collect()}


def test_causes_by_words(spark):
    cases = [("A", "no data here", "DATA_QUALITY", "DATA_MISSING"), ("A", "missing instruments.yaml", "CONFIG_MISMATCH", "CONFIG_MISMATCH"), ("A", "instrumentsXyaml", "DATA_QUALITY", "DATA_QUALITY"), ("A", "RUNTIME_ERROR: x", "DATA_QUALITY", "RUNTIME_ERROR"), ("bst-005", "", "DATA_STALE", "DATA_STALE")]
    df = spark.createDataFrame(cases, "id string, details string, report string, run string").withColumn("status", F.lit("Fail"))
    of = lambda words: sem.root_cause(F.col("id"), F.col("status"), F.col("details"), words)
    assert df.where((of(sem.REPORT_CAUSES) != F.col("report")) | (of(sem.RUN_CAUSES) != F.col("run"))).count() == 0
