import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from plumbline import catalogue
from plumbline.functions import semantics as sem
from plumbline.operators import bars as ops
from plumbline.plans import checks, dialect, market, repairs
from plumbline.sources import vendor_csv
from plumbline.streaming import live

SMALL = sorted(set(catalogue.QUERIES) - set(market.SCORECARDS)) + ["market_scorecard", "top_failures"]


def plain(rows):
    def v(x):
        return round(x, 6) + 0.0 if isinstance(x, float) and x == x else (x.isoformat() if hasattr(x, "isoformat") else x)

    return sorted((tuple(v(x) for x in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", SMALL)
def test_plan_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for t in dialect.TABLES:
        con.sql(f"create view {t} as from '{sf}/{t}.parquet'")
    got, want = catalogue.QUERIES[name](spark, sf), con.sql(catalogue.SQL[name])
    order = sorted(got.columns)
    assert order == sorted(want.columns)
    assert plain(got.select(order).collect()) == plain(want.select(*order).fetchall())


def test_every_check_id_once_per_family():
    for f in (*checks.FAMILIES, *market.FAMILIES):
        ids = [i for i, *_ in f.rows]
        assert len(ids) == len(set(ids)) and all(len(m.split()) >= 4 for _, m, _, _ in f.rows)


def test_entry_without_llm(spark):
    assert set(catalogue.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_semantics(spark):
    df = spark.createDataFrame([(1, 100.0), (2, None), (3, 130.0), (4, 0.0)], "d int, x double").withColumn("k", F.lit(1))
    w = sem.frame("k")
    got = df.select("d", sem.padded_return(F.col("x"), w).alias("p"), sem.plain_return(F.col("x"), w).alias("q")).orderBy("d").collect()
    assert [r.p for r in got][:1] == [None] and got[1].p == 0 and abs(got[2].p - 0.3) < 1e-12 and got[2].q is None
    r = spark.sql("select 1d a, 0d b").select(sem.ratio(F.col("a"), F.col("b")).alias("r"), sem.ratio(F.col("b"), F.col("b")).alias("z")).first()
    assert r.r == float("inf") and r.z is None
    assert spark.sql("select explode(array(1d, null)) x").agg(sem.share(F.col("x") > 0.5).alias("s")).first().s == 0.5


def test_vendor_files(spark, tmp_path):
    p = tmp_path / "EOD" / "Dhan" / "NSE" / "EQUITY"
    p.mkdir(parents=True)
    (p / "ABC.csv").write_text(" Date ,Open,HIGH,low,close\n01-02-2024,1,2,0.5,1.5\n2024-02-02,x,2,NaN,1\nbad,1,1,1,1\n01-02-2024,9,9,9,9\n")
    df = vendor_csv.read_bars(spark, str(tmp_path))
    rows = vendor_csv.deduplicated(df).orderBy("ts").collect()
    assert len(rows) == 2 and rows[0].open == 1 and rows[0].adj_close == 1.5 and rows[1].open is None and rows[1].low is None and rows[0].volume == 0
    assert (rows[0].symbol, rows[0].source, rows[0].exchange, rows[0].timeframe) == ("ABC", "dhan", "NSE", "eod")
    status = {r.name: r.status for r in vendor_csv.prevalidate(df).collect()}
    assert status["duplicates"] == "WARN" and status["nulls"] == "WARN" and status["rows"] == "OK"
    vendor_csv.write_bars(df, str(tmp_path / "out"), "r1")
    rec = spark.createDataFrame([("r1", 3)], "run_id string, n int")
    for _ in range(2):
        vendor_csv.append_run(spark, rec, str(tmp_path / "runs"))
    assert spark.read.parquet(str(tmp_path / "runs")).count() == 1


def test_capped_returns_follow_the_capped_close(spark):
    """RECT-EOD-009 on a table: each far close is cut to the previous, already cut, one."""
    rows = [(1, 100.0, 0), (2, 150.0, 1), (3, 300.0, 1), (4, 290.0, 0), (5, 100.0, -1), (6, 101.0, 0)]
    df = spark.createDataFrame([("s", "e", "v", d, c, c, c, c, None, 1.0, 1.0, 0, "", k) for d, c, k in rows], "symbol string, exchange string, source string, d int, open double, high double, low double, close double, adj_close double, volume double, open_interest double, inserted int, log string, dir int")
    got = [r.close for r in spark.sql(dialect.render("@CAPPED({t}, 0.2)", "spark"), t=df).orderBy("d").collect()]
    assert got == [100.0, 120.0, 144.0, 290.0, 232.0, 101.0]


def test_repaired_frames_against_a_plain_loop(spark, sf):
    """The chain's caps over real frames, row by row in Python from the step before."""
    text = repairs.EOD_REPAIRED[: repairs.EOD_REPAIRED.index("r009 AS")].rstrip().rstrip(",")
    rows = dialect.query(text + " SELECT symbol, exchange, source, d, close, dir FROM way")(spark, sf).collect()
    want, last = {}, {}
    for r in sorted(rows, key=lambda r: (r.symbol, r.exchange, r.source, r.d)):
        key = (r.symbol, r.exchange, r.source)
        last[key] = round(last[key] * (1 + r.dir * repairs.CAP), 2) if r.dir and key in last else r.close
        want[(*key, r.d)] = last[key]
    got = {(r.symbol, r.exchange, r.source, r.d): r.close for r in catalogue.QUERIES["repair_eod"](spark, sf).collect()}
    assert got.keys() == want.keys() and sum(r.dir != 0 for r in rows) > 100
    assert all(abs(got[k] - want[k]) < 1e-6 for k in got)


def test_missing_weekdays_are_inserted_flat(spark):
    import datetime as dt

    rows = [("s", "e", "v", dt.date(2024, 1, d), *(x,) * 5, 10.0, 1.0) for d, x in ((1, 10.0), (4, 11.0), (8, 11.5))]  # a Monday, the Thursday after, the next Monday
    df = spark.createDataFrame(rows, "symbol string, exchange string, source string, d date, open double, high double, low double, close double, adj_close double, volume double, open_interest double")
    text = "WITH " + repairs.eod_chain("2024-12-31", base="bars AS (SELECT * FROM {t})") + " SELECT day(d) AS d, close, inserted, log FROM repaired ORDER BY d"
    got = [tuple(r) for r in spark.sql(dialect.render(text, "spark"), t=df).collect()]
    assert [r[:3] for r in got] == [(1, 10.0, 0), (2, 10.0, 1), (3, 10.0, 1), (4, 11.0, 0), (5, 11.0, 1), (8, 11.5, 0)]
    assert all(("RECT-EOD-002" in r[3]) == bool(r[2]) for r in got)


def test_rule_audit_counts_cells(spark):
    rules = catalogue.QUERIES["repair_rules"](spark, "/root/testdata/sf0.01").collect()
    assert {"RECT-EOD-001", "RECT-EOD-005", "RECT-EOD-004", "RECT-EOD-009", "RECT-EOD-011", "RECT-EOD-012"} <= {r.rule_id for r in rules}
    assert all(r.changes >= r.rows_modified > 0 and r.confidence >= repairs.MIN_CONFIDENCE for r in rules)


#: Checks whose planted faults are in some frames and not in others.
BOTH_WAYS = ["BT-001", "BT-002", "SRC-E014", "SYM-004", "SYM-005", "SYM-006", "TF-002", "BT-011", "EOD-046", "SYM-002", "RD-002", "INST-003", "INST-004", "INST-005", "INST-006", "INST-007", "INST-008", "INST-010", "INST-011", "INST-012"]


def test_checks_pass_and_fail(spark):
    """Every check of the stored results is there; those with planted faults fail in some frames and pass in others."""
    rows = catalogue.QUERIES["check_results"](spark, "/root/testdata/sf0.01").collect()
    by = {}
    for r in rows:
        by.setdefault(r.check_id, set()).add(r.status)
    assert len(by) >= 230
    assert all({"Pass", "Fail"} <= by[i] for i in BOTH_WAYS), [i for i in BOTH_WAYS if not {"Pass", "Fail"} <= by[i]]
    assert by["LT-019"] == {"Skip"} and "Skip" in by["EOD-046"]


def test_clock_drift(spark, sf):
    for drift, failed in ((1500, True), (-2000, True), (20, False)):
        rows = [r for r in dialect.query(market.live_checks(drift).text("spark"))(spark, sf).collect() if r.check_id == "LT-019"]
        assert rows and all(r.failed is failed and r.value == drift for r in rows)


def test_anova_tail(spark):
    """The finite form of the tail against a numeric integral of the F density."""
    import math

    def tail(f, d1, d2, steps=200_000, top=2_000.0):
        c = math.exp(math.lgamma((d1 + d2) / 2) - math.lgamma(d1 / 2) - math.lgamma(d2 / 2) + d1 / 2 * math.log(d1 / d2))
        # substitution u = 1 / (1 + x) keeps the range finite
        total, lo, hi = 0.0, 0.0, 1 / (1 + f)
        for i in range(steps):
            u = (i + 0.5) * hi / steps
            x = 1 / u - 1
            total += c * x ** (d1 / 2 - 1) * (1 + d1 * x / d2) ** (-(d1 + d2) / 2) / (u * u)
        return total * hi / steps

    for d1, f in ((2, 1.7), (4, 2.9)):
        d2 = 57
        x, b = d2 / (d2 + d1 * f), d2 / 2
        want = x**b if d1 == 2 else x**b * (1 + b * (1 - x))
        assert abs(tail(f, d1, d2) - want) < 1e-4


def test_root_causes_and_null_tokens(spark):
    rows = [("EOD-001", "Fail", "Data_Not_Present"), ("GOV-003", "Pass", ""), ("EOD-002", "Fail", "stale since"), ("INT-011", "Fail", None), ("SYM-002", "Fail", "isin TBD"), ("EOD-005", "Fail", "3 rows"), ("EOD-005", "Pass", None)]
    df = spark.createDataFrame(rows, "id string, status string, details string")
    got = [r[0] for r in df.select(sem.root_cause(F.col("id"), F.col("status"), F.col("details"))).collect()]
    assert got == ["DATA_MISSING", "DATA_STALE", "DATA_STALE", "SYNTHETIC_ARTIFACT", "CONFIG_MISMATCH", "DATA_QUALITY", "OK"]
    cells = spark.createDataFrame([(x,) for x in ["--", "#N/A", " NA ", "1.5", "na"]], "x string")
    assert [r[0] for r in cells.select(sem.cleaned(F.col("x"))).collect()] == [None, None, None, "1.5", "na"]


def test_operators(spark):
    df = spark.sql("select 'a' k, date_add(date'2024-01-01', cast(id as int)) d, cast(id div 3 as double) v from range(10) where id <> 3")
    assert [str(r.d) for r in ops.missing_weekdays(df, ["k"]).collect()] == ["2024-01-04"]
    assert sorted(r.length for r in ops.runs(df, ["k"], "v").collect()) == [1, 2, 3, 3]
    left, right = spark.sql("select 'a' k, explode(array(1, 5, 9)) t"), spark.sql("select 'a' k, explode(array(2, 5)) t").withColumn("x", F.col("t") * 10)
    assert {r.t: r.x for r in ops.as_of(left, right, ["k"], "t", ["x"]).collect()} == {1: None, 5: 50, 9: 50}


def test_streams(spark, tmp_path):
    ticks = spark.sql("select 'E' symbol, if(id % 2 = 0, 'a', 'b') source, id event_id, timestamp'2024-01-01 09:20:00' + make_interval(0,0,0,0,0,0,id * 20) ts, double(100 + id) close from range(60)")
    ticks.unionByName(ticks.limit(5)).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = live.watermarked(spark.readStream.schema(ticks.schema).parquet(str(tmp_path / "in")))
    for name, df, mode in (("bars", live.minute_bars(live.deduplicated(stream)), "append"), ("sess", live.sessions(stream), "append")):
        q = df.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).start()
        q.processAllAvailable()
        q.stop()
    bars = spark.table("bars")
    assert bars.count() > 10 and bars.agg(F.max("ticks")).first()[0] <= 3
