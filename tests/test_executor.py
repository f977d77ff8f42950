"""The rule executor: the plans' comparison SQL runs in test_engine; here filters, limits and faults planted by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from plumbline.plans import executor
from plumbline.plans.executor import Config

BAR = "symbol string, exchange string, source string, d date, open double, high double, low double, close double, adj_close double, volume double, open_interest double"
DAY = dt.date(2024, 1, 1)


def frame(spark, closes, source="v", start=DAY, **cells):
    rows = []
    for i, c in enumerate(closes):
        row = dict(symbol="s", exchange="e", source=source, d=start + dt.timedelta(days=i + 2 * (i // 5)), open=c, high=c + 1, low=c - 1, close=c, adj_close=c, volume=100.0, open_interest=5.0)
        row |= {k: v[i] for k, v in cells.items() if v[i] != "same"}
        rows.append(tuple(row.values()))
    return spark.createDataFrame(rows, BAR)


def ran(bars, **config):
    config = Config(**{"as_of": "2030-01-01", "max_changes": None} | config)
    done, told = executor.run(bars, "EOD", config)
    return done.orderBy("source", "d").collect(), {(r.source, r.rule_id): (r.action, r.changes) for r in told.collect()}


def test_all_rules_are_registered_and_ordered():
    from plumbline.plans import repairs

    assert set(executor.REGISTRY) == set(repairs.RULES) and len(executor.REGISTRY) == 27
    for timeframe, n in (("EOD", 16), ("INTRADAY", 11)):
        got = executor.chosen(timeframe, Config())
        assert len(got) == n and [r.priority for r in got] == sorted(r.priority for r in got)
    with pytest.raises(ValueError):
        executor.chosen("EOD", Config(rules=frozenset({"RECT-EOD-999"})))


def test_filter_and_switch(spark):
    bars = frame(spark, [10.0] * 6, volume=["same", None, "same", "same", "same", "same"], open_interest=[-5.0, None, *["same"] * 4])
    rows, told = ran(bars, rules=frozenset({"RECT-EOD-012"}))
    assert {k[1] for k in told} == {"RECT-EOD-012"} and told["v", "RECT-EOD-012"] == ("FIXED", 2)
    assert [r.open_interest for r in rows] == [5.0, 0.0, 5.0, 5.0, 5.0, 5.0] and rows[1].volume is None
    rows, told = ran(bars, off=frozenset({"RECT-EOD-012"}))
    assert ("v", "RECT-EOD-012") not in told and rows[0].open_interest == -5.0 and rows[1].volume == 100.0


def test_low_confidence_is_measured_and_not_applied(spark):
    bars = frame(spark, [10.0] * 4, adj_close=[None, "same", "same", None])
    rows, told = ran(bars, min_confidence=0.9)
    assert told["v", "RECT-EOD-011"] == ("FLAGGED", 2) and [r.adj_close for r in rows] == [None, 10.0, 10.0, None]
    rows, told = ran(bars, min_confidence=0.9, confidence={"RECT-EOD-011": 0.95})
    assert told["v", "RECT-EOD-011"] == ("FIXED", 2) and all(r.adj_close == 10.0 for r in rows)


def test_too_many_changes_flag_the_frame_only(spark):
    few, many = frame(spark, [10.0] * 8, "few", volume=[None, *["same"] * 7]), frame(spark, [10.0] * 8, "many", volume=[None] * 3 + ["same"] * 5)
    rows, told = ran(few.union(many), max_changes=2, rules=frozenset({"RECT-EOD-001"}))
    assert told["few", "RECT-EOD-001"] == ("FIXED", 1) and told["many", "RECT-EOD-001"] == ("FLAGGED", 3)
    assert [r.volume for r in rows if r.source == "few"][0] == 0.0 and [r.volume for r in rows if r.source == "many"][:3] == [None] * 3


def test_dropped_and_inserted_rows_are_measured_first(spark):
    bars = frame(spark, [10.0] * 6).union(frame(spark, [9.0] * 6)).union(frame(spark, [7.0, 7.0], start=dt.date(2031, 1, 1))).where(F.col("d") != dt.date(2024, 1, 3))
    rows, told = ran(bars)
    assert told["v", "RECT-EOD-003"] == ("FIXED", 5) and told["v", "RECT-EOD-020"] == ("FIXED", 2) and told["v", "RECT-EOD-002"] == ("FIXED", 1)
    assert len(rows) == 6 and [r.close for r in rows] == [9.0] * 6 and [r.inserted for r in rows] == [0, 0, 1, 0, 0, 0]
    rows, told = ran(bars, max_changes=1)
    assert told["v", "RECT-EOD-003"] == ("FLAGGED", 5) and told["v", "RECT-EOD-020"] == ("FLAGGED", 2) and len(rows) > 10


def test_far_returns_fold_from_the_cut_close(spark):
    closes = [100.0, 150.0, 300.0, 290.0, 100.0, 101.0, 200.0]
    want, last = [], None
    for i, c in enumerate(closes):
        way = 0 if not i else (1 if c / closes[i - 1] - 1 > 0.2 else -1 if c / closes[i - 1] - 1 < -0.2 else 0)
        last = round(last * (1 + way * 0.2), 2) if way else c
        want.append(last)
    rows, told = ran(frame(spark, closes), rules=frozenset({"RECT-EOD-009"}))
    assert [r.close for r in rows] == want and told["v", "RECT-EOD-009"] == ("FIXED", 4)


def test_dry_run_writes_nothing(spark, tmp_path):
    bars = frame(spark, [10.0] * 3, volume=[None] * 3)
    executor.run(bars, "EOD", Config(dry_run=True, as_of="2030-01-01"), str(tmp_path / "a"))
    assert not (tmp_path / "a").exists()
    executor.run(bars, "EOD", Config(as_of="2030-01-01"), str(tmp_path / "b"))
    assert spark.read.parquet(str(tmp_path / "b" / "bars")).count() == 3 and spark.read.parquet(str(tmp_path / "b" / "audit")).where("action = 'FIXED'").count() >= 1


def test_empty_and_null_frames(spark):
    rows, told = ran(frame(spark, [1.0]).limit(0))
    assert rows == [] and told == {}
    rows, told = ran(frame(spark, [1.0] * 3, **{c: [None] * 3 for c in ("open", "high", "low", "close", "adj_close", "volume", "open_interest")}))
    assert len(rows) == 3 and rows[0].close is None and rows[0].volume == 0.0
