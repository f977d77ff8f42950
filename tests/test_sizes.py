"""Plans whose windows and joins must not hold a whole frame, which grows with the input."""

import datetime as dt
import random
import re

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plumbline import catalogue
from plumbline.plans import dialect, market


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


def rows_of(df):
    return sorted(map(repr, map(tuple, df.select(sorted(df.columns)).collect())))


def wanted(name, folder, table):
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    con.sql(f"create view {table} as from '{folder}/{table}.parquet'")
    rel = con.sql(catalogue.SQL[name])
    return sorted(map(repr, rel.select(*sorted(rel.columns)).fetchall()))


def test_live_windows_are_by_block_or_hour(spark, sf):
    windows = [re.findall(r"\[([^\[\]]*)\]", line) for line in plan_of(catalogue.QUERIES["checks_live"](spark, sf)) if re.search(r"\bWindow \[", line)]
    over_ticks = [w[1] for w in windows if "close#" in w[0] or "row_number" in w[0] or "ret#" in w[0] or "begun#" in w[0] and "last_begun#" not in w[0]]
    assert len(over_ticks) >= 3 and all("block#" in w or "at_hour#" in w for w in over_ticks)


@pytest.mark.parametrize("block", [64, 61])
def test_live_blocks_give_the_figures_of_whole_frames(spark, tmp_path, block):
    """Runs of equal closes across several blocks, hours without ticks, equal times, nulls."""
    rng, now, close, rows = random.Random(block), dt.datetime(2024, 1, 2, 8, 58), 100.0, []
    for i in range(1500):
        now += dt.timedelta(seconds=rng.choice([0, 1, 7, 40]) if i % 400 else 9000)
        close = close if 300 < i < 700 else round(close * (1 + rng.gauss(0, 0.01)), 2)
        rows.append((i, now, rng.randrange(90), "ab"[rng.random() < 0.2], None if rng.random() < 0.01 else close, "{}"))
    pd.DataFrame(rows, columns=["event_id", "ts", "user_id", "event_type", "value", "props"]).astype({"ts": "datetime64[us]"}).to_parquet(tmp_path / "events.parquet", index=False)
    text = market.LIVE_CHECKS.text("spark").replace(str(market._BLOCK), str(block)).replace(str(market._BLOCK - market._BACK), str(block - market._BACK))
    assert rows_of(dialect.query(text)(spark, str(tmp_path))) == wanted("checks_live", tmp_path, "events")


def test_calls_and_puts_meet_by_strike(spark, tmp_path):
    """60,000 calls and puts of one strike and day: their pairs would be 900 million."""
    n = 60_000
    day = dt.date(1995, 3, 1)
    frame = pd.DataFrame({
        "l_orderkey": [30 * (i // 100) for i in range(n)], "l_linenumber": [i % 2 for i in range(n)], "l_linestatus": "O", "l_returnflag": "A", "l_shipdate": day,
        "l_extendedprice": [10_000.0 + i % 50 for i in range(n)], "l_tax": 0.02, "l_discount": [0.01 * (i % 9) for i in range(n)],
    })
    frame.to_parquet(tmp_path / "lineitem.parquet", index=False)
    df = catalogue.QUERIES["checks_derivatives"](spark, str(tmp_path))
    plan = plan_of(df)
    assert not any("Join" in line and "strike_price#" in line and re.search(r"\bd#", line) for line in plan)
    assert not any(re.search(r"\bWindow \[", line) and "step" not in line and "strike_price" not in line for line in plan)
    got = {r.check_id: r for r in df.collect()}
    assert got["DERIV-003"].value is not None and got["DERIV-004"].value == round(7 / 600, 4) and len(got) == 5  # 7 of 600 keys are multiples of 89


def test_all_results_have_the_bounded_plans(spark, sf):
    """The results that scorecards and outcomes share come from the same plans as the families' own queries."""
    plan = plan_of(dialect.query(f"WITH {market.results('spark')} SELECT * FROM results")(spark, sf))
    assert not any("Join" in line and "strike_price#" in line and re.search(r"\bd#", line) for line in plan)
    assert any(re.search(r"\bWindow \[", line) and "block#" in line for line in plan)


def test_daily_bars_without_sorting_all_rows(spark, sf):
    """The rows of the plain text, null keys and days of one order included; only rows of a day's ends reach the choice."""
    from plumbline.sources.bars import DAILY

    rows = spark.read.parquet(f"{sf}/lineitem.parquet")
    odd = rows.limit(200).withColumns({"l_orderkey": F.lit(None).cast("long"), "l_linestatus": F.lit(None).cast("string")}).unionByName(rows.limit(100).withColumn("l_orderkey", F.lit(7).cast("long")))
    table = rows.unionByName(odd)
    plain, quick = (spark.sql(dialect.render(f"WITH {text} SELECT * FROM bars", "spark"), lineitem=table) for text in (DAILY.strip(), dialect.BASES["daily_bars"][2]))
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, quick.collect()))
    below = [re.findall(r"(SortAggregate|BroadcastHashJoin|FileScan)", x._jdf.queryExecution().executedPlan().toString()) for x in (plain, quick)]
    sorts_a_scan = [("SortAggregate", "FileScan") in zip(x, x[1:]) for x in below]
    assert sorts_a_scan == [True, False]
