"""Live state against plans that see all ticks at once, for several cuts into batches, with restarts and late ticks."""

import datetime as dt
import os
import random
import time

import duckdb
import pandas as pd
import pytest

from plumbline.streaming import live, queries, state

START = dt.datetime(2024, 1, 2, 9, 0)


def ticks(seed=5, n=900):
    """Dense ticks of two feeds with halts, spikes, unchanged prices and volumes that jump."""
    rng, rows, now = random.Random(seed), [], START
    price = {"a": 100.0, "b": 200.0}
    for i in range(n):
        now += dt.timedelta(seconds=rng.choice([1, 5, 20]) if rng.random() < 0.97 else rng.choice([130, 290, 301, 700]))
        kind = rng.choice("ab")
        if i == n // 2:  # prices move to another level
            price = {k: v * 1.15 for k, v in price.items()}
        price[kind] = round(price[kind] * (1 + rng.gauss(0, 0.001)), 2) if rng.random() < 0.7 else price[kind]
        value = price[kind] * (1.3 if rng.random() < 0.01 else 1)
        rows.append((i, now + dt.timedelta(microseconds=rng.randrange(10**6)), 49 if rng.random() < 0.02 else rng.randrange(8), kind, round(value, 2), "{}"))
    return pd.DataFrame(rows, columns=["event_id", "ts", "user_id", "event_type", "value", "props"])


def laid(folder, frame, cuts, seed=1):
    """Files of a table, each later than the one before; ticks arrive up to four minutes out of order."""
    rng = random.Random(seed)
    os.makedirs(f"{folder}/events.parquet")
    arrival = frame.assign(at=[t + dt.timedelta(seconds=rng.random() * 240) for t in frame.ts]).sort_values("at").drop(columns="at")
    size = -(-len(arrival) // cuts)
    for i in range(cuts):
        path = f"{folder}/events.parquet/part-{i:03d}.parquet"
        part = arrival.iloc[i * size : (i + 1) * size].sample(frac=1, random_state=seed)
        part.astype({"ts": "datetime64[us]"}).to_parquet(path, index=False)
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))


def wanted(name, folder):
    con = duckdb.connect()
    con.sql(f"create view events as from '{folder}/events.parquet/*.parquet'")
    rel = con.sql(queries.SQL[name])
    return sorted(map(repr, rel.select(*sorted(rel.columns)).fetchall()))


def rows_of(df):
    return sorted(map(repr, map(tuple, df.select(sorted(df.columns)).collect())))


@pytest.fixture(scope="module")
def own(spark):
    session = state.with_rocks(spark)
    session.conf.set("spark.sql.shuffle.partitions", "2")
    return session


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_sql(spark, sf, name):
    con = duckdb.connect()
    con.sql(f"create view events as from '{sf}/events.parquet'")
    got = queries.QUERIES[name](spark, sf)
    rel = con.sql(queries.SQL[name])
    assert rows_of(got) == sorted(map(repr, rel.select(*sorted(got.columns)).fetchall())) and got.count() > 0


@pytest.mark.parametrize("cuts", [1, 4, 11])
@pytest.mark.parametrize(("name", "plan"), [("live_halts", state.halts), ("live_last_ticks", state.last_ticks)])
def test_any_cut_into_batches_gives_the_same(own, tmp_path, name, plan, cuts):
    frame = ticks()
    laid(tmp_path, frame, cuts, seed=cuts)
    got = queries.drained(plan(live.watermarked(queries.feed(own, str(tmp_path), 1))), name)
    want = wanted(name, tmp_path)
    assert rows_of(got) == want and len(want) > 50
    if name == "live_last_ticks":
        assert {"LT-004", "LT-006", "LT-011", "LT-016", "LT-018", "MICRO-002", "MICRO-003"} <= {r.check_id for r in got.collect()}
    else:
        assert {r.kind for r in got.collect()} == {"SILENT", "HALT", "RESUMED"}


def test_restart_goes_on_from_the_checkpoint(own, tmp_path):
    """Half of the files, a stop, the other half: nothing is told twice and nothing is lost."""
    frame = ticks(seed=9)
    laid(tmp_path / "all", frame, 6)
    os.makedirs(tmp_path / "in" / "events.parquet")
    names = sorted(os.listdir(tmp_path / "all" / "events.parquet"))
    for half in (names[:3], names[3:]):
        for x in half:
            os.rename(tmp_path / "all" / "events.parquet" / x, tmp_path / "in" / "events.parquet" / x)
        stream = state.last_ticks(live.watermarked(queries.feed(own, str(tmp_path / "in"), 1)))
        stream.writeStream.option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start().awaitTermination()
    assert rows_of(own.read.parquet(str(tmp_path / "out"))) == wanted("live_last_ticks", tmp_path / "in")


def until(query, check, seconds=60):
    end = time.time() + seconds
    while time.time() < end:
        if query.exception():
            raise query.exception()
        if check():
            return
        time.sleep(0.3)
    raise AssertionError(f"not seen within {seconds} s")


def sink(own, path, schema):
    return lambda: own.read.schema(schema).parquet(str(path)).collect() if os.path.isdir(path) else []


def test_a_silent_key_is_told_without_a_tick_and_after_a_restart(own, tmp_path):
    laid(tmp_path, ticks(n=20), 1)
    seen = sink(own, tmp_path / "out", state.HALTS)

    def start():
        stream = state.halts(live.watermarked(queries.feed(own, str(tmp_path))), clock="processing", silent_s=1, halt_s=25)
        return stream.writeStream.option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "at")).start()

    query = start()
    last = {k: v.event_id.iloc[-1] for k, v in ticks(n=20).groupby("event_type")}
    silent = lambda kind: {r.source for r in seen() if r.kind == kind and r.event_id == last[r.source]}
    until(query, lambda: silent("SILENT") == {"a", "b"})
    query.stop()
    assert not silent("HALT")
    query = start()  # no further file: the timer comes from the checkpoint
    until(query, lambda: silent("HALT") == {"a", "b"})
    query.stop()
    assert len([r for r in seen() if r.event_id == last[r.source]]) == 4


def test_breaker_survives_a_restart_and_expires(own, tmp_path):
    os.makedirs(tmp_path / "in")
    seen = sink(own, tmp_path / "out", state.ACTIONS)

    def put(name, rows):
        pd.DataFrame(rows, columns=["symbol", "source", "status", "gate"]).to_parquet(tmp_path / "in" / name, index=False)

    def start(ttl):
        stream = state.breaker(own.readStream.schema("symbol string, source string, status string, gate string").parquet(str(tmp_path / "in")), 3, ttl)
        return stream.writeStream.option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "at")).start()

    put("a.parquet", [("S", "x", "Fail", "Soft")] * 3 + [("S", "x", "Fail", "Hard"), ("S", "y", "Fail", "Hard")] + [("S", "y", "Pass", "Hard")] * 9)
    query = start(20_000)
    until(query, lambda: {(r.source, r.action) for r in seen()} == {("x", "QUARANTINE")})
    query.stop()
    put("b.parquet", [("S", "x", "Fail", "Hard")] * 3)
    query = start(20_000)
    until(query, lambda: len(seen()) >= 2)
    assert sorted((r.source, r.action) for r in seen()) == [("x", "FREEZE"), ("x", "QUARANTINE")]  # not told again
    until(query, lambda: ("x", "RELEASE") in {(r.source, r.action) for r in seen()})
    put("c.parquet", [("S", "x", "Fail", "Soft")] * 2)  # counts have lapsed, so these two don't trip it
    put("d.parquet", [("S", "y", "Fail", "Soft")] * 4)
    until(query, lambda: ("y", "QUARANTINE") in {(r.source, r.action) for r in seen()})
    query.stop()
    assert sorted((r.source, r.action) for r in seen()) == [("x", "FREEZE"), ("x", "QUARANTINE"), ("x", "RELEASE"), ("y", "QUARANTINE")]


def test_feeds_meet_within_the_range_and_state_is_dropped(own, tmp_path):
    frame = ticks(n=1200)
    laid(tmp_path, frame, 8)
    late = frame.iloc[[0]].assign(event_id=5000, event_type="a", value=1.0)  # hours behind the watermark
    path = f"{tmp_path}/events.parquet/part-999.parquet"
    late.astype({"ts": "datetime64[us]"}).to_parquet(path, index=False)
    os.utime(path, (1_700_000_999, 1_700_000_999))
    one, two = (queries.feed(own, str(tmp_path), 1).where(f"source = '{x}'") for x in "ab")
    query = live.feed_agreement(one, two).writeStream.option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = {(r.event, r.other_event) for r in own.read.parquet(str(tmp_path / "out")).collect()}
    rows = list(frame.itertuples())
    want = {(x.event_id, y.event_id) for x in rows if x.event_type == "a" for y in rows if y.event_type == "b" and abs((x.ts - y.ts).total_seconds()) <= 60 and abs(x.value / y.value - 1) > 0.003}
    assert got == want and len(want) > 500
    sizes = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(sizes) < 0.6 * len(frame) and sizes[-1] < 0.2 * len(frame)


def test_feeds_compare_ticks_near_each_other_only(own, tmp_path):
    """The feeds meet by symbol and stretch of time: of a symbol's long feeds no tick is compared with all others."""
    one, two = (live.watermarked(queries.feed(own, "/root/testdata/sf0.001")) for _ in "ab")
    plan = live.feed_agreement(one.where("source = 'click'"), two.where("source = 'view'"))._jdf.queryExecution().analyzed().toString()
    joined = next(line for line in plan.splitlines() if "Join Inner" in line)
    assert "stretch" in joined.partition("other_ts")[0]
    ends = [START + dt.timedelta(seconds=360 * i + x) for i in range(40) for x in (0, 0.000001, 59.999999, 60, 300, 359.999999)]
    frame = pd.DataFrame([(2 * i + k, t, 1, "ab"[k], 1.0 + k, "{}") for i, t in enumerate(ends) for k in (0, 1)], columns=["event_id", "ts", "user_id", "event_type", "value", "props"])
    laid(tmp_path, frame, 1)
    got = queries.drained(live.feed_agreement(*(queries.feed(own, str(tmp_path)).where(f"source = '{x}'") for x in "ab")), "edges").collect()
    want = sorted((x, y) for x, t in zip(range(0, 480, 2), ends) for y, u in zip(range(1, 480, 2), ends) if abs(t - u) <= dt.timedelta(seconds=60))
    assert sorted((r.event, r.other_event) for r in got) == want


class Handle:
    """State in a dict, for a processor without a stream."""

    def __init__(self):
        self.timers, self.kept = [], {}

    def listTimers(self):  # noqa: N802
        return self.timers

    def registerTimer(self, at):  # noqa: N802
        self.timers.append(at)

    def deleteTimer(self, at):  # noqa: N802
        self.timers = [t for t in self.timers if t != at]

    def getValueState(self, name, schema, ttl=None):  # noqa: N802
        return Value(self.kept, name)

    getListState = getMapState = getValueState  # noqa: N815


class Value:
    def __init__(self, kept, name):
        self.kept, self.name = kept, name

    def exists(self):
        return self.name in self.kept

    def get(self):
        return self.kept[self.name]

    def update(self, x):
        self.kept[self.name] = x

    put = update

    def clear(self):
        self.kept.pop(self.name, None)

    def updateValue(self, key, x):  # noqa: N802
        self.kept[self.name, key] = x

    def getValue(self, key):  # noqa: N802
        return self.kept[self.name, key]

    def removeKey(self, key):  # noqa: N802
        del self.kept[self.name, key]


class Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.ms


@pytest.mark.parametrize("processor", [state.Halts, state.LastTicks])
def test_a_keys_ticks_are_never_in_memory_at_once(processor):
    """20 days of 300,000 ticks in one batch: in memory are those that come together and those of an hour."""
    import tracemalloc

    import numpy as np

    n = 300_000
    us = 1_704_067_200_000_000 + np.random.default_rng(1).permutation(n) * 5_760_000
    chunks = (pd.DataFrame({"us": us[i : i + 10_000], "event_id": np.arange(i, i + 10_000), "close": 1.0 + i, "volume": 2.0, "open_interest": 3.0, "spread": 0.1}) for i in range(0, n, 10_000))
    handle, made = Handle(), processor()
    made.init(handle)
    tracemalloc.start()
    told = sum(map(len, made.handleInputRows(("E", "a"), chunks, Clock(0))))
    told += sum(map(len, made.handleExpiredTimer(("E", "a"), Clock(2_000_000_000_000), None)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert told > 0 and peak < 70_000_000  # of which 14 MB are the state itself, kept in a dict here
