"""Calendars, views, zones and measures against plain Python."""

import datetime as dt
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from plumbline.operators import bars as ops
from plumbline.operators import calendar, queries, views


def test_calendar_by_exchange(spark, tmp_path):
    path = tmp_path / "days.csv"
    path.write_text("Exchange, Date ,Open\nnse,2024-01-22,\nNSE,26-01-2024,no\nNSE,20/01/2024,yes\nBSE,2024-01-26,\nBSE,bad,\nNSE,2024-01-26,\n")
    closed = calendar.closed_days(spark, str(path))
    assert closed.count() == 4
    day = lambda n: dt.date(2024, 1, n)
    own = {("N", "NSE", "a"): [15, 16, 18, 20, 22, 27], ("N", "BSE", "a"): [19, 22, 25], ("M", "NSE", "b"): [26]}
    bars = spark.createDataFrame([(*k, day(n)) for k, v in own.items() for n in [*v, v[0]]] + [("Z", "NSE", "a", None)], "symbol string, exchange string, source string, d date")
    days = calendar.calendar(calendar.spans(bars), closed)

    def trades(exchange, d):
        if exchange == "NSE" and d in (day(22), day(26)) or exchange == "BSE" and d == day(26):
            return False
        return d.weekday() < 5 or (exchange == "NSE" and d == day(20))

    want, gone, more = {}, set(), set()
    for k, v in own.items():
        due = [day(n) for n in range(min(v), max(v) + 1) if trades(k[1], day(n))]
        have = {day(n) for n in v}
        gone |= {(*k, d) for d in due if d not in have}
        more |= {(*k, d) for d in have if not trades(k[1], d)}
        want[k] = (len(due), len(have & set(due)), len(set(due) - have), len([d for d in have if not trades(k[1], d)]))
    assert {tuple(r)[:3]: tuple(r)[3:] for r in calendar.counted(bars, days).collect()} == want
    assert {tuple(r) for r in calendar.missing_days(bars, days).collect()} == gone and gone
    assert {tuple(r) for r in calendar.extra_days(bars, days).collect()} == more and more
    assert calendar.counted(bars.limit(0), days).collect() == []


def test_viewport_keeps_the_extremes(spark):
    rows = [("k", i, float((i * 7919) % 1009) - 300) for i in range(5000)] + [("k", 10_000, 9e9), ("k", None, 1.0), ("k", 5, None), ("j", 20_000, 1.0)]
    df = spark.createDataFrame(rows, "k string, at long, x double")
    got = views.viewport(df, ["k"], "at", "x", 0, 4999, 97).collect()
    inside = [(a, x) for k, a, x in rows if k == "k" and a is not None and a <= 4999 and x is not None]
    assert len(got) == 97 and sum(r.rows for r in got) == len(inside) and {r.k for r in got} == {"k"}
    assert max(r.high for r in got) == max(x for _, x in inside) and min(r.low for r in got) == min(x for _, x in inside)
    for r in got:
        own = sorted((a, x) for a, x in inside if min(a * 97 // 4999, 96) == r.pixel)
        assert (r.first, r.last, r.low, r.high) == (own[0][1], own[-1][1], min(x for _, x in own), max(x for _, x in own))
    with pytest.raises(ValueError):
        views.viewport(df, ["k"], "at", "x", 5, 5, 10)


def test_axis_of_a_narrow_view_is_of_all_rows(spark):
    df = spark.createDataFrame([("k", i, 1.0 + i, 2.0 + i, 10.0 * i) for i in range(9)], "k string, at long, low double, high double, volume double")
    assert tuple(views.axis_ranges(df, ["k"], "at", 2, 4).first()) == ("k", 3, 3.0, 6.0, 40.0)
    assert tuple(views.axis_ranges(df, ["k"], "at", 8, 99).first()) == ("k", 1, 1.0, 10.0, 80.0)


def test_zones(spark):
    """Offsets, absent and double local times of a zone with summer time, against zoneinfo."""
    zone = "Europe/Berlin"

    def want(text):
        told = dt.datetime.fromisoformat(text.replace("Z", "+00:00"))
        told = told.replace(tzinfo=ZoneInfo(zone)) if told.tzinfo is None else told
        return told.astimezone(dt.timezone.utc).astimezone(ZoneInfo(zone)).replace(tzinfo=None)

    plain = ["2024-03-31 01:59:59", "2024-03-31 02:30:00", "2024-03-31 03:00:00", "2024-10-27 02:30:00", "2024-07-01 12:00:00", "2024-01-02T03:04:05Z", "2024-07-02T03:04:05+05:30", "2024-12-31 23:30:00-02:00", "2024-05-05"]
    odd = {"02-01-2024 09:15:00": dt.datetime(2024, 1, 2, 9, 15), " 5-6-2024 ": dt.datetime(2024, 6, 5), "nonsense": None, "2024-13-01 00:00:00": None, "": None}
    expected = {t: want(t) for t in plain} | odd
    for session in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", session)
        try:
            df = spark.createDataFrame([(t,) for t in expected] + [(None,)], "t string")
            got = {r.t: r.w for r in df.select("t", views.wall_time(F.col("t"), zone).alias("w")).collect()}
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert {k: v for k, v in got.items() if k is not None} == expected and got[None] is None
    moved = spark.sql("select timestamp_ntz'2024-10-27 02:30:00' a").select(views.shifted(F.col("a"), zone, "UTC").alias("u")).first().u
    assert moved == dt.datetime(2024, 10, 27, 0, 30)  # of two instants the earlier


def test_measures_round_trip(spark):
    df = spark.createDataFrame([(1, 2.5, "a\"b"), (None, None, None)], "n int, x double, t string")
    made = df.select(views.measures(n=F.col("n"), x=F.col("x"), t=F.col("t")).alias("p"))
    back = made.select("p", views.measure(F.col("p"), "n", "int").alias("n"), views.measure(F.col("p"), "x").alias("x"), views.measure(F.col("p"), "t", "string").alias("t"), views.measure(F.col("p"), "t").alias("bad"), views.measure(F.col("p"), "none").alias("none")).collect()
    assert [tuple(r)[1:] for r in back] == [(1, 2.5, 'a"b', None, None), (None,) * 5] and back[1].p == "{}"


def test_queries_are_over_whole_tables(spark, sf):
    assert {r.symbol for r in queries.calendar_days(spark, sf).collect()} == {"S0", "S1", "S2"}


def test_sets_of_stamps(spark):
    rows = [("k", m, d, x) for m, days in (("a", [1, 2, 3, 3]), ("b", [1, 2, 3, 4, 5]), ("c", [2, 3, 9])) for x, d in enumerate(days)] + [("j", "a", 7, 0), ("k", "c", None, 0)]
    df = spark.createDataFrame(rows, "k string, m string, d int, x int")
    assert sorted(map(tuple, ops.in_all(df, ["k"], "m", "d").collect())) == [("j", 7), ("k", 2), ("k", 3)]
    got = {(r.one, r.two): (r.rows, r.common, r.subset) for r in ops.contained(df, ["k"], "m", "d").collect()}
    assert got == {("a", "b"): (3, 3, True), ("b", "a"): (5, 3, False), ("a", "c"): (3, 2, False), ("c", "a"): (3, 2, False), ("b", "c"): (5, 2, False), ("c", "b"): (3, 2, False)}
    pairs = ops.aligned(df, ["k"], "m", "d", ["x"], "x").where("one = 'a' AND two = 'b' AND d = 3").collect()
    assert [(r.x_one, r.x_two) for r in pairs] == [(2, 2)]  # of the two rows of a the first
    assert ops.known_elsewhere(df, df.where("m = 'c'"), ["d"]).where("m = 'b'").count() == 2
