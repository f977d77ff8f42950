"""Live checks with keyed state: halts by timers, statistics of the last ticks, a circuit breaker.

A key is (symbol, source). Each check is a stateful processor of ``transformWithStateInPandas``; its state lives in the
RocksDB store of the stream's checkpoint, so it survives restarts and lost executors, and is bounded: ticks that wait for
the watermark, a ring of ``RING`` ticks, a few numbers. Waiting ticks are packed by hour; a task's memory holds those of one
hour and not all that a batch brings.

Ticks are put in order before they are judged: they wait until the watermark has passed them, then run by (time, event).
So verdicts don't depend on how the stream was cut into batches or on the order of arrival within the watermark. Ticks
behind the watermark are dropped by Spark before they reach a processor.

Defined cases: a null close takes part in no statistic of closes; equal times run by event; a repeated event is judged
again (drop duplicates before); an empty stream gives no rows; a key that never comes back keeps one row of state.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Seconds without a tick: the heartbeat is missing, and trading has halted.
SILENT_S, HALT_S = 120, 300
#: Ticks that the longest statistic looks back on, the one at hand included.
RING = 60
TICK = "us long, event_id long, close double, volume double, open_interest double, spread double"
COLUMNS = [c.split()[0] for c in TICK.split(", ")]
#: A tick in state.
PACKED = np.dtype([(c.split()[0], "<i8" if c.endswith("long") else "<f8") for c in TICK.split(", ")])
NO_EVENT = -(1 << 63)
#: Microseconds of the slots in which ticks wait, ticks in memory before they are put there, and ticks judged at once.
SLOT_US, HELD, AT_ONCE = 3_600_000_000, 200_000, 4096
HALTS = "symbol string, source string, kind string, event_id long, seconds double"
FLAGS = "symbol string, source string, event_id long, check_id string, value double"
ACTIONS = "symbol string, source string, action string"


class Ordered(StatefulProcessor):
    """Ticks wait in state until the watermark passes them, then reach :meth:`settled` in order.

    What waits is kept packed, by slots of time, so a key's ticks are never in memory at once: those at hand while rows
    come (``HELD``), and those of one slot while they are judged.
    """

    out: list[str]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "slot long, part long", "body binary")
        self.slots = handle.getValueState("slots", "body binary")

    def settled(self, ticks: np.ndarray) -> list[tuple]:
        """Rows for some ticks (``PACKED``), which are final and in order."""
        raise NotImplementedError

    def passed(self, now: int) -> tuple[list[tuple], int | None]:
        """Rows for the time that has passed without a tick, and the next time in microseconds to be called at, if any."""
        return [], None

    def _frame(self, key: tuple, rows: list[tuple]) -> Iterator[pd.DataFrame]:
        if rows:
            yield pd.DataFrame([(*key, *r) for r in rows], columns=self.out)

    def _known(self) -> dict[int, list[int]]:
        """slot: [parts, time of its first tick]."""
        body = self.slots.get()[0] if self.slots.exists() else b""
        return {s: [k, t] for s, k, t in np.frombuffer(body, np.int64).reshape(-1, 3).tolist()}

    def _hold(self, known: dict[int, list[int]], ticks: np.ndarray) -> None:
        slot = ticks["us"] // SLOT_US
        order = np.argsort(slot, kind="stable")
        slot, ticks = slot[order], ticks[order]
        cuts = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))[: len(slot)].tolist()
        for i, j in zip(cuts, [*cuts[1:], len(slot)]):
            parts, first = known.get(at := int(slot[i]), (0, None))
            self.waiting.updateValue((at, parts), (ticks[i:j].tobytes(),))
            least = int(ticks["us"][i:j].min())
            known[at] = [parts + 1, least if first is None else min(first, least)]

    def _slot(self, at: int, parts: int) -> np.ndarray:
        """The ticks of a slot in order; they are taken out of the state."""
        got = []
        for i in range(parts):
            got.append(np.frombuffer(self.waiting.getValue((at, i))[0], PACKED))
            self.waiting.removeKey((at, i))
        return _in_order(np.concatenate(got))

    def _run(self, key: tuple, known: dict[int, list[int]], now_ms: int) -> Iterator[pd.DataFrame]:
        now = now_ms * 1000
        for at in sorted(x for x, (_, first) in known.items() if first <= now):
            ticks = self._slot(at, known.pop(at)[0])
            final = int(np.searchsorted(ticks["us"], now, "right"))
            for i in range(0, final, AT_ONCE):
                yield from self._frame(key, self.settled(ticks[i : min(i + AT_ONCE, final)]))
            if final < len(ticks):
                self._hold(known, ticks[final:])
        rows, call = self.passed(now)
        self.slots.update((np.array([(s, *x) for s, x in known.items()], np.int64).tobytes(),))
        self._call(min((x for x in (*(first for _, first in known.values()), call) if x is not None), default=None), now_ms)
        yield from self._frame(key, rows)

    def _call(self, due: int | None, now_ms: int) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if due is not None:
            self.handle.registerTimer(max(due // 1000, now_ms) + 1)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        known, got, held = self._known(), [], 0
        for part in rows:
            got.append(_packed(part))
            held += len(got[-1])
            if held >= HELD:
                self._hold(known, np.concatenate(got))
                got, held = [], 0
        if held:
            self._hold(known, np.concatenate(got))
        yield from self._run(key, known, self.now(timerValues))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        yield from self._run(key, self._known(), self.now(timerValues))

    def now(self, timers) -> int:
        return timers.getCurrentWatermarkInMs()

    def close(self) -> None:
        pass


def _packed(part: pd.DataFrame) -> np.ndarray:
    """The ticks of a frame; null is NaN, of an event ``NO_EVENT``. A tick without a time is none."""
    part = part[part["us"].notna()]
    out = np.zeros(len(part), PACKED)
    for c in COLUMNS:
        x = part[c]
        out[c] = x if x.dtype == np.int64 else x.fillna(NO_EVENT).astype("int64") if PACKED[c].kind == "i" else x.astype("float64")
    return out


def _in_order(ticks: np.ndarray) -> np.ndarray:
    return ticks[np.lexsort([ticks[c] for c in reversed(COLUMNS)])]


def _event(x: int) -> int | None:
    return None if x == NO_EVENT else x


class Halts(Ordered):
    """SILENT and HALT once a key has had no tick for so long, without a further tick; RESUMED with the gap when one comes.

    With the event clock time is the watermark. With the processing clock ticks are final when they come, and silence is
    measured from the batch that brought the last one.
    """

    out = ["symbol", "source", "kind", "event_id", "seconds"]

    def __init__(self, silent_s: float = SILENT_S, halt_s: float = HALT_S, clock: str = "event"):
        self.limits, self.clock = (("SILENT", int(silent_s * 1e6)), ("HALT", int(halt_s * 1e6))), clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.last = handle.getValueState("last", "us long, event_id long, seen long, told long")

    def now(self, timers) -> int:
        return super().now(timers) if self.clock == "event" else timers.getCurrentProcessingTimeInMs()

    def _silence(self, rows: list[tuple], event: int | None, gap: int, told: int) -> int:
        """How much has been told once the silence has lasted ``gap``."""
        for i, (kind, limit) in enumerate(self.limits):
            if gap > limit and told <= i:
                rows.append((kind, event, None))
                told = i + 1
        return told

    def settled(self, ticks, seen=None):
        us, event, _, told = self.last.get() if self.last.exists() else (None, None, None, 0)
        rows, times, events = [], ticks["us"], ticks["event_id"]
        # the first tick ends what the state knows; of the others only those after a silence tell something
        far = np.append(0, 1 + np.flatnonzero(np.diff(times) > min(limit for _, limit in self.limits)))
        for i in far.tolist():
            if i:
                us, event, told = int(times[i - 1]), _event(int(events[i - 1])), 0
            if us is not None:
                gap = int(times[i]) - us
                if self._silence(rows, event, gap, told) == len(self.limits):
                    rows.append(("RESUMED", event, gap // 1000 / 1e3))
        self.last.update((int(times[-1]), _event(int(events[-1])), int(times[-1]) if seen is None else seen, 0))
        return rows

    def passed(self, now):
        if not self.last.exists():
            return [], None
        rows: list[tuple] = []
        us, event, seen, told = self.last.get()
        told = self._silence(rows, event, now - seen, told)
        self.last.update((us, event, seen, told))
        return rows, seen + self.limits[told][1] if told < len(self.limits) else None

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        if self.clock == "event":
            yield from super().handleInputRows(key, rows, timerValues)
        else:  # nothing waits: a tick's own time may be ahead of the clock
            ticks = _in_order(np.concatenate([np.zeros(0, PACKED), *map(_packed, rows)]))
            now_ms = self.now(timerValues)
            if len(ticks):
                yield from self._frame(key, self.settled(ticks, now_ms * 1000))
            yield from self._run(key, {}, now_ms)


class _Window:
    """Count, mean and sample deviation of the values, nulls apart, in the windows that end at each tick."""

    def __init__(self, x: np.ndarray, size: int, m: int):
        w = np.lib.stride_tricks.sliding_window_view(x, size)[len(x) - size + 1 - m :]
        there = ~np.isnan(w)
        self.n = there.sum(axis=1)
        with np.errstate(all="ignore"):
            self.mean = np.where(there, w, 0.0).sum(axis=1) / self.n
            sd = np.sqrt((np.where(there, w - self.mean[:, None], 0.0) ** 2).sum(axis=1) / (self.n - 1))
        alike = np.where(there, w, -np.inf).max(axis=1) == np.where(there, w, np.inf).min(axis=1)
        self.sd = np.where(self.n > 1, np.where(alike, 0.0, sd), np.nan)
        self.of = w

    def z(self, x: np.ndarray, least: int, floor: float = 0.0) -> np.ndarray:
        """Deviations of x from the mean; null below ``least`` values and where they don't vary."""
        sd = np.maximum(self.sd, floor)
        return np.where((self.n >= least) & (sd > 0), np.abs(x - self.mean) / sd, np.nan)

    def quantile(self, q: float, ordered: np.ndarray) -> np.ndarray:
        """The quantile, interpolated between the values next to it, of the sorted windows."""
        at = q * (self.n - 1)
        low = np.maximum(np.floor(at), 0).astype(np.int64)
        t, row = at - low, np.arange(len(ordered))
        a, b = ordered[row, low], ordered[row, np.minimum(low + 1, np.maximum(self.n - 1, 0))]
        return np.where(t >= 0.5, b - (b - a) * (1 - t), a + (b - a) * t)


class LastTicks(Ordered):
    """A row for each tick and check that fails by the ``RING`` ticks up to it, the session's first price or an unchanged price."""

    out = ["symbol", "source", "event_id", "check_id", "value"]

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.ring = handle.getValueState("ring", "body binary")
        self.session = handle.getValueState("session", "ticks long, first double, held_from long, oi double")

    def settled(self, ticks):
        ring = np.frombuffer(self.ring.get()[0], PACKED) if self.ring.exists() else np.zeros(0, PACKED)
        count, first, held_from, oi = self.session.get() if self.session.exists() else (0, None, None, None)
        whole = np.concatenate([ring, ticks])
        close, us = ticks["close"], ticks["us"]
        before = np.append(ring["close"][-1:] if len(ring) else np.nan, close[:-1])
        held = np.maximum.accumulate(np.where(close == before, us[0] if held_from is None else held_from, us))
        if first is None and not np.isnan(close).all():
            first = float(close[~np.isnan(close)][0])
        interest = ticks["open_interest"]
        earlier = np.append(np.nan if oi is None else oi, interest[:-1])
        rows, events = [], ticks["event_id"].tolist()
        for check, value, limit in self.figures(whole, len(ticks), count, first, us - held, np.where(earlier == 0, np.nan, earlier)):
            at = np.flatnonzero(value > limit)
            rows += [(_event(events[i]), check, round(x, 4)) for i, x in zip(at.tolist(), value[at].tolist())]
        self.ring.update((whole[-RING:].tobytes(),))
        last = float(interest[-1])
        self.session.update((count + len(ticks), first, int(held[-1]), last if last and last == last else None))
        return rows

    @staticmethod
    def figures(whole: np.ndarray, m: int, count: int, first: float | None, held: np.ndarray, oi: np.ndarray) -> list[tuple[str, np.ndarray, float]]:
        """(check, figures, limit) of the last ``m`` ticks of ``whole``; NaN where there is none."""

        def column(c: str) -> np.ndarray:
            return np.concatenate([np.full(RING, np.nan), whole[c]])

        closes, spreads, volumes = column("close"), column("spread"), column("volume")
        close, nr = closes[-m:], count + 1 + np.arange(m)
        with np.errstate(all="ignore"):
            returns = np.where(closes[:-1] == 0, np.nan, closes[1:] / closes[:-1] - 1)
            c20, c60, r5, r60 = _Window(closes, 20, m), _Window(closes, RING, m), _Window(returns, 5, m), _Window(returns, RING - 1, m)
            ordered = np.sort(c60.of, axis=1)
            q1, q3 = c60.quantile(0.25, ordered), c60.quantile(0.75, ordered)
            full = nr >= RING
            return [
                ("LT-004", np.where(nr >= 10, c20.z(close, 5), np.nan), 3),
                ("LT-006", np.where(nr >= 10, _Window(volumes, 20, m).z(volumes[-m:], 5), np.nan), 4),
                ("LT-009", np.abs(whole["open_interest"][-m:] / oi - 1), 0.05),
                ("LT-011", np.where(full & (c20.n > 0) & (c60.mean != 0), np.abs(c20.mean / c60.mean - 1), np.nan), 0.03),
                ("LT-014", _Window(spreads, RING, m).z(spreads[-m:], 5, 0.001), 3),
                ("LT-016", np.where(nr >= 20, np.maximum(q1 - close, close - q3) - 3 * (q3 - q1), np.nan), 0),
                ("LT-018", np.where(full, r5.sd / np.maximum(r60.sd, 1e-8), np.nan), 3),
                ("MICRO-002", np.where(nr > 1, np.abs(close / first - 1), np.nan) if first else np.full(m, np.nan), 0.2),
                ("MICRO-003", np.where(np.isnan(close), np.nan, held / 1e6), 120),
            ]


class Breaker(StatefulProcessor):
    """QUARANTINE and FREEZE once a key has more than ``limit`` failures, or failures of a hard gate; RELEASE when they lapse.

    Counts and the open breakers are values with a time to live: without a new failure for ``ttl_ms`` they are forgotten,
    and a key that had tripped is released by a timer.
    """

    def __init__(self, limit: int = 3, ttl_ms: int = 86_400_000):
        self.limit, self.ttl_ms = limit, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getValueState("counts", "fails long, hard long", self.ttl_ms)
        self.open = handle.getValueState("open", "quarantined boolean, frozen boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        fails, hard = self.counts.get() if self.counts.exists() else (0, 0)
        was = fails
        for part in rows:
            failed = part["status"] == "Fail"
            fails, hard = fails + int(failed.sum()), hard + int((failed & (part["gate"] == "Hard")).sum())
        if fails == was:
            return
        self.counts.update((fails, hard))
        quarantined, frozen = self.open.get() if self.open.exists() else (False, False)
        told = [x for x, on, already in (("QUARANTINE", fails > self.limit, quarantined), ("FREEZE", hard > self.limit, frozen)) if on and not already]
        quarantined, frozen = quarantined or fails > self.limit, frozen or hard > self.limit
        if quarantined or frozen:
            self.open.update((quarantined, frozen))
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.ttl_ms)
        if told:
            yield pd.DataFrame([(*key, x) for x in told], columns=["symbol", "source", "action"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.open.clear()
        self.counts.clear()
        yield pd.DataFrame([(*key, "RELEASE")], columns=["symbol", "source", "action"])

    def close(self) -> None:
        pass


def _ticks(ticks: DataFrame) -> DataFrame:
    """The columns of a watermarked stream that the processors read, by key."""
    spread = F.col("ask") - F.col("bid") if {"bid", "ask"} <= set(ticks.columns) else F.lit(None).cast("double")
    given = {c: F.col(c).cast("double") if c in ticks.columns else F.lit(None).cast("double") for c in ("close", "volume", "open_interest")}
    return ticks.select("symbol", "source", "ts", F.unix_micros("ts").alias("us"), F.col("event_id").cast("long").alias("event_id"), *[c.alias(x) for x, c in given.items()], spread.alias("spread"))


def halts(ticks: DataFrame, clock: str = "event", silent_s: float = SILENT_S, halt_s: float = HALT_S) -> DataFrame:
    """``HALTS`` rows of a watermarked stream (symbol, source, ts, event_id); event_id is the last tick before the silence."""
    mode = {"event": "EventTime", "processing": "ProcessingTime"}[clock]
    return _ticks(ticks).groupBy("symbol", "source").transformWithStateInPandas(Halts(silent_s, halt_s, clock), HALTS, "Append", mode)


def last_ticks(ticks: DataFrame) -> DataFrame:
    """``FLAGS`` rows of a watermarked stream of ticks."""
    return _ticks(ticks).groupBy("symbol", "source").transformWithStateInPandas(LastTicks(), FLAGS, "Append", "EventTime")


def breaker(results: DataFrame, limit: int = 3, ttl_ms: int = 86_400_000) -> DataFrame:
    """``ACTIONS`` rows of a stream of results (symbol, source, status, gate)."""
    return results.groupBy("symbol", "source").transformWithStateInPandas(Breaker(limit, ttl_ms), ACTIONS, "Append", "ProcessingTime")


def with_rocks(spark: SparkSession) -> SparkSession:
    """A session of its own with the state store that the processors need."""
    own = spark.newSession()
    own.conf.set(STORE, ROCKS)
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return own
