"""Stateful processors: keyed state and timers on a live feed.

Each processor holds one small value per key. Rows of a key within one
micro-batch come unordered, so they are put in arrival order first; how many
they can be is set by the source's rate limit (files or offsets per trigger). For
operators without timers, ``chunks`` packs the rows of a hot key instead.

In a micro-batch the watermark is that of the batches before. A timer that it
has passed is treated as fired before the key's rows, as a record-by-record
engine would; keys without rows are woken by the timer itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from brook.operators import machines as M

PLACE = ("arrival", "event_id")


def in_order(rows: Iterator[Row], place=PLACE) -> list[Row]:
    return sorted(rows, key=lambda r: tuple(r[c] for c in place))


def millis(ts) -> int:
    """A timestamp column value as milliseconds; UTC sessions hand out UTC values."""
    return int(round(ts.timestamp() * 1000))


class Processor(StatefulProcessor):
    """Common shape: ``on_rows`` in arrival order, nothing on timers."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        yield from self.on_rows(key[0], in_order(rows), timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        return iter([])

    def close(self) -> None:
        pass

    def on_rows(self, key, rows, timerValues) -> Iterator[Row]:
        raise NotImplementedError


#: Counts that a task holds before they travel.
HELD_COUNTS = 200_000


def partial_counts(rows: DataFrame, key: str) -> DataFrame:
    """Rows as (key, n), counted per task up to a bound of held counts, so that a common key travels as a few counts."""
    def merged(parts: list[pa.Table]) -> pa.Table:
        counts = pa.concat_tables(parts).group_by(key).aggregate([("n", "sum")])
        return counts.select([key, "n_sum"]).rename_columns([key, "n"])

    def count(batches):
        held: list[pa.Table] = []
        new = 0  # counts that came since the last merge
        for batch in batches:
            one = pa.Table.from_batches([batch]).append_column("n", pa.repeat(pa.scalar(1, pa.int64()), len(batch)))
            held.append(merged([one]))
            new += len(held[-1])
            if new > HELD_COUNTS:
                held, new = [merged(held)], 0
                if len(held[0]) > HELD_COUNTS:
                    yield from held[0].to_batches()
                    held = []
        if held:
            yield from merged(held).to_batches()

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key).mapInArrow(count, f"`{key}` {kind}, n bigint")


def distinct_per_batch(rows: DataFrame, *columns: str) -> DataFrame:
    """``columns`` with repeats removed per Arrow batch, before rows travel to their key.

    Set the watermark on the result: a Python map does not pass it on.
    """
    def distinct(batches):
        for pdf in batches:
            yield pdf.drop_duplicates()

    some = rows.select(*columns)
    return some.mapInPandas(distinct, some.schema)


class RunningCount(StatefulProcessor):
    """Count per key in explicit keyed state, fed with partial counts; one row per key and batch."""

    def init(self, handle):
        self.count = handle.getValueState("count", "n bigint")

    def handleInputRows(self, key, rows, timerValues):
        seen = self.count.get()
        n = (seen[0] if seen else 0) + sum(row.n for row in rows)
        self.count.update((n,))
        yield Row(key=key[0], n=n)

    def close(self):
        pass


class BucketCounts(StatefulProcessor):
    """The same for a bucket of keys at a time: with many keys, a call and state access for each would be the whole job."""

    def init(self, handle):
        self.counts = handle.getValueState("counts", "key array<string>, n array<bigint>")

    def handleInputRows(self, key, rows, timerValues):
        new = pd.concat(list(rows), ignore_index=True)[["key", "n"]]
        held = self.counts.get()
        if held:
            before = pd.DataFrame({"key": pd.Series(list(held[0]), dtype=object), "n": pd.Series(list(held[1]), dtype="int64")})
            both = pd.concat([before.assign(new=False), new.assign(new=True)], ignore_index=True)
        else:
            both = new.assign(new=True)
        both = both.groupby("key", dropna=False, sort=False).agg(n=("n", "sum"), new=("new", "max")).reset_index()
        both["key"] = both["key"].astype(object).where(both["key"].notna(), None)
        self.counts.update((both["key"].tolist(), both["n"].tolist()))
        yield both.loc[both["new"], ["key", "n"]]

    def close(self):
        pass


def bucket_counts(counts: DataFrame, key: str, buckets: int = 1024) -> DataFrame:
    """Running counts (key, n) of partial counts; ``buckets`` stays the same for the life of a checkpoint."""
    dealt = counts.select(F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket"), F.col(key).alias("key"), "n")
    return process(dealt, "bucket", BucketCounts(), "update")


class TtlCount(RunningCount):
    """The same, but a count not written for ``ttl_ms`` of processing time is forgotten."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle):
        self.count = handle.getValueState("count", "n bigint", ttlDurationMs=self.ttl_ms)


class Reduce(Processor):
    """Running reduce of ``value`` with any two-argument combiner, one row per record."""

    def __init__(self, combine: Callable[[int, int], int]):
        self.combine = combine

    def init(self, handle):
        self.held = handle.getValueState("held", "value bigint")

    def on_rows(self, key, rows, timerValues):
        got = self.held.get()
        held = got[0] if got else None
        for row in rows:
            held = row.value if held is None else self.combine(held, row.value)
            yield Row(key=key, event_id=row.event_id, value=held)
        self.held.update((held,))


class LastValue(Processor):
    """The previous value of the key, 0 at first, with every row."""

    def init(self, handle):
        self.last = handle.getValueState("last", "vc int")

    def on_rows(self, key, rows, timerValues):
        got = self.last.get()
        last = got[0] if got else 0
        for row in rows:
            yield Row(event_id=row.event_id, id=key, vc=row.vc, last=last)
            last = row.vc
        self.last.update((last,))


class JumpAlert(Processor):
    """Readings further than ``threshold`` from the previous one."""

    def __init__(self, threshold: float = 1.7):
        self.threshold = threshold

    def init(self, handle):
        self.last = handle.getValueState("last", "vc int")

    def on_rows(self, key, rows, timerValues):
        got = self.last.get()
        last = got[0] if got else 0
        for row in rows:
            diff = abs(row.vc - last)
            if diff > self.threshold:
                yield Row(event_id=row.event_id, id=key, vc=row.vc, diff=diff)
            last = row.vc
        self.last.update((last,))


class SelfCleaningJump(Processor):
    """Jump alert that forgets the previous value when its event-time timer fires."""

    def __init__(self, threshold: int = 10, keep_ms: int = 60_000):
        self.threshold, self.keep_ms = threshold, keep_ms

    def init(self, handle):
        self.handle = handle
        self.state = handle.getValueState("state", "vc int, due bigint")

    def on_rows(self, key, rows, timerValues):
        clock = timerValues.getCurrentWatermarkInMs()
        got = self.state.get()
        last, due = (got[0], got[1]) if got else (0, None)
        if due is not None:
            self.handle.deleteTimer(due)
            if clock >= due:
                last = 0
        for row in rows:
            diff = abs(row.vc - last)
            if diff > self.threshold:
                yield Row(event_id=row.event_id, id=key, vc=row.vc, diff=diff)
            last = row.vc
            due = M.set_timer(millis(row.ts) + self.keep_ms, clock).due
        self.handle.registerTimer(due)
        self.state.update((last, due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.state.clear()
        return iter([])


class TimerPerEvent(Processor):
    """A timer at every row's event time + delay; equal timers of a key are one."""

    def __init__(self, delay_ms: int):
        self.delay_ms = delay_ms

    def handleInputRows(self, key, rows, timerValues):
        # Order does not matter, so rows are taken one by one; setting a timer again is harmless.
        for row in rows:
            self.handle.registerTimer(millis(row.ts) + self.delay_ms)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield Row(
            id=key[0], fire_ms=expiredTimerInfo.getExpiryTimeInMs(),
            watermark_ms=timerValues.getCurrentWatermarkInMs())


class ProcessingTimer(Processor):
    """A timer per batch of rows of the key at processing time + delay."""

    def __init__(self, delay_ms: int):
        self.delay_ms = delay_ms

    def handleInputRows(self, key, rows, timerValues):
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.delay_ms)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield Row(id=key[0], fire_ms=expiredTimerInfo.getExpiryTimeInMs())


class SingleTimer(Processor):
    """Shared shape of the single-timer machines: ``step`` decides, this keeps the timer."""

    def init(self, handle):
        self.handle = handle
        self.timer = handle.getValueState("timer", "time bigint, due bigint")
        self.last = handle.getValueState("last", "vc int")

    def clock(self, timerValues) -> int:
        return timerValues.getCurrentWatermarkInMs()

    def step(self, timer, clock, row, last):
        raise NotImplementedError

    def on_rows(self, key, rows, timerValues):
        clock = self.clock(timerValues)
        held, seen = self.timer.get(), self.last.get()
        before = timer = M.Timer(*held) if held else None
        last = seen[0] if seen else None
        if M.is_due(timer, clock):
            yield Row(id=key, fire_ms=timer.time)
            timer = None
        for row in rows:
            timer = self.step(timer, clock, row, last)
            last = row.vc
        self.last.update((last,))
        if timer != before:
            if before is not None:
                self.handle.deleteTimer(before.due)
            if timer is None:
                self.timer.clear()
            else:
                self.handle.registerTimer(timer.due)
                self.timer.update((timer.time, timer.due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        held = self.timer.get()
        if held and held[1] == expiredTimerInfo.getExpiryTimeInMs():
            self.timer.clear()
            yield Row(id=key[0], fire_ms=held[0])


class OneTimer(SingleTimer):
    """At most one event-time timer per key."""

    def __init__(self, delay_ms: int):
        self.delay_ms = delay_ms

    def step(self, timer, clock, row, last):
        return M.one_timer(timer, clock, millis(row.ts), self.delay_ms)


class OneProcessingTimer(SingleTimer):
    """At most one processing-time timer per key."""

    def __init__(self, delay_ms: int):
        self.delay_ms = delay_ms

    def clock(self, timerValues):
        return timerValues.getCurrentProcessingTimeInMs()

    def step(self, timer, clock, row, last):
        return M.one_timer(timer, clock, clock, self.delay_ms)


class RisingEvent(SingleTimer):
    """Alert when a level has kept rising for ``hold_ms`` of event time."""

    def __init__(self, hold_ms: int):
        self.hold_ms = hold_ms

    def step(self, timer, clock, row, last):
        at = millis(row.ts)
        reset = at if last is not None and row.vc <= last else None
        return M.rising_event(timer, clock, at, reset, self.hold_ms)


class RisingProcessing(OneProcessingTimer):
    """Alert when a level has not fallen for the delay after a rise, processing time."""

    def step(self, timer, clock, row, last):
        if not last:  # 0 stands for "no reading yet"
            return timer
        return M.rising_clock(timer, clock, row.vc < last, False, row.vc > last, self.delay_ms)


class Gate(Processor):
    """Readings pass while a switch of their key is on (processing time).

    Rows with ``duration_ms`` are switches. Every switch sets its own timer and
    the earliest one that fires closes the gate.
    """

    def init(self, handle):
        self.handle = handle
        self.open = handle.getValueState("open", "open boolean")

    def handleInputRows(self, key, rows, timerValues):
        now = timerValues.getCurrentProcessingTimeInMs()
        got = self.open.get()
        is_open = bool(got and got[0])
        due = [t for t in self.handle.listTimers() if t <= now]
        for t in due:
            self.handle.deleteTimer(t)
            is_open = False
        for row in in_order(rows, ("arrival", "rank", "event_id")):
            if row.duration_ms is not None:
                is_open = True
                self.handle.registerTimer(now + row.duration_ms)
            elif is_open:
                yield Row(event_id=row.event_id, id=key[0], vc=row.vc)
        self.open.update((is_open,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.open.clear()
        return iter([])


class DynamicThreshold(Processor):
    """Jump alerts under thresholds that a second stream sets and removes.

    Rows with ``threshold_vc`` are rules; ``rank`` puts a rule before a reading
    that arrives at the same time.
    """

    def init(self, handle):
        self.state = handle.getValueState("state", "threshold int, vc int")

    def handleInputRows(self, key, rows, timerValues):
        got = self.state.get()
        threshold, last = got if got else (0, 0)
        for row in in_order(rows, ("arrival", "rank", "event_id")):
            if row.threshold_vc is not None:
                threshold = row.threshold_vc
                continue
            diff = abs(row.vc - last)
            if threshold != 0 and diff > threshold:
                yield Row(event_id=row.event_id, id=key[0], vc=row.vc, diff=diff)
            last = row.vc
        self.state.update((threshold, last))


class Buffer(Processor):
    """Hold rows and let them go ``n`` at a time; the rest waits in list state."""

    def __init__(self, n: int = 3):
        self.n = n

    def init(self, handle):
        self.held = handle.getListState("held", "event_id bigint, vc int")

    def on_rows(self, key, rows, timerValues):
        held = [tuple(r) for r in self.held.get()] if self.held.exists() else []
        for row in rows:
            held.append((row.event_id, row.vc))
            if len(held) == self.n:
                for event_id, vc in held:
                    yield Row(shard=key, event_id=event_id, vc=vc)
                held = []
        if held:
            self.held.put(held)
        else:
            self.held.clear()


class LateWindow(StatefulProcessor):
    """Counts of a (key, window) that fire at the window's end and again with late rows until the allowed lateness is over.

    A processor's calls and timers cost far more than a count, so keys are dealt into buckets: a bucket's state is the table
    of its open windows, worked on as columns, with one timer at the first instant when one of them is due. A window is due at
    its last instant, when it fires, and ``late_ms`` after it, when it is forgotten. Rows come as counts. A row is
    judged by the watermark of the batches before; hopelessly late ones give nothing here.
    """

    FIELDS = ["id", "start_ms", "n", "fired"]

    def __init__(self, size_ms: int, late_ms: int):
        self.size_ms, self.late_ms = size_ms, late_ms

    def init(self, handle):
        self.handle = handle
        self.state = handle.getValueState(
            "windows", "due bigint, id array<string>, start_ms array<bigint>, n array<bigint>, fired array<boolean>")

    def open_windows(self) -> tuple[int | None, pd.DataFrame]:
        due, *columns = self.state.get() or (None, [], [], [], [])
        return due, pd.DataFrame(dict(zip(self.FIELDS, map(list, columns)))).astype(
            {"id": object, "start_ms": "int64", "n": "int64", "fired": bool})

    def keep(self, windows: pd.DataFrame, before: int | None) -> None:
        if not len(windows):
            self.state.clear()
            if before is not None:
                self.handle.deleteTimer(before)
            return
        last = windows["start_ms"] + self.size_ms - 1
        due = int(last.where(~windows["fired"], last + self.late_ms).min())
        if due != before:
            if before is not None:
                self.handle.deleteTimer(before)
            self.handle.registerTimer(due)
        self.state.update((due, *[windows[c].tolist() for c in self.FIELDS]))

    def handleInputRows(self, key, rows, timerValues):
        wm = timerValues.getCurrentWatermarkInMs()
        new = pd.concat(list(rows), ignore_index=True)
        last = new["start_ms"] + self.size_ms - 1
        new = new.assign(fired=wm >= last, new=True)[wm < last + self.late_ms]
        if not len(new):
            return
        before, held = self.open_windows()
        both = pd.concat([held.assign(new=False), new[[*self.FIELDS, "new"]]], ignore_index=True) if len(held) else new
        both = both.groupby(["id", "start_ms"], dropna=False, sort=False).agg(
            n=("n", "sum"), fired=("fired", "first"), new=("new", "max")).reset_index()
        both["id"] = both["id"].astype(object).where(both["id"].notna(), None)
        self.keep(both, before)
        again = both[both["new"] & (both["start_ms"] + self.size_ms - 1 <= wm)]
        if len(again):
            yield self.firing(again, "refire")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        wm = timerValues.getCurrentWatermarkInMs()
        before, held = self.open_windows()
        last = held["start_ms"] + self.size_ms - 1
        first = held[~held["fired"] & (last <= wm)]
        held["fired"] |= last <= wm
        self.keep(held[last + self.late_ms > wm], before)
        if len(first):
            yield self.firing(first, "first")

    @staticmethod
    def firing(windows: pd.DataFrame, name: str) -> pd.DataFrame:
        return windows.assign(firing=name)[["id", "start_ms", "firing", "n"]]

    def close(self):
        pass


def window_counts(rows: DataFrame, size: str) -> DataFrame:
    """Rows as (id, start_ms, n), counted per Arrow batch; ``rows`` has the watermark."""
    def count(batches):
        for pdf in batches:
            yield pdf.groupby(["id", "start_ms"], dropna=False).size().rename("n").reset_index()

    start = F.unix_millis(F.window("ts", size)["start"])
    return rows.select("id", start.alias("start_ms")).mapInPandas(count, "id string, start_ms bigint, n bigint")


def late_windows(counts: DataFrame, size_ms: int, late_ms: int, buckets: int = 256) -> DataFrame:
    """Firings (id, start_ms, firing, n) of window counts; ``buckets`` stays the same for the life of a checkpoint."""
    dealt = counts.withColumn("bucket", F.pmod(F.xxhash64("id", "start_ms"), F.lit(buckets)).cast("int"))
    return process(dealt, "bucket", LateWindow(size_ms, late_ms))


OUTPUTS = {
    LateWindow: "id string, start_ms bigint, firing string, n bigint",
    RunningCount: "key string, n bigint",
    BucketCounts: "key string, n bigint",
    TtlCount: "key string, n bigint",
    Reduce: "key string, event_id bigint, value bigint",
    LastValue: "event_id bigint, id string, vc int, last int",
    JumpAlert: "event_id bigint, id string, vc int, diff int",
    SelfCleaningJump: "event_id bigint, id string, vc int, diff int",
    TimerPerEvent: "id string, fire_ms bigint, watermark_ms bigint",
    ProcessingTimer: "id string, fire_ms bigint",
    OneTimer: "id string, fire_ms bigint",
    OneProcessingTimer: "id string, fire_ms bigint",
    RisingEvent: "id string, fire_ms bigint",
    RisingProcessing: "id string, fire_ms bigint",
    Gate: "event_id bigint, id string, vc int",
    DynamicThreshold: "event_id bigint, id string, vc int, diff int",
    Buffer: "shard int, event_id bigint, vc int",
}

ON_PROCESSING_TIME = (TtlCount, ProcessingTimer, OneProcessingTimer, RisingProcessing, Gate)
ON_EVENT_TIME = (SelfCleaningJump, TimerPerEvent, OneTimer, RisingEvent, LateWindow)
IN_PANDAS = (LateWindow, BucketCounts)


def process(rows: DataFrame, key: str | list[str], processor: StatefulProcessor, mode: str = "append") -> DataFrame:
    """Run a processor per key. Event-time processors need a watermark on ``rows``."""
    kind = type(processor)
    time_mode = (
        "processingTime" if kind in ON_PROCESSING_TIME
        else "eventTime" if kind in ON_EVENT_TIME else "none")
    grouped = rows.groupBy(*([key] if isinstance(key, str) else key))
    run = grouped.transformWithStateInPandas if kind in IN_PANDAS else grouped.transformWithState
    return run(
        statefulProcessor=processor, outputStructType=OUTPUTS[kind], outputMode=mode, timeMode=time_mode)
