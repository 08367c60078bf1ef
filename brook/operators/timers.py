"""One timer per key over ordered ticks, for keys of any length.

A tick is one clock reading of a key: ``sets``, the time a timer gets if none is pending then (null: none is set), and
``breaks``, whether a pending timer is dropped first. A pending timer that is due at a tick fires before the tick acts.
So the machine's state is the pending timer, and what a run of ticks does is a function from the timer at its
entry to the timer at its exit and the firings between.

Keys of ordinary length are folded tick by tick over sorted partitions. A hot key is cut into slices (see ``scan``), and:

1. each slice tells which timers may be pending at its end, whatever was pending at its start, with one backward
   pass over jumps "timer set here -> tick that ends it"; a tick that breaks makes this one timer;
2. such an exit is handed to the slice that will end it: the first one that reaches its due time or has a break;
3. that slice answers with its own exit: an edge between exits;
4. pointer jumping over the edges finds the exits that really occur, from the key's first tick on, in as many rounds as the
   number of slices has binary digits;
5. each slice is walked once from the timer that really enters it.

Tasks hold one slice's ticks; tables between the steps have one row per possible exit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brook.functions.durations import from_micros
from brook.operators import machines as M
from brook.operators import scan as S
from brook.session import shared_dir

NONE = -(2**63)  # time and due of "no timer"


class Ticks:
    """A run of ticks of one key in clock order, one a clock reading."""

    def __init__(self, clock: np.ndarray, sets: np.ndarray, has: np.ndarray, breaks: np.ndarray):
        n = len(clock)
        self.n, self.clock, self.sets = n, clock, sets
        self.due = np.maximum(sets, clock + 1)
        places = np.arange(n + 1)

        def following(flags: np.ndarray) -> np.ndarray:
            """At each place the first flagged tick from there on, n if there is none."""
            at = np.where(np.append(flags, True), places, n)
            return np.minimum.accumulate(at[::-1])[::-1]

        self.next_set, self.next_break = following(has), following(breaks)
        # Where the timer set at a tick ends; it is due later than its own tick.
        self.end = np.minimum(np.searchsorted(clock, self.due), self.next_break[1:])
        self._exit: np.ndarray | None = None

    @classmethod
    def of(cls, table: pa.Table) -> Ticks:
        order = np.argsort(table.column("clock").to_numpy(), kind="stable")
        sets = table.column("sets")
        return cls(table.column("clock").to_numpy()[order], sets.fill_null(0).to_numpy()[order],
                   ~np.asarray(sets.is_null())[order], np.asarray(table.column("breaks"))[order])

    def _starts(self, due: int) -> int:
        """The tick that ends what is pending at entry; the first one if nothing is."""
        return 0 if due == NONE else int(min(np.searchsorted(self.clock, due), self.next_break[0]))

    def exits(self) -> np.ndarray:
        """For each tick the tick whose timer is pending at the end if one is set there, -1 if none is pending."""
        if self._exit is None:
            out, end, later = [-1] * self.n, self.end.tolist(), self.next_set.tolist()
            for i in range(self.n - 1, -1, -1):
                j = end[i]
                if j == self.n:
                    out[i] = i
                elif later[j] < self.n:
                    out[i] = out[later[j]]
            self._exit = np.array(out, dtype=np.int64)
        return self._exit

    def _timer(self, tick: int) -> tuple[int, int]:
        return (NONE, NONE) if tick < 0 else (int(self.sets[tick]), int(self.due[tick]))

    def exit(self, time: int, due: int) -> tuple[int, int]:
        """What is pending at the end, from what is pending at entry."""
        j = self._starts(due)
        if j == self.n:
            return time, due
        first = self.next_set[j]
        return self._timer(-1 if first == self.n else int(self.exits()[first]))

    def possible_exits(self) -> list[tuple[int, int]]:
        """Timers set in this run that can be pending at its end, and "none" if that can be."""
        firsts = np.unique(self.next_set[:min(int(self.next_break[0]), self.n - 1) + 1])
        found = np.append(self.exits(), -1)[firsts]  # a first of n: nothing is set any more
        return sorted({self._timer(int(i)) for i in np.unique(found)})  # two ticks may set the same timer

    def walk(self, time: int, due: int) -> list[int]:
        """Times of the timers that fire in this run."""
        fired, j = [], self._starts(due)
        if j < self.n and due != NONE and self.clock[j] >= due:
            fired.append(time)
        i = int(self.next_set[j])
        while i < self.n:
            j = int(self.end[i])
            if j == self.n:
                break
            if self.clock[j] >= self.due[i]:
                fired.append(int(self.sets[i]))
            i = int(self.next_set[j])
        return fired


def fold(ticks: DataFrame, end: int | None, keep_open: bool = False, profile: DataFrame | None = None) -> DataFrame:
    """(id, fire_time) of all timers that fire; with ``keep_open`` also those pending at ``end``, told apart by ``fired``.

    ``ticks`` has id, clock, sets and breaks, one row per id and clock. ``profile`` may be a cheaper frame with the same
    ids, at least as many rows of each.
    """
    final = M.LONG_AGO if end is None else end
    laid = S.scan(ticks.select("id", "clock", "sets", "breaks"), ["id"], ["clock"], profile=profile)
    if laid.sliced:
        rows = _folded(laid.df.where(f"{S.SLICE} < 0"), final).unionAll(_chained(laid.df.where(f"{S.SLICE} >= 0"), final))
    else:
        rows = _folded(laid.df, final)
    if not keep_open:
        rows = rows.where("fired")
    return rows.select("id", from_micros("time").alias("fire_time"), *(["fired"] if keep_open else []))


def _folded(ticks: DataFrame, final: int) -> DataFrame:
    """The fold over sorted partitions; it holds one timer."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, timer = None, None
        for batch in batches:
            ids, times, fired = [], [], []
            for key, clock, sets, breaks in zip(*[batch.column(c).to_pylist() for c in ("id", "clock", "sets", "breaks")]):
                if key != current:
                    if timer is not None:
                        ids.append(current), times.append(timer.time), fired.append(M.is_due(timer, final))
                    current, timer = key, None
                if M.is_due(timer, clock):
                    ids.append(key), times.append(timer.time), fired.append(True)
                    timer = None
                if breaks:
                    timer = None
                if timer is None and sets is not None:
                    timer = M.set_timer(sets, clock)
            yield pack(ids, times, fired)
        if timer is not None:
            yield pack([current], [timer.time], [M.is_due(timer, final)])

    def pack(ids, times, fired):
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.string()), pa.array(times, pa.int64()), pa.array(fired, pa.bool_())],
            names=["id", "time", "fired"])

    return ticks.select("id", "clock", "sets", "breaks").repartition("id").sortWithinPartitions("id", "clock").mapInArrow(
        run, "id string, time bigint, fired boolean")


_EXIT = "g bigint, s bigint, time bigint, due bigint"


def _chained(hot: DataFrame, final: int) -> DataFrame:
    """The same for hot keys, slice by slice."""
    spark, root = hot.sparkSession, shared_dir(hot.sparkSession, "timers")

    def stored(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{root}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{root}/{name}")

    ticks = stored(hot.withColumnsRenamed({S.HOT: "g", S.SLICE: "s"}), "ticks")

    def exits(key, table):
        run = Ticks.of(table)
        found = run.possible_exits()
        return pa.table({
            "g": pa.array([key[0].as_py()]), "s": pa.array([key[1].as_py()]), "top": pa.array([int(run.clock[-1])]),
            "stops": pa.array([bool(run.next_break[0] < run.n)]),
            "times": pa.array([[t for t, _ in found]]), "dues": pa.array([[d for _, d in found]])})

    told = stored(ticks.groupBy("g", "s").applyInArrow(
        exits, "g bigint, s bigint, top bigint, stops boolean, times array<bigint>, dues array<bigint>"), "exits")
    # For each slice the next one, and the next one with a break.
    after = S.scan(told.select("g", "s", "stops"), ["g"], ["s"]).add(
        nxt=S.following(F.col("s")), stop=S.next_known(F.when(F.col("stops"), F.col("s")))).rows()
    after = S.scan(after, ["g"], ["s"]).add(next_stop=S.following(F.col("stop"))).rows().select("g", "s", "nxt", "next_stop")
    # For each exit the first slice that reaches its due time: exits and slices in one order.
    found = told.select("g", "s", F.inline(F.arrays_zip(F.col("times").alias("time"), F.col("dues").alias("due"))))
    nothing = F.lit(None).cast("bigint")
    marks = told.select("g", F.col("top").alias("at"), F.lit(1).alias("rank"), "s", nothing.alias("time"), nothing.alias("due"))
    both = marks.unionAll(found.select("g", F.col("due").alias("at"), F.lit(0).alias("rank"), "s", "time", "due"))
    due = S.scan(both, ["g"], ["at", "rank", "s", "time"]).add(reach=S.next_known(F.when(F.col("rank") == 1, F.col("s")))).rows()
    to = F.when(F.col("due") == NONE, F.col("nxt")).otherwise(F.least("reach", "next_stop"))
    nodes = stored(due.where("rank = 0").join(after, ["g", "s"]).select("g", "s", "time", "due", to.alias("to")), "nodes")
    # Before the first slice nothing is pending.
    start = told.groupBy("g").agg(F.min("s").alias("to")).select(
        "g", F.lit(-1).cast("bigint").alias("s"), *[F.lit(NONE).alias(c) for c in ("time", "due")], "to")

    def answer(key, table, asked):
        if not (table.num_rows and asked.num_rows):
            return pa.table({c: pa.array([], pa.int64()) for c in ("g", "s", "time", "due", "s2", "time2", "due2")})
        run = Ticks.of(table)
        ends = [run.exit(t, d) for t, d in zip(asked.column("time").to_pylist(), asked.column("due").to_pylist())]
        here = pa.array([key[1].as_py()] * len(ends), pa.int64())
        return pa.table({
            **{c: asked.column(c) for c in ("g", "s", "time", "due")}, "s2": here,
            "time2": pa.array([t for t, _ in ends], pa.int64()), "due2": pa.array([d for _, d in ends], pa.int64())})

    by_slice = ticks.groupBy("g", "s")
    asked = nodes.unionAll(start).where("to is not null")
    jumps = stored(by_slice.cogroup(asked.groupBy("g", "to")).applyInArrow(
        answer, f"{_EXIT}, s2 bigint, time2 bigint, due2 bigint"), "jumps-0")
    seen = stored(start.select("g", "s", "time", "due"), "seen-0")
    most = told.groupBy("g").count().agg(F.max("count")).first()[0]
    at = ["g", "s", "time", "due"]
    for i in range(1, most.bit_length() + 1):
        on = [F.col("j.g") == F.col("k.g")] + [F.col(f"j.{c}2") == F.col(f"k.{c}") for c in at[1:]]
        further = seen.join(jumps, at).select("g", F.col("s2").alias("s"), F.col("time2").alias("time"), F.col("due2").alias("due"))
        seen = stored(seen.unionAll(further).distinct(), f"seen-{i}")
        jumps = stored(jumps.alias("j").join(jumps.alias("k"), on).select(
            "j.g", "j.s", "j.time", "j.due", "k.s2", "k.time2", "k.due2"), f"jumps-{i}")
    real = nodes.unionAll(start).join(seen, at)

    def walk(key, table, entered):
        if not (table.num_rows and entered.num_rows):
            return pa.table({"id": pa.array([], pa.string()), "time": pa.array([], pa.int64()), "fired": pa.array([], pa.bool_())})
        times = Ticks.of(table).walk(entered.column("time")[0].as_py(), entered.column("due")[0].as_py())
        return pa.table({"id": pa.array([table.column("id")[0].as_py()] * len(times), pa.string()),
                         "time": pa.array(times, pa.int64()), "fired": pa.array([True] * len(times), pa.bool_())})

    walked = by_slice.cogroup(real.where("to is not null").groupBy("g", "to")).applyInArrow(
        walk, "id string, time bigint, fired boolean")
    left = real.where(f"to is null and due <> {NONE}").join(ticks.groupBy("g").agg(F.first("id").alias("id")), "g")
    return walked.unionAll(left.select("id", "time", (F.col("due") <= final).alias("fired")))
