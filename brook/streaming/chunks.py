"""Per-record results on a stream, with keyed state in the engine's own store.

A stateful processor is called once per key and micro-batch, and every call asks the engine's store several times. With many
keys of a few rows each, those calls are the whole job. So keys are dealt by hash into buckets, and a bucket is the key of the
processor: its state is the table of what its keys came to, read and written at once, and the rows of a micro-batch are
worked on as columns. A call's rows are bounded, since a micro-batch is. A bucket's rows come as chunks in any order; chunks
that overlap are merged, so any feed gives the same answers.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from brook.functions.durations import from_micros

PLACE = ("arrival", "rank", "event_id")


@dataclass(frozen=True)
class Carried:
    """A value that runs along a key: ``latest`` known one of a column, or its running ``total``."""

    name: str
    kind: str = "latest"


#: Buckets of keys; fixed for the life of a checkpoint. A micro-batch of two million rows gives each some thousands.
BUCKETS = 256

#: The whole number that stands for null on the way through Python, so that columns stay whole; null places come first, as in
#: the bounded queries.
NOTHING = -(2**63)


def bucketed(rows: DataFrame, carried: Sequence[Carried], buckets: int = BUCKETS) -> DataFrame:
    """Rows (id, arrival, rank, event_id and the carried columns, whole numbers) with their bucket."""
    places = {"arrival": F.unix_micros(F.col("arrival").cast("timestamp")), "rank": F.col("rank"), "event_id": F.col("event_id")}
    return rows.select(
        F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int").alias("bucket"), "id",
        *[F.coalesce(places[c].cast("bigint"), F.lit(NOTHING)).alias(c) for c in PLACE],
        *[F.coalesce(F.col(c.name).cast("bigint"), F.lit(0 if c.kind == "total" else NOTHING)).alias(c.name) for c in carried])


def _along(codes: np.ndarray, values: np.ndarray, known: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """What is known before and after every row; rows of a key (its code) stand together, ``known`` is by code."""
    n = len(codes)
    starts = np.ones(n, dtype=bool)
    starts[1:] = codes[1:] != codes[:-1]
    first = np.maximum.accumulate(np.where(starts, np.arange(n), 0))
    if kind == "total":
        run = np.cumsum(values)
        now = known[codes] + run - (run - values)[first]
    else:
        place = np.maximum.accumulate(np.where(values != NOTHING, np.arange(n), -1))
        now = np.where(place >= first, values[place], known[codes])
    before = np.where(starts, known[codes], np.concatenate(([0], now[:-1])))
    return before, now


class Carry(StatefulProcessor):
    """Hands every row what its key came to before it, a bucket of keys at a time."""

    def __init__(self, carried: Sequence[Carried]):
        self.carried = carried

    def init(self, handle):
        self.state = handle.getValueState("known", ", ".join(["id array<string>", *[f"{c.name} array<bigint>" for c in self.carried]]))

    def handleInputRows(self, key, rows, timerValues):
        held = self.state.get()
        ids = list(held[0]) if held else []
        known = {c.name: list(v) for c, v in zip(self.carried, held[1:])} if held else {c.name: [] for c in self.carried}
        code = {k: i for i, k in enumerate(ids)}
        frames = list(rows)
        every = pd.concat(frames, ignore_index=True) if len(frames) > 1 else frames[0]
        at = np.concatenate(([0], np.cumsum([len(f) for f in frames])))
        parts = []
        for low, high in zip(at, at[1:]):
            part = every.iloc[low:high].sort_values(list(PLACE), kind="stable")
            parts.append({**{c: part[c].tolist() for c in PLACE}, "row": part.index.tolist()})
        for chunk in self.disjoint(parts):
            some = every.iloc[chunk["row"]]
            names = np.where(some["id"].isna(), None, some["id"].to_numpy(dtype=object))
            for k in pd.unique(names).tolist():
                if k not in code:
                    code[k] = len(ids)
                    ids.append(k)
                    for c in self.carried:
                        known[c.name].append(0 if c.kind == "total" else NOTHING)
            codes = np.fromiter(map(code.__getitem__, names), dtype=np.int64, count=len(names))
            order = np.argsort(codes, kind="stable")
            codes, some = codes[order], some.iloc[order]
            out = {"id": names[order], **{c: some[c].to_numpy() for c in PLACE}}
            ends = np.flatnonzero(np.append(codes[1:] != codes[:-1], True))
            for c in self.carried:
                values, so_far = some[c.name].to_numpy(), np.array(known[c.name], dtype=np.int64)
                out[c.name] = values
                out[f"{c.name}_before"], out[f"{c.name}_now"] = _along(codes, values, so_far, c.kind)
                so_far[codes[ends]] = out[f"{c.name}_now"][ends]
                known[c.name] = so_far.tolist()
            yield pd.DataFrame(out)
        self.state.update((ids, *[known[c.name] for c in self.carried]))

    def disjoint(self, chunks: list[dict]) -> list[dict]:
        """The chunks in order; those that overlap are merged row by row."""
        chunks.sort(key=lambda c: tuple(c[p][0] for p in PLACE))
        runs: list[list[dict]] = []
        top = None
        for chunk in chunks:
            if top is not None and tuple(chunk[p][0] for p in PLACE) < top:
                runs[-1].append(chunk)
            else:
                runs.append([chunk])
            top = max(top or (), tuple(chunk[p][-1] for p in PLACE))
        out: list[dict] = []
        for run in runs:
            if len(run) > 1:
                both = {c: [x for chunk in run for x in chunk[c]] for c in run[0]}
                order = np.lexsort([np.array(both[p], dtype=np.int64) for p in reversed(PLACE)]).tolist()
                run = [{c: [both[c][i] for i in order] for c in both}]
            out += run
        return out

    def close(self):
        pass


def running(rows: DataFrame, carried: Sequence[Carried], buckets: int = BUCKETS) -> DataFrame:
    """Rows with ``<name>_now``, what is known after each, and ``<name>_before``, what was known before it."""
    schema = ", ".join(["id string", *[f"{c} bigint" for c in PLACE],
                        *[f"{c.name}{x} bigint" for c in carried for x in ("", "_before", "_now")]])
    out = bucketed(rows, carried, buckets).groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=Carry(carried), outputStructType=schema, outputMode="append", timeMode="none")

    def known(c: Carried, name: str) -> Column:
        return F.col(name) if c.kind == "total" else F.nullif(F.col(name), F.lit(NOTHING)).alias(name)

    placed = {c: F.nullif(F.col(c), F.lit(NOTHING)) for c in PLACE}
    return out.select(
        placed["event_id"].alias("event_id"), "id", placed["rank"].alias("rank"), from_micros(placed["arrival"]).alias("arrival"),
        *[known(c, f"{c.name}{x}") for c in carried for x in ("", "_now", "_before")])


def last_values(rows: DataFrame) -> DataFrame:
    """The previous value of the key, 0 at first, with every reading (event_id, id, vc, arrival)."""
    out = running(rows.withColumn("rank", F.lit(0)), [Carried("vc")])
    return out.select("event_id", "id", F.col("vc").cast("int").alias("vc"), F.coalesce("vc_before", F.lit(0)).cast("int").alias("last"),
                      "arrival")


def jump_alerts(rows: DataFrame, threshold: float = 1.7) -> DataFrame:
    """Readings further than ``threshold`` from the previous one, which starts at 0."""
    diff = F.abs(F.col("vc") - F.col("last"))
    return last_values(rows).where(diff > threshold).select("event_id", "id", "vc", diff.alias("diff"))


def running_sums(rows: DataFrame, value: str = "value", name: str = "running") -> DataFrame:
    """A running sum with every row (event_id, id, value, arrival)."""
    out = running(rows.withColumn("rank", F.lit(0)), [Carried(value, "total")])
    return out.select("event_id", "id", "arrival", value, F.col(f"{value}_now").alias(name))


def threshold_alerts(tagged: DataFrame) -> DataFrame:
    """Dynamic-threshold alerts of rules (rank 0) and readings (rank 1) in one stream."""
    out = running(tagged, [Carried("vc"), Carried("threshold_vc")])
    diff = F.abs(F.col("vc") - F.coalesce("vc_before", F.lit(0)))
    hit = (F.col("rank") == 1) & (F.col("threshold_vc_now") != 0) & (diff > F.col("threshold_vc_now"))
    return out.where(hit).select("event_id", "id", F.col("vc").cast("int").alias("vc"), diff.cast("int").alias("diff"))
