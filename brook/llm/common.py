"""Helpers shared by the corpus operators.

The word rule of several operators is fixed by their contracts: A-Z becomes a-z and a word is a maximal run of
digits, a-z and non-ASCII characters. On UTF-8 bytes that is one translation table and one split.
"""

from __future__ import annotations

import ctypes
import gc
import threading
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

_WORD = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
#: Lower-cases A-Z and turns every byte outside a word into a blank.
WORD_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _WORD else 0x20 for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: bytes | None) -> list[bytes]:
    """The words of a text in UTF-8, lower-cased; none for null."""
    return text.translate(WORD_TABLE).split() if text else []


def utf8(name: str = "text") -> Column:
    """A text column as bytes: Python then pays no decoding."""
    return F.col(name).cast("binary")


def stored(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Writes a table into the shared folder and reads it back: the lineage ends there.

    The shuffle files of this write are of no further use, so the engine removes them at its end.
    """
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(setting, before) if before is not None else spark.conf.unset(setting)
    return spark.read.parquet(path)


def crc_mod(name: str, m: int) -> Column:
    """crc32 of the id as text, mod m; null ids give null."""
    return F.crc32(F.col(name).cast("string").cast("binary")) % m


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches so that a slice holds about `most_bytes` of one binary column (one row at least)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(sizes.tolist()):
            if i > start and held + n > most_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if batch.num_rows > start:
            yield batch.slice(start)


_kept: list = [(), None]


def kept(make: Callable[[], object], *sources: object) -> object:
    """What a worker process keeps between tasks, made from these very objects.

    It keeps that of one operator at a time, so that what stages keep doesn't add up.
    """
    held = _kept[0]
    if len(held) != len(sources) or any(a is not b for a, b in zip(held, sources, strict=True)):
        _kept[:] = [(), None]  # the old one goes before the new one is made
        _kept[:] = [sources, make()]
    return _kept[1]


IDLE_SECONDS = 3
_turn = [0]


def _rest() -> None:
    """A worker process that gets no new task for a while lets go of what it keeps: the next stage needs the memory."""
    _turn[0] += 1
    mine = _turn[0]

    def drop() -> None:
        if _turn[0] == mine:
            _kept[:] = [(), None]
            give_back()

    timer = threading.Timer(IDLE_SECONDS, drop)
    timer.daemon = True
    timer.start()


def carried(df: DataFrame, columns: list[str], more: str) -> StructType:
    """A schema of columns that pass through Python and of new ones."""
    fresh = StructType.fromDDL(more)
    return StructType([StructField(c, df.schema[c].dataType) for c in columns] + fresh.fields)


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: StructType | str,
                column: str = "text", most_bytes: int = 16 << 20) -> DataFrame:
    """mapInArrow over slices that are bounded in bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _turn[0] += 1
        try:
            for part in slices(batches, column, most_bytes):
                out = work(part)
                if out is not None:
                    yield out
        finally:
            _rest()

    return df.mapInArrow(run, schema)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: well spread, the same on every machine."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64, copy=True)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def unit(x: np.ndarray) -> np.ndarray:
    """64-bit values to the open interval (0, 1)."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of two sets of whole vectors, as longs; beyond a long they stop at its ends."""
    most = float(np.abs(a.astype(np.float64)).max(initial=0)) * float(np.abs(b.astype(np.float64)).max(initial=0)) * a.shape[1]
    if most < 2**53:  # then doubles hold them
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if most < 2**62:
        return a @ b.T
    return np.clip(a.astype(object) @ b.T.astype(object), -(2**63), 2**63 - 1).astype(np.int64)


def give_back() -> None:
    """Memory that Python, Arrow and the C library hold but no longer use goes back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def segment_starts(lengths: np.ndarray) -> np.ndarray:
    """Offsets of consecutive segments, with the end as the last value."""
    return np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
