"""Running values that do not depend on any one key fitting into one task.

A running count, sum, maximum or "previous row" per key is a window function.
A window puts all rows of its key into one task, which fails when one key holds
a third of the data, or when there is no key at all. Here such keys are cut
along their order into slices of equal depth:

1. count rows per key; keys above ``rows_per_slice`` are hot, however many they are;
2. read slice boundaries off a sample of the hot rows, as tuples of *all* order columns, so that even the rows of
   one instant are cut; a key gets at most ``FAN`` slices at a time, and slices that are still too long are cut again;
3. window over (key, slice) - every row moves once, hot keys to many tasks;
4. one summary row per hot (key, slice), folded over the earlier slices of the
   key, is joined back.

Hot keys and boundaries are frames: small ones live in the plan, larger ones in a stored table, and rows find theirs by a
join on the key. Slice numbers are a fixed function of the row and of those frames, so a retried task sees the same
slices and no row has to be materialised. The number of slices is known before the plan is built: the summary is broadcast
up to ``BROADCAST_SLICES`` slices and joined by (key, slice) beyond.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brook.functions.durations import to_micros
from brook.session import shared_dir

ROWS_PER_SLICE_CONF = "spark.brook.rowsPerSlice"
ROWS_PER_SLICE = 1_000_000
SLICES_PER_PARTITION = 4  # so that hashing spreads them evenly
FAN = 256  # slices that a key is cut into at a time
FIRST_FAN = 512  # the same for a value over the whole table, whose boundaries are literals
SAMPLED = 32  # sampled rows for each boundary
SKETCH = 4_096  # size of the quantile sketch that a whole-table value's one pass takes along
BROADCAST_SLICES = 30_000
LOCAL_ROWS, LOCAL_BYTES = 1_000, 4_000_000  # frames up to here live in the plan

SLICE, HOT = "_slice", "_hot"


def rows_per_slice(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(ROWS_PER_SLICE_CONF, str(ROWS_PER_SLICE)))


def _position(df: DataFrame, name: str) -> Column:
    """The order column as a double; microseconds up to year 2255 are exact."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return to_micros(name).cast("double")
    return F.col(name).cast("double")


def _settled(frame: DataFrame) -> DataFrame | None:
    """A frame with its rows fixed: in the plan if they are few, else as a stored table; None if there are none.

    Either way the optimizer knows its size, and broadcasts it only if that is below its threshold.
    """
    spark = frame.sparkSession
    few = frame.limit(LOCAL_ROWS + 1).toArrow()
    if not few.num_rows:
        return None
    if few.num_rows <= LOCAL_ROWS and few.nbytes <= LOCAL_BYTES:
        return spark.createDataFrame(few, frame.schema)
    path = shared_dir(spark, "slices")
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def _tuple(columns: Sequence[str]) -> Column:
    return F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(columns)])


def _reached(bounds: Column, row: Column) -> Column:
    """How many of up to FAN - 1 sorted boundaries a row has reached, by binary search."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range((FAN - 1).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.coalesce(F.get(bounds, at + step - 1) <= row, F.lit(False)), at + step).otherwise(at))


def _sampled_bounds(rows: DataFrame, groups: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Boundaries of each group, which has ``_n`` rows and wants ``_want`` slices: at most FAN - 1 tuples of the order.

    They are read off a sample that a hash of the row decides, about SAMPLED rows for each boundary; they decide how
    even the slices are, never what the result is.
    """
    share = F.col("_want") * F.lit(SAMPLED * 2.0**30) / F.col("_n")
    seen = rows.where((F.col("_want") > 1) & (F.pmod(F.xxhash64(*order), F.lit(1 << 30)) < share))
    listed = seen.groupBy(*groups).agg(F.max("_want").alias("_want"), F.sort_array(F.collect_list(_tuple(order))).alias("_s"))
    picked = F.transform(F.sequence(F.lit(1), F.col("_want") - 1), lambda i: F.element_at(
        "_s", (F.floor(i * F.size("_s") / F.col("_want")) + 1).cast("int")))
    return listed.select(*groups, F.array_distinct(picked).alias("_bounds"))


@dataclass(frozen=True)
class Running:
    """One running value: how it looks inside a slice and across slices."""

    value: Callable[[Scan], Column]  # what a row contributes to the summary
    fold: Callable[[Column], Column]  # aggregate of those contributions
    local: Callable[[Scan], Column]  # the window expression inside a slice
    join: Callable[[Column, Column], Column]  # local value with the carried one
    later: bool = False  # carry comes from later slices


def _frame(s: Scan, before: bool):
    return s.window().rowsBetween(Window.unboundedPreceding, -1 if before else 0)


def total(value: Column, before: bool = False) -> Running:
    """Running sum, 0 where there is nothing yet; ``before`` leaves the row itself out.

    Sums of doubles are rounded in the order of slices, so their last digits may depend on the slicing; use whole
    numbers or decimals where every digit counts.
    """
    zero = F.lit(0)
    return Running(
        lambda s: value,
        F.sum,
        lambda s: F.coalesce(F.sum(value).over(_frame(s, before)), zero),
        lambda here, carried: here + F.coalesce(carried, zero),
    )


def position() -> Running:
    """1-based position of the row within its key."""
    return total(F.lit(1).cast("bigint"))


def highest(value: Column, before: bool = False) -> Running:
    """Running maximum of a number, timestamp or struct; nulls are ignored."""
    return Running(
        lambda s: value, F.max, lambda s: F.max(value).over(_frame(s, before)), F.greatest)


def lowest(value: Column, before: bool = False) -> Running:
    """Running minimum of a number, timestamp or struct; nulls are ignored."""
    return Running(
        lambda s: value, F.min, lambda s: F.min(value).over(_frame(s, before)), F.least)


def _placed(value: Column):
    return lambda s: F.struct(*s.order, value.alias("_v"))


def _placed_known(value: Column):
    return lambda s: F.when(value.isNotNull(), F.struct(*s.order, value.alias("_v")))


def _boxed(here: Column, carried: Column) -> Column:
    return F.when(here.isNull(), carried["_v"]).otherwise(here["_v"])


def previous(value: Column) -> Running:
    """The value on the row before, null on the first row."""
    return Running(
        _placed(value), F.max, lambda s: F.lag(F.struct(value.alias("_v"))).over(s.window()), _boxed)


def following(value: Column) -> Running:
    """The value on the row after, null on the last row."""
    return Running(
        _placed(value), F.min, lambda s: F.lead(F.struct(value.alias("_v"))).over(s.window()),
        _boxed, later=True)


def latest(value: Column, before: bool = False) -> Running:
    """The last non-null value so far; ``before`` leaves the row itself out."""
    return Running(
        _placed_known(value), F.max,
        lambda s: F.last(value, ignorenulls=True).over(_frame(s, before)),
        lambda here, carried: F.coalesce(here, carried["_v"]))


def next_known(value: Column) -> Running:
    """The first non-null value at or after the row."""
    return Running(
        _placed_known(value), F.min,
        lambda s: F.last(value, ignorenulls=True).over(
            s.window(reverse=True).rowsBetween(Window.unboundedPreceding, 0)),
        lambda here, carried: F.coalesce(here, carried["_v"]), later=True)


@dataclass(frozen=True)
class Scan:
    """Rows laid out for running values over ``keys`` in the order ``order``."""

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    sliced: bool
    slices: int = 0  # how many there are at most
    n_rows: int | None = None  # known where the whole table was counted
    facts: dict | None = None  # what the caller asked that pass for

    def window(self, reverse: bool = False):
        order = [F.col(c).desc() if reverse else F.col(c).asc() for c in self.order]
        part = [*self.keys, SLICE] if self.sliced else list(self.keys)
        return Window.partitionBy(*part).orderBy(*order)

    def _carry(self, specs: dict[str, Running], later: bool) -> DataFrame:
        """Per hot (key, slice): what its earlier (or later) slices add up to."""
        summary = self.df.where(F.col(SLICE) >= 0).groupBy(HOT, SLICE).agg(
            *[r.fold(r.value(self)).alias(f"_c_{n}") for n, r in specs.items()])
        over = Window.partitionBy(HOT).orderBy(SLICE)
        over = over.rowsBetween(1, Window.unboundedFollowing) if later else over.rowsBetween(
            Window.unboundedPreceding, -1)
        return summary.select(
            HOT, SLICE, *[r.fold(F.col(f"_c_{n}")).over(over).alias(f"_c_{n}") for n, r in specs.items()])

    def with_carry(self, df: DataFrame, carry: DataFrame) -> DataFrame:
        """Rows with what one row per hot (key, slice) says; nulls where it says nothing."""
        if self.slices <= BROADCAST_SLICES:
            return df.join(F.broadcast(carry), [HOT, SLICE], "left")
        # Rows of cold keys find nothing; their keys spread them over the tasks of the join.
        cold = F.pmod(F.xxhash64(*self.keys), F.lit(1 << 20)) if self.keys else F.lit(0)
        place = F.when(F.col(SLICE) >= 0, F.col(SLICE)).otherwise(-1 - cold)
        carry = carry.withColumnsRenamed({HOT: "_h", SLICE: "_p"})
        return df.withColumn("_at", place).join(
            carry, (F.col("_at") == F.col("_p")) & (F.coalesce(HOT, F.lit(-1)) == F.col("_h")), "left").drop("_at", "_h", "_p")

    def add(self, **specs: Running) -> Scan:
        """Append running values; they may not refer to each other."""
        df = self.df
        if self.sliced:
            for later in (False, True):
                some = {n: r for n, r in specs.items() if r.later is later}
                if some:
                    df = self.with_carry(df, self._carry(some, later))
        out = {}
        for n, r in specs.items():
            here = r.local(self)
            if self.sliced:
                out[n] = r.join(here, F.col(f"_c_{n}"))
            else:
                out[n] = here["_v"] if r.join is _boxed else here
        df = df.withColumns(out).drop(*[f"_c_{n}" for n in specs])
        return replace(self, df=df)

    def with_column(self, name: str, value: Column) -> Scan:
        return replace(self, df=self.df.withColumn(name, value))

    def rows(self) -> DataFrame:
        return self.df.drop(SLICE, HOT)


def scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slice_rows: int | None = None,
    profile: DataFrame | None = None,
    facts: dict[str, Column] | None = None,
) -> Scan:
    """Lay out ``df`` for running values per ``keys`` in the order ``order``.

    ``order`` must be unique within a key. An empty ``keys`` means one running value over the whole frame; then the
    first column of the order must be a number or a timestamp. ``profile`` may name a cheaper frame with the same
    keys and the same values of the order, or of its first columns, to count on; for a keyed value it may lack the
    order, and boundaries of hot keys then come from ``df``. A whole-table value takes one eager pass, which also
    answers ``facts``, aggregates over the profile.
    """
    profile = df if profile is None else profile
    keys, order = tuple(keys), tuple(order)
    size = slice_rows or rows_per_slice(df)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if not keys:
        return _whole(df, order, size, parts, profile, facts or {})

    counts = profile.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > size)
    hot = _settled(counts.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_n",
        (F.monotonically_increasing_id() + 1).alias(HOT)))
    if hot is None:
        return Scan(df, keys, order, False)
    if not _known(profile, order):
        profile = df
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    names = [f"_k{i}" for i in range(len(keys))]
    n_hot, top = hot.agg(F.sum("_n"), F.max("_n")).first()
    even = F.ceil(F.col("_n") * (SLICES_PER_PARTITION * parts / n_hot))
    hot = hot.withColumn("_want", F.least(F.lit(FAN), F.greatest(F.ceil(F.col("_n") / size), even, F.lit(2))).cast("int"))

    marked = profile.join(hot, same).drop(*names)
    bounds = _settled(_sampled_bounds(marked, [HOT], _known(profile, order)))
    cuts = hot if bounds is None else hot.join(bounds, HOT, "left")
    if bounds is None:
        cuts = cuts.withColumn("_bounds", F.array().cast(f"array<{_tuple_type(profile, order)}>"))

    def cut(rows: DataFrame) -> DataFrame:
        found = rows.join(cuts.drop("_n", "_want"), same, "left").drop(*names)
        at = F.coalesce(_reached(F.col("_bounds"), _tuple(_known(profile, order))), F.lit(0)).cast("bigint")
        return found.withColumn(SLICE, F.when(F.col(HOT).isNull(), F.lit(-1).cast("bigint")).otherwise(at)).drop("_bounds")

    estimate = hot.select(HOT, (F.col("_n") / F.col("_want")).alias("_each"))
    slices = hot.agg(F.sum("_want")).first()[0]
    laid, seen = cut(df), cut(profile)
    deep = math.ceil(top / min(FAN, max(2, math.ceil(top / size))))
    while deep > 2 * size:
        laid, seen, estimate, more = _cut_again(laid, seen, estimate, [HOT], order, size)
        slices, deep = slices + more, math.ceil(deep / FAN)
    return Scan(laid, keys, order, True, slices)


def _known(profile: DataFrame, order: Sequence[str]) -> list[str]:
    """The first columns of the order that the profile has."""
    out = []
    for c in order:
        if c not in profile.columns:
            break
        out.append(c)
    return out


def _tuple_type(profile: DataFrame, order: Sequence[str]) -> str:
    return profile.select(_tuple(_known(profile, order)).alias("t")).schema["t"].dataType.simpleString()


def _cut_again(laid: DataFrame, seen: DataFrame, estimate: DataFrame, on: Sequence[str], order: Sequence[str], size: int):
    """Cuts the slices of ``estimate`` (``on``, rows expected in each) into up to FAN each; numbers stay in order."""
    wanted = estimate.select(
        *on, F.col("_each").alias("_n"),
        F.least(F.lit(FAN), F.ceil(F.col("_each") / size)).cast("int").alias("_want")).where("_want > 1")
    columns = _known(seen, order)
    bounds = _settled(_sampled_bounds(seen.where(f"{SLICE} >= 0").join(wanted, list(on)), [HOT, SLICE], columns))
    if bounds is None:
        return laid, seen, estimate, 0

    def cut(rows: DataFrame) -> DataFrame:
        found = rows.join(bounds, [HOT, SLICE], "left")
        at = F.coalesce(_reached(F.col("_bounds"), _tuple(columns)), F.lit(0))
        return found.withColumn(SLICE, F.when(F.col(SLICE) < 0, F.col(SLICE)).otherwise(F.col(SLICE) * FAN + at)).drop("_bounds")

    more = bounds.agg(F.sum(F.size("_bounds"))).first()[0]
    return cut(laid), cut(seen), estimate.withColumn("_each", F.col("_each") / FAN), more


def _whole(df: DataFrame, order: tuple[str, ...], size: int, parts: int, profile: DataFrame, facts: dict[str, Column]) -> Scan:
    """Slices over the whole frame: along the first column, instants that fill slices of their own along the others."""
    sketch = F.kll_sketch_agg_double(_position(profile, order[0]), F.lit(SKETCH))
    seen = profile.agg(F.count("*").alias("n"), sketch.alias("q"), *[c.alias(f"f_{k}") for k, c in facts.items()])
    grid = F.expr(f"array({', '.join(f'{i / FIRST_FAN!r}D' for i in range(1, FIRST_FAN))})")
    seen = seen.withColumn("q", F.when(
        F.kll_sketch_get_n_double("q") > 0, F.kll_sketch_get_quantile_double("q", grid))).first()
    n_rows, on_grid = seen["n"], seen["q"] or []
    n = min(FIRST_FAN, max(SLICES_PER_PARTITION * parts, math.ceil(n_rows / size)))
    quantiles = [on_grid[i * FIRST_FAN // n - 1] for i in range(1, n)] if on_grid else []
    known = {k: seen[f"f_{k}"] for k in facts}

    held: dict[float, int] = {}  # boundaries that fall on one instant
    for q in quantiles:
        held[q] = held.get(q, 0) + 1
    crowded = {q: k for q, k in held.items() if k > 1}
    edges = sorted({*held, *(math.nextafter(q, math.inf) for q in crowded)})
    laid = _bucket(df.withColumn(HOT, F.lit(0).cast("bigint")), _position(df, order[0]), edges)
    out = Scan(laid, (), order, True, len(edges) + 1, n_rows, known)
    if len(_known(profile, order)) < 2:
        crowded = {}  # nothing but the first column to cut by

    # Crowded instants, and all slices if they are still too long, are cut along the whole order.
    each = n_rows / max(1, n)
    long = {i: each for i in range(len(edges) + 1)} if each > 2 * size else {}
    long |= {edges.index(q) + 1: max(each * (k + 1), 1.0) for q, k in crowded.items()}
    cut = _bucket(profile.withColumn(HOT, F.lit(0).cast("bigint")), _position(profile, order[0]), edges)
    goal = size if each > 2 * size else max(1, min(size, int(each)))
    while long:
        estimate = df.sparkSession.createDataFrame([(0, i, float(x)) for i, x in long.items()], f"{HOT} long, {SLICE} long, _each double")
        laid, cut, _, more = _cut_again(laid, cut, estimate, [HOT, SLICE], order, goal)
        out = replace(out, df=laid, slices=out.slices + more)
        if not more:
            break
        long = {i * FAN + j: x / FAN for i, x in long.items() if x / FAN > 2 * goal for j in range(FAN)}
    return out


def _bucket(df: DataFrame, place: Column, cut: list[float]) -> DataFrame:
    """Number of the slice each row falls into; rows without a place come first."""
    if not cut:
        return df.withColumn(SLICE, F.lit(0).cast("bigint"))
    edges = [-math.inf, *cut, math.inf]
    placed = df.withColumn("_x", F.coalesce(place, F.lit(-math.inf)))
    placed = Bucketizer(splits=edges, inputCol="_x", outputCol="_b").transform(placed)
    return placed.withColumn(SLICE, F.col("_b").cast("bigint")).drop("_x", "_b")
