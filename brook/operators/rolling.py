"""Aggregates without windows: grouped totals and one running result per row."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brook.functions.text import words
from brook.operators import scan as S
from brook.session import shared_dir


def tokenize(lines: DataFrame, line: str = "line", keep: Sequence[str] = ()) -> DataFrame:
    """One (word, 1) pair per word of every line."""
    return lines.select(*keep, F.explode(words(line)).alias("word")).where("word <> ''").withColumn(
        "one", F.lit(1).cast("bigint"))


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    """Rows per key; partial counts are taken before the exchange."""
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def word_count(lines: DataFrame, line: str = "line") -> DataFrame:
    return tokenize(lines, line).groupBy("word").agg(F.sum("one").alias("n"))


def rolling_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str | Column,
                name: str = "running") -> DataFrame:
    """One updated sum per record of the key."""
    value = F.col(value) if isinstance(value, str) else value
    return S.scan(df, keys, order).add(**{name: S.total(value)}).rows()


def rolling_count(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  name: str = "running") -> DataFrame:
    return S.scan(df, keys, order).add(**{name: S.position()}).rows()


def rolling_reduce(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                   combine: str = "sum", name: str = "running") -> DataFrame:
    """Running reduce with a known combiner: ``sum``, ``min`` or ``max``."""
    made = {"sum": S.total, "min": S.lowest, "max": S.highest}[combine](F.col(value))
    return S.scan(df, keys, order).add(**{name: made}).rows()


def prefixes(ends: DataFrame, value: str, combine: Callable[[Column, Column], Column], keys: Sequence[str] = (S.HOT,),
             place: str = S.SLICE) -> DataFrame:
    """(keys, place, ``value``): what everything before each place of a key combines to; the first place has no row.

    A parallel prefix: after round i a place holds the last 2^i values up to it, so that each round is one join of places
    that lie 2^i apart and ``combine`` runs on the executors. Rounds are stored, as each reads the one before twice.
    ``combine`` must be associative; it need not commute.
    """
    spark, root = ends.sparkSession, shared_dir(ends.sparkSession, "prefixes")

    def stored(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{root}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{root}/{name}")

    back = {f"_g{i}": k for i, k in enumerate(keys)} | {"_p": place, "_v": value}
    keys = [f"_g{i}" for i in range(len(keys))]  # the layout below has slices of its own
    ends = ends.select(*[F.col(c).alias(n) for n, c in back.items()])
    spot = S.scan(ends.select(*keys, "_p"), keys, ["_p"]).add(_i=S.position()).rows()
    rows = stored(ends.join(spot, [*keys, "_p"]), "0")
    most = rows.agg(F.max("_i")).first()[0] or 0
    step, n = 1, 1
    while step < most:
        left = rows.select(*keys, (F.col("_i") + step).alias("_i"), F.struct("_v").alias("_l"))
        both = rows.join(left, [*keys, "_i"], "left")
        joined = both.where("_l is not null").withColumn("_v", combine(F.col("_l")["_v"], F.col("_v")))
        both = joined.unionAll(both.where("_l is null"))
        rows = stored(both.select(*keys, "_p", "_v", "_i"), str(n))
        step, n = 2 * step, n + 1
    following = spot.select(*keys, "_p", (F.col("_i") - 1).alias("_i"))
    found = rows.select(*keys, "_v", "_i").join(following, [*keys, "_i"])
    return found.select(*[F.col(n).alias(c) for n, c in back.items()])


def rolling_fold(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                 combine: Callable[[object, object], object], name: str = "running") -> DataFrame:
    """Running reduce with any associative Python combiner, which need not commute and whose values may grow.

    Folded along sorted partitions, one value held at a time. A hot key is folded slice by slice; what its earlier
    slices combine to is found by ``prefixes`` and put in front.
    """
    laid = S.scan(df, keys, order)
    part = [*keys, S.SLICE] if laid.sliced else list(keys)
    kind = df.schema[value].dataType.simpleString()
    named = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in laid.df.schema)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, held = None, None
        for pdf in batches:
            out = []
            for place, v in zip(pdf[part].itertuples(index=False, name=None), pdf[value].tolist()):
                held = combine(held, v) if place == current else v
                current = place
                out.append(held)
            yield pdf.assign(**{name: out})

    folded = laid.df.repartition(*part).sortWithinPartitions(*part, *order).mapInPandas(
        fold, f"{named}, `{name}` {kind}")
    if not laid.sliced:
        return folded

    @F.pandas_udf(kind)
    def combined(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([combine(x, y) for x, y in zip(a.tolist(), b.tolist())], dtype=object)

    path = shared_dir(df.sparkSession, "folded")
    folded.write.parquet(path)  # read twice, and a Python fold is not repeated for that
    folded = df.sparkSession.read.schema(folded.schema).parquet(path)
    ends = folded.where(F.col(S.SLICE) >= 0).groupBy(S.HOT, S.SLICE).agg(F.max_by(name, F.struct(*order)).alias("_before"))
    joined = laid.with_carry(folded, prefixes(ends, "_before", combined))
    first = joined.where("_before is null").drop("_before")
    later = joined.where("_before is not null").withColumn(name, combined(F.col("_before"), F.col(name))).drop("_before")
    return first.unionAll(later.select(*first.columns)).drop(S.HOT, S.SLICE)


def rolling_extreme(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                    kind: str, record: Sequence[str] = ()) -> DataFrame:
    """Running ``min`` / ``max`` of one field, or of the whole record holding it.

    With ``record`` the result is the record that holds the extreme, the first
    such record on a tie. Without it only the field is tracked.
    """
    scan = S.scan(df, keys, order)
    spec = {"min": S.lowest, "max": S.highest}[kind]
    if not record:
        return scan.add(**{f"{kind}_{value}": spec(F.col(value))}).rows()
    rest = [c for c in record if c not in (value, *order)]
    if kind == "min":
        held = F.struct(F.col(value).alias("_x"), *order, *rest)
        out = scan.add(_best=S.lowest(held)).rows()
    else:
        # The first record wins a tie: the record of a new strict maximum is
        # kept until a greater value comes.
        top = scan.add(_top=S.highest(F.col(value), before=True))
        new = F.col("_top").isNull() | (F.col(value) > F.col("_top"))
        held = F.when(new, F.struct(F.col(value).alias("_x"), *order, *rest))
        out = top.add(_best=S.latest(held)).rows().drop("_top")
    picked = [F.col("_best")["_x" if c == value else c].alias(f"best_{c}") for c in record]
    return out.select(*keys, *[c for c in order if c not in keys], *picked)


def running_total(df: DataFrame, order: Sequence[str], name: str = "running") -> DataFrame:
    """Running number of rows over the whole frame."""
    return S.scan(df, [], order).add(**{name: S.position()}).rows()


def running_distinct(df: DataFrame, member: str, order: Sequence[str],
                     name: str = "running") -> DataFrame:
    """Running number of different members: first sightings, then a running sum."""
    seen = S.scan(df, [member], order).add(_nth=S.position()).rows()
    first = F.when(F.col("_nth") == 1, 1).otherwise(0).cast("bigint")
    return (
        S.scan(seen, [], order, profile=df.select(*order))
        .add(**{name: S.total(first)}).rows().drop("_nth")
    )


def approximate_distinct(df: DataFrame, member: str, name: str = "uv", digits: int = 3) -> DataFrame:
    """Different members from the smallest hash in each of 16 ** digits buckets; the standard error is 4 ** -digits.

    One row a bucket and task travels, whatever the number of members. While a twentieth of the buckets is empty, their
    share gives the count; beyond, the mean of the minima does, corrected by that share. Null is no member.
    """
    buckets, unit = 16**digits, 2**48
    hashed = F.md5(F.col(member).cast("string").cast("binary"))
    least = df.where(F.col(member).isNotNull()).groupBy(F.substring(hashed, 1, digits).alias("_b")).agg(
        F.min(F.substring(hashed, digits + 1, 12)).alias("_h"))
    full, minima = F.count("*"), F.coalesce(F.sum(F.conv("_h", 16, 10).cast("bigint")), F.lit(0))
    empty = F.lit(buckets) - full
    by_share = F.lit(float(buckets)) * F.log(F.lit(float(buckets)) / F.greatest(empty, F.lit(1)))
    by_minima = F.lit(float(buckets - 1)) * full * F.lit(float(unit)) / (minima + empty * F.lit(unit))
    return least.agg(F.round(F.when(empty * 20 >= buckets, by_share).otherwise(by_minima)).cast("bigint").alias(name))


def bitmap_members(df: DataFrame, member: str, groups: Sequence[Column] = ()) -> DataFrame:
    """The members of each group as bitmaps: one row of at most 4 KB per group and range of 32,768 numbers.

    Members are whole numbers; null is none. Bitmaps of panes or batches merge with ``merge_bitmaps``.
    """
    known = df.where(F.col(member).isNotNull())
    return known.groupBy(*groups, F.bitmap_bucket_number(member).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(member)).alias("members"))


def merge_bitmaps(bitmaps: DataFrame, *groups: str) -> DataFrame:
    """Bitmaps of coarser groups."""
    return bitmaps.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("members").alias("members"))


def count_bitmaps(bitmaps: DataFrame, *groups: str, name: str = "uv") -> DataFrame:
    """Exact number of different members of each group."""
    return bitmaps.groupBy(*groups).agg(F.coalesce(F.sum(F.bitmap_count("members")), F.lit(0)).alias(name))


def count_average(df: DataFrame, key: str, order: Sequence[str], value: str, n: int = 2) -> DataFrame:
    """Average of every ``n`` readings of a key; an incomplete tail gives nothing."""
    placed = S.scan(df.select(key, *order, value), [key], order).add(_pos=S.position()).rows()
    block = F.floor((F.col("_pos") - 1) / n).cast("bigint")
    return (
        placed.groupBy(key, block.alias("block"))
        .agg(F.count("*").alias("n"), F.avg(value).alias("avg"))
        .where(F.col("n") == n)
    )


def buffer_release(df: DataFrame, order: Sequence[str], n: int = 3) -> DataFrame:
    """Rows released ``n`` at a time in arrival order; the tail stays held."""
    scan = S.scan(df, [], order)
    placed = scan.add(_pos=S.position()).rows()
    return (
        placed.where(F.col("_pos") <= scan.n_rows // n * n)
        .withColumn("batch_no", F.floor((F.col("_pos") - 1) / n).cast("bigint")).drop("_pos")
    )
