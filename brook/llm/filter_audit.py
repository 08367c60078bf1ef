"""How filters interact: every order of a set of filters at once, from the counts of their failure masks.

A document's failures are a mask of one bit a filter. Rows are aggregated to cells, one a (part, mask) with its documents,
its good and its toxic ones: 2^k cells a part at most, with partial sums before the exchange. What survives a set S of filters
is the sum of the cells whose mask meets no filter of S. A Gray-code walk visits all sets so that one filter is switched at
each step: every cell holds the number of its failures among the filters that are on, a cell whose number leaves 0 is
taken from the running survivors and one that comes back to 0 is added again. The 2^k states are stored; each order's steps
are differences of two of them. The walk takes all parts of a batch at once.

Copies: `repeats` finds rows whose text stands under a smaller doc_id by a 256-bit hash of the text. The row of the smallest id
is found by an equi-join on (hash, id), so a text that a third of all rows share is no hot key: its rows differ in their ids,
and equal rows are counted before.

Defined cases: a null text is an empty one; an empty text fails A and no other filter but E; a null source is the part ''; a null
doc_id has no smaller one, is none, and has no label; rows of one doc_id count each, also if they are equal; several labels of
one doc_id: good or toxic if any says so; an empty table gives no part, so no row; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brook.llm.common import stored, table
from brook.session import shared_dir

FILTERS = "ABCDE"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def text_failures(text: Column) -> dict[str, Column]:
    """Filters A to D as conditions on a text that is not null; words are runs of other bytes than ASCII white space."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    signs = F.length(text) - F.length(F.translate(text, "#$%&*|", ""))
    return {
        "A": n < 50,
        "B": 100 * distinct < 65 * n,
        "C": 100 * capitals > 5 * F.length(text),
        "D": signs > 0,
    }


def masks(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, and per distinct row: n, good, toxic (documents, those with the label)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"), text.alias("text"))
    failed = text_failures(F.col("text"))
    mask = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(failed.values())), F.lit(0))
    rows = rows.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("h"))
    rows = stored(spark, rows.groupBy("doc_id", "part", "mask", "h").agg(F.count("*").alias("n")),
                  shared_dir(spark, "filter-audit"))
    first = rows.filter("doc_id is not null").groupBy("h").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = rows.join(first, ["h", "doc_id"], "left").join(marks, "doc_id", "left")
    again = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return rows.select(
        "part", (F.col("mask") + F.when(again, 16).otherwise(0)).alias("mask"), "n",
        (F.col("n") * F.coalesce("good", F.lit(0))).alias("good"), (F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"))


def survivors(cells: np.ndarray) -> np.ndarray:
    """What survives each set of filters, from cells[part, mask, count]: out[part, set, count]."""
    parts, n, kinds = cells.shape
    mask = np.arange(n)
    failing = np.zeros(n, dtype=np.int64)  # failures of each cell among the filters that are on
    running = cells.sum(axis=1)
    out = np.empty((parts, n, kinds), dtype=np.int64)
    out[:, 0] = running
    on = 0
    for step in range(1, n):
        bit = (step & -step).bit_length() - 1  # the Gray code's next switch
        hit = mask >> bit & 1 != 0
        if on >> bit & 1:
            failing[hit] -= 1
            running = running + cells[:, hit & (failing == 0)].sum(axis=1)
        else:
            running = running - cells[:, hit & (failing == 0)].sum(axis=1)
            failing[hit] += 1
        on ^= 1 << bit
        out[:, on] = running
    return out


def audit(rows: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from rows of (part, mask, n, good, toxic)."""
    k = len(filters)
    cells = rows.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
    packed = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    orders = list(permutations(range(k)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                grid = np.zeros((some.num_rows, 1 << k, 3), dtype=np.int64)
                for i, listed in enumerate(some.column("cells").to_pylist()):
                    for c in listed:
                        grid[i, c["mask"]] = c["n"], c["good"], c["toxic"]
                yield from _steps(some.column("part").to_pylist(), grid)

    def _steps(parts: list[str], grid: np.ndarray) -> Iterator[pa.RecordBatch]:
        state = survivors(grid)
        failing = [grid[:, (np.arange(1 << k) >> f & 1) != 0, 0].sum(axis=1) for f in range(k)]
        lost = np.zeros((len(parts), len(orders), k, 3), dtype=np.int64)
        left = np.zeros((len(parts), len(orders), k), dtype=np.int64)
        for o, order in enumerate(orders):
            on = 0
            for s, f in enumerate(order):
                lost[:, o, s] = state[:, on] - state[:, on | 1 << f]
                on |= 1 << f
                left[:, o, s] = state[:, on, 0]
        total = [sum(lost[:, o, order.index(f), 0] for o, order in enumerate(orders)) for f in range(k)]
        names = ["".join(filters[f] for f in order) for order in orders]
        for i, part in enumerate(parts):
            of = [f for order in orders for f in order]
            gone = lost[i].reshape(-1, 3)
            columns = {
                "part": [part] * len(of), "filter_order": [x for x in names for _ in range(k)],
                "step": pa.array([s + 1 for _ in orders for s in range(k)], pa.int32()),
                "kept": left[i].reshape(-1), "removed": gone[:, 0],
                "redundant": np.array([failing[f][i] for f in of]) - gone[:, 0],
                "unique_fails": [int(grid[i, 1 << f, 0]) for f in of], "good_lost": gone[:, 1], "toxic_lost": gone[:, 2],
                "shapley": [int(total[f][i]) for f in of],
            }
            yield pa.RecordBatch.from_pydict(columns)

    assert factorial(k) == len(orders) <= 5040
    return packed.mapInArrow(
        run, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract: filters A to E over `documents`, with the labels' quality and toxic."""
    return audit(masks(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


OP13_SQL = r"""
WITH marks AS (
  SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
flags AS (
  SELECT part, doc_id,
    CASE WHEN len(w) < 50 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) THEN 'E' ELSE '' END AS f
  FROM words),
cells AS (
  SELECT part, f, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM flags LEFT JOIN marks USING (doc_id) GROUP BY part, f),
letters(l) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps AS (
  SELECT filter_order, step, filter_order[step] AS l, filter_order[1:step - 1] AS earlier
  FROM orders, range(1, 6) r(step)),
counted AS (
  SELECT part, filter_order, step, l,
    sum(CASE WHEN translate(f, earlier || l, '') = f THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN contains(f, l) AND translate(f, earlier, '') = f THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN contains(f, l) AND translate(f, earlier, '') <> f THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN f = l THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN contains(f, l) AND translate(f, earlier, '') = f THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN contains(f, l) AND translate(f, earlier, '') = f THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, l)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, l) AS BIGINT) AS shapley
FROM counted
"""
