"""Hard negatives by shared lists of anchor clusters.

Anchors are grouped into blocks of similar direction. For a block with centre c, whose members lie within the angle b of it,
a candidate v at the angle t from c scores at most |u| * |v| * cos(max(0, t - b)) with any member u (the triangle
inequality of angles). Candidates are sorted once a block by |v| * cos(max(0, t - b)); every member walks that one list
and ends, certified, when |u| times the next bound is below the score it still needs. Members need the k-th best
score found so far or, for negatives, the lower end of their window, whichever is more.

The walk is the same for both questions. Positives: the best rows of the anchor's label. Negatives: for each positive, the best rows
of other labels whose score lies in a window between two shares of the positive's score.

Distribution: candidates are packed into parts of one cell (nearest of at most `CELLS` centres, fitted on at most `SAMPLE`
anchors; they only decide how well lists prune), cut by a hash of id and vector, so a part has `PART` / 2 rows on average whatever
repeats. Anchors are broadcast in waves of at most `WAVE` components; parts stay where they are, and a task walks its
parts for all blocks of the wave and returns at most k rows an anchor and positive. A bounded random table of `SEED` rows is walked
first by each worker, so that lists end early from the start. Every wave is written before the next begins.

Defined cases: rows with a null id, a null label, a null or empty vector, or a null, NaN or infinite component take no part;
components beyond a long stop at its ends, and so do scores; vectors of another size than the anchor's score nothing with it; a
repeated anchor id is one anchor (its smallest size, label, vector), and rows of the anchor's id are none of its candidates; other
rows of one id count separately (k copies of equal rows are kept, more can't be in a result); ties go to the smaller id; where
fewer rows fit, fewer are returned; a positive score of 0 or less has a window of at most one score; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brook.llm.common import kept, products, stored, table
from brook.session import shared_dir

POSITIVES, NEGATIVES, SCALE = 5, 10, 256
LOWER, UPPER = (30, 100), (90, 100)  # shares of the positive's score between which a negative's lies
CELLS, SAMPLE, PART, BLOCK, SEED, WAVE, STEP = 64, 4_096, 2_048, 256, 2_048, 4_000_000, 256
_LOW, _HIGH = -(2**63), 2**63 - 1


def integral(vectors: DataFrame, most: int, scale: int = SCALE) -> DataFrame:
    """vec_id, label, v (array<long>), dim, copies of the rows that take part; at most `most` copies of equal rows count."""
    values = F.transform("embedding", lambda x: x.cast("double"))
    good = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)
            & F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    ints = F.transform(values, lambda x: F.floor(x * scale).cast("long"))
    rows = vectors.filter(good).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                                       ints.alias("v"))
    return rows.groupBy("vec_id", "label", "v").agg(F.least(F.count("*"), F.lit(most)).cast("int").alias("copies")).withColumn(
        "dim", F.size("v"))


# -- the walk ---------------------------------------------------------------------------------------------------------

def _matrix(flat: np.ndarray, dim: int) -> np.ndarray:
    return np.asarray(flat, dtype=np.int64).reshape(-1, dim)


def _norms(v: np.ndarray) -> np.ndarray:
    return np.sqrt((v.astype(np.float64) ** 2).sum(axis=1))


@dataclass
class Part:
    """Candidates of one size."""

    ids: np.ndarray
    labels: np.ndarray
    copies: np.ndarray
    v: np.ndarray

    def __post_init__(self):
        self.norm = _norms(self.v)
        self.unit = self.v / np.maximum(self.norm, 1e-300)[:, None]


class Block:
    """Anchors of similar direction and what is asked of them: probes (anchor, lo, hi, same label or another)."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, v: np.ndarray, probes: np.ndarray):
        self.ids, self.labels, self.v, self.norm = ids, labels, v, _norms(v)
        self.anchor, self.lo, self.hi = probes  # place in the block, window
        unit = v / np.maximum(self.norm, 1e-300)[:, None]
        middle = unit.sum(axis=0)
        size = np.sqrt((middle**2).sum())
        self.centre = middle / size if size > 0 else middle
        cosine = (unit @ self.centre)[self.norm > 0]
        self.angle = float(np.arccos(np.clip(cosine, -1, 1)).max(initial=0)) if size > 0 else np.pi

    def shared_list(self, part: Part) -> tuple[np.ndarray, np.ndarray]:
        """Candidates by falling bound for a member of norm 1, and the bounds; 1e-6 covers rounding of the angles."""
        apart = np.arccos(np.clip(part.unit @ self.centre, -1, 1)) - self.angle - 1e-6
        bound = part.norm * np.cos(np.maximum(apart, 0)) * (1 + 1e-9)
        bound = np.where(bound < 0, bound * (1 - 2e-9), bound)
        order = np.argsort(-bound, kind="stable")
        return order, bound[order]


class Best:
    """The k best (score, id) of each probe."""

    def __init__(self, probes: int, k: int, floor: np.ndarray | None = None):
        self.k, self.n = k, np.zeros(probes, dtype=np.int64)
        self.score = np.full((probes, k), _LOW, dtype=np.int64)
        self.id = np.zeros((probes, k), dtype=np.int64)
        self.floor = np.full(probes, _LOW, dtype=np.int64) if floor is None else floor.copy()

    def add(self, probe: np.ndarray, score: np.ndarray, who: np.ndarray) -> None:
        touched = np.unique(probe)
        row, col = np.nonzero(np.arange(self.k)[None, :] < self.n[touched][:, None])
        probe = np.concatenate((probe, touched[row]))
        score = np.concatenate((score, self.score[touched[row], col]))
        who = np.concatenate((who, self.id[touched[row], col]))
        order = np.lexsort((who, ~score, probe))  # ~x falls as x grows, without overflow
        probe, score, who = probe[order], score[order], who[order]
        starts = np.flatnonzero(np.concatenate(([True], probe[1:] != probe[:-1])))
        place = np.arange(len(probe)) - np.repeat(starts, np.diff(np.append(starts, len(probe))))
        good = place < self.k
        probe, place = probe[good], place[good]
        self.score[probe, place], self.id[probe, place] = score[good], who[good]
        np.maximum.at(self.n, probe, place + 1)
        full = touched[self.n[touched] == self.k]
        self.floor[full] = np.maximum(self.floor[full], self.score[full, self.k - 1])


def walk(block: Block, first: int, part: Part, best: Best, same: bool) -> int:
    """Every member walks the block's list of a part until it is certain that nothing better follows.

    first: number of the block's first probe in `best`. Returns the number of products.
    """
    probes = first + np.arange(len(block.anchor))
    order, bound = block.shared_list(part)
    at, made = 0, 0
    while at < len(order):
        open_ = block.norm[block.anchor] * bound[at] >= np.maximum(best.floor[probes], block.lo).astype(np.float64)
        if not open_.any():
            break
        members, which = np.unique(block.anchor[open_], return_inverse=True)
        some = order[at:at + STEP]
        score = products(block.v[members], part.v[some])
        made += score.size
        fits = (block.labels[members][:, None] == part.labels[some][None, :]) == same
        fits &= block.ids[members][:, None] != part.ids[some][None, :]
        asked = probes[open_]
        least = np.maximum(best.floor[asked], block.lo[open_])
        mine = score[which]
        hit, col = np.nonzero(fits[which] & (mine >= least[:, None]) & (mine <= block.hi[open_][:, None]))
        if len(hit):
            times = part.copies[some][col]
            best.add(np.repeat(asked[hit], times), np.repeat(mine[hit, col], times), np.repeat(part.ids[some][col], times))
        at += len(some)
    return made


# -- distribution -----------------------------------------------------------------------------------------------------

def _vectors(rows: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, places, matrix) for each size of vector in a table."""
    dims = rows.column("dim").to_numpy()
    for d in np.unique(dims).tolist():
        at = np.flatnonzero(dims == d)
        lists = rows.column("v").take(pa.array(at)).combine_chunks()
        flat = lists.flatten() if isinstance(lists, pa.Array) else pa.concat_arrays([c.flatten() for c in lists.chunks])
        yield d, at, _matrix(flat.to_numpy(zero_copy_only=False), d)


def centres(anchors: DataFrame) -> dict[int, np.ndarray]:
    """Directions that cells are named by, for each size of vector in a bounded sample of anchors."""
    sample = anchors.select("dim", "v", "vec_id").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()
    out = {}
    for d, _, v in _vectors(sample):
        unit = v / np.maximum(_norms(v), 1e-300)[:, None]
        middle = unit[:max(1, min(CELLS, len(unit) // 64))]
        for _ in range(6):
            near = (unit @ middle.T).argmax(axis=1)
            moved = np.stack([unit[near == c].sum(axis=0) if (near == c).any() else middle[c] for c in range(len(middle))])
            middle = moved / np.maximum(np.sqrt((moved**2).sum(axis=1)), 1e-300)[:, None]
        out[d] = middle
    return out


def with_cells(rows: DataFrame, middles: dict[int, np.ndarray]) -> DataFrame:
    """Adds the number of the nearest centre; sizes without centres are one cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.zeros(batch.num_rows, dtype=np.int32)
            for d, at, v in _vectors(pa.Table.from_batches([batch])):
                if d in middles:
                    cell[at] = (v @ middles[d].T).argmax(axis=1)
            yield batch.append_column("cell", pa.array(cell))

    fields = "vec_id long, label long, v array<long>, copies int, dim int, cell int"
    return rows.select("vec_id", "label", "v", "copies", "dim").mapInArrow(run, fields)


def parts(rows: DataFrame) -> DataFrame:
    """Candidates packed by cell and a hash of id and vector: dim, ids, labels, copies, flat."""
    sizes = rows.groupBy("dim", "cell").agg(F.ceil(F.count("*") / F.lit(PART // 2)).alias("cuts"))
    cut = rows.join(sizes, ["dim", "cell"]).withColumn("cut", F.pmod(F.xxhash64("vec_id", "v"), "cuts"))
    packed = cut.groupBy("dim", "cell", "cut").agg(F.collect_list(F.struct("vec_id", "label", "copies", "v")).alias("m"))
    return packed.select("dim", F.transform("m", lambda x: x["vec_id"]).alias("ids"),
                         F.transform("m", lambda x: x["label"]).alias("labels"),
                         F.transform("m", lambda x: x["copies"]).alias("copies"),
                         F.flatten(F.transform("m", lambda x: x["v"])).alias("flat"))


def blocks_of(anchors: pa.Table, probes: dict[str, np.ndarray] | None) -> tuple[dict[int, list[tuple[Block, int]]], np.ndarray]:
    """Blocks of a wave by size of vector, each with the number of its first probe, and the wave's probe of every such number.

    probes: anchor id, lo and hi of what is asked, sorted by anchor; None asks one open question of each anchor.
    """
    ids, labels = anchors.column("vec_id").to_numpy(), anchors.column("label").to_numpy()
    cells = anchors.column("cell").to_numpy()
    out: dict[int, list[tuple[Block, int]]] = {}
    named, first = [], 0
    for d, at, v in _vectors(anchors):
        out[d] = []
        order = np.lexsort((ids[at], cells[at]))
        edges = np.flatnonzero(np.diff(cells[at][order])) + 1
        for run in np.split(order, edges):
            for i in range(0, len(run), BLOCK):
                some = run[i:i + BLOCK]
                who = ids[at][some]
                if probes is None:
                    mine, place = who, np.arange(len(some))
                    lo, hi = np.full(len(some), _LOW), np.full(len(some), _HIGH)
                else:
                    a, b = (np.searchsorted(probes["anchor"], who, side=s) for s in ("left", "right"))
                    place = np.repeat(np.arange(len(some)), b - a)
                    mine = np.concatenate([np.arange(x, y) for x, y in zip(a, b, strict=True)]) if len(a) else a
                    lo, hi = probes["lo"][mine], probes["hi"][mine]
                out[d].append((Block(who, labels[at][some], v[some], (place, lo, hi)), first))
                named.append(mine)
                first += len(mine)
    return out, np.concatenate(named) if named else np.zeros(0, dtype=np.int64)


def _part(batch: pa.RecordBatch, i: int, dim: int) -> Part:
    ids, labels, copies, flat = (batch.column(c)[i].values.to_numpy(zero_copy_only=False)
                                 for c in ("ids", "labels", "copies", "flat"))
    return Part(ids, labels, copies, _matrix(flat, dim))


def search(spark: SparkSession, filed: DataFrame, seeds: pa.Table, asked: tuple[dict, np.ndarray], same: bool, k: int,
           path: str) -> None:
    """Writes (probe, vec_id, score): for the wave's probes, at most k rows of each task over the parts."""
    by_size, named = asked
    held = spark.sparkContext.broadcast((by_size, named, [
        (d, Part(seeds.column("vec_id").to_numpy()[at], seeds.column("label").to_numpy()[at],
                 seeds.column("copies").to_numpy()[at], v)) for d, at, v in _vectors(seeds)]))
    total = len(named)

    def floors() -> np.ndarray:
        blocks, _, first = held.value
        best = Best(total, k)
        for d, part in first:
            for block, at in blocks.get(d, ()):
                walk(block, at, part, best, same)
        return best.floor

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, names, _ = held.value
        best = Best(total, k, kept(floors, held.value))
        for batch in batches:
            for i in range(batch.num_rows):
                dim = batch.column("dim")[i].as_py()
                part = _part(batch, i, dim) if dim in blocks else None
                for block, at in blocks.get(dim, ()):
                    walk(block, at, part, best, same)
        row, col = np.nonzero(np.arange(k)[None, :] < best.n[:, None])
        for i in range(0, len(row), 100_000):
            r, c = row[i:i + 100_000], col[i:i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(names[r]), pa.array(best.id[r, c]), pa.array(best.score[r, c])],
                                             names=["probe", "vec_id", "score"])

    filed.mapInArrow(run, "probe long, vec_id long, score long").write.parquet(path)
    held.destroy()


def _ranked(scores: DataFrame, keys: list[str], k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id"))
    return scores.withColumn("rank", place.cast("int")).filter(F.col("rank") <= k)


def window(score: np.ndarray, share: tuple[int, int], up: bool) -> np.ndarray:
    """A share of whole scores, rounded up or down, without leaving longs."""
    n, of = share
    rest = score % of * n
    return score // of * n + (-(-rest // of) if up else rest // of)


def mine(spark: SparkSession, vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         lower: tuple[int, int] = LOWER, upper: tuple[int, int] = UPPER, scale: int = SCALE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: each positive's hardest negatives in its window."""
    root = shared_dir(spark, "hard-negatives")
    whole = integral(vectors, max(positives, negatives), scale)
    rows = stored(spark, whole, f"{root}/whole")
    rows = stored(spark, with_cells(rows, centres(rows.filter(is_anchor))), f"{root}/rows")
    filed = stored(spark, parts(rows), f"{root}/parts")
    seeds = rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(SEED).drop("cell").toArrow()
    anchors = rows.filter(is_anchor).groupBy("vec_id").agg(F.min(F.struct("dim", "label", "v", "cell")).alias("m")).select(
        "vec_id", "m.*")
    n, dim = anchors.agg(F.count("*"), F.max("dim")).head()
    waves = max(1, -(-n * (dim or 0) // WAVE))

    def wave(frame: DataFrame, key: str, w: int) -> pa.Table:
        """One wave's rows: at most about WAVE components."""
        return frame.filter(F.pmod(F.xxhash64(key), F.lit(waves)) == w).toArrow()

    for w in range(waves):
        search(spark, filed, seeds, blocks_of(wave(anchors, "vec_id", w), None), True, positives, f"{root}/same/wave={w}")
    found = _ranked(spark.read.parquet(f"{root}/same"), ["probe"], positives).select(
        F.col("probe").alias("anchor_id"), F.col("vec_id").alias("positive_id"), "rank", "score")
    found = stored(spark, found, f"{root}/positives")
    for w in range(waves):
        pairs = wave(found, "anchor_id", w).sort_by([("anchor_id", "ascending"), ("rank", "ascending")])
        who, score = pairs.column("anchor_id").to_numpy(), pairs.column("score").to_numpy()
        probes = {"anchor": who, "lo": window(score, lower, True), "hi": window(score, upper, False)}
        blocks, named = blocks_of(wave(anchors, "vec_id", w), probes)
        # A probe's name is anchor and place of the positive in one number's stead: its row in `pairs`.
        search(spark, filed, seeds, (blocks, named), False, negatives, f"{root}/other/wave={w}")
        names = pa.table({"probe": pa.array(np.arange(len(who))), "anchor_id": who, "place": pairs.column("rank"),
                          "positive_id": pairs.column("positive_id"), "positive_score": score})
        spark.createDataFrame(names).write.parquet(f"{root}/probes/wave={w}")
    scores = spark.read.parquet(f"{root}/other").join(spark.read.parquet(f"{root}/probes"), ["wave", "probe"])
    return _ranked(scores, ["anchor_id", "place"], negatives).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract: anchors divisible by 100; labels of ids divisible by 7 are first changed."""
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(spark, vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)


OP12_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS same,
         CAST(list_sum(list_transform(list_zip(a.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM scores WHERE same)
  WHERE place <= 5)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
WHERE rank <= 10
"""
