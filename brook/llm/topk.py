"""Exact top-k by inner product with norm buckets.

Candidates are grouped by length into buckets of at most `BUCKET` vectors. For a query q and a score to beat, a bucket
whose largest norm is b needs a cosine of at least t = score / (|q| b); above 1 the bucket is skipped. Else the
bucket's t picks the pruning: from `STEEP` on, coordinate pruning (a unit vector within the cosine t of q / |q| has its
value in q's strongest coordinates inside a known interval); below, length pruning (only norms of at least score / |q|
can reach the score). What is left is verified by integer products.

Distribution: the score to beat comes from the `HEAD` longest vectors, a bounded table that every query meets first.
Vectors are packed into rows of one bucket part each, queries into blocks of at most about `BLOCK`. The stated queries meet
the parts in waves of blocks with at most about `WAVE` components, which bounds what a wave broadcasts; parts stay where
they are, and a block skips a part that none of its queries can need. A joined row holds one part and one block, so memory
is bounded; each gives at most k scores a query, and more queries make more waves.

Defined cases: null vectors and vectors with a null, NaN or infinite component take no part, nor do null ids; vectors of
another size than the query's score nothing with it; several rows of one id count separately as candidates (k copies of equal rows are
kept), and a repeated query id is one query (its smallest vector); components and scores beyond a long stop at its ends; ties
go to the smaller vec_id; fewer than k candidates give fewer rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brook.llm.common import products, table
from brook.session import shared_dir

K, SCALE = 5, 256
BUCKET, BLOCK, HEAD, WAVE = 2_048, 512, 2_048, 4_000_000
#: Local cosine threshold from which coordinates prune; number of coordinates that are looked at.
STEEP, COORDINATES = 0.6, 4
_LOW = np.iinfo(np.int64).min
_PAIRS = "query_id long, vec_id long, score long"


def integral(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, v (array<long>), n2 (squared norm), of the rows that take part."""
    values = F.transform("embedding", lambda x: x.cast("double"))
    good = (F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)
            & F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    ints = F.transform(values, lambda x: F.floor(x * scale).cast("long"))
    return (vectors.filter(good).select(F.col("vec_id").cast("long").alias("vec_id"), ints.alias("v"))
            .withColumn("n2", F.aggregate("v", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double"))))


def _packed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row a key: ids, vectors one behind the other, number and size of the vectors, largest squared norm."""
    return rows.groupBy(*keys).agg(F.collect_list(F.struct("vec_id", "v")).alias("m"), F.max("n2").alias("top")).select(
        *keys, F.transform("m", lambda x: x["vec_id"]).alias("ids"),
        F.flatten(F.transform("m", lambda x: x["v"])).alias("flat"), "top")


def parts(rows: DataFrame, n: int) -> DataFrame:
    """Bucket parts: a band of norms (powers of the root of 2), cut by a hash of the row so that a part stays small."""
    band = F.floor(F.log2(F.greatest("n2", F.lit(1.0)))).cast("int")
    cuts = F.lit(max(1, -(-n // (BUCKET // 2))))  # even if all vectors are of one band, a part has BUCKET / 2 on average
    return _packed(rows.withColumn("band", band).withColumn("cut", F.pmod(F.xxhash64("vec_id", "v", "copy"), cuts)),
                   ["dim", "band", "cut"])


def _matrix(flat: np.ndarray, dim: int) -> np.ndarray:
    return flat.reshape(-1, dim)


def best(queries: np.ndarray, q_ids: np.ndarray, floor: np.ndarray, v: np.ndarray, ids: np.ndarray,
         k: int = K) -> tuple[list, list, list]:
    """The k best candidates of one bucket part for each query, of those that reach the query's floor.

    floor: the least score that matters; the part's own rows of a query's id don't count.
    """
    out: tuple[list, list, list] = ([], [], [])
    norm = np.sqrt((v.astype(np.float64) ** 2).sum(axis=1))
    order = np.argsort(-norm, kind="stable")
    v, ids, norm = v[order], ids[order], norm[order]
    unit = v / np.maximum(norm, 1e-300)[:, None]
    q_norm = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
    for i, q in enumerate(queries):
        picked = slice(None)
        if floor[i] > 0 and len(norm):
            if q_norm[i] * norm[0] * (1 + 1e-9) < floor[i]:
                continue
            need = floor[i] / (q_norm[i] * norm[0])  # local threshold of the cosine
            if need >= STEEP:
                n = int(np.searchsorted(-norm, -floor[i] / q_norm[i] * (1 - 1e-9), side="right"))
                ok = np.ones(n, dtype=bool)
                for c in np.argsort(-np.abs(q))[:COORDINATES]:
                    x = q[c] / q_norm[i]
                    wide = np.sqrt(max(0.0, 1 - min(need, 1.0) ** 2) * max(0.0, 1 - x * x)) + 1e-9
                    ok &= np.abs(unit[:n, c] - min(need, 1.0) * x) <= wide + (1 - min(need, 1.0)) * abs(x)
                picked = np.flatnonzero(ok)
            else:
                picked = slice(0, int(np.searchsorted(-norm, -floor[i] / q_norm[i] * (1 - 1e-9), side="right")))
        score = products(v[picked], q[None, :])[:, 0]
        who = ids[picked]
        good = np.flatnonzero((score >= floor[i]) & (who != q_ids[i]))
        if len(good) > k:
            good = good[np.lexsort((who[good], -score[good]))[:k]]
        out[0].extend([int(q_ids[i])] * len(good))
        out[1].extend(who[good].tolist())
        out[2].extend(score[good].tolist())
    return out


def _batch(columns: tuple[list, list, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])


def _ranked(scores: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return scores.withColumn("rank", place).filter(F.col("rank") <= k)


def top_k(spark: SparkSession, vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of every query row."""
    root = shared_dir(spark, "top-k")
    # More than k copies of one row can't be in a result.
    copies = integral(vectors, scale).groupBy("vec_id", "v", "n2").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("copies"))
    copies.select("vec_id", "v", "n2", F.size("v").alias("dim"), F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).write.parquet(
        f"{root}/rows")
    rows = spark.read.parquet(f"{root}/rows")
    n, n_queries, dim = rows.agg(F.count("*"), F.count_if(is_query), F.max("dim")).head()
    asked = rows.filter(is_query).groupBy("dim", "vec_id").agg(F.min(F.struct("v", "n2")).alias("m")).select(
        "dim", "vec_id", "m.v", "m.n2")
    asked = asked.join(asked.groupBy("vec_id").agg(F.min("dim").alias("dim")), ["vec_id", "dim"])
    blocks = F.lit(max(1, -(-n_queries // BLOCK)))
    _packed(asked.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), blocks)), ["dim", "block"]).write.parquet(
        f"{root}/queries")
    queries = spark.read.parquet(f"{root}/queries")

    # A floor for each query: its k-th score among the longest vectors (HEAD rows at most, so they may be broadcast).
    head = rows.orderBy(F.desc("n2"), "vec_id").limit(HEAD).select("dim", "vec_id", "v").toArrow()
    held = spark.sparkContext.broadcast([(int(d), np.array(i), np.array(v, dtype=np.int64)) for d, i, v in _by_dim(head)])

    def floors(batches):
        for batch in batches:
            for b in batch.to_pylist():
                q, ids = _matrix(np.array(b["flat"], dtype=np.int64), b["dim"]), np.array(b["ids"])
                floor = np.full(len(ids), _LOW)
                for d, who, v in held.value:
                    if d == b["dim"]:
                        score = products(v, q)
                        score[who[:, None] == ids[None, :]] = _LOW
                        if len(who) > k:
                            floor = np.partition(score, len(who) - k, axis=0)[len(who) - k]
                norm = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
                # The largest norm that this block cannot do without: |v| >= floor / |q|.
                least = np.where(floor > 0, floor / np.maximum(norm, 1e-300), 0.0).min()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b["dim"]], pa.int32()), pa.array([b["block"]], pa.int64()), pa.array([b["ids"]]),
                     pa.array([b["flat"]]), pa.array([floor.tolist()], pa.list_(pa.int64())),
                     pa.array([float(least) * (1 - 1e-9)])],
                    names=["dim", "block", "q_ids", "q_flat", "floor", "least"])

    queries.mapInArrow(floors, "dim int, block long, q_ids array<long>, q_flat array<long>, floor array<long>, "
                               "least double").write.parquet(f"{root}/floors")
    asked = spark.read.parquet(f"{root}/floors")
    parts(rows, n).write.parquet(f"{root}/parts")
    filed = spark.read.parquet(f"{root}/parts").select("dim", "ids", "flat", "top")
    waves = max(1, -(-n_queries * (dim or 0) // WAVE))

    def meeting(wave: int) -> DataFrame:
        """Parts and the blocks of one wave that need them; a wave is bounded, so it may be broadcast."""
        blocks_of = asked.filter(F.pmod("block", F.lit(waves)) == wave)
        return filed.join(F.broadcast(blocks_of), "dim").filter(F.sqrt(F.col("top").cast("double")) >= F.col("least")).select(
            "dim", "ids", "flat", "q_ids", "q_flat", "floor")

    def scored(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                dim = batch.column("dim")[i].as_py()
                ids, flat, q_ids, q_flat, floor = (
                    batch.column(c)[i].values.to_numpy(zero_copy_only=False)
                    for c in ("ids", "flat", "q_ids", "q_flat", "floor"))
                yield _batch(best(_matrix(q_flat, dim), q_ids, floor, _matrix(flat, dim), ids, k))

    for w in range(waves):  # each wave is written before the next one is broadcast
        meeting(w).mapInArrow(scored, _PAIRS).write.parquet(f"{root}/scores/{w}")
    scores = spark.read.schema(_PAIRS).parquet(f"{root}/scores/*")
    return _ranked(scores, k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def _by_dim(head: pa.Table):
    dims = head.column("dim").to_pylist()
    ids, vectors = head.column("vec_id").to_pylist(), head.column("v").to_pylist()
    for d in sorted(set(dims)):
        at = [i for i, x in enumerate(dims) if x == d]
        yield d, [ids[i] for i in at], [vectors[i] for i in at]


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract: queries are the rows whose vec_id is divisible by 50."""
    return top_k(spark, table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP10_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
WHERE rank <= 5
"""
