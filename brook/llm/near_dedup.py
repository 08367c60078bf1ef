"""Near-duplicate detection with ProbMinHash over five-word shingles.

A text is the multiset of its five-word shingles. ProbMinHash lets every shingle arrive by a Poisson process whose rate is
its count and drop each arrival into a random one of `M` components; the shingle that comes first into a component is its
value. Two texts agree in a component with the probability Jaccard of their multisets. Arrivals are drawn in rounds, and a
shingle stops as soon as its next arrival is later than the last component of its text (early termination).

Bands of `ROWS` components put texts into buckets; texts that share one are candidates and are verified exactly, on their
shingles. Links of `SIMILARITY` or more are closed into classes by star contraction. With 24 bands of 4, a pair of
similarity 0.8 is missed with probability 3e-6.

A bucket never becomes all its pairs. Texts are compared with pivots of their bucket: one at first (the text that shares
most buckets, which in a group of near copies is the least edited one), then 8, 512 and so on, and only where
members still belong to different classes, against pivots of other classes. A bucket whose members are one class is done;
any other goes on until every member has been a pivot, so no link is lost to a cap.

Between the first and the later rounds, texts that cannot have a link any more leave the open buckets. Let x have weight
n(x), and s(x) of it in shingles that some other open text has. The probability Jaccard of x with any text is at most
s(x) / n(x); and of x and y whose counts are all 1 it is at most s / (n(x) + n(y) - s) for s the smaller of s(x) and s(y).
Heavily edited copies, and texts that merely share a passage, go by these bounds, which lose nothing. In the later rounds a
pair meets only in the first of its common buckets, and only if `AGREE` components of its signatures are equal; at a
similarity of 0.8 fewer are with probability 1e-6. Before that, a parity sketch of `BITS` bits bounds what a pair may share: a
shingle's j-th copy flips one bit, so two sketches differ in no more bits than the texts differ in copies of shingles. With
N = n(x) + n(y), at most (N - bits) / 2 copies are common. A shingle adds at most its larger count over (N + bits) / 2 to the
similarity, so with e copies in both texts beyond the first of their shingle it is at most (N - bits + 2 e) / (N + bits); and it
is at most the common copies over the smaller weight, as no coupling agrees more often. These bounds lose no link, and a large
group of copies that are too different to be linked makes few pairs: they are nearly exact up to some hundred differing
shingles, and let all pairs pass far beyond.

Equal texts are one node from the start (md5 of the text), so thousands of copies cost one signature row each and no
pair. Results are carried by text and reach documents by one join, whose hot keys the engine splits. So are the open buckets:
one row a text lists its buckets, so each round's join with the labels grows with the texts, not with their places in buckets.

Defined cases: null texts are a class of their own each; texts without words join equal texts only; texts of fewer than
five words are one shingle; a class is named by its smallest doc_id (null if all are null); repeated rows are copies.
"""

from __future__ import annotations

from collections import OrderedDict
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brook.llm.common import kept, map_batches, mix, segment_starts, stored, table, unit, utf8, words
from brook.session import shared_dir

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 24, 4
M = BANDS * ROWS
#: Equal components of 96 that a pair of similarity 0.8 almost surely has (its mean is 77, its deviation 3.9).
AGREE = 58
#: Bits of a text's parity sketch.
BITS = 1024
#: Pivots of a bucket in the second round, and how many times more each round after it takes: few rounds label members anew.
PIVOTS, GROWTH = 8, 64
KEPT_WORDS = 300_000
#: Bytes of text that a worker holds at once; its arrays take about thirty times that.
SLICE = 4 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """Word hashes, kept up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > KEPT_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def shingles(texts: list[bytes | None], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of all texts: text number, hash, count; sorted by text and hash."""
    split = [words(t) for t in texts]
    lengths = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
    flat = np.fromiter(map(kept(_Hashes, _Hashes).__getitem__, chain.from_iterable(split)), dtype=np.uint64,
                       count=int(lengths.sum()))
    starts = segment_starts(lengths)[:-1]
    counts = np.where(lengths >= size, lengths - size + 1, (lengths > 0).astype(np.int64))
    owner = np.repeat(np.arange(len(split)), counts)
    first = np.arange(len(owner)) - np.repeat(segment_starts(counts)[:-1], counts) + starts[owner]
    n = np.minimum(lengths, size)[owner]
    h = n.astype(np.uint64)
    with np.errstate(over="ignore"):
        for j in range(size):
            inside = j < n
            at = np.where(inside, first + j, 0) if len(flat) else first
            h = np.where(inside, mix(h * np.uint64(0x100000001B3) + flat[at]), h) if len(flat) else h
    order = np.lexsort((h, owner))
    owner, h = owner[order], h[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return owner[at], h[at], np.diff(np.append(at, len(h)))


def signatures(n_texts: int, owner: np.ndarray, h: np.ndarray, count: np.ndarray, m: int = M) -> np.ndarray:
    """ProbMinHash values, n_texts x m; rows of texts without shingles stay 0."""
    best = np.full(n_texts * m, np.inf)
    value = np.zeros(n_texts * m, dtype=np.uint64)
    arrival = np.zeros(len(h))
    rate = count.astype(np.float64)
    turn = 0
    with np.errstate(over="ignore"):
        while len(h):
            turn += 1
            arrival = arrival - np.log(unit(mix(h + _STEP * np.uint64(2 * turn)))) / rate
            latest = best.reshape(n_texts, m).max(axis=1)
            going = arrival < latest[owner]
            if not going.all():
                owner, h, rate, arrival = owner[going], h[going], rate[going], arrival[going]
            slot = owner * m + (mix(h + _STEP * np.uint64(2 * turn + 1)) % np.uint64(m)).astype(np.int64)
            np.minimum.at(best, slot, arrival)
            won = best[slot] == arrival
            value[slot[won]] = h[won]
    return value.reshape(n_texts, m)


def bands_of(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """64-bit bucket numbers, n_texts x bands."""
    n, m = sig.shape
    parts = sig.reshape(n, m // rows, rows)
    h = np.broadcast_to(np.arange(1, m // rows + 1, dtype=np.uint64), parts.shape[:2]).copy()
    with np.errstate(over="ignore"):
        for j in range(rows):
            h = mix(h * np.uint64(0x100000001B3) ^ parts[:, :, j])
    return h.view(np.int64)


def sketches(n_texts: int, owner: np.ndarray, h: np.ndarray, count: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Parity sketches, n_texts x bits / 64: each copy of each shingle flips one bit."""
    odd = np.zeros(n_texts * bits, dtype=bool)
    turn = 0
    with np.errstate(over="ignore"):
        while len(h):
            turn += 1
            at = owner * bits + (mix(h + _STEP * np.uint64(2 * turn)) % np.uint64(bits)).astype(np.int64)
            np.logical_xor.at(odd, at, True)
            more = count > turn
            owner, h, count = owner[more], h[more], count[more]
    return np.packbits(odd).view(np.int64).reshape(n_texts, bits // 64)


def most_bits(n: Column, again: Column, p_n: Column, p_again: Column, similarity: float) -> Column:
    """The most bits in which the sketches of two texts of that similarity can differ."""
    both = n + p_n
    by_copies = (both * (1 - similarity) + 2 * (again + p_again)) / (1 + similarity)
    return F.least(by_copies, both - 2 * similarity * F.least(n, p_n)) + 1e-6


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two multisets (sorted distinct hashes, counts); plain Jaccard if all counts are equal."""
    (ha, ca), (hb, cb) = a, b
    if not len(ha) or not len(hb):
        return 0.0
    both, ia, ib = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    if ca.max() == 1 and cb.max() == 1:
        return len(both) / (len(ha) + len(hb) - len(both))
    wa, wb = ca[ia].astype(float), cb[ib].astype(float)
    order = np.argsort(wa / wb, kind="stable")
    wa, wb = wa[order], wb[order]
    ratio = wa / wb
    only_a, only_b = float(ca.sum() - wa.sum()), float(cb.sum() - wb.sum())
    below = np.searchsorted(ratio, ratio, side="left")  # of a smaller ratio: b's weight is the larger one there
    sum_b, sum_a = np.concatenate(([0.0], np.cumsum(wb))), np.concatenate((np.cumsum(wa[::-1])[::-1], [0.0]))
    larger = only_a + sum_a[below] + ratio * (only_b + sum_b[below])
    return float((wa / larger).sum())


def _node(text: str = "text") -> Column:
    return F.unhex(F.md5(F.col(text).cast("binary")))


def buckets(docs: DataFrame) -> DataFrame:
    """bucket, t (node): the bands of every text that has words."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        place = {t: i for i, t in reversed(list(enumerate(batch.column("t").to_pylist())))}  # copies in a batch: once
        batch = batch.take(pa.array(sorted(place.values())))
        owner, h, count = shingles(batch.column("text").to_pylist())
        some = np.unique(owner)
        keys = bands_of(signatures(batch.num_rows, owner, h, count)[some])
        return pa.RecordBatch.from_arrays(
            [pa.array(keys.ravel()), batch.column("t").take(pa.array(np.repeat(some, keys.shape[1])))],
            names=["bucket", "t"])

    nodes = docs.filter("text is not null").select(_node().alias("t"), utf8().alias("text"))
    return map_batches(nodes, work, "bucket long, t binary", most_bytes=SLICE).dropDuplicates(["bucket", "t"])


def verified(pairs: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) of nodes whose texts reach the similarity."""

    def run(batches):
        kept: OrderedDict[bytes, tuple] = OrderedDict()

        def of(t: bytes, text: bytes) -> tuple:
            if t not in kept:
                _, h, n = shingles([text])
                kept[t] = (h, n)
                if len(kept) > 256:
                    kept.popitem(last=False)
            kept.move_to_end(t)
            return kept[t]

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("a", "b", "x", "y")]
            good = [probability_jaccard(of(a, x), of(b, y)) >= similarity for a, b, x, y in zip(*cols, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    one = texts.select(F.col("t").alias("a"), F.col("text").alias("x"))
    two = texts.select(F.col("t").alias("b"), F.col("text").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(run, "a binary, b binary")


class _Store:
    """Tables of one run in the shared folder; each is written once and read back, so lineage stays short."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.n = spark, shared_dir(spark, name), 0

    def __call__(self, df: DataFrame) -> DataFrame:
        self.n += 1
        return stored(self.spark, df, f"{self.root}/{self.n}")


def components(edges: DataFrame, keep: _Store) -> DataFrame:
    """node, label: the smallest node of each connected component, by alternating large and small stars."""

    def least(df: DataFrame) -> DataFrame:
        return df.groupBy("u").agg(F.min("v").alias("m"))

    edges = keep(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    few = max(8, -(-edges.count() // 500_000))  # stars never have more edges, so their tables need no more parts
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = least(both).select("u", F.least("u", "m").alias("m"))
        edges = keep(both.filter("v > u").join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                     .filter("u <> v").distinct().coalesce(few))
        m = least(edges)
        edges = keep(edges.join(m, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                     .unionByName(m.select("u", F.col("m").alias("v"))).filter("u <> v").distinct().coalesce(few))
        # Done when every node has one edge, and none leads to a node with an edge.
        heads = least(edges).select(F.col("u").alias("head"))
        n, chained, nodes = edges.join(heads, edges["v"] == heads["head"], "left").agg(
            F.count("*"), F.count("head"), F.count_distinct("u")).head()
        if not chained and n == nodes:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))


def bounds(texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """t, n, again (copies beyond the first of their shingle), flat (none), reach (a flat text's largest partner weight),
    signature, bands and sketch.

    Only texts that may have a link: what they share with others reaches the similarity.
    """

    def totals(batch: pa.RecordBatch) -> pa.RecordBatch:
        owner, h, count = shingles(batch.column("text").to_pylist())
        sig = signatures(batch.num_rows, owner, h, count)
        n = np.bincount(owner, weights=count, minlength=batch.num_rows).astype(np.int64)
        kinds = np.bincount(owner, minlength=batch.num_rows)
        listed = [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(k))
                  for x, k in (((sig & np.uint64(0x7FFFFFFF)).astype(np.int32), pa.int32()), (bands_of(sig), pa.int64()),
                               (sketches(batch.num_rows, owner, h, count), pa.int64()))]
        return pa.RecordBatch.from_arrays([batch.column("t"), pa.array(n), pa.array(n - kinds), pa.array(n == kinds), *listed],
                                          names=["t", "n", "again", "flat", "sig", "bands", "sketch"])

    def single(batch: pa.RecordBatch) -> pa.RecordBatch:
        owner, h, count = shingles(batch.column("text").to_pylist())
        order = np.argsort(h, kind="stable")
        owner, h, count = owner[order], h[order], count[order]
        first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, dtype=np.int64)
        times = np.diff(np.append(first, len(h)))
        return pa.RecordBatch.from_arrays(
            [pa.array(h[first].view(np.int64)), pa.array(times), pa.array(count[first].astype(np.int64)),
             batch.column("t").take(pa.array(owner[first]))], names=["h", "times", "w", "t"])

    weights = map_batches(texts, totals, "t binary, n long, again long, flat boolean, sig array<int>, bands array<long>, "
                          "sketch array<long>", most_bytes=SLICE)
    # A shingle of one text only is that text's own; no group is gathered, counts and minima combine before the exchange.
    own = (map_batches(texts, single, "h long, times long, w long, t binary", most_bytes=SLICE)
           .select("h", "times", "w", F.conv(F.hex(F.substring("t", 1, 7)), 16, 10).cast("long").alias("k"))
           .groupBy("h").agg(F.sum("times").alias("times"), F.min("k").alias("k"), F.sum("w").alias("w"))
           .filter("times = 1").groupBy("k").agg(F.sum("w").alias("own")))
    # Seven bytes name a text here; should two texts share them, both count each other's own shingles as shared too.
    keyed = weights.withColumn("k", F.conv(F.hex(F.substring("t", 1, 7)), 16, 10).cast("long"))
    twins = F.count("*").over(Window.partitionBy("k"))
    shared = keyed.withColumn("twins", twins).join(own, "k", "left").withColumn(
        "s", F.when(F.col("twins") > 1, F.col("n")).otherwise(F.col("n") - F.coalesce("own", F.lit(0))))
    reach = F.when(F.col("flat"), F.col("s") * (1 + similarity) / similarity - F.col("n") + 1e-6)
    return shared.filter(F.col("s") >= similarity * F.col("n") - 1e-6).select(
        "t", "n", "again", "flat", reach.alias("reach"), "sig", "bands", "sketch")


def classes(spark: SparkSession, docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """t, label of every text that is linked to a different one."""
    keep = _Store(spark, "near-dedup")
    found = keep(buckets(docs))
    shared = found.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    # One row a text, its buckets (at most `BANDS`) as a list: what belongs to a text is joined to that row alone.
    nodes = keep(found.join(shared, "bucket").groupBy("t").agg(
        F.sum("size").alias("pull"), F.collect_list(F.struct("bucket", "size")).alias("held")))
    members = keep(nodes.select("t", "pull", F.inline("held")))
    texts = keep(docs.filter("text is not null").select(_node().alias("t"), utf8().alias("text"))
                 .groupBy("t").agg(F.first("text").alias("text")).join(nodes.select("t"), "t", "left_semi"))

    heads = members.groupBy("bucket").agg(F.max(F.struct("pull", "t")).alias("head")).select(
        "bucket", F.col("head.t").alias("head"))
    pairs = members.join(heads, "bucket").filter("t <> head").select(
        F.least("head", "t").alias("a"), F.greatest("head", "t").alias("b")).distinct()
    links = keep(verified(keep(pairs), texts, similarity))
    labels = components(links, keep)

    def mixed(texts: DataFrame) -> DataFrame:
        """Members of buckets that hold several classes, with their label; texts: one row a text, with its buckets."""
        rows = keep(texts.join(labels, texts["t"] == labels["node"], "left").select(
            F.explode("buckets").alias("bucket"), *[texts[c] for c in texts.columns if c != "buckets"],
            F.coalesce("label", "t").alias("label")))
        several = rows.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter(
            "lo <> hi").select("bucket")
        return rows.join(several, "bucket")

    def by_text(rows: DataFrame) -> DataFrame:
        """t, buckets: one row a text."""
        return rows.groupBy("t").agg(F.collect_list("bucket").alias("buckets"))

    # Two members have met by now; of more, those that may still have a link go on.
    crowded = nodes.select("t", F.filter("held", lambda x: x["size"] > 2)["bucket"].alias("buckets"))
    going = keep(by_text(mixed(crowded)))
    if going.isEmpty():
        return labels.select(F.col("node").alias("t"), "label")
    fit = keep(bounds(texts.join(going.select("t"), "t", "left_semi"), similarity).join(nodes.select("t", "pull"), "t"))
    rows = keep(going.join(fit, "t").select(F.explode("buckets").alias("bucket"), "t", "n", "flat", "reach"))
    space = rows.groupBy("bucket").agg(F.count("*").alias("size"), F.min("n").alias("least"),
                                       F.min("flat").alias("all_flat"))
    going = keep(by_text(rows.join(space, "bucket").filter("size > 1 and (not all_flat or reach >= least)")))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy(F.desc("pull"), "t"))
    upto = PIVOTS
    while True:
        rows = keep(mixed(going.join(fit, "t")))
        if rows.isEmpty():
            break
        pivots = rows.withColumn("place", place).filter(F.col("place") <= upto).select(
            "bucket", F.col("t").alias("p"),
            *[F.col(c).alias(f"p_{c}") for c in ("n", "again", "flat", "reach", "label", "sig", "bands", "sketch")])
        equal = F.aggregate(F.zip_with("sig", "p_sig", lambda x, y: (x == y).cast("int")), F.lit(0), lambda k, x: k + x)
        differ = sum((F.bit_count(F.get("sketch", F.lit(i)).bitwiseXOR(F.get("p_sketch", F.lit(i)))) for i in range(BITS // 64)),
                     F.lit(0))
        met = rows.join(pivots, "bucket").filter(
            "label <> p_label and (not flat or not p_flat or (n <= p_reach and p_n <= reach))").filter(
            differ <= most_bits(*map(F.col, ("n", "again", "p_n", "p_again")), similarity)).filter(
            F.element_at(F.array_intersect("bands", "p_bands"), 1) == F.col("bucket")).filter(equal >= AGREE)
        pairs = keep(met.select(F.least("p", "t").alias("a"), F.greatest("p", "t").alias("b")).distinct())
        more = keep(verified(pairs, texts, similarity))
        if not more.isEmpty():
            stars = labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
            labels = components(stars.unionByName(more), keep)
        # Pivots have met every other class of their bucket, so they leave it.
        going = keep(by_text(rows.withColumn("place", place).filter(F.col("place") > upto)))
        upto *= GROWTH
    return labels.select(F.col("node").alias("t"), "label")


def assigned(spark: SparkSession, docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """t, class (smallest doc_id), and how many rows have that id and this text, for every text but null."""
    labels = classes(spark, docs, similarity)
    ids = docs.filter("text is not null").groupBy(_node().alias("t"), F.col("doc_id").alias("id")).agg(
        F.count("*").alias("rows"))
    per_text = ids.groupBy("t").agg(F.min("id").alias("least"), F.min_by("rows", "id").alias("rows"),
                                    F.max("rows").alias("most"))
    named = per_text.join(labels, "t", "left").withColumn("label", F.coalesce("label", "t"))
    # Equal ids under different texts of a class: the smallest text stays.
    stay = named.groupBy("label").agg(F.min("least").alias("class"), F.min(F.when(
        F.col("least").isNotNull(), F.struct("least", "t"))).alias("s"), F.min("t").alias("any"))
    return named.join(stay, "label").select(
        "t", "class", F.coalesce(F.col("s.t"), F.col("any")).eqNullSafe(F.col("t")).alias("holds"),
        F.coalesce("rows", "most").alias("rows"))


def near_duplicates(spark: SparkSession, docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id of every row."""
    of = assigned(spark, docs, similarity)
    rows = docs.select("doc_id", _node().alias("t"))
    return rows.join(of.select("t", "class"), "t", "left").select(
        "doc_id", F.when(F.col("t").isNull(), F.col("doc_id")).otherwise(F.col("class")).alias("class_id"))


def keep_one(spark: SparkSession, docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of each class: the one with the smallest doc_id; null texts stay; columns as before."""
    node = "_brook_t"
    keep = _Store(spark, "near-dedup-kept")
    of = keep(assigned(spark, docs, similarity).filter("holds").select(F.col("t").alias(node), "class", "rows"))
    again = not of.filter("rows > 1").isEmpty()  # the same row twice: rare, and only then a further step
    names = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.withColumn(node, _node())
    joined = rows.join(of.withColumnsRenamed({"class": "_brook_class", "rows": "_brook_rows"}), node, "left")
    stays = joined.filter(F.col(node).isNull() | (F.col("_brook_rows").isNotNull()
                                                 & F.col("doc_id").eqNullSafe(F.col("_brook_class"))))
    if not again:
        return stays.select(*names)
    once = F.coalesce("_brook_rows", F.lit(1)) == 1
    return stays.filter(once).select(*names).unionByName(
        stays.filter(~once).dropDuplicates([node]).select(*names))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and class_id (smallest doc_id of the class) of every document."""
    return near_duplicates(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))
