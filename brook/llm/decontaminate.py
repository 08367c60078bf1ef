"""Benchmark decontamination: one word-level Aho-Corasick automaton over all benchmark windows.

Every window (ten consecutive words of an item; a shorter item is one window) becomes a sequence of word numbers in one
automaton. A document is scanned once; each match gives the index of its last word, hence the hit words, and word
indexes map back to byte and character offsets of the untouched text.

Defined cases: null or word-free texts have no words and no hits; items without id, text or words are no windows;
items with the same window all count; several rows of one item count as one item each time they occur under the same
id; an empty benchmark leaves every document clean. Overlapping windows hit the union of their words.

Size: the automaton is broadcast, so it needs a bound. Items are dealt into groups of at most `max_group_words` words
(a longer item makes a group of its own) and one automaton per group scans the documents; the common case is one group.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brook.llm.common import WORD_TABLE, carried, kept, map_batches, table, utf8, words

WINDOW = 10
#: Bound of one broadcast automaton, in benchmark words (about 150 bytes a word and window position).
MAX_GROUP_WORDS = 500_000


class Matcher:
    """Windows of some items, matched by one automaton. Items: (id, text bytes)."""

    def __init__(self, items: Iterable[tuple[object, bytes | None]], window: int = WINDOW):
        self.numbers: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set] = {}
        for item_id, text in items:
            ws = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words(text)]
            if item_id is None or not ws:
                continue
            for i in range(max(1, len(ws) - window + 1)):
                owners.setdefault(tuple(ws[i:i + window]), set()).add(item_id)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for key, ids in owners.items():
            self.automaton.add_word(key, (len(key), frozenset(ids)))
        self.empty = not owners
        if owners:
            self.automaton.make_automaton()

    def scan(self, ws: list[bytes]) -> tuple[np.ndarray, set]:
        """Which words lie in an occurrence of a window, and the items that occur."""
        hit, items = np.zeros(len(ws) + 1, dtype=np.int64), set()
        if self.empty or not ws:
            return hit[:-1] > 0, items
        number = self.numbers.get
        for end, (n, ids) in self.automaton.iter(tuple([number(w, 0) for w in ws])):
            hit[end - n + 1] += 1
            hit[end + 1] -= 1
            items |= ids
        return np.cumsum(hit)[:-1] > 0, items


def spans(text: bytes, hit: np.ndarray) -> list[tuple[int, int]]:
    """Runs of hit words as character offsets [start, end) of the original text."""
    found = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(WORD_TABLE))]
    out, open_at = [], None
    for i, (a, b) in enumerate(found):
        if hit[i]:
            open_at = a if open_at is None else open_at
            last = b
        if open_at is not None and (not hit[i] or i + 1 == len(found)):
            out.append((len(text[:open_at].decode()), len(text[:last].decode())))
            open_at = None
    return out


def groups(benchmark: DataFrame, max_words: int) -> list[DataFrame]:
    """Parts of the benchmark, each within the bound of one automaton; a part is a filter on a hash of the id."""
    total = benchmark.agg(F.sum(F.size(F.split("text", " ")))).head()[0] or 0
    n = max(1, -(-int(total) // max_words))
    if n == 1:
        return [benchmark]
    return [benchmark.filter(F.pmod(F.xxhash64("item_id"), F.lit(n)) == i) for i in range(n)]


def find(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
         max_group_words: int = MAX_GROUP_WORDS) -> DataFrame:
    """doc_id, n_words, hit spans (character offsets), number of hit words and the sorted item ids of each document."""
    bench = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").alias("text"))
    parts = groups(bench, max_group_words)
    schema = carried(docs, ["doc_id"], "n_words long, n_hit long, items array<string>, "
                                       "spans array<struct<start: long, end: long>>")
    holders = []
    for part in parts:
        rows = part.withColumn("text", utf8()).collect()  # bounded: one group
        holders.append(spark.sparkContext.broadcast([(r.item_id, bytes(r.text) if r.text is not None else None)
                                                     for r in rows]))
    matchers: list[Matcher] = []

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not matchers:
            values = [h.value for h in holders]
            matchers.extend(kept(lambda: [Matcher(v, window) for v in values], window, *values))
        n_words, n_hit, items, where = [], [], [], []
        for text in batch.column("text").to_pylist():
            ws = words(text)
            hit, found = np.zeros(len(ws), dtype=bool), set()
            for m in matchers:
                h, ids = m.scan(ws)
                if ids:
                    hit |= h
                    found |= ids
            n_words.append(len(ws))
            n_hit.append(int(hit.sum()) if found else 0)
            items.append(sorted(found))
            where.append([{"start": a, "end": b} for a, b in spans(text, hit)] if found else [])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
             pa.array(items, pa.list_(pa.string())),
             pa.array(where, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
            names=["doc_id", "n_words", "n_hit", "items", "spans"])

    return map_batches(docs.select("doc_id", utf8().alias("text")), work, schema)


def clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any benchmark window, all columns kept.

    Rows pass through the scan as they are, so null ids, repeated rows and extra columns need no join.
    """
    flagged = "_brook_hit"
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc_id"), F.col("text").alias("text"))
    out = find(spark, rows, benchmark, window).withColumn(flagged, F.col("n_hit") > 0)
    return out.filter(~F.col(flagged)).select(*[F.col("doc_id").getField(c).alias(c) for c in docs.columns])


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digest: counts, the item list's sha256 and the verdict of each document."""
    found = find(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


OP3_SQL = r"""
WITH w AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, array_to_string(ws[i + 1 : i + least(10, len(ws))], ' ') AS win, least(10, len(ws)) AS n
  FROM (SELECT item_id, ws, unnest(range(greatest(1, len(ws) - 9))) AS i FROM w WHERE len(ws) > 0)),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, i, n, array_to_string(ws[i + 1 : i + n], ' ') AS win
  FROM (SELECT doc_id, ws, n, unnest(range(len(ws) - n + 1)) AS i FROM d, sizes WHERE len(ws) >= n)),
hits AS (SELECT a.doc_id, a.i, a.n, b.item_id FROM places a JOIN windows b ON a.win = b.win AND a.n = b.n),
hit_words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM
  (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM
  (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
