"""Language identification by cross-parsing entropy.

For each language a suffix automaton holds the labelled text of a bounded sample. A document is parsed against it from
left to right into the longest phrases that occur in the language's text; c phrases over n bytes, with a text of m bytes
to point into, cost c * log2(m) / n bits a byte. The language with the fewest normalised phrases wins.

Documents are lower-cased and runs of ASCII characters other than letters are one blank; bytes of UTF-8 are the symbols,
so any script works. Automata are dense tables of transitions, walked with NumPy for many blocks of text at once. A long text
is cut into blocks of `BLOCK` bytes, which costs each language at most one phrase a block.

The automata are a classifier: they are fitted on at most `MAX_ROWS` labelled texts of each language, taken in hash order of
id and text, and of a long text on `MAX_CHARS` characters from its first letter on. All languages share `ROWS_ALL` texts of
that length: beyond eight languages each gets fewer texts, beyond `ROWS_ALL` one shorter text, of `LEAST_CHARS` at
least. No language that has a labelled text with letters is left out.

Defined cases: null and letter-free texts are `und` with score 0; rows with a null language or without letters are
not learned from; without any learned language every text is `und`; ties go to the language that sorts first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brook.llm.common import carried, crc_mod, kept, map_batches, segment_starts, table

MAX_ROWS, MAX_CHARS, ROWS_ALL, LEAST_CHARS = 24, 2_500, 200, 200
BLOCK = 1_024
UNKNOWN = "und"
#: ASCII letters and non-ASCII bytes stay, everything else becomes a blank.
_LETTERS = bytes(c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def prepared(name: str = "text"):
    """Lower case in UTF-8; null for a text without letters."""
    return F.when(F.col(name).rlike(r"\p{L}"), F.lower(F.col(name)).cast("binary"))


def blanks(text: bytes) -> bytes:
    """One blank for each run of ASCII characters that aren't letters, and around the text."""
    return b" " + b" ".join(text.translate(_LETTERS).split()) + b" "


def sample(docs: DataFrame, max_rows: int = MAX_ROWS, max_chars: int = MAX_CHARS) -> list[tuple[str, list[bytes]]]:
    """The labelled texts of each language, in a fixed order."""
    rows = docs.select(F.col("lang").alias("lang"), F.col("doc_id").alias("id"), F.col("text").alias("text")).filter(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    # Every language that occurs is learned: with more of them, each gets fewer and shorter texts, one at least.
    n = max(1, rows.select("lang").distinct().count())
    max_rows, max_chars = min(max_rows, max(1, ROWS_ALL // n)), min(max_chars, max(LEAST_CHARS, ROWS_ALL * max_chars // n))
    # For fitting a long text gives the characters from its first letter on.
    start = F.regexp_instr("text", F.lit(r"\p{L}"))
    rows = rows.select("lang", "id", F.substring("text", start, F.lit(max_chars)).alias("text"))
    # Ranked before the texts are read again; the engine keeps max_rows per task and language before the exchange.
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("id", "text"), "id"))
    kept = rows.withColumn("place", place).filter(F.col("place") <= max_rows)
    got = kept.select("lang", "place", prepared().alias("text")).collect()  # bounded by the parameters
    out: dict[str, list[bytes]] = {}
    for r in sorted(got, key=lambda r: (r.lang, r.place)):
        out.setdefault(r.lang, []).append(blanks(bytes(r.text)))
    return sorted(out.items())


def automaton(texts: list[bytes], codes: np.ndarray, width: int) -> np.ndarray:
    """Dense transitions of the suffix automaton of the texts, joined by a symbol that nothing matches; -1: none."""
    nxt: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for n, text in enumerate(texts):
        for symbol in [*codes[np.frombuffer(text, dtype=np.uint8)].tolist(), -2 - n]:
            cur = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p != -1 and symbol not in nxt[p]:
                nxt[p][symbol] = cur
                p = link[p]
            if p != -1:
                q = nxt[p][symbol]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    clone = len(nxt)
                    nxt.append(dict(nxt[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p != -1 and nxt[p].get(symbol) == q:
                        nxt[p][symbol] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur
    dense = np.full((len(nxt), width), -1, dtype=np.int32)
    for state, moves in enumerate(nxt):
        for symbol, to in moves.items():
            if symbol >= 0:
                dense[state, symbol] = to
    return dense


class Parser:
    """The automata of all languages in one table of transitions."""

    def __init__(self, texts: list[tuple[str, list[bytes]]]):
        self.names = [name for name, _ in texts]
        seen = np.zeros(256, dtype=bool)
        for _, ts in texts:
            for t in ts:
                seen[np.frombuffer(t, dtype=np.uint8)] = True
        self.codes = np.zeros(256, dtype=np.int32)  # 0: a byte that no sample has
        self.codes[seen] = np.arange(1, seen.sum() + 1)
        self.width = int(seen.sum()) + 1
        parts = [automaton(ts, self.codes, self.width) for _, ts in texts]
        sizes = segment_starts(np.array([len(p) for p in parts], dtype=np.int64))
        # States hold the offset of their row; every language's root and its row after one symbol are known.
        self.roots = sizes[:-1] * self.width
        for p, base in zip(parts, sizes[:-1], strict=True):
            p[p >= 0] = (p[p >= 0] + int(base)) * self.width
        self.table = np.concatenate(parts).ravel() if parts else np.zeros(0, dtype=np.int32)
        self.bits = np.log2([2 + sum(map(len, ts)) for _, ts in texts])

    def phrases(self, blocks: list[np.ndarray]) -> np.ndarray:
        """Number of phrases of each block in each language."""
        order = np.argsort([-len(b) for b in blocks], kind="stable")
        lengths = np.array([len(blocks[i]) for i in order])
        grid = np.zeros((int(lengths.max(initial=0)), len(blocks)), dtype=np.int32)
        for column, i in enumerate(order):
            grid[:len(blocks[i]), column] = blocks[i]
        live = len(blocks) - np.searchsorted(lengths[::-1], np.arange(len(grid)), side="right")
        k = len(self.names)
        roots = self.roots.astype(np.int32)[:, None]
        lane_root = np.repeat(roots, len(blocks), axis=1)
        state = lane_root.copy()
        count = np.zeros((k, len(blocks)), dtype=np.int32)
        flat, width = self.table, len(blocks)
        for step in range(len(grid)):
            n = live[step]
            to = flat.take(state[:, :n] + grid[step, :n])
            stop = np.flatnonzero(to < 0)
            if len(stop):
                at = stop if n == width else stop + stop // n * (width - n)
                root = lane_root.ravel()[at]
                # The phrase ends before this symbol, unless it is empty: then the symbol is a phrase of its own.
                inside = state.ravel()[at] != root
                again = flat.take(root + grid[step].take(at % width))
                again[~inside] = -1
                count.ravel()[at] += 1 + ((again < 0) & inside)
                to.ravel()[stop] = np.where(again < 0, root, again)
            state[:, :n] = to
        count += state != lane_root  # an open phrase at the end
        out = np.empty((len(blocks), k), dtype=np.int64)
        out[order] = count.T
        return out

    def judge(self, texts: list[bytes | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each prepared text."""
        blocks, owner, n_bytes = [], [], np.zeros(len(texts))
        for i, t in enumerate(texts):
            if t is not None and self.names:
                code = self.codes[np.frombuffer(blanks(t), dtype=np.uint8)]
                n_bytes[i] = len(code)
                cuts = [code[j:j + BLOCK] for j in range(0, len(code), BLOCK)]
                blocks += cuts
                owner += [i] * len(cuts)
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if blocks:
            total = np.zeros((len(texts), len(self.names)))
            for i in range(0, len(blocks), 2_048):
                np.add.at(total, owner[i:i + 2_048], self.phrases(blocks[i:i + 2_048]))
            cost = total * self.bits / np.maximum(n_bytes, 1)[:, None]
            best = cost.argmin(axis=1)
            # Bits saved against each language over the text's phrases, as shares of a soft choice.
            gain = np.exp(-np.minimum((cost - cost.min(axis=1, keepdims=True)) * np.sqrt(n_bytes)[:, None], 700))
            share = 1.0 / gain.sum(axis=1)
            for i in np.flatnonzero(n_bytes):
                names[i], scores[i] = self.names[best[i]], share[i]
        return names, scores


def _parser(held) -> Parser:
    """One per worker process and sample."""
    texts = held.value
    return kept(lambda: Parser(texts), Parser, texts)


def identify(spark: SparkSession, docs: DataFrame, texts: list[tuple[str, list[bytes]]]) -> DataFrame:
    """doc_id, lang_pred and score of every row, from the sample of `sample`."""
    held = spark.sparkContext.broadcast(texts)
    schema = carried(docs, ["doc_id"], "lang_pred string, score double")
    own: list[Parser] = []

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not own:
            own.append(_parser(held))
        names, scores = own[0].judge(batch.column("text").to_pylist())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores)],
                                          names=["doc_id", "lang_pred", "score"])

    return map_batches(docs.select("doc_id", prepared().alias("text")), work, schema)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract: learn where crc32(doc_id) mod 4 is not 2, predict every document."""
    docs = table(spark, sf_dir, "documents")
    texts = sample(docs.filter(F.coalesce(crc_mod("doc_id", 4) != 2, F.lit(False))))
    return identify(spark, docs.select("doc_id", "text"), texts).select(
        "doc_id", F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
