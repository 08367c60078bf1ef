"""Token ids of a corpus in binary shards, each a wavelet matrix.

**File.** A shard holds the ids of consecutive documents as one sequence of n ids and L = bit length of the largest id
levels. Level by level, from the highest bit, the bits of the sequence form a plane, and the sequence is stably parted by
them (zeros first). A plane is cut into blocks of `BLOCK_BITS` bits, each compressed on its own where that helps; a
directory holds the place of every block and the ones before it. So one id (`access`), the number of an id in a range
(`count`) and all its places (`occurrences`) are read from a few blocks of the compressed file; `all` undoes the parting
level by level. Documents' ids and lengths stand in front.

**Distribution.** Documents are dealt into ranges of (doc_id, hash of the text), so that one id with a third of all rows
is spread too, and sorted within them. A task encodes its range in order and closes a shard at the first document end after
`SHARD` ids; what it holds is one shard. Spark's text writer writes one file a shard, byte for byte and with its usual
commit, so any store Spark can write will do and a retried task leaves no second copy; Spark's binary reader reads them.
A shard knows its range and the ids before it in that range; ids before a range are sums of one row a range.

**Encoding** goes through the tokenizers library. A text is cut before each run of white space that follows another
character, between a word of letters and a sign, and between a lone line end and a letter: the byte-level splitter starts a
new token there in any case, so the parts' ids, joined, are the text's ids. New words of letters, which that splitter
never cuts, go to the library in one call, split at line ends instead; the lengths of their tokens tell where each word ends.
Ids of short parts are kept by a worker in two generations (`KEPT` parts each at most; the older one goes when the
younger is full, and a part that is met again moves on), so frequent parts are encoded once. That makes encoding cheap and bounds memory for long texts
with white space; a text without any is encoded in one piece.

Defined cases: null and empty texts have the end id only; a null doc_id sorts first and stays null; rows of one doc_id are
ordered by the hash of their texts, then the texts, and equal rows each get a place of their own; a special token's string
in a text becomes its id, as the library does by default; an empty table makes no shard; extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import struct
import sys
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brook.llm.common import kept, segment_starts, slices, stored, table
from brook.session import shared_dir

END_ID = 2
SHARD, BLOCK_BITS, KEPT, LONG_PART = 1 << 21, 1 << 16, 300_000, 64
#: Bytes of text whose parts are looked up together.
SLICE = 2 << 20
_MAGIC = b"WMX1"
_HEADER = struct.Struct("<4sIIIIQQ")  # magic, levels, range, number in the range, documents, ids, ids before in the range
_LEVEL = struct.Struct("<QI")  # zeros, blocks


# -- the file ---------------------------------------------------------------------------------------------------------

def _section(data: bytes) -> bytes:
    packed = zstandard.compress(data, 3)
    return struct.pack("<Q", len(packed)) + packed


def pack(ids: np.ndarray, doc_ids: Sequence[int | None], lengths: Sequence[int], place: int = 0, number: int = 0,
         before: int = 0) -> bytes:
    """One shard as bytes."""
    ids = np.asarray(ids, dtype=np.uint32)
    n, levels = len(ids), max(1, int(ids.max(initial=0)).bit_length())
    squeeze = zstandard.ZstdCompressor(level=1).compress
    out = [_HEADER.pack(_MAGIC, levels, place, number, len(doc_ids), n, before)]
    out.append(_section(np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes()))
    out.append(_section(np.array([d is not None for d in doc_ids], dtype=np.uint8).tobytes()))
    out.append(_section(np.array(lengths, dtype="<u8").tobytes()))
    current = ids.astype(np.uint16) if levels <= 16 else ids
    for level in range(levels):
        ones = current & np.array(1 << (levels - 1 - level), dtype=current.dtype) != 0
        packed = np.packbits(ones, bitorder="little")
        starts = np.arange(0, len(packed), BLOCK_BITS // 8)
        counts = np.add.reduceat(np.bitwise_count(packed), starts, dtype=np.int64) if n else np.zeros(0, dtype=np.int64)
        plane = packed.tobytes()
        blocks = []
        for i in range(len(starts)):
            raw = plane[i * BLOCK_BITS // 8:(i + 1) * BLOCK_BITS // 8]
            small = squeeze(raw)
            blocks.append(small if len(small) < len(raw) else raw)
        out.append(_LEVEL.pack(n - int(counts.sum()), len(blocks)))
        out.append(segment_starts(counts).astype("<u8").tobytes())
        out.append(segment_starts(np.array([len(b) for b in blocks], dtype=np.int64)).astype("<u8").tobytes())
        out += blocks
        current = np.concatenate((current[~ones], current[ones]))
    return b"".join(out)


class Shard:
    """Reads a shard; blocks are opened when asked for, `HELD` of them stay open."""

    HELD = 256

    def __init__(self, data: bytes):
        self.data = memoryview(data)
        magic, self.levels, self.place, self.number, n_docs, self.n, self.before = _HEADER.unpack_from(self.data)
        if magic != _MAGIC:
            raise ValueError("not a token shard")
        at, parts = _HEADER.size, []
        for _ in range(3):
            (size,) = struct.unpack_from("<Q", self.data, at)
            parts.append(zstandard.decompress(bytes(self.data[at + 8:at + 8 + size])))
            at += 8 + size
        valid = np.frombuffer(parts[1], dtype=np.uint8)
        self.doc_ids = [int(d) if v else None for d, v in zip(np.frombuffer(parts[0], dtype="<i8"), valid, strict=True)]
        self.starts = segment_starts(np.frombuffer(parts[2], dtype="<u8").astype(np.int64))
        assert len(self.doc_ids) == n_docs
        self._zeros, self._ones, self._offsets, self._open = [], [], [], {}
        for _ in range(self.levels):
            zeros, n_blocks = _LEVEL.unpack_from(self.data, at)
            at += _LEVEL.size
            ones, offsets = (np.frombuffer(self.data, "<u8", n_blocks + 1, at + k * 8 * (n_blocks + 1)).astype(np.int64)
                             for k in (0, 1))
            at += 16 * (n_blocks + 1)
            self._zeros.append(int(zeros))
            self._ones.append(ones)
            self._offsets.append(offsets + at)
            at += int(offsets[-1])

    def _block(self, level: int, i: int) -> np.ndarray:
        """The bits of one block."""
        held = self._open.get((level, i))
        if held is None:
            bits = min(BLOCK_BITS, self.n - i * BLOCK_BITS)
            a, b = self._offsets[level][i:i + 2]
            raw = self.data[a:b]
            if b - a < -(-bits // 8):
                raw = zstandard.decompress(bytes(raw))
            held = np.unpackbits(np.frombuffer(raw, dtype=np.uint8), count=bits, bitorder="little")
            if len(self._open) >= self.HELD:
                self._open.clear()
            self._open[level, i] = held
        return held

    def rank(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones before each place of a plane."""
        at = np.asarray(at, dtype=np.int64)
        block = at // BLOCK_BITS
        out = self._ones[level][block]
        for i in np.unique(block[at % BLOCK_BITS > 0]):
            mine = np.flatnonzero(block == i)
            out[mine] += segment_starts(self._block(level, i))[at[mine] % BLOCK_BITS]
        return out

    def select(self, level: int, bit: int, k: np.ndarray) -> np.ndarray:
        """Place of the k-th (from 0) one or zero of a plane."""
        k, ones = np.asarray(k, dtype=np.int64), self._ones[level]
        before = ones if bit else np.minimum(np.arange(len(ones)) * BLOCK_BITS, self.n) - ones
        block = np.searchsorted(before, k, side="right") - 1
        out = np.empty(len(k), dtype=np.int64)
        for i in np.unique(block):
            mine = np.flatnonzero(block == i)
            out[mine] = i * BLOCK_BITS + np.flatnonzero(self._block(level, i) == bit)[k[mine] - before[i]]
        return out

    def access(self, at: np.ndarray) -> np.ndarray:
        """The ids at some places."""
        at = np.asarray(at, dtype=np.int64).copy()
        out = np.zeros(len(at), dtype=np.uint32)
        for level in range(self.levels):
            block, bit = at // BLOCK_BITS, np.zeros(len(at), dtype=bool)
            for i in np.unique(block):
                mine = np.flatnonzero(block == i)
                bit[mine] = self._block(level, i)[at[mine] % BLOCK_BITS] != 0
            ones = self.rank(level, at)
            at = np.where(bit, self._zeros[level] + ones, at - ones)
            out = (out << np.uint32(1)) | bit
        return out

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        """Where the id's occurrences of [lo, hi) stand below the last level."""
        if token < 0 or token >> self.levels:
            return 0, 0
        for level in range(self.levels):
            ones = self.rank(level, np.array([lo, hi]))
            if token >> (self.levels - 1 - level) & 1:
                lo, hi = (self._zeros[level] + ones).tolist()
            else:
                lo, hi = lo - int(ones[0]), hi - int(ones[1])
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        lo, hi = self._range(token, lo, self.n if hi is None else hi)
        return hi - lo

    def occurrences(self, token: int, lo: int = 0, hi: int | None = None) -> np.ndarray:
        """All places of an id, in order."""
        a, b = self._range(token, lo, self.n if hi is None else hi)
        at = np.arange(a, b)
        for level in reversed(range(self.levels)):
            if token >> (self.levels - 1 - level) & 1:
                at = self.select(level, 1, at - self._zeros[level])
            else:
                at = self.select(level, 0, at)
        return at

    def all(self) -> np.ndarray:
        """The whole sequence: from the last level up, parted halves go back to where they came from."""
        ids = np.zeros(self.n, dtype=np.uint16 if self.levels <= 16 else np.uint32)
        for level in reversed(range(self.levels)):
            blocks = [self._block(level, i) for i in range(len(self._ones[level]) - 1)]
            ones = np.concatenate(blocks) != 0 if blocks else np.zeros(0, dtype=bool)
            zeros, above = self._zeros[level], np.empty_like(ids)
            above[~ones] = ids[:zeros]
            above[ones] = ids[zeros:] | np.array(1 << (self.levels - 1 - level), dtype=ids.dtype)
            ids = above
        return ids.astype(np.uint32)


# -- encoding ---------------------------------------------------------------------------------------------------------

#: White space other than the four below, and characters that some rule may take for white space.
_ODD = re.compile("[" + "".join(map(chr, (
    0x0B, 0x0C, *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2010), *range(0x2028, 0x2030),
    *range(0x205F, 0x2065), 0x3000, 0xFEFF))) + "]")
#: Letters of Latin and Cyrillic words, by code points that all versions of Unicode agree on.
_LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u0400-\u0481\u048a-\u0523"
#: A word of such letters before a sign, white space or the end; a lone line end before a letter; anything else up to white space.
_PART = re.compile(rf" ?[{_LETTER}]++(?=[ \n\t\r!-&(-/:-@\[-`{{-~]|\Z)|\n(?=[{_LETTER}])|[ \n\t\r]*[^ \n\t\r]+|[ \n\t\r]+")
#: The same for texts with strings of special tokens, which hold letters and signs but no white space.
_COARSE = re.compile(r"[ \n\t\r]*[^ \n\t\r]+|[ \n\t\r]+")
_PLAIN = re.compile(f" ?[{_LETTER}]+")
#: The characters that stand for bytes in the vocabulary; a line end stays.
_BYTES = np.arange(256, dtype="<u2")
_HIDDEN = [*range(0x21), *range(0x7F, 0xA1), 0xAD]
_BYTES[_HIDDEN] = 256 + np.arange(len(_HIDDEN))
_BYTES[0x0A] = 0x0A
#: For texts with odd characters: only where a letter, digit or sign of ASCII stands before.
_CUT = re.compile(r"(?<=[!-~])(?=[ \n\t\r])")


def text_parts(text: str, special: Sequence[str] = ("<|endoftext|>",)) -> list[str]:
    """The text cut where no token can reach across."""
    if _ODD.search(text):
        return _CUT.split(text)
    return (_COARSE if any(x in text for x in special) else _PART).findall(text)


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers; short parts are encoded once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.by_line = Tokenizer.from_file(path), Tokenizer.from_file(path)
        for t in (self.tokenizer, self.by_line):
            t.no_truncation()
            t.no_padding()
        self.by_line.pre_tokenizer = pre_tokenizers.Split("\n", "removed")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Words may be split at line ends instead if the splitter is the byte-level one and nothing else touches letters.
        told = json.loads(self.tokenizer.to_str())
        splitter = told["pre_tokenizer"] or {}
        self.plain = (splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True)
                      and not splitter.get("add_prefix_space") and told["normalizer"] is None
                      and all(re.search(rf"[^{_LETTER}\s]", x) for x in self.special))
        vocabulary = self.tokenizer.get_vocab()
        self.sizes = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=np.int64)
        self.sizes[list(vocabulary.values())] = list(map(len, vocabulary))
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _words(self, parts: list[str]) -> list[bytes] | None:
        """Ids of words of letters, in one call; none if the tokens' lengths don't add up to theirs."""
        data = np.frombuffer("\n".join(parts).encode(), dtype=np.uint8)
        found = self.by_line.encode_batch_fast([_BYTES[data].tobytes().decode("utf-16-le")], add_special_tokens=False)
        ids = np.array(found[0].ids, dtype="<u4")
        ends = np.cumsum(self.sizes[ids])
        want = np.append(np.flatnonzero(data == 0x0A), len(data)) - np.arange(len(parts))
        at = np.searchsorted(ends, want)
        if not len(ids) or ends[-1] != want[-1] or (ends[at] != want).any():
            return None
        raw, cuts = ids.tobytes(), [0, *(4 * (at + 1)).tolist()]
        return [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _encode(self, parts: list[str]) -> list[bytes]:
        words = [p for p in parts if _PLAIN.fullmatch(p)] if self.plain else []
        if words and (ids := self._words(words)) is not None:
            of = dict(zip(words, ids, strict=True))
            rest = [p for p in parts if p not in of]
            of.update(zip(rest, self._each(rest), strict=True))
            return [of[p] for p in parts]
        return self._each(parts)

    def _each(self, parts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def many(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text."""
        split = [text_parts(t, self.special) if t else [] for t in texts]
        wanted = set().union(*split)
        long = {p for p in wanted if len(p) > LONG_PART}
        wanted -= long
        missing = wanted - self.known.keys()
        if len(self.known) + len(missing) > KEPT:
            self.older, self.known = self.known, {}
            missing = wanted
        known, older = self.known, self.older
        again = missing & older.keys()
        known.update([(p, older[p]) for p in again])
        new = list(missing - again)
        for i in range(0, len(new), 10_000):
            known.update(zip(new[i:i + 10_000], self._encode(new[i:i + 10_000]), strict=True))
        if not long:
            return [b"".join(map(known.__getitem__, parts)) for parts in split]
        once = {p: self._encode([p])[0] for p in long}
        return [b"".join([known[p] if p in known else once[p] for p in parts]) for parts in split]

    def ids(self, text: str | None) -> bytes:
        return self.many([text])[0]


def worker_encoder(path: str) -> Encoder:
    """One per worker process and path: each task has its own copy of the path, the interned one is the same object."""
    return kept(lambda: Encoder(path), Encoder, sys.intern(path))


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


# -- writing and reading ----------------------------------------------------------------------------------------------

def write_shards(spark: SparkSession, docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID,
                 shard: int = SHARD) -> None:
    """Writes the ids of all documents in ascending doc_id order, `end_id` after each, one file a shard."""
    tokenizer = tokenizer or default_tokenizer()
    end = np.array([end_id], dtype="<u4").tobytes()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer)
        place, number, before = TaskContext.get().partitionId(), 0, 0
        doc_ids, lengths, held, n = [], [], [], 0

        def close() -> pa.RecordBatch:
            packed = pack(np.frombuffer(b"".join(held), dtype="<u4"), doc_ids, lengths, place, number, before)
            return pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], names=["data"])

        for part in slices(batches, "text", SLICE):
            for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoder.many(part.column("text").to_pylist()),
                                   strict=True):
                ids += end
                doc_ids.append(doc_id)
                lengths.append(len(ids) // 4)
                held.append(ids)
                n += len(ids) // 4
                if n >= shard:
                    yield close()
                    doc_ids, lengths, held, number, before, n = [], [], [], number + 1, before + n, 0
        if doc_ids:
            yield close()

    files = rows.mapInArrow(run, "data binary").select(F.col("data").cast("string").alias("data"))
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    earlier = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")  # the shuffle files are of no use once the shards are written
    try:
        # The text writer copies the bytes of a string as they are; the line end after them is not part of a shard.
        files.write.option("maxRecordsPerFile", 1).text(path)
    finally:
        spark.conf.set(setting, earlier) if earlier is not None else spark.conf.unset(setting)


def shard_rows(spark: SparkSession, path: str, work, schema: str) -> DataFrame:
    """Rows that `work` makes of each shard: it takes a Shard and returns lists, one a column."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("content"):
                if len(data.as_buffer()) > 1:
                    yield pa.RecordBatch.from_pydict(dict(zip(names, work(Shard(data.as_buffer())), strict=True)))

    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return found.mapInArrow(run, schema)


def _with_starts(rows: DataFrame) -> DataFrame:
    """`start` from `before` (ids before it in its range), `place` and `ids` (ids of its range)."""
    totals = sorted(rows.groupBy("place").agg(F.sum("n_tokens")).collect())  # one row a range partition
    starts = segment_starts(np.array([n for _, n in totals], dtype=np.int64)).tolist()
    placed = rows.sparkSession.createDataFrame(
        [(p, s) for (p, _), s in zip(totals, starts, strict=False)], "place int, ahead long")
    return rows.join(placed, "place").withColumn("start", F.col("ahead") + F.col("before"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the shards."""

    def work(s: Shard):
        data = memoryview(s.all().astype("<u4").tobytes())
        at = s.starts.tolist()
        crcs = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(at, at[1:], strict=False)]
        n = len(s.doc_ids)
        return (pa.array([s.place] * n, pa.int32()), pa.array(s.doc_ids, pa.int64()), pa.array(s.starts[:-1] + s.before),
                pa.array(np.diff(s.starts)), pa.array(crcs, pa.int64()))

    rows = shard_rows(spark, path, work, "place int, doc_id long, before long, n_tokens long, ids_crc32 long")
    rows = stored(spark, rows, shared_dir(spark, "token-documents"))
    return _with_starts(rows).select("doc_id", "start", "n_tokens", "ids_crc32")


def token_counts(spark: SparkSession, path: str, tokens: Sequence[int]) -> DataFrame:
    """token, n: how often each id stands in the corpus, from a few blocks a shard."""
    tokens = sorted({int(t) for t in tokens})
    rows = shard_rows(spark, path, lambda s: (tokens, [s.count(t) for t in tokens]), "token long, n long")
    return rows.groupBy("token").agg(F.sum("n").alias("n"))


def occurrences(spark: SparkSession, path: str, token: int) -> DataFrame:
    """doc_id, position: every place of an id, counted within its document."""

    def work(s: Shard):
        at = s.occurrences(token)
        doc = np.searchsorted(s.starts, at, side="right") - 1
        return (pa.array([s.doc_ids[d] for d in doc.tolist()], pa.int64()), pa.array(at - s.starts[doc]))

    return shard_rows(spark, path, work, "doc_id long, position long")


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract: ids of byte_bpe_50k with id 2 at each end, written as shards and read back."""
    path = shared_dir(spark, "token-shards")
    write_shards(spark, table(spark, sf_dir, "documents"), path)
    return read_documents(spark, path)
