"""SentencePiece encoding by sampled segmentations, and lossless decoding.

A text becomes "▁" and the text with blanks as "▁", as SentencePiece does, and then a lattice over its characters:
every vocabulary piece that matches is an edge; a character that is no piece has the edges of its UTF-8 bytes. Forward
filtering sums the weights of all segmentations up to each position; backward sampling draws, from the end, one edge after
another in proportion, so a segmentation has exactly its share. Draws come from a counter-based generator seeded by the
row's key, `seed` and the place in the text: any partitioning or retry gives the same pieces.

No piece holds "▁" after another character or a line end (checked when the vocabulary is read), so the lattice
falls into independent words. A distinct word is filtered once and kept; sampling runs over all words of a batch at once.

Weights: the vocabulary is a merge list whose scores are ranks, so a piece of rank r weighs (r + 1) ** -alpha. Larger
alpha prefers frequent, longer segmentations less sharply spread; sampling never rules an edge out.

Decoding joins the pieces' bytes, turns "▁" into a blank and drops the first blank. A literal "▁" of a text is
encoded as its three bytes, hence every valid text comes back byte for byte.

Defined cases: null texts give null; the empty text gives no ids; a null key is a key like any other; equal keys with equal
texts give equal ids. The vocabulary file is read on the driver and broadcast (32,000 pieces, below 1 MB).
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brook.llm.common import carried, kept, map_batches, mix, segment_starts, table, unit, utf8

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
ALPHA, SEED = 1.5, 1
SPACE = "▁"
#: Stands for a literal SPACE inside a text: no valid UTF-8 text holds it.
LITERAL = "\ud800"
_WORD = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n+")
#: Lattice positions that a worker keeps.
KEPT_STATES = 2_500_000
_STEP, _TURN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


class Vocabulary:
    """Pieces of a SentencePiece file: (text or byte value, id, weight's logarithm)."""

    def __init__(self, path: str = MODEL, alpha: float = ALPHA):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.alpha = alpha
        self.bytes_of: list[bytes] = []
        self.byte_ids = [-1] * 256
        self.pieces: list[tuple[str, int, float]] = []
        ordinary = re.compile(f"{SPACE}*[^{SPACE}\n]*")
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:-1], 16)
                self.byte_ids[value] = i
                self.bytes_of.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.bytes_of.append(b"")
            else:
                if not ordinary.fullmatch(piece):
                    raise ValueError(f"piece {i} crosses a word")
                self.bytes_of.append(piece.replace(SPACE, " ").encode())
                # Runs of blanks have no rank of their own; they count as first.
                rank = -model.get_score(i) if model.get_score(i) > -1e8 else 0.0
                self.pieces.append((piece, i, -alpha * math.log(rank + 1.0)))
        if -1 in self.byte_ids:
            raise ValueError("the vocabulary has no byte fallback")
        self.begins = _Beginnings(self.pieces)


class _Beginnings:
    """All beginnings of pieces as a double array: from beginning b, character number c leads to place base[b] + c if `owner`
    there is b. The empty beginning stands at place 0."""

    def __init__(self, pieces: list[tuple[str, int, float]]):
        below: dict[str, list[str]] = {"": []}
        for piece, _, _ in pieces:
            for n in range(1, len(piece) + 1):
                if piece[:n] not in below:
                    below[piece[:n]] = []
                    below[piece[:n - 1]].append(piece[n - 1])
        letters = sorted({x for c in below.values() for x in c})
        number = {x: k for k, x in enumerate(letters, start=1)}
        self.number = np.zeros(0x110001, dtype=np.int32)  # 0: in no piece
        self.number[[ord(x) for x in letters]] = np.arange(1, len(letters) + 1)
        taken, place = bytearray(4 * len(below) + 2 * len(letters) + 2), {"": 0}
        taken[0], free = 1, 1
        # Beginnings with most followers first. Those of several don't look back; the holes they leave are for those of one.
        for begin in sorted((b for b, c in below.items() if c), key=lambda b: (len(b) > 0, -len(below[b]))):
            codes = sorted(number[x] for x in below[begin])
            if len(codes) == 1:
                free = 1
            at = taken.index(0, max(free, codes[0]))
            while any(taken[at - codes[0] + c] for c in codes):
                at = taken.index(0, at + 1)
            free = at
            if at + 3 * len(letters) > len(taken):  # there is always room for all letters behind the next place
                taken.extend(bytes(len(taken)))
            for x in below[begin]:
                k = at - codes[0] + number[x]
                taken[k], place[begin + x] = 1, k
            below[begin] = [at - codes[0], *codes]
        room = max(place.values()) + len(letters) + 1
        self.base, self.owner = np.zeros(room, dtype=np.int32), np.full(room, -1, dtype=np.int32)
        self.ids, self.weights = np.full(room, -1, dtype=np.int32), np.zeros(room)
        for begin, (base, *codes) in ((b, c) for b, c in below.items() if c):
            self.base[place[begin]] = base
            self.owner[[base + c for c in codes]] = place[begin]
        for piece, i, w in pieces:
            self.ids[place[piece]], self.weights[place[piece]] = i, w


class _Grown:
    """An array that grows at its end."""

    def __init__(self, kind, values=()):
        self.held = np.zeros(max(1 << 16, len(values)), dtype=kind)
        self.n = 0
        self.extend(np.array(values, dtype=kind))

    def __len__(self) -> int:
        return self.n

    def extend(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.held):
            grown = np.zeros(max(self.n + len(more), len(self.held) * 5 // 4), dtype=self.held.dtype)
            grown[:self.n] = self.held[:self.n]
            self.held = grown
        self.held[self.n:self.n + len(more)] = more
        self.n += len(more)

    def drop_last(self) -> None:
        self.n -= 1

    def values(self) -> np.ndarray:
        return self.held[:self.n]


class _Words(dict):
    """Words in the order in which they were met first, with their numbers."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


class Sampler:
    """Lattices of words, kept up to a bound, and sampling over many of them at once."""

    def __init__(self, vocabulary: Vocabulary):
        self.bytes_of = vocabulary.bytes_of
        self.byte_ids = np.array(vocabulary.byte_ids, dtype=np.int32)
        self.begins = vocabulary.begins
        sizes = np.fromiter(map(len, self.bytes_of), dtype=np.int64, count=len(self.bytes_of))
        self.size_of, self.start_of = sizes.astype(np.int32), segment_starts(sizes)[:-1]
        self.raw = np.frombuffer(b"".join(self.bytes_of), dtype=np.uint8)
        self.byte_weight = min(w for *_, w in vocabulary.pieces)
        self.reset()

    def reset(self) -> None:
        """State 0 is the start of every word and has no edges."""
        self.words = _Words()
        self.ends = _Grown(np.int32)  # last state of each word
        self.first = _Grown(np.int64, [0, 0])  # first edge of each state, and the end
        self.before, self.piece, self.upto = _Grown(np.int32), _Grown(np.int32), _Grown(np.float32)

    def matches(self, chars: np.ndarray, room: np.ndarray) -> list[tuple[np.ndarray, ...]]:
        """All pieces at all places, by length (1 first): place, id, weight. room: characters up to the word's end."""
        b = self.begins
        code = b.number[chars]
        at, node, out, n = np.arange(len(chars), dtype=np.int32), np.zeros(len(chars), dtype=np.int32), [], 0
        while len(at):
            c = code[at + n]
            to = b.base[node] + c
            going = np.flatnonzero((b.owner[to] == node) & (c > 0))
            at, node = at[going], to[going]
            n += 1
            ids = b.ids[node]
            piece = np.flatnonzero(ids >= 0)
            out.append((at[piece], ids[piece], b.weights[node[piece]]))
            going = np.flatnonzero(room[at] > n)
            at, node = at[going], node[going]
        return out

    def add(self, fresh: list[str]) -> None:
        """Forward filtering of new words, all at once, by position.

        Characters, and the states behind them, are numbered by depth: all words' first ones, all second ones and so on.
        """
        lengths = np.fromiter(map(len, fresh), dtype=np.int64, count=len(fresh))
        by_length = np.argsort(-lengths, kind="stable")
        fresh, lengths = [fresh[k] for k in by_length.tolist()], lengths[by_length]
        chars = np.frombuffer("".join(fresh).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        starts = segment_starts(lengths)
        begin = np.repeat(starts[:-1], lengths)
        depth = np.arange(len(chars)) - begin
        cuts = segment_starts(np.bincount(depth))  # first character of each depth
        state = (cuts[depth] + np.repeat(np.arange(len(fresh)), lengths)).astype(np.int32)
        found = self.matches(chars, (np.repeat(starts[1:], lengths) - np.arange(len(chars))).astype(np.int32))
        # The state behind character c is base + state[c]; a word's start is state 0.
        base = len(self.first) - 1
        begins = np.append(state, 0)[np.arange(len(chars)) - 1] + 1  # the state before a character, from 1
        begins[starts[:-1]] = 0
        # A character that is no piece: a chain of states, one for each of its bytes but the last.
        known = np.zeros(len(chars), dtype=bool)
        known[found[0][0]] = True
        chain_before, chain_piece = [], []
        extra: list[tuple[int, int, int, float]] = []
        for c in np.flatnonzero(~known).tolist():
            x = chr(int(chars[c]))
            raw = SPACE.encode() if x == LITERAL else x.encode()
            source = 0 if c == begin[c] else base + int(begins[c]) - 1
            for b in raw[:-1]:
                chain_before.append(source)
                chain_piece.append(self.byte_ids[b])
                source = base + len(chars) + len(chain_before) - 1
            extra.append((c, source, self.byte_ids[raw[-1]], self.byte_weight * len(raw)))
        targets = [state[place + n] for n, (place, _, _) in enumerate(found)]
        if extra:
            c, from_state, i, w = zip(*extra, strict=True)
            found.append((np.array(c), np.array(i, dtype=np.int32), np.array(w)))
            targets.append(state[found[-1][0]])
        degree = np.zeros(len(chars), dtype=np.int64)
        for to in targets:
            degree[to] += 1  # a state has at most one edge of each length
        first = segment_starts(degree)
        source, ids = np.empty(first[-1], dtype=np.int32), np.empty(first[-1], dtype=np.int32)
        weights, share = np.empty(first[-1]), np.empty(first[-1])
        free = first[:-1].copy()
        for to, (place, i, w) in zip(targets, found, strict=True):
            slot = free[to]
            free[to] += 1
            source[slot], ids[slot], weights[slot] = begins[place], i, w
        total = np.zeros(len(chars) + 1)  # by state from 1; 0 is a word's start
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            a, b = int(first[lo]), int(first[hi])
            x = weights[a:b] + total[source[a:b]]
            new, n = first[lo:hi] - a, degree[lo:hi]
            top = np.maximum.reduceat(x, new)
            sums = top + np.log(np.add.reduceat(np.exp(x - np.repeat(top, n)), new))
            total[lo + 1:hi + 1] = sums
            share[a:b] = np.exp(x - np.repeat(sums, n))
        source = np.where(source == 0, 0, source + np.int32(base - 1))
        if extra:
            source[slot] = from_state
        # A state's edges by share, the largest first; states of one degree are sorted together.
        by_degree = np.argsort(degree, kind="stable")
        ends = np.cumsum(np.bincount(degree))
        for k in range(2, len(ends)):
            at = first[by_degree[ends[k - 1]:ends[k]], None] + np.arange(k)
            if len(at):
                order = np.argsort(-share[at], axis=1, kind="stable") + at[:, :1]
                source[at], ids[at], share[at] = source[order], ids[order], share[order]
        upto = np.cumsum(share)
        last = first[1:]
        upto -= np.repeat(np.append(0.0, upto[last[:-1] - 1]), degree)
        upto[last - 1] = 2.0  # the last edge takes what rounding leaves
        offset = len(self.piece)
        self.first.drop_last()
        self.first.extend(offset + first[:-1])
        self.first.extend(offset + len(ids) + np.arange(len(chain_piece) + 1))
        for held, edges, chained in ((self.before, source, chain_before), (self.piece, ids, chain_piece),
                                     (self.upto, upto, [2.0] * len(chain_piece))):
            held.extend(edges)
            held.extend(np.array(chained, dtype=edges.dtype))
        ends = np.empty(len(fresh), dtype=np.int32)
        ends[by_length] = base + state[starts[1:] - 1]
        self.ends.extend(ends)

    def encode(self, texts: list[bytes | None], seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of ids of each text."""
        if len(self.first) > KEPT_STATES:
            self.reset()
        split, sizes = [], np.zeros(len(texts), dtype=np.int64)
        for k, text in enumerate(texts):
            if text:
                s = text.decode()
                if SPACE in s:
                    s = s.replace(SPACE, LITERAL)
                split.append(_WORD.findall(SPACE + s.replace(" ", SPACE)))
                sizes[k] = len(split[-1])
        seen = len(self.ends)
        number = np.fromiter(map(self.words.__getitem__, chain.from_iterable(split)), dtype=np.int64,
                             count=int(sizes.sum()))
        fresh = list(islice(self.words, seen, None))
        for i in range(0, len(fresh), 20_000):
            self.add(fresh[i:i + 20_000])
        state = self.ends.values()[number].astype(np.int64)
        first, before, piece, upto = (x.values() for x in (self.first, self.before, self.piece, self.upto))
        starts = segment_starts(sizes)
        place = np.arange(len(state)) - np.repeat(starts[:-1], sizes)
        with np.errstate(over="ignore"):
            seed = np.repeat(seeds, sizes) + place.astype(np.uint64) * _STEP
        live = np.arange(len(state))
        n_pieces = np.zeros(len(state), dtype=np.int64)
        drawn: list[tuple[np.ndarray, np.ndarray]] = []
        turn = 0
        while len(live):
            turn += 1
            edge = first[state]
            with np.errstate(over="ignore"):
                u = unit(mix(seed + np.uint64(turn) * _TURN)).astype(np.float32)
            ahead = np.flatnonzero(u >= upto[edge])
            while len(ahead):  # edges are sorted by share, so most draws stop at the first
                edge[ahead] += 1
                ahead = ahead[u[ahead] >= upto[edge[ahead]]]
            drawn.append((live, piece[edge]))
            n_pieces[live] += 1
            state = before[edge].astype(np.int64)
            more = np.flatnonzero(state)
            live, state, seed = live[more], state[more], seed[more]
        ends = np.cumsum(n_pieces)
        ids = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.int32)
        for back, (where, got) in enumerate(drawn, start=1):
            ids[ends[where] - back] = got
        return ids, np.add.reduceat(np.append(n_pieces, 0), starts[:-1]) * (sizes > 0) if len(texts) else sizes

    def decode_all(self, ids: np.ndarray, starts: np.ndarray) -> list[bytes]:
        """The texts of many rows of ids at once; starts: first id of each row, and the end."""
        size = self.size_of[ids]
        ends = segment_starts(size)
        raw = self.raw[np.repeat(self.start_of[ids] - ends[:-1], size) + np.arange(ends[-1])].tobytes()
        at = ends[starts].tolist()
        return [raw[a + (raw[a:a + 1] == b" " and a < b):b] for a, b in zip(at[:-1], at[1:], strict=True)]

    def decode(self, ids: Iterable[int]) -> bytes:
        """The text of ids; the inverse of encode."""
        raw = b"".join(map(self.bytes_of.__getitem__, ids))
        return raw[1:] if raw[:1] == b" " else raw


def _sampler(held) -> Sampler:
    """One per worker process and vocabulary."""
    vocabulary = held.value
    return kept(lambda: Sampler(vocabulary), Sampler, vocabulary)


def _seeds(keys: list, seed: int) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(repr(k), seed=seed) for k in keys], dtype=np.uint64)


def encode(spark: SparkSession, docs: DataFrame, key: str = "doc_id", vocabulary: str = MODEL, alpha: float = ALPHA,
           seed: int = SEED) -> DataFrame:
    """key, ids (null for a null text), n_pieces, n_chars, and whether decoding gives the text back."""
    held = spark.sparkContext.broadcast(Vocabulary(vocabulary, alpha))
    schema = carried(docs, [key], "ids array<int>, n_pieces long, n_chars long, lossless boolean")
    own: list[Sampler] = []

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not own:
            own.append(_sampler(held))
        texts = batch.column("_brook_text").to_pylist()
        ids, sizes = own[0].encode(texts, _seeds(batch.column(key).to_pylist(), seed))
        at = segment_starts(sizes)
        none = np.array([t is None for t in texts])
        listed = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids), mask=pa.array(none))
        same = [t is None or back == t for t, back in zip(texts, own[0].decode_all(ids, at), strict=True)]
        return pa.RecordBatch.from_arrays(
            [batch.column(key), listed, pa.array(sizes, mask=none),
             pa.array([None if t is None else len(t.decode()) for t in texts], pa.int64()), pa.array(same)],
            names=[key, "ids", "n_pieces", "n_chars", "lossless"])

    rows = docs.select(F.col(f"`{key}`"), utf8().alias("_brook_text"))
    return map_batches(rows, work, schema, "_brook_text", 4 << 20)


def decode(spark: SparkSession, encoded: DataFrame, key: str = "doc_id", vocabulary: str = MODEL) -> DataFrame:
    """key, text of encoded rows; null ids give null."""
    held = spark.sparkContext.broadcast(Vocabulary(vocabulary))
    schema = carried(encoded, [key], "text string")

    def run(batches):
        for batch in batches:
            own = _sampler(held)
            texts = [None if x is None else own.decode(x).decode() for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(texts, pa.string())], names=[key, "text"])

    return encoded.select(F.col(f"`{key}`"), "ids").mapInArrow(run, schema)


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled ids of every document."""
    return encode(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))
