"""Line dedup and near-duplicates against plain forms, and their defined cases."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from brook.llm import line_dedup, near_dedup

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                   StructField("n_chars", LongType()), StructField("h", StringType()), StructField("t", StringType()),
                   StructField("label", StringType())])


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None if t is None else len(t), "x", "y", "z") for i, t in rows], DOCS)


def words(rng, n):
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))


# -- line dedup -------------------------------------------------------------------------------------------------------

def plain_line_dedup(rows, min_words=8, long_line=50):
    """What a divisor beyond all hashes leaves of the rule: pairs of lines, and long lines."""
    places = {}
    split = []
    for i, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        lines = [(k, x) for k, x in enumerate(t.split("\n")) if x.strip(" ")] if t else []
        split.append(((i, t), lines))
        for a in range(len(lines)):
            for n in (1, 2):
                piece = [x for _, x in lines[a:a + n]]
                w = sum(x.count(" ") + 1 for x in piece)
                if len(piece) == n and (w >= min_words if n == 2 else w >= long_line):
                    places.setdefault("\n".join(piece), []).append(((i, t), a, [k for k, _ in lines[a:a + n]]))
    gone = {}
    for at in places.values():
        for doc, _, ks in at[1:]:
            gone.setdefault(doc, set()).update(ks)
    return {d: None if d[1] is None else "\n".join(x for k, x in enumerate(d[1].split("\n")) if k not in gone.get(d, ()))
            for d, _ in split}


def test_line_dedup_is_brute_force(spark):
    rng = random.Random(7)
    passage = "\n".join(words(rng, 12) for _ in range(5))
    long = words(rng, 60)
    rows = [(k, "\n".join([words(rng, 9), passage if k % 3 else long, *([words(rng, 6)] * (k % 2)), "Of."])) for k in range(30)]
    rows += [(None, passage), (40, None), (41, ""), (42, " \n\n "), (43, passage), (43, passage), (44, "a b\nc d\n" * 3),
             (45, "\n".join([words(rng, 3), "", passage.split("\n")[0], "", passage.split("\n")[1], "tail"]))]
    want = plain_line_dedup(rows)
    out = line_dedup.drop_repeats(spark, frame(spark, rows), divisor=1_000_000_007)
    assert out.columns == DOCS.names
    got = out.collect()
    assert len(got) == len(rows)
    by_id = {}
    for i, t in rows:
        by_id.setdefault(i, []).append(want[i, t])
    for r in got:
        assert r.text in by_id[r.doc_id], r.doc_id
        assert r.n_chars == (None if r.text is None else len(r.text))
    kept = "\n".join(r.text for r in got if r.text and r.doc_id != 43)
    assert all(kept.count(x) == 1 for x in passage.split("\n"))
    assert {r.text for r in got if r.doc_id == 43} == {""}


def test_chunks_find_repeats_of_short_lines(spark):
    """Pairs below the word bound leave these; the chunks that the rolling hash cuts find them."""
    rng = random.Random(3)
    passage = "\n".join(words(rng, 2) for _ in range(80))
    rows = [(k, f"{words(rng, 9)}\n{passage}\n{words(rng, 9)}") for k in range(4)]
    out = {r.doc_id: r.text for r in line_dedup.drop_repeats(spark, frame(spark, rows)).collect()}
    assert out[0] == rows[0][1]
    left = [len(out[k].split("\n")) for k in (1, 2, 3)]
    assert max(left) < 60 and len(set(left)) == 1  # the same boundaries everywhere


def plain_passages(rows, min_words=8):
    """Every repeat of two or more lines and min_words words; of three or more lines only without overlap."""
    split, places, gone = {i: t.split("\n") for i, t in rows}, {}, set()
    for i in sorted(split):
        for a in range(len(split[i])):
            for b in range(a + 2, len(split[i]) + 1):
                if sum(len(x.split(" ")) for x in split[i][a:b]) >= min_words:
                    places.setdefault(tuple(split[i][a:b]), []).append((i, a))
    for passage, ((stays, at), *later) in places.items():
        n = len(passage)
        for i, a in later:
            if n == 2 or i != stays or a >= at + n:
                gone.update((i, k) for k in range(a, a + n))
    return {i: "\n".join(x for k, x in enumerate(lines) if (i, k) not in gone) for i, lines in split.items()}


def test_repeats_of_short_lines_go_to_their_edges(spark):
    rng = random.Random(3)
    passage = "\n".join(words(rng, rng.randrange(1, 4)) for _ in range(80))
    ends = [(words(rng, 9), words(rng, 9)) for _ in range(4)]
    rows = [(k, f"{a}\n{passage}\n{b}") for k, (a, b) in enumerate(ends)]
    out = {r.doc_id: r.text for r in line_dedup.drop_repeats(spark, frame(spark, rows)).collect()}
    assert out == {0: rows[0][1], **{k: "\n".join(ends[k]) for k in (1, 2, 3)}}
    lines = ["a", "b", "a b", "c d e", "d", "a b c d e", "a b c d e f g h", "b c d e f g h i"]
    rows = [(k, "\n".join(rng.choice(lines) for _ in range(rng.randrange(1, 16)))) for k in range(60)]
    rows += [(100, "a\n" * 40 + "b"), (101, "p\nq\n" * 9 + "r")]
    for options in ({}, {"divisor": 2}):
        out = line_dedup.drop_repeats(spark, frame(spark, rows), **options).collect()
        assert {r.doc_id: r.text for r in out} == plain_passages(rows)


def test_indentation_and_alignment_are_no_words(spark):
    rng = random.Random(8)
    code = ["        }", "      }", "    return x", "  }", "x = 1", "", "\t\t\t\t", "\r", " \r"]
    padded = " " * 49 + "Contents" + " " * 9
    han = "".join(chr(rng.randrange(0x4E00, 0x9F00)) for _ in range(60))
    clean = ["\n".join([words(rng, 9), *code[k % 2:4], words(rng, 9), *code[4:], padded, words(rng, 9)]) for k in range(6)]
    body = "    if a then b\n\t\treturn c   or d e"
    rows = list(enumerate(clean)) + [(k, f"{words(rng, 9)}\n{body}") for k in (10, 11)]
    rows += [(k, f"{words(rng, 9)}\n{text}\n{words(rng, 9)}") for text, ks in ((han, (20, 21)), (
        f"{han[:4]}\n{han[4:8]}", (22, 23)), (f"{han[:3]}\n{han[3:7]}", (24, 25))) for k in ks]
    out = {r.doc_id: r.text for r in line_dedup.drop_repeats(spark, frame(spark, rows)).collect()}
    gone = {11: body, 21: han, 23: f"{han[:4]}\n{han[4:8]}"}
    for k, text in rows:
        assert out[k] == ("\n".join(text.replace(gone[k], "").replace("\n\n", "\n").split("\n")).removesuffix("\n")
                          if k in gone else text), k


def test_line_dedup_is_native_and_empty_safe(spark):
    df = frame(spark, [(1, "a b c d e\nf g h i j"), (2, "x\na b c d e\nf g h i j")])
    plan = line_dedup.drop_repeats(spark, df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert line_dedup.drop_repeats(spark, df.limit(0)).count() == 0


# -- near-duplicates --------------------------------------------------------------------------------------------------

def plain_classes(rows, similarity=0.8):
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    parts = []
    for _, t in rows:
        _, h, n = near_dedup.shingles([t.encode() if t is not None else None])
        parts.append((h, n))
    for a in range(len(rows)):
        for b in range(a):
            ta, tb = rows[a][1], rows[b][1]
            if ta is not None and tb is not None and (
                    ta == tb or near_dedup.probability_jaccard(parts[a], parts[b]) >= similarity):
                parent[root(a)] = root(b)
    out = []
    for k in range(len(rows)):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(k) and rows[j][0] is not None]
        out.append((rows[k][0], min(ids, default=None)))
    return sorted(out, key=str)


def edited(rng, text, n):
    ws = text.split()
    for k in rng.sample(range(len(ws)), n):
        ws[k] = f"e{rng.randrange(10**6)}"
    return " ".join(ws)


def test_classes_are_brute_force(spark):
    rng = random.Random(11)
    rows = []
    for g in range(6):
        base = words(rng, 150)
        rows += [(g * 100, base), (g * 100 + 1, base), (g * 100 + 2, base.upper())]
        rows += [(g * 100 + 3 + k, edited(rng, base, rng.choice([1, 2, 3, 8, 40]))) for k in range(12)]
    chain = words(rng, 200).split()  # neighbours are similar, the ends are not
    rows += [(1000 + k, " ".join(chain[k * 6:k * 6 + 120])) for k in range(12)]
    rows += [(2000 + k, words(rng, 80)) for k in range(20)]
    rows += [(3000, None), (3001, None), (None, None), (3002, ""), (3003, ""), (3004, "?!"), (3005, "a b"), (3006, "A, b"),
             (None, rows[0][1]), (3007, "word " * 4000), (3008, "word " * 4001)]
    rng.shuffle(rows)
    got = near_dedup.near_duplicates(spark, frame(spark, rows))
    assert sorted(map(tuple, got.collect()), key=str) == plain_classes(rows)
    kept = near_dedup.keep_one(spark, frame(spark, rows))
    assert kept.columns == DOCS.names
    want = [c for i, c in plain_classes([r for r in rows if r[1] is not None])]
    assert kept.count() == len(set(want)) + 3


def test_buckets_are_finished_without_all_pairs(spark, monkeypatch):
    """All texts in one bucket: later pivots find the links that the first one misses."""
    rng = random.Random(2)
    rows = []
    for g in range(12):
        base = words(rng, 60)
        rows += [(g * 10 + k, edited(rng, base, 1) if k else base) for k in range(4)]
        rows += [(g * 10 + 4 + k, edited(rng, base, 3 * k)) for k in range(1, 4)]  # some are out of reach
        rows += [(g * 10 + 8, base + " same " * 30), (g * 10 + 9, edited(rng, base, 1) + " same " * 31)]  # not flat
    monkeypatch.setattr(near_dedup, "buckets", lambda docs: docs.select(
        F.lit(1).cast("long").alias("bucket"), near_dedup._node().alias("t")).distinct())
    plain = near_dedup.bounds
    monkeypatch.setattr(near_dedup, "bounds", lambda *a: plain(*a).withColumn("bands", F.array(F.lit(1).cast("long"))))
    got = near_dedup.near_duplicates(spark, frame(spark, rows))
    assert sorted(map(tuple, got.collect()), key=str) == plain_classes(rows)


def test_labels_are_joined_to_one_row_a_text(spark, monkeypatch):
    """A text was joined with its label once for each of its buckets, in every round."""
    rng = random.Random(12)
    base = words(rng, 200)
    rows = [(k, edited(rng, base, k % 25)) for k in range(60)]
    seen, kind = [], type(spark.range(1))
    plain = kind.join

    def joined(self, other, *args):
        if {"node", "label"} <= {*other.columns}:
            seen.append((self.count(), self.select("t").distinct().count()))
        return plain(self, other, *args)

    monkeypatch.setattr(kind, "join", joined)
    got = near_dedup.near_duplicates(spark, frame(spark, rows))
    assert sorted(map(tuple, got.collect()), key=str) == plain_classes(rows)
    assert seen and all(n == texts for n, texts in seen)


def test_copies_too_different_to_be_linked_make_few_pairs(spark, monkeypatch):
    """Copies of one text, each with other words, all met each other: their signatures are alike, their links are few."""
    rng = random.Random(21)
    base = words(rng, 300)
    rows = [(k, edited(rng, base, 5)) for k in range(80)]
    pairs, plain = [], near_dedup.verified

    def counted(found, *args):
        pairs.append(found.count())
        return plain(found, *args)

    monkeypatch.setattr(near_dedup, "verified", counted)
    got = near_dedup.near_duplicates(spark, frame(spark, rows))
    assert sorted(map(tuple, got.collect()), key=str) == plain_classes(rows)
    assert sum(pairs) < 1000, pairs


@pytest.mark.parametrize("similarity", [0.5, 0.8, 0.95])
def test_sketches_never_rule_out_a_link(spark, similarity):
    """Two texts of the similarity differ in no more bits than `most_bits`, counts over 1 and unequal lengths included."""
    rng = random.Random(5)
    texts = []
    for _ in range(60):
        base = words(rng, rng.randrange(10, 400)).split()
        part = base[:rng.randrange(5, 40)]
        for n in (0, 1, 3, 8):
            some = edited(rng, " ".join(base), n).split()
            texts.append(" ".join(some + part * rng.choice((0, 0, 1, 4)) + base * rng.choice((0, 0, 0, 2))).encode())
    owner, h, count = near_dedup.shingles(texts)
    bits = near_dedup.sketches(len(texts), owner, h, count)
    of = [(h[owner == i], count[owner == i]) for i in range(len(texts))]
    rows = [(int(of[i][1].sum()), int((of[i][1] - 1).sum()), int(of[j][1].sum()), int((of[j][1] - 1).sum()),
             int(np.bitwise_count((bits[i] ^ bits[j]).view(np.uint64)).sum()))
            for at in range(0, len(texts), 4) for i in range(at, at + 4) for j in range(i + 1, at + 4)
            if near_dedup.probability_jaccard(of[i], of[j]) >= similarity]
    kinds = spark.createDataFrame(rows, "n long, again long, p_n long, p_again long, differ int")
    most = near_dedup.most_bits(*map(F.col, ("n", "again", "p_n", "p_again")), similarity)
    assert len(rows) > 20 and kinds.filter(F.col("differ") > most).isEmpty()


def test_keep_one_of_repeated_rows(spark):
    text = "one two three four five six"
    rows = [(1, text), (1, text), (2, text), (5, None), (5, None), (None, "q r s t u v"), (None, "q r s t u v")]
    out = near_dedup.keep_one(spark, frame(spark, rows)).collect()
    assert sorted((str(r.doc_id) for r in out)) == ["1", "5", "5", "None"]
    assert near_dedup.keep_one(spark, frame(spark, [])).count() == 0


def test_signatures_estimate_probability_jaccard():
    rng = random.Random(6)
    base = words(rng, 300)
    a, b = base + " " + " ".join(base.split()[:80]), edited(rng, base, 12)
    owner, h, n = near_dedup.shingles([a.encode(), b.encode()])
    want = near_dedup.probability_jaccard((h[owner == 0], n[owner == 0]), (h[owner == 1], n[owner == 1]))
    sig = near_dedup.signatures(2, owner, h, n, m=4096)
    assert abs((sig[0] == sig[1]).mean() - want) < 0.03
    one = near_dedup.signatures(1, np.zeros(1, dtype=np.int64), np.array([5], dtype=np.uint64), np.array([3]))
    assert (one == 5).all()


@pytest.mark.parametrize("seed", range(5))
def test_probability_jaccard_is_its_definition(seed):
    rng = np.random.default_rng(seed)
    ha, hb = (np.sort(rng.choice(30, size=rng.integers(1, 20), replace=False)).astype(np.uint64) for _ in range(2))
    ca, cb = rng.integers(1, 5, len(ha)), rng.integers(1, 5, len(hb))
    wa, wb = dict(zip(ha.tolist(), ca.tolist(), strict=True)), dict(zip(hb.tolist(), cb.tolist(), strict=True))
    want = sum(1 / sum(max(wa.get(e, 0) / wa[d], wb.get(e, 0) / wb[d]) for e in {*wa, *wb}) for d in wa.keys() & wb.keys())
    assert abs(near_dedup.probability_jaccard((ha, ca), (hb, cb)) - want) < 1e-9


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + k, 101 + k) for k in range(20)] + [(200, k) for k in range(201, 230)]
    df = spark.createDataFrame([(a.to_bytes(2, "big"), b.to_bytes(2, "big")) for a, b in edges], "a binary, b binary")
    got = {int.from_bytes(r.node, "big"): int.from_bytes(r.label, "big")
           for r in near_dedup.components(df, near_dedup._Store(spark, "components-test")).collect()}
    parent = {x: x for e in edges for x in e}
    for _ in range(60):
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert all(got.get(x, x) == parent[x] for x in parent)
