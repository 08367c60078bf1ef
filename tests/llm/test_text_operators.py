"""Toxicity, decontamination, SentencePiece, language id and licenses against plain forms, and their defined cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from brook.llm import decontaminate, language, licenses, pieces, toxicity
from brook.llm.common import words

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                   StructField("lang", StringType()), StructField("source", StringType()),
                   StructField("n_chars", LongType()), StructField("score", StringType())])
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ODD = [(None, "a b"), (1, None), (2, ""), (3, " \n\t "), (3, " \n\t "), (4, "é" * 5000 + " x" * 40000), (5, "a b")]


def plain_words(text: str | None) -> list[str]:
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "clash") for i, t in rows], DOCS)


def rows_of(df, key="doc_id"):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: (r[key] is None, r[key]))


@pytest.mark.parametrize("text", ["", "Ab-C1 ÄÖ ß_x", "a\u00a0b \u2014 c", "0/9:A@Z[`a{\x7f\x80é"])
def test_words_follow_the_rule(text):
    assert [w.decode() for w in words(text.encode())] == plain_words(text)


# -- decontamination --------------------------------------------------------------------------------------------------

def brute_hits(text, items, n=10):
    ws, hit, found = plain_words(text), set(), set()
    for item, t in items:
        iw = plain_words(t)
        for k in range(max(1, len(iw) - n + 1)) if iw and item is not None else ():
            win = iw[k:k + n]
            for i in range(len(ws) - len(win) + 1):
                if ws[i:i + len(win)] == win:
                    hit.update(range(i, i + len(win)))
                    found.add(str(item))
    return len(ws), len(hit), sorted(found)


def test_decontamination_is_brute_force(spark):
    rng = random.Random(3)
    vocabulary = ["aa", "bb", "cc", "dd"]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 9, 10, 12])))) for k in range(12)]
    items += [(3, items[3][1]), (None, "aa bb"), (50, None), (51, "?!")]
    docs = [(k, "A-A, " * 3 + " ".join(rng.choice(vocabulary) for _ in range(60))) for k in range(20)] + ODD
    bench = spark.createDataFrame(items, "item_id long, text string")
    for bound in (500_000, 20):  # one automaton, several
        got = decontaminate.find(spark, frame(spark, docs), bench, max_group_words=bound).collect()
        want = sorted((i is None, i or 0, *brute_hits(t, items)) for i, t in docs)
        assert sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_hit, list(r["items"])) for r in got) == want


def test_decontamination_spans_and_clean(spark):
    item = "one two three four five six seven eight nine ten"
    rows = [(1, "É. One, two-three four five six seven eight NINE ten! more"), (2, "clean"), (None, item), (3, None)]
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    found = {r.doc_id: r.spans for r in decontaminate.find(spark, frame(spark, rows), bench).collect()}
    (a, b), = found[1]
    assert rows[0][1][a:b] == "One, two-three four five six seven eight NINE ten"
    kept = decontaminate.clean(spark, frame(spark, rows), bench)
    assert kept.columns == DOCS.names and {r.doc_id for r in kept.collect()} == {2, 3}
    empty = bench.limit(0)
    assert decontaminate.clean(spark, frame(spark, rows), empty).count() == 4
    assert decontaminate.clean(spark, frame(spark, []), bench).count() == 0


def test_item_digest(spark, tmp_path):
    frame(spark, [(1, "x a b y"), (2, "q")]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(10, "a b"), (9, "b y")], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    got = rows_of(decontaminate.op3_benchmark_decontamination(spark, str(tmp_path)))
    assert got[0]["items_sha256"] == hashlib.sha256(b"10,9").hexdigest() and got[0]["n_hit"] == 3
    assert got[1]["items_sha256"] == hashlib.sha256(b"").hexdigest() and not got[1]["contaminated"]


# -- SentencePiece ----------------------------------------------------------------------------------------------------

TEXTS = ["", " ", "  two  spaces ", "hello world\n\nline", "▁ literal▁▁", "日本語テキスト \U00010348", "x" * 3000, "Ünï cödé",
         "tab\there\r\n", "\ufeffbom", "a\u0000b"]


def test_encoding_round_trip_and_reproducible(spark):
    rows = list(enumerate(TEXTS)) + [(None, "hello"), (99, None)]
    docs = frame(spark, rows)
    out = pieces.encode(spark, docs).collect()
    assert all(r.lossless for r in out)
    again = {(r.doc_id, tuple(r.ids) if r.ids is not None else None)
             for r in pieces.encode(spark, docs.repartition(5)).collect()}
    assert {(r.doc_id, tuple(r.ids) if r.ids is not None else None) for r in out} == again
    back = {r.doc_id: r.text for r in pieces.decode(spark, pieces.encode(spark, docs)).collect()}
    assert back == dict(rows)
    other = {r.doc_id: r.ids for r in pieces.encode(spark, docs, seed=2).collect()}
    assert any(other[r.doc_id] != r.ids for r in out)
    assert pieces.encode(spark, docs.limit(0)).count() == 0


def test_samples_follow_the_lattice():
    """All segmentations of a word, each as often as its weight says."""
    import math
    from collections import Counter

    vocabulary = pieces.Vocabulary()
    table = {p: (i, w) for p, i, w in vocabulary.pieces}

    def all_of(s):
        if not s:
            yield (), 0.0
        for n in range(1, len(s) + 1):
            if s[:n] in table:
                for rest, w in all_of(s[n:]):
                    yield (table[s[:n]][0], *rest), w + table[s[:n]][1]

    want = {g: math.exp(w) for g, w in all_of("▁there")}
    mass = sum(want.values())
    sampler, seen, n = pieces.Sampler(vocabulary), Counter(), 20_000
    ids, sizes = sampler.encode([b"there"] * n, np.arange(n, dtype=np.uint64) * np.uint64(7919))
    at = np.concatenate(([0], np.cumsum(sizes)))
    seen.update(tuple(ids[a:b].tolist()) for a, b in zip(at, at[1:], strict=False))
    assert set(seen) <= set(want)
    assert sum(abs(want[g] / mass - seen[g] / n) for g in want) / 2 < 0.02


def test_kept_words_are_bounded(monkeypatch):
    sampler = pieces.Sampler(pieces.Vocabulary())
    seeds = np.arange(3, dtype=np.uint64)
    first, _ = sampler.encode([b"one two", b"three", b"one"], seeds)
    monkeypatch.setattr(pieces, "KEPT_STATES", 1)
    again, _ = sampler.encode([b"one two", b"three", b"one"], seeds)
    assert first.tolist() == again.tolist()


def test_new_words_are_filtered_without_sorting_edges(monkeypatch):
    """Edges were found by hash and search and sorted twice, and every id was decoded on its own."""
    sampler = pieces.Sampler(pieces.Vocabulary())
    monkeypatch.setattr(np, "lexsort", None)
    texts = [t.encode() for t in TEXTS] + [None, "ὦ▁𐍈 ".encode() * 3]
    ids, sizes = sampler.encode(texts, np.arange(len(texts), dtype=np.uint64))
    starts = np.concatenate(([0], np.cumsum(sizes)))
    assert sampler.decode_all(ids, starts) == [t or b"" for t in texts]
    assert [sampler.decode(ids[a:b].tolist()) for a, b in zip(starts[:-1], starts[1:], strict=True)] == [t or b"" for t in texts]


def test_beginnings_of_pieces_are_all_found():
    listed = [("ab", 0, -1.0), ("a", 1, -2.0), ("b\u4e00c", 2, -3.0), ("\U0001f600", 3, -4.0), ("\u4e00", 4, -5.0), ("abcd", 5, -6.0)]
    b, found = pieces._Beginnings(listed), {}
    for piece, i, w in listed:
        place = 0
        for x in piece:
            to = b.base[place] + b.number[ord(x)]
            assert b.owner[to] == place
            place = to
        found[piece] = (piece, int(b.ids[place]), float(b.weights[place]))
    assert [*found.values()] == listed and (b.ids >= 0).sum() == len(listed)


# -- language ---------------------------------------------------------------------------------------------------------

def phrases(text: bytes, corpus: list[bytes]) -> int:
    at = n = 0
    while at < len(text):
        end = at + 1
        while end <= len(text) and any(text[at:end] in c for c in corpus):
            end += 1
        at, n = max(end - 1, at + 1), n + 1
    return n


def test_cross_parsing_is_the_greedy_parse():
    rng = random.Random(5)
    texts = [(name, [language.blanks("".join(rng.choice(letters) for _ in range(80)).encode()) for _ in range(3)])
             for name, letters in (("x", "abc "), ("y", "bcdé "), ("z", "aaab "))]
    parser = language.Parser(texts)
    samples = [language.blanks("".join(rng.choice("abcdeé q") for _ in range(n)).encode()) for n in (1, 7, 60, 200)]
    got = parser.phrases([parser.codes[np.frombuffer(s, dtype=np.uint8)] for s in samples])
    assert got.tolist() == [[phrases(s, ts) for _, ts in texts] for s in samples]


def test_language_held_out_and_odd_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = language.op6_language_id(spark, sf_dir).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (got.lang_pred == got.lang).mean() > 0.95 and got.score.between(0, 1).all()
    assert ((got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4)) == 2).all()
    texts = language.sample(docs)
    odd = rows_of(language.identify(spark, frame(spark, [*ODD, (8, "12 34 !")]), texts))
    by = {r["doc_id"]: r for r in odd}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (1, 2, 3, 8))
    assert by[4]["lang_pred"] != "und" and len(odd) == len(ODD) + 1
    assert {r["lang_pred"] for r in rows_of(language.identify(spark, frame(spark, ODD), []))} == {"und"}


def test_every_labelled_language_is_learned(spark):
    """Long texts give a part of themselves, and no language is left out, however many there are."""
    german = [(i, " ".join(["der Mann geht heute mit seinem Hund durch den Wald"] * 80)) for i in range(20)]
    english = [(100 + i, "the man walks his dog through the forest today") for i in range(20)]
    rows = spark.createDataFrame([(i, t, "de" if i < 100 else "en") for i, t in german + english], "doc_id long, text string, lang string")
    texts = language.sample(rows)
    assert [name for name, _ in texts] == ["de", "en"] and max(len(t) for _, ts in texts for t in ts) <= language.MAX_CHARS + 2
    found = language.identify(spark, frame(spark, [(1, "mit dem Hund durch den Wald"), (2, "his dog walks")]), texts)
    assert {r["doc_id"]: r["lang_pred"] for r in rows_of(found)} == {1: "de", 2: "en"}
    many = spark.createDataFrame([(i, f"{i} " + chr(0x4E00 + i % 300) * 400, f"l{i % 300}") for i in range(900)],
                                 "doc_id long, text string, lang string")
    texts = language.sample(many)
    assert len(texts) == 300 and all(len(ts) == 1 for _, ts in texts)
    assert sum(len(t) for _, ts in texts for t in ts) <= 4 * language.ROWS_ALL * language.MAX_CHARS


# -- toxicity ---------------------------------------------------------------------------------------------------------

def test_toxicity_learns_and_keeps_odd_rows(spark):
    rng = random.Random(1)
    plain = ["the", "house", "stands", "near", "river", "and", "old", "trees", "grow", "there"]
    bad = ["blarg", "blargish", "snork", "snorkel"]
    rows, labels = [], []
    for i in range(400):
        ws = [rng.choice(plain) for _ in range(rng.randrange(20, 120))]
        if i % 4 == 0:
            for _ in range(max(2, len(ws) // 15)):
                ws[rng.randrange(len(ws))] = rng.choice(bad)
        rows.append((i, " ".join(ws)))
        labels.append((i, 1, int(i % 4 == 0)))
    docs = frame(spark, rows)
    marks = spark.createDataFrame([*labels, (None, 1, 1), (9_999, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, marks.filter("doc_id is null or doc_id < 300"))
    got = {r.doc_id: r["_brook_score"] for r in toxicity.scored(spark, docs, model, ["doc_id"]).collect()}
    assert all((got[i] >= 0.5) == (i % 4 == 0) for i in range(300, 400))
    new = frame(spark, [(1, "the old blargy house near the river and blarged trees grow"), *ODD])
    kept = toxicity.keep_ordinary(spark, new, model)
    assert kept.columns == DOCS.names
    assert sum(r.text in (None, "", " \n\t ") for r in kept.collect()) == 4
    assert 1 not in {r.doc_id for r in kept.filter("text like '%house%'").collect()}
    untrained = toxicity.fit(docs, marks.limit(0))
    assert toxicity.keep_ordinary(spark, new, untrained).count() == new.count()


@pytest.mark.parametrize("marks", [
    [(1, 1), (2, 0), (3, 1), (4, 0)], [(9_000 + i, i % 2) for i in range(50)], [(i, 1) for i in range(30)], [(None, 1), (5, None)]])
def test_few_labels_give_no_nan(spark, marks):
    docs = frame(spark, [(i, f"word{i} is a text") for i in range(40)] + ODD)
    labels = spark.createDataFrame(marks, "doc_id long, toxic int").selectExpr("doc_id", "1 as quality", "toxic")
    scores = [r["_brook_score"] for r in toxicity.scored(spark, docs, toxicity.fit(docs, labels), ["doc_id"]).collect()]
    assert len(scores) == 40 + len(ODD) and all(0 <= s <= 1 for s in scores)


def test_a_repeated_id_is_sampled_once(spark):
    rows = [(i % 3, f"text {i} of one id") for i in range(90)] + [(100 + i, f"another {i}") for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in [*range(3), *range(100, 160)]], "doc_id long, toxic int")
    found = toxicity.sample(frame(spark, rows), labels).groupBy("id").count().collect()
    assert found and {r["count"] for r in found} == {1}
    assert toxicity.sample(frame(spark, rows), labels, max_rows=4).groupBy("toxic").count().filter("count > 4").count() == 0


def test_only_common_words_have_a_place(spark):
    counts = spark.createDataFrame([(f"w{i}", max(0, 5 - i), i) for i in range(20)], "w string, a long, b long")
    kept = {r.w for r in toxicity.commonest(counts, 3).collect()}
    assert kept == {"w0", "w1", "w2", "w17", "w18", "w19"}
    m = toxicity.Model([b"ab", b"ac"], np.array([3.0, 0]), np.array([1.0, 4]), (10.0, 10.0))
    assert np.allclose(m.word_share.sum(axis=1) + m.word_back[:, 0], 1, atol=1e-6) and m.word_back[0, 0] > 0.7


def test_probabilities_of_a_context_sum_to_one():
    ws = [b"ab", b"abc", b"ba", b"cab"]
    m = toxicity.Model(ws, np.array([3.0, 1, 0, 2]), np.array([1.0, 0, 4, 1]))
    keys = []
    for c in range(256):
        key = 0
        for b in [1, 1, 1, 1, ord("a"), c]:
            key = (key << 8) | b
        keys.append(key)
    key = np.array(keys, dtype=np.uint64)
    p = np.full((2, 256), 1 / 256)
    for grams, share, contexts, back, n in m.levels:
        g = toxicity._low(key, n)
        h = g >> np.uint64(8)
        i = np.minimum(np.searchsorted(contexts, h), len(contexts) - 1)
        p *= np.where(contexts[i] == h, back[:, i], 1.0)
        i = np.minimum(np.searchsorted(grams, g), len(grams) - 1)
        p += np.where(grams[i] == g, share[:, i], 0.0)
    assert np.allclose(p.sum(axis=1), 1, atol=1e-5)


# -- licenses ---------------------------------------------------------------------------------------------------------

def test_base_phrases_are_brute_force(spark, tmp_path):
    rng = random.Random(2)
    parts = ["cc", "by", "CC-BY", "general", "public", "license", "all", "rights", "reserved", "GNU", "x", "nc", "4.0"]
    rows = [(i, " ".join(rng.choice(parts) for _ in range(rng.randrange(0, 60)))) for i in range(60)] + ODD
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = licenses.op9_license_scans(spark, str(tmp_path)).collect()
    want = []
    for i, t in rows:
        ws = plain_words(t)
        at = [(k, label) for phrase, label in licenses.BASE for k in range(len(ws))
              if ws[k:k + phrase.count(b" ") + 1] == phrase.decode().split()]
        places = [k for k, _ in at]
        want.append((str(i), len(ws), len(at), min(places, default=None), max(places, default=None),
                     ",".join(sorted({x for _, x in at}))))
    assert sorted(((str(r.doc_id), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got),
                  key=str) == sorted(want, key=str)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got)


def test_priority_and_containment():
    scanner = licenses.Scanner(licenses.default_rules())
    labels = lambda t: [r.label for *_, r in scanner.scan(words(t.encode()))]
    assert labels("Licensed under the Apache License, Version 2.0.") == ["apache-2.0"]
    assert labels("SPDX-License-Identifier: GPL-2.0-or-later") == ["gpl-2.0-or-later"]
    assert labels("Released under the MIT License.") == ["mit"]
    assert labels("GNU General Public License, version 3") == ["gpl-3.0", "gpl"]
    assert labels("a commit about limits") == []
    assert len(licenses.default_rules()) >= 300


def generated(rng, parsed):
    """A random match of a parsed pattern without loops."""
    out = ""
    for op, av in parsed:
        name = str(op)
        if name == "LITERAL":
            out += chr(av)
        elif name == "IN":
            kind, x = rng.choice(av)
            out += chr(x if str(kind) == "LITERAL" else rng.randrange(x[0], x[1] + 1))
        elif name == "MAX_REPEAT":
            out += "".join(generated(rng, av[2]) for _ in range(rng.randrange(av[0], int(av[1]) + 1)))
        elif name == "SUBPATTERN":
            out += generated(rng, av[-1])
        elif name == "BRANCH":
            out += generated(rng, rng.choice(av[1]))
        else:
            assert name == "ASSERT_NOT"
    return out


def test_keywords_lose_no_match():
    rng = random.Random(6)
    rules = licenses.default_rules()
    scanner = licenses.Scanner(rules)
    for r in rules:
        parsed = re._parser.parse(r.pattern.pattern.decode())
        for _ in range(40):
            ws = generated(rng, parsed).encode().split()
            line = b" ".join(ws)
            assert r.pattern.search(line), line
            assert set(ws) & set(r.keyword.split()), line
    label = lambda t: {r.label for *_, r in scanner.scan(words(t.encode()))}
    for text, want in (("GPLv2", "gpl-2.0"), ("GPLv3", "gpl-3.0"), ("AGPLv3", "agpl-3.0"), ("LGPLv3", "lgpl-3.0"),
                       ("LGPLv2.1", "lgpl-2.1"), ("0BSD", "bsd-0"), ("FreeBSD license", "bsd-2-clause"),
                       ("PSF license", "python-2.0"), ("open rail", "openrail"),
                       ("noncommercial use only", "noncommercial"),
                       ("public domain dedication and license", "pddl-1.0")):
        assert label(text) == {want}, text


def test_suppression_matches_the_plain_rule():
    rng = random.Random(9)
    for _ in range(200):
        found = []
        for k in range(12):
            a = rng.randrange(30)
            found.append((a, a + rng.randrange(1, 12), k, licenses.Rule("x", rng.choice([50, 60]), b"k", re.compile(b"k"), 1)))
        found.sort(key=lambda d: (-d[3].priority, d[0] - d[1], d[0], d[2]))
        kept = []
        for d in found:
            if not any(c[0] <= d[0] and d[1] <= c[1] for c in kept):
                kept.append(d)
        assert licenses.suppress(found) == kept


def test_queries_return_every_row(spark, sf_dir):
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for query in (toxicity.op2_toxicity, licenses.op9_license_scans, pieces.op5_sentencepiece):
        out = query(spark, sf_dir)
        assert out.count() == n and out.filter(F.col("doc_id").isNull()).count() == 0
