"""Token shards against plain arrays and the tokenizer itself."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from brook.llm import token_files as tf
from brook.session import shared_dir


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tf.default_tokenizer())


@pytest.mark.parametrize(("n", "top", "block"), [(0, 1, 64), (1, 1, 64), (1, 50_257, 64), (130, 9, 64), (64, 3, 64), (5_000, 50_257, 512),
                                                 (3_000, 2, 1 << 16), (2_000, 1 << 20, 256)])
def test_wavelet_matrix_is_a_plain_array(monkeypatch, n, top, block):
    monkeypatch.setattr(tf, "BLOCK_BITS", block)
    monkeypatch.setattr(tf.Shard, "HELD", 3)
    rng = np.random.default_rng(n + top)
    ids = np.minimum(rng.integers(0, top, n), rng.integers(0, top, n)).astype(np.uint32)
    lengths = [n // 3, n - n // 3]
    s = tf.Shard(tf.pack(ids, [None, -7], lengths, 5, 2, 99) + b"\n")
    assert (s.n, s.place, s.number, s.before, s.doc_ids, s.starts.tolist()) == (n, 5, 2, 99, [None, -7], [0, n // 3, n])
    assert (s.all() == ids).all()
    at = rng.integers(0, n, 50) if n else np.zeros(0, dtype=np.int64)
    assert (s.access(at) == ids[at]).all()
    for token in {*ids[:20].tolist(), 0, 1, top - 1, top + 5, 1 << 40}:
        for lo, hi in ((0, n), (n // 4, n // 2), (n, n)):
            want = lo + np.flatnonzero(ids[lo:hi] == token)
            assert s.count(token, lo, hi) == len(want) and s.occurrences(token, lo, hi).tolist() == want.tolist()


ODD = ["a", "Z", "7", " ", "  ", "\n", "\t", "\r\n", "'s", "'", "!", " ", "　", "\x0b", "​", "ไทย", "é",
       "\U0001f600", "\x1c", " ", "<|endoftext|>", "#", "word", "don't", " ", "\x85"]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(ODD), max_size=30))
def test_parts_keep_the_ids(tokenizer, made):
    text = "".join(made)
    assert "".join(tf.text_parts(text)) == text
    mine = np.frombuffer(tf.Encoder(tf.default_tokenizer()).ids(text) if text in ("", "a") else ENCODER.ids(text), "<u4")
    assert mine.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


ENCODER = tf.Encoder(tf.default_tokenizer())


def test_bounded_cache_keeps_the_ids(tokenizer, monkeypatch):
    monkeypatch.setattr(tf, "KEPT", 5)
    encoder = tf.Encoder(tf.default_tokenizer())
    text = " ".join(f"word{i % 13} {'long' * 40}" for i in range(60))
    for _ in range(2):
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert len(encoder.known) <= 30


def plain(tokenizer, rows):
    """(doc_id, start, n, crc) in order; equal ids by any order of their texts."""
    out, start = [], 0
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("shard", [1, 50, 1 << 21])
def test_shards_of_documents(spark, tokenizer, shard):
    rows = [(i * 3 - 50, f"Document {i} has words, {'more ' * (i % 40)}and an end.\n") for i in range(200)]
    rows += [(1_000, None), (1_001, ""), (1_002, "x" * 5_000), (1_003, "word   " * 500), (-2**60, "first")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as data", "'c' as place", "2 as start")
    path = shared_dir(spark, "shards")
    tf.write_shards(spark, docs.repartition(7), path, shard=shard)
    want = plain(tokenizer, sorted(rows))
    assert sorted(map(tuple, tf.read_documents(spark, path).collect())) == want
    everything = np.concatenate([[*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for _, t in sorted(rows)])
    tokens = [2, 2**31, int(everything[0]), int(everything[5]), int(everything[-3])]
    counts = {r.token: r.n for r in tf.token_counts(spark, path, tokens).collect()}
    assert counts == {t: int((everything == t).sum()) for t in tokens}
    starts = {w[0]: w[1] for w in want}
    places = sorted(starts[r.doc_id] + r.position for r in tf.occurrences(spark, path, tokens[3]).collect())
    assert places == np.flatnonzero(everything == tokens[3]).tolist()


def test_repeated_and_null_ids_and_no_rows(spark, tokenizer):
    rows = [(7, "same text here")] * 40 + [(7, "another text")] * 5 + [(None, "no id"), (8, "last one")]
    path = shared_dir(spark, "shards")
    tf.write_shards(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(5), path, shard=20)
    got = tf.read_documents(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None] + [7] * 45 + [8]
    assert [r.start for r in got] == np.concatenate(([0], np.cumsum([r.n_tokens for r in got])[:-1])).tolist()
    assert sorted(r.ids_crc32 for r in got) == sorted(p[3] for p in plain(tokenizer, rows))
    empty = shared_dir(spark, "shards")
    tf.write_shards(spark, spark.createDataFrame([], "doc_id long, text string"), empty)
    assert tf.read_documents(spark, empty).count() == 0
    assert tf.token_counts(spark, empty, [1]).count() == 0 and tf.occurrences(spark, empty, 1).count() == 0


def test_contract_on_stored_documents(spark, sf_dir, tokenizer):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    out = tf.op11_token_files(spark, sf_dir)
    assert out.columns[:4] == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, out.collect())) == plain(tokenizer, docs)


def test_frequent_parts_are_encoded_once(monkeypatch):
    """A full cache forgot every part before, frequent ones too."""
    monkeypatch.setattr(tf, "KEPT", 50)
    encoder, asked = tf.Encoder(tf.default_tokenizer()), []
    plain = encoder._encode
    monkeypatch.setattr(encoder, "_encode", lambda parts: asked.extend(parts) or plain(parts))
    for i in range(500):
        encoder.ids(f"common words stay known{i}")
    assert asked.count(" words") == 1 and len(encoder.known) <= 50 and len(encoder.older) <= 50


def test_a_sign_makes_no_new_word(monkeypatch):
    """A word was encoded again for every sign behind it, and each word by a call's own encoding."""
    encoder, apart = tf.Encoder(tf.default_tokenizer()), []
    plain = encoder._each
    monkeypatch.setattr(encoder, "_each", lambda parts: apart.extend(parts) or plain(parts))
    encoder.ids("Unword unword, unword. (unword)\nÜnwört ünwört; слово слово!")
    assert sorted(p for p in encoder.known if "unword" in p) == [" (unword)", " unword"]
    assert not any(p.strip().isalpha() for p in apart)


@pytest.mark.parametrize("seed", range(3))
def test_words_in_one_call_are_the_librarys(tokenizer, seed):
    rng = np.random.default_rng(seed)
    made = ["a", "Zq", "é", "ß", "Жд", "'", "s", "’", "7", " ", "  ", "\n", "\n\n", "\t", ",", ".", "!?", "<|endoftext|>", "<|", "endoftext",
            "|>", "\u0301", "日本", "\u00a0", "ª", "×", "don't", "Ġx", "\U0001f600"]
    texts = ["".join(made[k] for k in rng.integers(0, len(made), rng.integers(0, 14))) for _ in range(800)]
    for text, ids in zip(texts, ENCODER.many(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_tokens_that_do_not_add_up_are_not_used(tokenizer, monkeypatch):
    encoder = tf.Encoder(tf.default_tokenizer())
    monkeypatch.setattr(encoder, "sizes", encoder.sizes * 0 + 1)
    text = "Some words whose tokens are longer than one"
    assert np.frombuffer(encoder.ids(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_tasks_of_a_worker_share_their_words(spark, tmp_path):
    """Each task made an encoder of its own, as its copy of the path was another object."""
    made = tmp_path / "made"
    made.mkdir()
    plain = tf.Encoder.__init__

    def counted(self, path):
        import os
        import uuid

        (made / f"{os.getpid()}-{uuid.uuid4().hex}").touch()
        plain(self, path)

    def run(batches):
        tf.Encoder.__init__ = counted
        path = "".join(list(tf.default_tokenizer()))  # not the object of any other task
        tf.worker_encoder(path)
        yield from batches

    spark.range(64, numPartitions=64).mapInArrow(run, "id long").count()
    pids = [f.name.split("-")[0] for f in made.iterdir()]
    assert pids and len(pids) == len(set(pids))
