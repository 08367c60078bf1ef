"""Hard negatives against a plain form; the shared list's certificate; exact products."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from brook.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, n_pos=5, n_neg=10):
    good = [(i, l, [min(max(math.floor(256 * float(x)), -2**63), 2**63 - 1) for x in v]) for i, v, l in rows
            if i is not None and l is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    anchors = {}
    for i, l, v in good:
        if i % 100 == 0:
            anchors[i] = min(anchors.get(i, (len(v), l, v)), (len(v), l, v))
    out = []
    for a, (d, label, q) in anchors.items():
        scored = sorted((-sum(x * y for x, y in zip(q, v, strict=True)), i, l) for i, l, v in good if i != a and len(v) == d)
        for s, p, _ in [t for t in scored if t[2] == label][:n_pos]:
            fit = [t for t in scored if t[2] != label and 30 * -s <= 100 * -t[0] <= 90 * -s][:n_neg]
            out += [(a, p, r, i, -s, -t) for r, (t, i, _) in enumerate(fit, 1)]
    return sorted(out)


def shrink(monkeypatch, **more):
    for name, value in ({"PART": 32, "BLOCK": 3, "SEED": 20, "STEP": 8, "SAMPLE": 70, "WAVE": 40} | more).items():
        monkeypatch.setattr(hn, name, value)


@pytest.mark.parametrize("spread", [0.0, 1.0])
def test_is_brute_force(spark, monkeypatch, spread):
    shrink(monkeypatch)
    rng = np.random.default_rng(3)
    middles = rng.normal(size=(4, 6))
    v = (middles[rng.integers(0, 4, 900)] + 0.6 * rng.normal(size=(900, 6))) * np.exp(spread * rng.normal(size=(900, 1)))
    v[200:260] = v[200]  # ties
    rows = [(i, x.tolist(), int(l)) for i, (x, l) in enumerate(zip(v, rng.integers(0, 3, 900), strict=True))]
    rows += [(1_000, None, 1), (1_100, [None] * 6, 1), (1_200, [float("nan")] * 6, 1), (1_300, [float("inf")] * 6, 1),
             (None, v[0].tolist(), 1), (1_400, v[3].tolist(), None), (1_500, [0.5, 0.25], 1), (1_501, [1.0, 1.0], 1),
             (1_502, [0.5, 0.5], 2), (1_600, [], 1), (1_700, [0.0] * 6, 2), (1_800, (-v[0]).tolist(), 77)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as cell", "1 as score", "2 as dim")
    got = sorted(map(tuple, hn.mine(spark, df, F.col("vec_id") % 100 == 0).collect()))
    want = plain(rows)
    assert got == want and len(want) > 100


def test_repeated_rows(spark, monkeypatch):
    shrink(monkeypatch, WAVE=4_000_000)
    rows = [(1, [1.0, 0.0], 0)] * 30 + [(1, [0.9, 0.1], 0)] * 2 + [(2, [0.5, 0.0], 1)] * 30 + [(2, [0.5, 0.1], 1), (0, [1.0, 0.0], 0)]
    rows += [(0, [1.0, 0.5], 0), (100, [0.2, 0.2], 1), (3, [0.6, 0.0], 5), (4, [0.6, 0.0], 6)]
    got = hn.mine(spark, spark.createDataFrame(rows, SCHEMA).repartition(4), F.col("vec_id") % 100 == 0).collect()
    assert sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got) == plain(rows)


def test_few_none_and_large(spark):
    one = spark.createDataFrame([(0, [1.0], 1)], SCHEMA)
    for df in (one, one.limit(0), spark.createDataFrame([(0, [1.0], 1), (1, [1.0], 1)], SCHEMA)):
        out = hn.mine(spark, df, F.col("vec_id") % 100 == 0)
        assert out.count() == 0 and out.columns == [
            "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    rows = [(0, [1e8, 1.0], 1), (1, [0.5, 0.0], 1), (2, [0.3, 0.0], 2), (3, [1e8, 0.0], 2)]
    got = hn.mine(spark, spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0).collect()
    assert [(r.positive_id, r.negative_id, r.negative_score) for r in got] == [(1, 2, 256 * 10**8 * 76)]


def test_members_end_before_the_list_does():
    rng = np.random.default_rng(5)
    middle = rng.normal(size=16)
    near, far = middle + 0.05 * rng.normal(size=(64, 16)), rng.normal(size=(4_000, 16))
    v = np.floor(256 * np.concatenate((near, far))).astype(np.int64)
    part = hn.Part(np.arange(len(v)), np.zeros(len(v), dtype=np.int64), np.ones(len(v), dtype=np.int32), v)
    anchors = np.floor(256 * (middle + 0.05 * rng.normal(size=(40, 16)))).astype(np.int64)
    low, high = np.full(40, hn._LOW), np.full(40, hn._HIGH)
    block = hn.Block(10_000 + np.arange(40), np.zeros(40, dtype=np.int64), anchors, (np.arange(40), low, high))
    best = hn.Best(40, 5)
    made = hn.walk(block, 0, part, best, True)
    assert made < 0.5 * 40 * len(v)  # the certificate ends lists early
    score = anchors @ v.T
    for i in range(40):
        order = np.lexsort((part.ids, -score[i]))[:5]
        assert best.id[i].tolist() == part.ids[order].tolist()
    _, bound = block.shared_list(part)
    order, _ = block.shared_list(part)
    assert (score[:, order] <= block.norm[:, None] * bound[None, :] + 1e-6).all()


def test_products_and_windows_are_exact():
    rng = np.random.default_rng(2)
    for size in (1 << 10, 1 << 27, 1 << 62):
        a, b = rng.integers(-size, size, (3, 4)), rng.integers(-size, size, (5, 4))
        want = [[max(hn._LOW, min(hn._HIGH, sum(int(x) * int(y) for x, y in zip(p, q, strict=True)))) for q in b] for p in a]
        assert hn.products(a, b).tolist() == want
    score = np.array([0, 1, 7, 10, 101, -1, -7, -101, 2**63 - 1, -2**63, 2**62 + 3])
    assert hn.window(score, (30, 100), True).tolist() == [-(-30 * int(s) // 100) for s in score]
    assert hn.window(score, (90, 100), False).tolist() == [90 * int(s) // 100 for s in score]
