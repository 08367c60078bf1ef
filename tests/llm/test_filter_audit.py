"""The filter audit against a plain form over all orders."""

from __future__ import annotations

import random
import re
from itertools import permutations

import duckdb
import numpy as np

from brook.llm import filter_audit as fa

DOCS, LABELS = "doc_id long, text string, source string", "doc_id long, quality int, toxic int"


def plain(docs, labels):
    good, toxic = ({d for d, *marks in labels if d is not None and marks[i] == 1} for i in (0, 1))
    first = {}
    for d, text, _ in docs:
        if d is not None:
            first[text or ""] = min(first.get(text or "", d), d)
    rows = []
    for d, text, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
            "E": d is not None and d > first[text]}
        rows.append((source or "", {f for f in "ABCDE" if failed[f]}, d in good, d in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        mine, shapley = [r for r in rows if r[0] == part], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone, left = [r for r in left if f in r[1]], [r for r in left if f not in r[1]]
                failing = [r for r in mine if f in r[1]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), len(failing) - len(gone), sum(r[1] == {f} for r in mine),
                    sum(r[2] for r in gone), sum(r[3] for r in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {(*k, *v) for k, v in out.items()}


def documents(n, rng):
    words = ["alpha", "beta", "Gamma", "DELTA", "x", "#tag", "50%", "café", "zü", " ", "\x0bq"] + [f"w{i}" for i in range(80)]
    texts = [" ".join(rng.choices(words[rng.choice((0, 11)):], k=rng.choice((0, 3, 49, 50, 51, 90)))) for _ in range(n // 2)]
    texts += ["", None, "   ", "\n\t", "ABC", "x" * 3_000, " ".join(f"u{i}" for i in range(50))]
    return [(i, rng.choice(texts), rng.choice(("web", "book", None, ""))) for i in range(n)]


def test_all_orders(spark):
    rng = random.Random(6)
    docs = documents(150, rng)
    docs += [(3, "one text", "web"), (3, "one text", "web"), (3, "one text", "book"), (9, "one text", "web"), (None, "one text", "web"),
             (None, None, None), (1_000, docs[5][1], "solo")]
    labels = [(i, rng.choice((0, 1, None)), rng.choice((0, 1))) for i in range(0, 160, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    frames = (spark.createDataFrame(docs, DOCS).selectExpr("*", "7 as n", "'c' as part", "1 as mask").repartition(5),
              spark.createDataFrame(labels, LABELS).selectExpr("*", "1 as good"))
    got = [tuple(r) for r in fa.audit(fa.masks(spark, *frames)).collect()]
    want = plain(docs, labels)
    assert set(got) == want and len(got) == len(want)


def test_survivors_of_every_set():
    rng = np.random.default_rng(1)
    cells = rng.integers(0, 9, (4, 32, 3))
    got = fa.survivors(cells)
    for chosen in range(32):
        assert (got[:, chosen] == cells[:, (np.arange(32) & chosen) == 0].sum(axis=1)).all()


def test_no_documents_no_labels(spark):
    none, marks = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert fa.audit(fa.masks(spark, none, marks)).count() == 0
    out = fa.audit(fa.masks(spark, spark.createDataFrame([(1, "a", None)], DOCS), marks)).collect()
    assert len(out) == 600 and {r.part for r in out} == {""} and sum(r.removed for r in out) == 120


def test_sql(spark, sf_dir):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    out = fa.op13_filter_audit(spark, sf_dir)
    columns = ["part", "filter_order", "step", *fa.COUNTS]
    assert out.columns == columns
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({fa.OP13_SQL})").fetchall()
    assert sorted(map(tuple, out.collect())) == sorted(want)
