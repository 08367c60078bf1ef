"""URL filters, HTML extraction and exact top-k against plain forms, and their defined cases."""

from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brook.llm import html_text, topk, url_filter

# -- URLs -------------------------------------------------------------------------------------------------------------

URLS = [None, "", "no scheme", "http://", "http://a.net", "http://a.NET/", "https://x.example.net/en/1?q#f",
        "https://example.net/en/", "https://notexample.com/de/", "https://m.example.com/de/x", "https://example.com/de",
        "ftp://org/fr/", "http://b.org/fr/?a=/de/", "http://example.net?x/en/", "a://b://c.net/d", "http://cheap-pills.example.org/x",
        "http://x.org/supercheap-pills/", "http://docs.spam-farm.org/", "http://é.net/ü", "http://x.org/a.exe", "http://x.org/a.exe/b"]


@pytest.mark.parametrize("url", URLS)
def test_index_runs_every_rule_that_fits(url):
    rules = url_filter.default_rules()
    host, path = url_filter.split(url)
    fit = [r for r in rules if host + path and r.compiled.match(host + path)]
    for counts in ({}, {t: len(t) for r in rules for t in r.tokens}):
        a, b = url_filter.Index(rules, counts).decide(host, path)
        assert (a is not None) == any(r.host_rule for r in fit) and (b is not None) == any(not r.host_rule for r in fit)


def test_url_contract(spark):
    got = {r.page_id: r for r in url_filter.judge(
        spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")).collect()}
    at = {u: got[i] for i, u in enumerate(URLS)}
    assert (at[None].host, at[None].path, at[None].verdict, at[None].rule) == ("", "", "allow", None)
    assert at["http://a.net"].rule is None and at["http://a.NET/"].rule == "net/"
    assert at["https://x.example.net/en/1?q#f"].rule == "example.net/en/" and at["https://x.example.net/en/1?q#f"].path == "/en/1"
    assert at["https://notexample.com/de/"].rule is None and at["https://m.example.com/de/x"].verdict == "block"
    assert at["https://example.com/de"].rule is None
    assert at["ftp://org/fr/"].rule == "org/fr/" and at["http://b.org/fr/?a=/de/"].path == "/fr/"
    assert at["http://example.net?x/en/"].path == "" and at["http://example.net?x/en/"].rule is None
    assert at["a://b://c.net/d"].host == "b:"
    assert at["http://x.org/supercheap-pills/"].verdict == "block"
    assert at["http://x.org/a.exe"].verdict == "block" and at["http://x.org/a.exe/b"].verdict == "allow"
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string, host string")).count() == 0


# -- HTML -------------------------------------------------------------------------------------------------------------

LONG = "This is a sentence of the article that says something of interest to its readers. " * 3


def page(inside: str) -> str:
    return (f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var x='</p><p>no</p>';</script></head>"
            f"<body class='has-sidebar'>{inside}</body></html>")


def test_article_without_boilerplate():
    html = page(
        "<header><a href=/>Home</a></header><nav><ul><li><a>One</a><li><a>Two</a></ul></nav><aside>Popular now.</aside>"
        f"<div class='cookie-notice'>We use cookies on this page.</div><article><header><h1>Title &amp; more</h1></header>"
        f"<p><b>{LONG}<br><p>Short one.</p><div class=ad>Buy this wonderful thing today, it is cheap.</div>"
        f"<ul><li>First point</li><li>Second point</li></ul><p>{LONG}</p></article>"
        f"<form><label>Name</label><input><button>Send</button></form><section id=comments><article><p>{LONG} Nice.</p></article>"
        "</section><footer>&copy; 2024 Somebody. All rights reserved.</footer>")
    long = LONG.strip()
    assert html_text.main_text(html) == "\n\n".join(
        ["Title & more", long, "Short one.", "First point", "Second point", long])


def test_page_without_article_element():
    html = page(f"<div id='top-nav'><a>A</a> <a>B</a></div><div><p>{LONG}</p><p>Well.</p><p>{LONG}</p></div>"
                "<div class='footer'>Imprint</div>")
    assert html_text.main_text(html) == "\n\n".join([LONG.strip(), "Well.", LONG.strip()])


@pytest.mark.parametrize(("html", "text"), [
    (None, ""), ("", ""), ("<p", ""), ("<!-- only", ""), ("<script>x", ""), ("<article>a &lt; b&nbsp;&amp c</article>", "a < b & c"),
    ("<article><p>x<!-- y -->z</article>", "xz"), ("<article>a<b>b</b>\n c</article>", "ab c"),
])
def test_html_odd_pages(html, text):
    assert html_text.main_text(html) == text


def test_unclosed_quotes_stay_linear():
    html_text.main_text("<a href=\"" * 20_000 + "<article>" + LONG * 50)
    html_text.main_text("<div>" * 20_000 + LONG)


def test_minimum_cut_is_exhaustive_search():
    rng = random.Random(4)
    for _ in range(150):
        n = rng.randrange(1, 8)
        terminal = [rng.randrange(-9, 10) for _ in range(n)]
        edges = {(i, j): rng.randrange(1, 7) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5}

        def cost(side, terminal=terminal, edges=edges):
            return (sum(-t for t, s in zip(terminal, side, strict=True) if t < 0 and s)
                    + sum(t for t, s in zip(terminal, side, strict=True) if t > 0 and not s)
                    + sum(c for (i, j), c in edges.items() if side[i] != side[j]))

        assert cost(html_text.minimum_cut(terminal, edges)) == min(map(cost, itertools.product([False, True], repeat=n)))


def test_extraction_keeps_every_row(spark, sf_dir):
    out = html_text.op4_html_extraction(spark, sf_dir)
    assert out.count() == spark.read.parquet(f"{sf_dir}/pages.parquet").count()
    assert out.filter("text = ''").count() == 0
    odd = spark.createDataFrame([(1, "u", None, 1), (1, "u", None, 1), (None, None, "<p>x</p>", 2)],
                                "page_id long, url string, html string, text int")
    assert html_text.extract(odd).count() == 3 and html_text.extract(odd.limit(0)).count() == 0


# -- top-k ------------------------------------------------------------------------------------------------------------

def plain_top_k(rows, k):
    good = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in good:
        if q % 50 == 0:
            scores = sorted(((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in good
                             if i != q and len(a) == len(b)))[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scores, 1)]
    return sorted(out)


@pytest.mark.parametrize(("spread", "steep"), [(1.0, 0.6), (0.0, 0.0), (3.0, 2.0)])
def test_top_k_is_brute_force(spark, monkeypatch, spread, steep):
    rng = np.random.default_rng(8)
    v = rng.normal(size=(600, 8)) * np.exp(spread * rng.normal(size=(600, 1)))
    v[100:140] = v[100]  # ties
    rows = [(i, [float(np.float32(x)) for x in row]) for i, row in enumerate(v)]
    rows += [(700, None), (750, [None] * 8), (800, [float("nan")] * 8), (850, [float("inf")] * 8), (None, rows[0][1]),
             (900, [0.5, 0.25]), (901, [1.0, 1.0]), (950, [])]
    for name, value in (("BUCKET", 64), ("BLOCK", 4), ("HEAD", 50), ("WAVE", 40), ("STEEP", steep)):
        monkeypatch.setattr(topk, name, value)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))
    got = sorted(map(tuple, topk.top_k(spark, df, F.col("vec_id") % 50 == 0).collect()))
    assert got == plain_top_k(rows, 5)


def test_top_k_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (50, [2.0])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, topk.top_k(spark, df, F.col("vec_id") % 50 == 0).collect())) == [
        (0, 1, 50, 256 * 512), (50, 1, 0, 256 * 512)]
    assert topk.top_k(spark, df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_top_k_of_large_and_repeated_vectors(spark, monkeypatch):
    """Squares beyond a long, and one id that holds a third of the rows."""
    rows = [(0, [1e8, 1.0]), (1, [0.5, 2.0]), (2, [1.0, -3.0]), (3, [1e8, 0.0]), (50, [0.0, 0.25])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, topk.top_k(spark, df, F.col("vec_id").isin(50)).collect()))
    assert got == [t for t in plain_top_k(rows, 5) if t[0] == 50] and len(got) == 4
    monkeypatch.setattr(topk, "BUCKET", 32)
    rng = np.random.default_rng(1)
    many = [(7, [float(x) for x in rng.integers(-9, 9, 3)]) for _ in range(200)] + [(7, [2.0, 2.0, 2.0])] * 150
    many += [(i, [float(x) for x in rng.integers(-9, 9, 3)]) for i in range(400)]
    df = spark.createDataFrame(many, "vec_id long, embedding array<double>").repartition(4)
    assert sorted(map(tuple, topk.top_k(spark, df, F.col("vec_id") % 50 == 0).collect())) == plain_top_k(many, 5)
    rows = topk.integral(df).withColumn("dim", F.size("v")).withColumn("copy", F.monotonically_increasing_id())
    assert max(len(r.ids) for r in topk.parts(rows, 750).collect()) < 120
