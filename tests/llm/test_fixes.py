"""Inputs that once gave wrong rows, lost text or grew without bound: one test for each."""

import random
import re
import time
import tracemalloc

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyframe.llm import bpe, decontam, html, licenses, neardup, sharding, topk, warc
from tests.llm import brute


def test_each_benchmark_finds_its_own_documents(spark):
    """Twenty benchmarks one after the other in one session: no worker may search an earlier one."""
    docs = [(i, f"a {i} " + " ".join(f"w{i}x{j}" for j in range(14))) for i in range(20)]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1).cache()
    for k in range(20):
        items = [(f"i{k}", " ".join(f"w{k}x{j}" for j in range(2, 13)))]
        tests = spark.createDataFrame(items, "item_id string, text string")
        got = {r["doc_id"]: (r["n_words"], r["n"]) for r in decontam.find_matches(df, tests).select("doc_id", "n_words", decontam.hit_words(F.col("hits")).alias("n")).collect()}
        assert got == {i: brute.contamination(t, items)[:2] for i, t in docs}
        assert {r["doc_id"] for r in decontam.clean(df, tests).collect()} == set(range(20)) - {k}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=9), max_size=6), st.lists(st.lists(st.sampled_from("abcd"), max_size=14), min_size=1, max_size=4), st.integers(1, 5))
def test_search_gives_the_hits_of_brute_force(items, docs, window):
    found = decontam.TestSet([(str(i), " ".join(w)) for i, w in enumerate(items)], window)
    counts, hits, matches = found.search([" ".join(d) for d in docs])
    for d, n, h, m in zip(docs, counts, hits, matches):
        want, names = set(), set()
        for i, item in enumerate(items):
            k = min(window, len(item))
            for a in range(len(item) - k + 1 if item else 0):
                for b in range(len(d) - k + 1):
                    if item[a : a + k] == d[b : b + k]:
                        want.update(range(b, b + k))
                        names.add(str(i))
        assert n == len(d) and {x for s in h for x in range(s["word"], s["word"] + s["words"])} == want and {x["item_id"] for x in m} == names


def test_memory_of_a_test_set():
    rnd = random.Random(1)
    words = [f"word{i}" for i in range(20_000)]
    items = [(str(i), " ".join(rnd.choices(words, k=400))) for i in range(800)]
    size = sum(len(t) for _, t in items)
    tracemalloc.start()
    found = decontam.TestSet(items, 10)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(found.low) > 300_000 and peak < 50 * size


@pytest.mark.parametrize(("page", "text"), [
    ("<svg-icon></svg-icon><article><p>own text</p></article>", "own text"),
    ("<article><p>a</p><button-group><b>b</b></button-group><p>c</p></article>", "a b c"),
    ("<title-bar>x</title-bar><article><p>own</p></article>", "own"),
    ("<article><p>a</p><svg><path></article><p>tail</p>", "a"),
    ("<article><p>a</p><svg><text>drawn</text></svg><p>b</p><button>press</button></article>", "a b"),
    ("<article><p>a <math><mi>x</mi><mo>=</mo><mn>1</mn></math> b</p></article>", "a x=1 b"),
    ("<div class='post-ad-free'><p>own text</p></div>", "own text"),
    ("<div class='content widget-area-main'><p>own text</p></div>", "own text"),
    ("<div id='page-header-wrap'><p>own text</p></div><div class='sidebar'>x</div>", "own text"),
    ("<div data-class='ad' title=\"class='ad'\"><p>own text</p></div><p>more</p>", "own text more"),
    ("<div class='story-body'><p>own text</p></div><div class='ad-box'>buy</div>", "own text"),
    ("<article><p>own</p><div class='comment-list'><p>reader</p></div><div class='share-buttons'>share</div></article>", "own"),
    ("<article><p>own</p><section id='comments-area'>reader</section><div class='related_posts'>others</div><div class='newsletter-signup'>mail</div></article>", "own"),
    ("<article><div class='comment-list'><p>all there is</p></div></article>", "all there is"),
    ("<article><div class='notice-of-meeting'><p>own</p></div></article>", "own"),
])
def test_html_parts(page, text):
    assert html.extract_group([f"<html><body>{page}</body></html>"]) == [text]


def test_html_depth():
    for page in ("<div>" * 50_000 + "deep" + "</div>" * 50_000, "<div class='ad box'>" * 30_000 + "deep", "<ul><li>" * 20_000 + "deep"):
        tracemalloc.start()
        start = time.process_time()
        assert html.extract_group([page]) == ["deep"]
        _, peak = tracemalloc.get_traced_memory()
        tracemalloc.stop()
        assert peak < 200 << 20 and time.process_time() - start < 30


_BLOCKS = st.recursive(
    st.text("abc ", min_size=1, max_size=8).map(lambda t: f"<p>{t}</p>"),
    lambda inner: st.tuples(st.sampled_from(["div", "section", "article", "main", "ul", "svg-x", "object-list"]), st.sampled_from(["", " class='post-ad-free'", " id=comment-list", " class='notice x'", " role=main"]), st.lists(inner, max_size=3)).map(lambda t: f"<{t[0]}{t[1]}>{''.join(t[2])}</{t[0]}>"),
    max_leaves=8,
)


@settings(max_examples=150, deadline=None)
@given(_BLOCKS)
def test_a_page_with_text_is_never_empty(page):
    """Names alone never take all of a page's text, unless an article shows where it would be."""
    plain = " ".join(re.sub("<[^>]*>", " ", page).split())
    if "<article" not in page and "<main" not in page or not re.search("comment-list|notice x", page):
        assert bool(html.extract_group([page])[0]) == bool(plain)


def test_template_of_pages_without_articles():
    """Against a plain rule: on pages of one layout, the text of a block is the template's if it stands on all of them."""
    rnd = random.Random(5)
    for _ in range(20):
        fixed = [f"fixed {k}" for k in range(rnd.randint(1, 3))]
        pages, want = [], []
        for i in range(rnd.randint(3, 8)):
            own = [f"own {i} {k} {rnd.random()}" for k in range(3)]
            parts = [f"<div class=t{k}><p>{t}</p></div>" for k, t in enumerate(fixed)] + [f"<div class=s{k}><p>{t}</p></div>" for k, t in enumerate(own)]
            pages.append("<html><body>" + "".join(parts) + "</body></html>")
            want.append(" ".join(own))
        assert html.extract_group(pages) == want


RECORD = "record_id long, url string, at {}, kind string, headers map<string,string>, payload string"


@pytest.mark.parametrize("kind", ["double", "timestamp", "decimal(12,3)"])
def test_revisits_of_any_time(spark, kind):
    rows = [(1, 10.0, "response", "one"), (2, 20.2, "response", "two"), (3, 20.9, "revisit", None), (4, 20.2, "revisit", None), (5, 10.0, "revisit", None)]
    df = spark.createDataFrame([(i, "http://a.example/x", float(at), k, {"etag": "e"}, p) for i, at, k, p in rows], RECORD.format("double"))
    at = F.timestamp_millis((F.col("at") * 1000).cast("long")) if kind == "timestamp" else F.col("at").cast(kind)
    for bucket in (100_000, 1):
        got = {r["record_id"]: (r["refers_to"], r["outcome"], r["payload"]) for r in warc.resolve_revisits(df.withColumn("at", at), bucket).collect()}
        assert got == {3: (2, "resolved", "two"), 4: (1, "resolved", "one"), 5: (None, "missing", None)}


def test_revisits_of_records_that_share_an_id(spark):
    rows = [(1, f"http://{h}.example/", 5, "response", {"etag": "e"}, h) for h in "ab"] + [(2, f"http://{h}.example/", 9, "revisit", {"etag": "e"}, None) for h in "ab"]
    got = warc.resolve_revisits(spark.createDataFrame(rows, RECORD.format("long"))).collect()
    assert sorted((r["url_key"], r["payload"]) for r in got) == [("a.example", "a"), ("b.example", "b")]


def test_revisits_of_a_hot_response(spark):
    rows = [(0, "http://h.example/", 0, "response", {"etag": "e"}, "body")] + [(i, "http://h.example/", i, "revisit", {"etag": "e"}, None) for i in range(1, 300)]
    rows += [(1000 + i, f"http://o{i}.example/", i, "response", {}, str(i)) for i in range(30)] + [(2000 + i, f"http://o{i}.example/", 50, "revisit", {}, None) for i in range(30)]
    got = warc.resolve_revisits(spark.createDataFrame(rows, RECORD.format("long")), answers=20).collect()
    assert len(got) == 329 and sum(r["payload"] == "body" for r in got) == 299 and sum(r["outcome"] == "unchecked" for r in got) == 30


def test_ports_of_their_scheme(spark):
    df = spark.createDataFrame([("http://a.example:80/x",), ("https://a.example:443/x",), ("http://a.example:443/x",), ("HTTPS://a.example:80/x",)], "u string")
    assert [r[0] for r in df.select(warc.canonical_url(F.col("u"))).collect()] == ["a.example/x", "a.example/x", "a.example:443/x", "a.example:80/x"]


def test_license_positions_of_a_much_repeated_notice():
    words = [b"under", b"the", b"mit", b"license"] * 30_000 + ["é".encode(), b"undr", b"the", b"mit", b"license"]
    start = time.process_time()
    places = licenses._scanner(licenses.NOTICES).scan(words)
    assert time.process_time() - start < 20
    exact = [p for p in places if p[0] == "under the mit license" and p[4] == 0]
    assert [p[2] for p in exact] == list(range(0, 120_000, 4)) and all(p[3] == 4 for p in exact)
    assert places[-1][2:] == (120_001, 4, 1)


def test_closed_rows_are_not_read():
    rnd = np.random.default_rng(2)
    vectors = (rnd.normal(size=(2000, 32)) ** 5 * 40).astype(np.int64)  # few large components
    queries = vectors[::100]
    index = topk.ImpactIndex(np.arange(2000), vectors)
    found = list(index.search(np.arange(0, 2000, 100), queries, 5))
    for q, ids, scores in found:
        exact = vectors @ vectors[q]
        exact[q] = -(1 << 62)
        want = np.lexsort((np.arange(2000), -exact))[:5]
        assert ids.tolist() == want.tolist() and scores.tolist() == exact[want].tolist()
    assert index.read < 0.5 * len(queries) * np.count_nonzero(vectors)


def test_top_k_of_an_id_that_stands_often(spark):
    rows = [(7, [1.0, 2.0])] * 500 + [(8, [1.0, 1.0]), (9, [3.0, 0.0])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") == 9, 4).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(7, 3 * 65536)] * 4


def test_shards_by_the_law(spark):
    """Against the law itself: rows in order of their key and size, each in the shard of its middle byte."""
    rnd = random.Random(6)
    rows = [(i, rnd.choice(["same", f"t{i}"]), rnd.choice([1, 5, 400, None])) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, text string, bytes long")
    key = sharding.spread_key(F.col("text"), F.col("id")).alias("key")
    placed = sharding.shard(df, 9, F.col("bytes"), F.col("text"), F.col("id"), rows_in_range=50).withColumn("key", key)
    total, at, seen = sum(b or 0 for *_, b in rows), 0, [0] * 9
    for r in sorted(placed.collect(), key=lambda r: (r["key"], r["bytes"] or 0)):
        size = r["bytes"] or 0
        shard = min(8, (2 * at + size) * 9 // (2 * total))
        assert (r["shard"], r["slot"]) == (shard, seen[shard])
        seen[shard] += 1
        at += size


def test_few_ranges_hold_many_rows(spark, monkeypatch):
    monkeypatch.setattr(sharding, "MOST_RANGES", 4)
    df = spark.range(2000).withColumn("size", F.lit(1).cast("long"))
    got = sharding.shard(df, 4, F.col("size"), F.col("id"), F.col("id"), rows_in_range=1).groupBy("shard").count().collect()
    assert sorted(r["count"] for r in got) == [500] * 4


def test_one_id_with_very_many_rows(spark, monkeypatch):
    monkeypatch.setattr(neardup, "CLUSTER_ROWS", 8)
    monkeypatch.setattr(neardup, "BUCKET_ROWS", 8)
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(5, text)] * 300 + [(5, f"{text} {i}") for i in range(40)] + [(9, text + " other"), (3, "quite another text here")]
    got = {(r["doc_id"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(5, 5, True), (9, 5, False), (3, 3, True)}


def test_characters_that_one_table_lacks():
    import base64

    import public_tokenizers
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    newer = bpe.newer_characters()
    tool, rnd = bpe.ByteBPE(path, public_tokenizers.PATTERN, newer), random.Random(4)
    for _ in range(300):
        text = "".join(rnd.choice([*rnd.sample(newer, 3), "a", " ", "1", "́", "."]) for _ in range(20)) if newer else "a"
        assert tool.encode(text) == library.encode_ordinary(text)
