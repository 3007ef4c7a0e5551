"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns, hot groups, and the method's own parts."""

import random
import re

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tallyframe.llm import bpe, chat, common, decontam, html, licenses, neardup, quality, sharding, topk, warc
from tests.llm import brute

CLASH = "doc_id long, text string, n_words int, places int, score int, token_ids int, component int, component_id int, node int, key int, shard int, hits int, kept int"


def documents(spark, *rows):
    return spark.createDataFrame([(i, t, *[7] * 11) for i, t in rows], CLASH)


LONG = "under the mit license " + "word " * 300_000 + "cc by nc"


def test_licenses(spark):
    df = documents(spark, (1, None), (1, ""), (2, LONG), (3, "Undr the MIT licence!"), (3, "Undr the MIT licence!"), (None, "cc by-nc cc by nc"))
    got = licenses.scan(df).select("doc_id", "n_words", "places", "component").collect()
    assert sorted(r["n_words"] for r in got) == [0, 0, 4, 4, 6, 300_007] and all(r["component"] == 7 for r in got)
    fuzzy = [p for r in got if r["doc_id"] == 3 for p in r["places"]]
    assert [(p["label"], p["word"], p["words"], p["edits"]) for p in fuzzy] == [("mit", 0, 4, 2)] * 2
    assert [p["word"] for r in got if r["doc_id"] is None for p in r["places"]] == [0, 3]
    assert licenses.scan(df.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("under the mit license apache version 2 cc by nc mitt x".split()), max_size=30))
def test_licenses_keep_all_exact_places(words):
    text = " ".join(words)
    places = licenses._scanner(licenses.NOTICES).scan(common.words_of(text))
    base = [p for p in places if p[4] == 0 and p[0] in brute.PHRASES]
    assert (len(words), len(base), min((p[2] for p in base), default=None), max((p[2] for p in base), default=None)) == brute.licenses(text)[:4]


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int, score int")


def test_top_k(spark, monkeypatch):
    rnd = random.Random(3)
    data = [(i, [rnd.gauss(0, 1) if i % 3 else 0.25] * 2 + [rnd.gauss(0, 1) for _ in range(6)], 0, 0) for i in range(300)]
    data += [(50, [9.0] * 8, 0, 0), (400, None, 0, 0), (401, [1.0, None], 0, 0), (402, [float("nan")] * 8, 0, 0), (403, [float("inf")], 0, 0), (None, [1.0], 0, 0), (404, [], 0, 0), (405, [0.5], 0, 0)]
    monkeypatch.setattr(topk, "INDEX_ROWS", 64)  # several blocks
    monkeypatch.setattr(topk, "QUERY_ROWS", 4)
    df = vectors(spark, data)
    got = sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 25 == 0, 4).collect()))
    fine = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v, *_ in data if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q in sorted({i for i, _ in fine if i % 25 == 0 and i != 400}):
        options = [v for i, v in fine if i == q]
        found = sorted(map(tuple, (r[1:] for r in got if r[0] == q)))
        tried = [[(k, x, -s) for k, (s, x) in enumerate(sorted((-sum(a * b for a, b in zip(v, w)), x) for x, w in fine if x != q)[:4], 1)] for v in options]
        assert found in tried
        want.append(q)
    assert sorted({r[0] for r in got}) == want
    assert topk.top_k(df.limit(0), F.lit(True), 4).count() == 0
    two = topk.top_k(vectors(spark, [(0, [1.0], 0, 0), (2, [1e12], 0, 0), (1, [1e12], 0, 0)]), F.col("vec_id") == 0, 5)
    assert [(r["vec_id"], r["rank"]) for r in two.orderBy("rank").collect()] == [(1, 1), (2, 2)]


def test_chat_edges(spark):
    odd = ["</s>", r"\</s>", "\\", "[TEXT] a", r"\[ROLE] \\[/INST]", "", None, "<s> x </s>", "a\n\x00é"]
    rows = [(1, i, r, t) for i, (r, t) in enumerate((r, t) for r in ("user", "assistant", "tool [TEXT] \\", None, "") for t in odd)]
    rows += [(None, 0, "assistant", "x"), (2, None, "user", "b"), (2, None, "user", "a"), (2, 1, "assistant", "c"), (2, 1, "assistant", "c")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(df.withColumn("segments", F.lit(1)))).collect()}
    assert tuple(got[1])[1:5] == brute.chat([(r, t) for _, _, r, t in rows if _ is not None][: 5 * len(odd)])
    assert tuple(got[2])[1:5] == brute.chat([("user", "a"), ("user", "b"), ("assistant", "c"), ("assistant", "c")]) and not got[2]["valid"]
    assert got[None]["n_turns"] == 1
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="\\</s>[INST] ROLEX&é\n"), st.text(alphabet="\\</s>[TEX] ROLE"))
def test_chat_round_trip(text, role):
    tool = chat.Formatter(chat.DEFAULT)
    for r in ("user", "assistant", "system", role):
        assert tool.read("".join(s for s, _ in tool.write(r, text))) == (r, text)


def records(spark, rows):
    return spark.createDataFrame(rows, "record_id long, url string, at long, kind string, headers map<string,string>, payload string, bucket int")


@pytest.mark.parametrize("bucket_rows", [2, 100_000])
def test_revisits(spark, bucket_rows):
    r, v = "response", "revisit"
    rows = [
        (1, "http://www.A.com:80/x/?b=2&a=1&utm_source=z#f", 10, r, {"ETag": "e1", "Date": "d1", "X": "1"}, "one", 0),
        (2, "https://a.com/x?a=1&b=2", 20, r, {"etag": "e2"}, "two", 0),
        (3, "a.com/x?b=2&a=1", 20, v, {"ETAG": "e1", "date": "d3", "x": "9"}, None, 0),  # not the response of its own time
        (4, "a.com/x?b=2&a=1", 30, v, {"etag": "e1"}, None, 0), (5, "a.com/x?b=2&a=1", 30, v, {}, None, 0),
        (6, "a.com/y", 30, v, {"etag": "e1"}, None, 0), (7, None, None, v, None, None, 0), (8, "a.com/x?b=2&a=1", 5, v, {"etag": "e1"}, None, 0),
        (4, "a.com/x?b=2&a=1", 30, v, {"etag": "e1"}, None, 0), (9, "", 1, r, {"last-modified": "m"}, "n", 0), (10, None, 4, v, {"Last-Modified": "m"}, None, 0),
    ]
    got = sorted((x["record_id"], x["refers_to"], x["outcome"], x["payload"]) for x in warc.resolve_revisits(records(spark, rows), bucket_rows).collect())
    assert got == [
        (3, 1, "resolved", "one"), (4, 2, "mismatch", None), (4, 2, "mismatch", None), (5, 2, "unchecked", None), (6, None, "missing", None),
        (7, None, "missing", None), (8, None, "missing", None), (10, 9, "resolved", "n"),
    ]
    merged = warc.resolve_revisits(records(spark, rows), bucket_rows).where("record_id = 3").first()["headers"]
    assert merged == {"etag": "e1", "date": "d3", "x": "1"}
    assert warc.resolve_revisits(records(spark, rows).limit(0)).count() == 0


def test_bpe_edges(spark):
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    texts = [None, "", "<|endoftext|> don't  stop \n\n ok", "a" * 100_000, "été 😀" * 60_000, "x", "x"]
    coded = bpe.encode(documents(spark, *enumerate(texts)), path, pattern)
    got = bpe.decode(coded, path, pattern).orderBy("doc_id").collect()
    assert [bytes(r["decoded"]).decode() for r in got] == [t or "" for t in texts] and all(r["exact"] and r["kept"] == 7 for r in got)
    summed = {r["doc_id"]: r for r in bpe.round_trip(documents(spark, *enumerate(texts)), path, pattern).collect()}
    assert all(summed[r["doc_id"]]["ids_sha256"] == brute.sha(",".join(map(str, r["token_ids"]))) for r in got)
    assert bpe.encode(documents(spark, (1, "a")).limit(0), path, pattern).count() == 0


def test_bpe_pairs_against_merging():
    """Adjacent tokens stay if merging their bytes by rank gives the pair again."""
    tool = bpe.codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)

    def merge(data):
        parts = [data[i : i + 1] for i in range(len(data))]
        while True:
            best = min(((tool.ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in tool.ranks), default=None)
            if best is None:
                return [tool.ranks[p] for p in parts]
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]

    rnd = random.Random(5)
    ids = [rnd.randrange(3000) for _ in range(1500)]
    for a, b in zip(ids, ids[1:]):
        assert tool.adjacent(a, b) == (merge(tool.tokens[a] + tool.tokens[b]) == [a, b])


def test_quality_edges(spark):
    good = [f"Some line number {i} of plain words, quite long.\nAnother one follows here." for i in range(60)]
    bad = [f"BUY!! NOW!! {i}!! ###\nCLICK!! HERE!!" for i in range(60)]
    model = quality.fit_rows(good + bad, [1] * 60 + [0] * 60)
    df = documents(spark, (1, None), (2, ""), (3, "\n\n"), (4, good[0]), (4, good[0]), (5, bad[0]), (6, bad[0] * 20_000))
    got = [(r["doc_id"], r["score"]) for r in quality.score(df, model).collect()]
    assert all((s >= 0.7) == (i < 5) and 0 <= s <= 1 for i, s in got) and len(got) == 7
    empty = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.fit(df, empty).constant == 0.5
    one = spark.createDataFrame([(4, 1), (4, 1), (None, 0), (5, None)], "doc_id long, quality int")
    assert quality.fit(df, one).constant is not None
    assert quality.score(df.limit(0), model).count() == 0


def test_quality_marginals_by_enumeration():
    rnd = np.random.default_rng(1)
    lengths = np.array([3, 0, 1, 4])
    e, m = rnd.normal(size=8), rnd.normal(size=(2, 2))
    good, expected, total = quality.marginals(e, m, lengths)
    at, logs, moves = 0, 0.0, np.zeros((2, 2))
    for n in lengths:
        paths = [[(k >> i) & 1 for i in range(n)] for k in range(2**n)] if n else []
        weights = np.array([np.exp(sum(s * e[at + i] for i, s in enumerate(p)) + sum(m[a, b] for a, b in zip(p, p[1:]))) for p in paths])
        for i in range(n):
            assert np.isclose(good[at + i], sum(w for w, p in zip(weights, paths) if p[i]) / weights.sum())
        for w, p in zip(weights, paths):
            for a, b in zip(p, p[1:]):
                moves[a, b] += w / weights.sum()
        logs += np.log(weights.sum()) if n else 0
        at += n
    assert np.allclose(expected, moves) and np.isclose(total, logs)


PAGE = (
    "<html><head><title>t</title></head><body><header>site</header><nav><a>menu</a></nav><div class='cookie-notice'>we use</div>{}"
    "<aside>side</aside><form>send</form><section id=comments><p>reader</p></section><footer>foot</footer><script>var a='<p>x</p>'</script></body></html>"
)


def test_html_edges(spark):
    article = [PAGE.format(f"<article><h1>Title {i}</h1><p>A&amp;B <b>bo</b>ld\n {i}<br>next<p>open &lt;</article>") for i in range(5)]
    plain = [PAGE.format(f"<div class=content><p>{'long text of its own ' * 9}{i}</p><p>Same words</p></div>") for i in range(5)]
    rows = [(i, "http://h.example/x", p) for i, p in enumerate(article)] + [(10 + i, "https://p.example/x", p) for i, p in enumerate(plain)]
    rows += [(20, None, None), (21, "", ""), (22, "http://one.example", article[0]), (22, "http://one.example", article[0]), (23, "http://x.example", "no markup & <b>at all")]
    df = spark.createDataFrame([(*r, 3) for r in rows], "page_id long, url string, html string, text int")
    got = [(r["page_id"], r["text"]) for r in html.extract(df).collect()]
    texts = dict(got)
    assert len(got) == len(rows) and all(texts[i] == f"Title {i} A&B bold {i} next open <" for i in range(5))
    assert all(texts[10 + i] == "long text of its own " * 9 + str(i) for i in range(5))
    assert (texts[20], texts[21], texts[22], texts[23]) == ("", "", texts[0], "no markup & at all")
    assert html.extract(df.limit(0)).count() == 0


def test_html_hot_host_by_both_joins(spark, monkeypatch):
    rows = [(i, "http://h.example/", PAGE.format(f"<article><p>text {i}</p></article>")) for i in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    monkeypatch.setattr(html, "BLOCK_PAGES", 10)
    want = {i: f"text {i}" for i in range(60)}
    for bound in (100, 0):
        monkeypatch.setattr(html, "LARGE_HOSTS", bound)
        assert {r["page_id"]: r["text"] for r in html.extract(df).collect()} == want


def test_html_template_decides_inside_articles():
    """Against brute force: text of all pages of the host is template, under any class, with and without an article element."""
    for box in ("article", "div class=story"):
        own = [[f"Title {i}", *(f"own text {i} {k}" for k in range(1 + i % 4))] for i in range(12)]
        pages = [
            f"<body><{box}><h1>{texts[0]}</h1><div class=kudos>Give kudos</div>{''.join(f'<p>{t}</p>' for t in texts[1:])}<div class=end>The end</div></{box.split()[0]}></body>"
            for texts in own
        ]
        shared = set.intersection(*[set(re.findall(r">([^<>]+)<", page)) for page in pages])
        assert html.extract_group(pages) == [" ".join(t for t in re.findall(r">([^<>]+)<", page) if t not in shared) for page in pages] == [" ".join(t) for t in own]
    cards = [f"<body><div class=story><p>{'long story ' * 20}{i}</p></div><div class=more><article>card {i}</article></div></body>" for i in range(6)]
    assert html.extract_group(cards) == [f"{'long story ' * 20}{i} card {i}" for i in range(6)]
    alike = [f"<body><article>same text</article><footer>{i}</footer></body>" for i in range(4)]
    assert html.extract_group(alike) == ["same text"] * 4


def test_html_short_slots_and_short_pages():
    pages = [f"<body><div class=story><h1>Head {i}</h1><div class=lead>Lead {i}</div><p>{'long text ' * 300}{i}</p></div></body>" for i in range(5)]
    assert html.extract_group(pages) == [f"Head {i} Lead {i} {'long text ' * 300}{i}" for i in range(5)]
    short = [f"<body><h1>Head {i}</h1><div class=note>short {i}</div><div class=tale></div></body>" for i in range(5)]
    long = f"<body><h1>Head</h1><div class=note></div><div class=tale>{'long ' * 9000}</div></body>"
    assert html.extract_group([*short, long]) == [*(f"Head {i} short {i}" for i in range(5)), "Head " + " ".join(["long"] * 9000)]


def test_html_copies_leave_the_texts_alone(spark, monkeypatch):
    page = "<body><div class=top>Our site</div><div class=story><p>own text {}</p></div></body>"
    rows = [(i, "http://h.example/", page.format(i % 5)) for i in range(300)] + [(1000 + i, "http://h.example/", page.format(0)) for i in range(300)]
    rows += [(i, "http://h.example/", page.format(0)) for i in (7000, 7000)] + [(5000 + i, "http://few.example/", page.format(i)) for i in range(4)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    monkeypatch.setattr(html, "BLOCK_PAGES", 20)
    monkeypatch.setattr(html, "COPY_ROWS", 50)
    want = sorted((i, "own text " + re.search(r"text (\d+)", h)[1]) for i, _, h in rows)
    for least, bound in ((64, 100), (2, 0), (1000, 100)):  # the most copied page, all copied pages, and none is joined to its rows
        monkeypatch.setattr(html, "COPIES", least)
        monkeypatch.setattr(html, "LARGE_HOSTS", bound)
        assert sorted((r["page_id"], r["text"]) for r in html.extract(df).collect()) == want


@pytest.mark.parametrize(("page", "text"), [
    ("<div class='layout no-sidebar'><article><p>own</p></article></div>", "own"),
    ("<div class='layout no-sidebar'><p>own</p></div>", "own"),
    ("<div class='page-with-menu'><p>intro</p><article><p>own</p></article></div>", "own"),
    ("<main id='search-results'><p>own</p></main>", "own"),
    ("<article class='post comments-open'><p>own</p></article>", "own"),
    ("<article class='comments'><p>own</p></article>", "own"),
    ("<article><div class='entry-header'><h1>Head</h1></div><p>own</p></article>", "Head own"),
    ("<article><header class='header'><h1>Head</h1></header><p>own</p></article>", "Head own"),
    ("<div class='widget'><main><div class='notice'>own</div></main></div>", "own"),
    ("<article><p>own</p><div class='share big'>share it</div></article>", "own"),
    ("<main><p>own</p></main><section id='comments'><article>reader</article></section>", "own"),
    ("<main><p>own</p><section id='comments'><article class='comment'>reader</article></section></main>", "own"),
    ("<main><nav>menu</nav></main><div class='cookie-notice'>we use</div>", ""),
])
def test_html_names_of_other_parts(page, text):
    assert html.extract_group([f"<html><body>{page}</body></html>"]) == [text]


def test_template_classes():
    pages = [["a", "b", "x", "x", "c"], ["a", "b", "x", "c"], ["a", "b", "c"]]
    assert html._classes(pages) == [["a", "b", "c"]]
    assert html._classes([["a", "b", "c"], ["a", "c", "b"], ["a", "b", "c"]]) == []  # one order only


def test_sharding_hot_group(spark):
    rows = [(i, "same" if i % 3 else f"t{i}", 50 + i % 7) for i in range(6000)] + [(None, None, 1), (1, "same", 51)]
    df = spark.createDataFrame(rows, "id long, text string, slot int")
    got = sharding.shard(df, 7, F.col("slot"), F.col("text"), F.col("id"), rows_in_range=100).collect()
    assert len(got) == len(rows) and sorted({r["shard"] for r in got}) == list(range(7))
    for k in range(7):
        assert sorted(r["slot"] for r in got if r["shard"] == k) == list(range(sum(r["shard"] == k for r in got)))
    cuts = sharding.splitters(df.select(sharding.spread_key(F.col("text"), F.col("id")).alias("key"), F.lit(1).alias("size")), 6002, 60)
    sized = df.select(sharding.range_of(sharding.spread_key(F.col("text"), F.col("id")), cuts).alias("part")).groupBy("part").count().collect()
    assert max(r["count"] for r in sized) < 3 * 6002 / 60
    assert sharding.shard(df.limit(0), 7, F.col("slot"), F.col("text"), F.col("id")).count() == 0


def test_decontamination_edges(spark):
    a = "one two three four five six seven eight nine ten eleven twelve"
    tests = spark.createDataFrame([(1, a), (2, "Short item"), (3, None), (4, ""), (None, "null id"), (5, a), (5, a), (6, "x " * 15)], "item_id long, text string")
    texts = [(1, None), (2, ""), (3, "Zero " + a.upper() + "!"), (4, "a short, item"), (5, a.replace("ten", "10")), (6, "null-id"), (3, "Zero " + a.upper() + "!"), (7, "x " * 50_000), (8, a + " " + a)]
    df = documents(spark, *texts)
    listed = [(r["item_id"], r["text"]) for r in tests.collect()]
    for test_bytes in (1 << 20, 20):  # in one pass and in many
        got = decontam.find_matches(df, tests, test_bytes=test_bytes).select("doc_id", "n_words", decontam.hit_words(F.col("hits")).alias("n"), "matches", "kept").collect()
        assert len(got) == len(texts)
        for r in got:
            w, n, items, *_ = brute.contamination(dict(texts)[r["doc_id"]], [("null" if i is None else i, t) for i, t in listed])
            assert (r["n_words"], r["n"], len({m["item_id"] for m in r["matches"]})) == (w, n, items)
        longest = next(r for r in got if r["doc_id"] == 3)["matches"]
        assert sorted((m["item_id"], m["item_word"], m["word"], m["words"]) for m in longest) == [("1", 0, 1, 12), ("5", 0, 1, 12)]
        assert {r["doc_id"] for r in decontam.clean(df, tests).collect()} == {1, 2, 5}
    assert decontam.find_matches(df, tests.limit(0)).where("size(hits) > 0").count() == 0
    assert decontam.clean(df.limit(0), tests).columns == df.columns


def test_near_duplicates_edges(spark, monkeypatch):
    rnd = random.Random(2)
    base = [str(rnd.randrange(10_000)) for _ in range(300)]

    def near(k):
        words = list(base)
        for _ in range(k % 5):
            words[rnd.randrange(len(words))] = "changed"
        return " ".join(words) + f" {k}"

    rows = [(100 + k, near(k)) for k in range(60)] + [(1, None), (2, ""), (3, " \t"), (4, "Two words"), (5, "two  WORDS"), (6, "other words"), (7, "x"), (7, "two words"), (None, "x"), (8, "long " * 100_000)]
    rows += [(9, " ".join(base[:150])), (9, " ".join(base[:150]))]
    df = documents(spark, *rows)
    want = brute.near_duplicates([r for r in rows if r[0] is not None and r != (7, "two words")])
    for n in (4096, 8):  # whole groups, and groups in blocks
        monkeypatch.setattr(neardup, "BUCKET_ROWS", n)
        monkeypatch.setattr(neardup, "CLUSTER_ROWS", n)
        got = neardup.near_duplicates(df).collect()
        assert len(got) == len(rows)
        ids = {r["doc_id"]: r["component_id"] for r in got}
        assert ids[7] == ids[4] == ids[5] == 4 and ids[None] is None  # id 7 stands at two texts
        assert {i: ids[i] for i in want if i != 7} == {i: c for i, (_, c) in want.items() if i != 7}
        assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in got)
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def test_every_pair_within_the_radius_shares_a_key():
    rule = neardup.Rule()
    rnd = np.random.default_rng(4)
    a = rnd.integers(0, 1 << 16, rule.hashes)
    for _ in range(500):
        off = rnd.choice(rule.hashes, rule.radius, replace=False)
        assert any(np.isin(chunk, off).sum() <= 1 for chunk in rule.chunks)
    assert sorted(np.concatenate(rule.chunks)) == list(range(rule.hashes)) and len(a) == rule.hashes


@pytest.mark.parametrize("shape", ["chain", "star", "random"])
def test_components(spark, shape):
    rnd = random.Random(6)
    edges = {"chain": [(i, i + 1) for i in range(200)], "star": [(500, i) for i in range(50)], "random": [(rnd.randrange(150), rnd.randrange(150)) for _ in range(120)]}[shape]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    got = {r["node"]: r["component"] for r in common.components(spark.createDataFrame(edges + edges[:3], "a long, b long"), "test").collect()}
    assert got == {x: root(x) for x in list(parent)}


def test_pipeline_on_odd_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score int"
    rows = [(1, "good words here", "en", "s", 1, 0), (1, "good words here", "en", "s", 1, 0), (2, None, None, None, None, 0), (None, "null id", "en", "s", 1, 0), (3, "", "en", "s", 0, 0)]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["1", "2", "3", "None"] and all(r["exact"] for r in got)
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, spark.createDataFrame([], schema), str(tmp_path)).count() == 0


@pytest.mark.parametrize("bits", [1 << 27, 1 << 16, 8])
def test_map_of_nodes_never_loses_one(spark, monkeypatch, bits):
    monkeypatch.setattr(neardup, "MAP_BITS", bits)
    rows = spark.range(-500, 500).select(F.col("id").alias("node"), F.lit("x").alias("__text"))
    wanted = rows.where("node % 7 = 0").select("node", F.lit(1).alias("component"))
    found = neardup._likely(rows, wanted)
    assert found.columns == rows.columns
    assert found.join(wanted, "node").count() == wanted.count()
    assert found.count() <= (1000 if bits == 8 else wanted.count() + 30)
    assert neardup._likely(rows, wanted.limit(0)).count() == 0
