"""Every query of the package against its SQL or a plain version, on the given small tables."""

import base64
import math
import os
import zlib
from collections import defaultdict

import duckdb
import pytest
import tiktoken

import corpus_pipeline
from __spark_entry__ import queries
from check_oracles import TABLES, canonical
from tallyframe.llm import queries as registered
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_DIR}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def docs(con):
    return con.execute("select doc_id, text from documents").fetchall()


def rows(spark, name):
    return queries()[name](spark, SF_DIR).collect()


def test_all_are_registered():
    assert set(registered.QUERIES) | {"pipeline"} <= set(queries())


@pytest.mark.parametrize("name", sorted(registered.ORACLES))
def test_sql(spark, con, name):
    df, want = queries()[name](spark, SF_DIR), con.sql(registered.ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(want.columns, want.fetchall())


def test_op1(spark, docs):
    got = {r["doc_id"]: tuple(r)[1:6] for r in rows(spark, "op1_license_scan")}
    assert got == {i: brute.licenses(t) for i, t in docs}


def test_op2(spark, con):
    v = {i: [math.floor(256 * x) for x in e] for i, e in con.execute("select vec_id, embedding from embeddings").fetchall()}
    want = []
    for q in (q for q in v if q % 50 == 0):
        best = sorted((-sum(a * b for a, b in zip(v[q], v[x])), x) for x in v if x != q)[:5]
        want += [(q, k, x, -s) for k, (s, x) in enumerate(best, 1)]
    assert sorted(map(tuple, rows(spark, "op2_topk"))) == sorted(want)


def test_op3(spark, con):
    turns = defaultdict(list)
    turns[-1] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    for conv, role, text in con.execute("select conv_id, role, text from conversations order by conv_id, turn").fetchall():
        turns[conv].append((role, text))
    got = {r["conv_id"]: tuple(r)[1:5] for r in rows(spark, "op3_chat_format")}
    assert got == {c: brute.chat(t) for c, t in turns.items()}


def test_op5(spark, docs):
    with open(registered.VOCABULARY, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    reference = tiktoken.Encoding("own", pat_str=registered.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r["doc_id"]: tuple(r)[1:] for r in rows(spark, "op5_byte_bpe")}
    for i, text in docs:
        ids = reference.encode_ordinary(text)
        assert got[i] == (len(ids), brute.sha(",".join(map(str, ids))), brute.sha(text))


def test_op6_on_held_out_rows(spark, con):
    labels = dict(con.execute("select doc_id, quality from labels").fetchall())
    got = {r["doc_id"]: r for r in rows(spark, "op6_quality")}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for i, r in got.items())
    judged = [got[i]["predicted"] == q for i, q in labels.items() if got[i]["held_out"]]
    assert sum(judged) >= 0.85 * len(judged)


def test_op7(spark, con):
    """The given pages hold their main text in one article element of paragraphs, headings and bold type."""
    import html
    import re

    got = {r["page_id"]: r for r in rows(spark, "op7_html_text")}
    for page, text in con.execute("select page_id, html from pages").fetchall():
        article = text[text.index("<article>") + 9 :].split("</article>")[0]
        blocks = html.unescape(re.sub("<(/?p|/?h1|br)>", " ", re.sub("</?b>", "", article)))
        assert got[page]["text"] == " ".join(blocks.split()) and got[page]["n_chars"] == len(got[page]["text"])


def test_op8(spark, docs):
    got, texts = rows(spark, "op8_sharding"), dict(docs)
    shards = defaultdict(list)
    for r in got:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(data) + 16, zlib.crc32(data), "bytes")
        shards[r["shard"]].append(r)
    assert len(got) == len(docs) and set(shards) <= set(range(40))
    assert all(sorted(r["slot"] for r in s) == list(range(len(s))) for s in shards.values())
    largest, mean = max(r["size"] for r in got), sum(r["size"] for r in got) / 40
    assert all(abs(sum(r["size"] for r in shards[k]) - mean) <= largest for k in range(40))


def test_op9(spark, con, docs):
    items = con.execute("select item_id, text from benchmark").fetchall()
    got = {r["doc_id"]: tuple(r)[1:] for r in rows(spark, "op9_decontamination")}
    assert got == {i: brute.contamination(t, items) for i, t in docs}


def test_op10(spark, docs):
    got = {r["doc_id"]: tuple(r)[1:3] for r in rows(spark, "op10_near_duplicates")}
    assert got == brute.near_duplicates(docs)


def test_op13(spark, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(registered.COUNTED)
    got = {r["doc_id"]: tuple(r)[1:] for r in rows(spark, "op13_token_counts")}
    for i, text in docs:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert got[i] == (len((text or "").encode()), n, n > 512)


def test_pipeline(spark, con, docs):
    """Each stage against a plain version of its decision; the classifier's own scores are taken as given."""
    data = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = con.execute("select item_id, text from benchmark").fetchall()
    columns = data.columns
    (_, quality), (_, near), (_, clean), (_, code) = corpus_pipeline.STAGES
    first = quality(spark, data, SF_DIR)
    kept = {r["doc_id"]: r["text"] for r in first.collect()}
    good = {i for i, in con.execute("select doc_id from labels where quality = 1").fetchall()}
    assert first.columns == columns and len(good & set(kept)) >= 0.95 * len(good) and len(kept) < len(docs)
    second = near(spark, spark.createDataFrame(first.collect(), data.schema), SF_DIR)
    want = {i for i, (_, c) in brute.near_duplicates(kept.items(), 5, 80).items() if c == i}
    assert second.columns == columns and sorted(r["doc_id"] for r in second.collect()) == sorted(want)
    third = clean(spark, second, SF_DIR)
    want = {i for i in want if not brute.contamination(kept[i], items)[4]}
    assert third.columns == columns and {r["doc_id"] for r in third.collect()} == want
    last = code(spark, third, SF_DIR).collect()
    assert {r["doc_id"] for r in last} == want and all(r["exact"] and r["n_tokens"] == len(r["token_ids"]) for r in last)
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, SF_DIR).collect()} == want
