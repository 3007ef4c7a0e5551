"""Registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import bpe, chat, decontam, html, licenses, manifest, neardup, quality, sharding, spelling, token_counts, topk, warc

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: Token counts: the vocabulary, and the number of tokens that a document should not exceed.
COUNTED, TOKEN_LIMIT = public_tokenizers.path("byte_bpe_50k.json"), 512
SHARDS = 40
PREDICTED = 0.7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"), keep=["doc_id"])
    base = F.filter("places", lambda p: (p["edits"] == 0) & p["phrase"].isin([n.phrase for n in licenses.BASE]))
    labels = lambda places: F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")
    words = F.transform(base, lambda p: p["word"])
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(words).alias("first_word"), F.array_max(words).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: 1 - p["edits"] / F.length(p["phrase"]))), F.lit(0.0)).alias("score"),
    )


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    probe = spark.sql(
        "select cast(-1 as bigint) as conv_id, cast(turn as bigint) as turn, role, '</s>[INST] ok [/INST]' as text "
        "from values (0, 'user'), (1, 'assistant') as t(turn, role)"
    )
    return chat.read_back(chat.format_turns(rows.unionByName(probe)))


def warc_records(pages: DataFrame) -> DataFrame:
    """Capture records made of the pages: each page is a full response, and each a not-modified answer some time later."""
    etag = F.md5("html")
    full = pages.select(
        (F.col("page_id") * 2).alias("record_id"), "url", (F.col("page_id") * 10).alias("at"), F.lit("response").alias("kind"),
        F.create_map(F.lit("etag"), etag, F.lit("content-type"), F.lit("text/html"), F.lit("date"), (F.col("page_id") * 10).cast("string")).alias("headers"),
        F.col("html").alias("payload"),
    )
    stale = pages.select(
        (F.col("page_id") * 2 + 1).alias("record_id"), "url", (F.col("page_id") * 10 + 1005).alias("at"), F.lit("revisit").alias("kind"),
        F.create_map(F.lit("ETag"), F.when(F.col("page_id") % 7 == 0, F.lit("other")).otherwise(etag), F.lit("Date"), (F.col("page_id") * 10 + 1005).cast("string"), F.lit("Content-Type"), F.lit("text/plain")).alias("headers"),
        F.lit(None).cast("string").alias("payload"),
    )
    return full.unionByName(stale)


def op4_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = warc.resolve_revisits(warc_records(table(spark, sf_dir, "pages")))
    return resolved.select(
        "record_id", "url_key", "at", "refers_to", "outcome", F.col("headers")["etag"].alias("etag"), F.col("headers")["date"].alias("date"),
        F.col("headers")["content-type"].alias("content_type"), F.length("payload").cast("long").alias("n_chars"), F.md5("payload").alias("payload_md5"),
    )


OP4_SQL = """
with cleaned as (select page_id, html, regexp_replace(regexp_replace(trim(coalesce(url, '')), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.\\-]*://', '') as bare from pages),
parts as (select *, regexp_extract(bare, '^([^?]*)', 1) as before, regexp_extract(bare, '\\?(.*)$', 1) as asked from cleaned),
named as (select page_id, html,
  regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(before, '^([^/]*)', 1)), '^.*@', ''), ':(80|443)$', ''), '^(www|m)\\.', '')
  || regexp_replace(regexp_replace(before, '^[^/]*', ''), '/+$', '')
  || case when len(p) > 0 then '?' || array_to_string(p, '&') else '' end as url_key
  from (select *, list_sort(list_filter(string_split(asked, '&'), lambda x: x <> '' and not regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid|sessionid)(=|$)'))) as p from parts)),
full_ as (select page_id * 2 as record_id, url_key, page_id * 10 as "at", md5(html) as etag, html from named),
stale as (select page_id * 2 + 1 as record_id, url_key, page_id * 10 + 1005 as "at", case when page_id % 7 = 0 then 'other' else md5(html) end as etag from named),
joined as (select s.record_id, s.url_key, s."at", f.record_id as refers_to, s.etag, f.etag as theirs, f.html
  from stale s asof left join full_ f on s.url_key = f.url_key and s."at" > f."at")
select record_id, url_key, "at", refers_to,
  case when refers_to is null then 'missing' when etag = theirs then 'resolved' else 'mismatch' end as outcome,
  etag, cast("at" as varchar) as date,
  case when etag = theirs then 'text/html' else 'text/plain' end as content_type,
  case when etag = theirs then cast(length(html) as bigint) end as n_chars,
  case when etag = theirs then md5(html) end as payload_md5
from joined
"""


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), VOCABULARY, PATTERN, keep=["doc_id"])


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= PREDICTED).cast("int").alias("predicted"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html.extract(table(spark, sf_dir, "pages"), keep=["page_id", "url"])
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("copies"))
    placed = sharding.shard(docs, SHARDS, F.col("size"), F.col("copies"), F.col("doc_id"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item_id"])))
    hits = decontam.hit_words(F.col("hits"))
    return found.select(
        "doc_id", "n_words", hits.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"), (hits > 0).alias("contaminated"),
    )


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), neardup.Rule(shingle=3, percent=85))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(spelling.count_words(table(spark, sf_dir, "documents"), min_length=5, min_count=3, slip=97))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    leaf = lambda text: manifest.leaf_hash([F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text])
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    proofs = manifest.manifest(docs, leaf(F.col("text")), seen=F.when(tampered, leaf(F.replace("text", F.lit("\n"), F.lit("")))))
    folded = manifest.fold(F.col("seen"), F.col("steps"))
    return proofs.select(
        "doc_id", "leaf", "subroot", "root", manifest.digest(manifest.proof_text(F.col("steps"))).alias("proof_sha256"), folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), COUNTED, keep=["doc_id"])
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


#: CRC-32 by a table made from its polynomial; bytes are folded in with list_reduce.
CRC_SQL = """
with recursive bits(v, k, c) as (
  select v, 0, cast(v as ubigint) from range(256) t(v)
  union all select v, k + 1, case when c & 1 = 1 then xor(c >> 1, cast(3988292384 as ubigint)) else c >> 1 end from bits where k < 8),
crc_table as (select list(c order by v) as crcs from bits where k = 8),
"""
OP12_SQL = CRC_SQL + """
leaves as (
  select doc_id, source, text, lang, n_chars,
    case when source is null then '0' else '1' || source end as g,
    row_number() over (partition by source order by doc_id) - 1 as i,
    xor(list_reduce(list_prepend(cast(4294967295 as ubigint), list_transform(string_split(cast(doc_id as varchar), ''), lambda x: cast(ascii(x) as ubigint))),
      lambda a, b: xor(a >> 8, crcs[cast((xor(a, b) & 255) + 1 as bigint)])), cast(4294967295 as ubigint)) % 2 = 0 as tampered
  from documents, crc_table),
hashed as (
  select doc_id, g, i, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
    case when tampered and text is not null then sha256(head || strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), '')) end as seen
  from (select *, coalesce(strlen(cast(doc_id as varchar)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
    || coalesce(strlen(cast(n_chars as varchar)) || ':' || n_chars, '-') as head from leaves)),
inner_nodes(level, g, i, h, n) as (
  select 0, g, i, leaf, count(*) over (partition by g) from hashed
  union all
  select level + 1, g, i // 3, sha256(string_agg(h, '' order by i)), max((n + 2) // 3) from inner_nodes where n > 1 group by level, g, i // 3),
tops as (select g, h, row_number() over (order by g) - 1 as i from inner_nodes where n = 1),
outer_nodes(level, i, h, n) as (
  select 0, i, h, count(*) over () from tops
  union all
  select level + 1, i // 3, sha256(string_agg(h, '' order by i)), max((n + 2) // 3) from outer_nodes where n > 1 group by level, i // 3),
inner_runs as (select level, g, i // 3 as run, list(h order by i) as hs from inner_nodes where n > 1 group by all),
outer_runs as (select level, i // 3 as run, list(h order by i) as hs from outer_nodes where n > 1 group by all),
up(doc_id, level, g, i, proof, folded) as (
  select doc_id, 0, g, i, '', coalesce(seen, leaf) from hashed
  union all
  select doc_id, u.level + 1, u.g, run, proof || list_aggregate(list_concat([''], hs[1:i % 3], hs[i % 3 + 2:]), 'string_agg', ''),
    sha256(list_aggregate(list_concat([''], hs[1:i % 3], [folded], hs[i % 3 + 2:]), 'string_agg', ''))
  from up u join inner_runs r on u.level = r.level and u.g = r.g and i // 3 = run),
below as (select doc_id, g, arg_max(proof, level) as proof, arg_max(folded, level) as folded from up group by doc_id, g),
over_(doc_id, level, i, proof, folded) as (
  select doc_id, 0, i, proof, folded from below join tops using (g)
  union all
  select doc_id, o.level + 1, run, proof || list_aggregate(list_concat([''], hs[1:i % 3], hs[i % 3 + 2:]), 'string_agg', ''),
    sha256(list_aggregate(list_concat([''], hs[1:i % 3], [folded], hs[i % 3 + 2:]), 'string_agg', ''))
  from over_ o join outer_runs r on o.level = r.level and i // 3 = run),
ended as (select doc_id, arg_max(proof, level) as proof, arg_max(folded, level) as folded from over_ group by doc_id)
select doc_id, leaf, tops.h as subroot, top.h as root, sha256(proof) as proof_sha256, folded as folded_root, folded = top.h as verified
from hashed join tops using (g) join ended using (doc_id), (select h from outer_nodes where n = 1) top
"""
OP11_SQL = CRC_SQL + """
runs as (
  select doc_id, run, count(*) as n from (select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) as run from documents)
  group by doc_id, run),
summed as (
  select run, n, xor(list_reduce(list_prepend(cast(4294967295 as ubigint), list_transform(range(1, strlen(bytes) // 2 + 1), lambda k: cast('0x' || substr(bytes, 2 * k - 1, 2) as ubigint))),
    lambda a, b: xor(a >> 8, crcs[cast((xor(a, b) & 255) + 1 as bigint)])), cast(4294967295 as ubigint)) as h
  from (select run, n, hex(encode(doc_id || ':' || run)) as bytes from runs), crc_table),
words as (
  select word, cast(sum(n) as bigint) as n
  from (select case when h % 97 = 0 then substr(run, 1, cast(h % length(run) as bigint)) || substr(run, cast(h % length(run) as bigint) + 2) else run end as word, n from summed)
  where length(word) >= 5 group by word having sum(n) >= 3),
cut as (select word, n, p, substr(word, 1, p) || substr(word, p + 2) as rest from (select word, n, unnest(range(length(word))) as p from words)),
near as (
  select a.word, b.word as other, b.n from cut a join cut b on a.p = b.p and a.rest = b.rest and a.word <> b.word
  union select c.word, w.word, w.n from cut c join words w on c.rest = w.word
  union select w.word, c.word, c.n from cut c join words w on c.rest = w.word),
best as (select word, count(*) as n_near, max(n) as most from near group by word),
forms as (select w.word, w.n, b.n_near, b.most as form_n, (select min(other) from near x where x.word = w.word and x.n = b.most) as form
  from words w join best b on b.word = w.word),
formed as (select w.word, w.n, coalesce(n_near, 0) as n_near, case when form_n >= 2 * w.n then form end as form, case when form_n >= 2 * w.n then form_n end as form_n
  from words w left join forms using (word)),
ways(word, spot, step) as (
  select word, word, 0 from formed
  union all select w.word, f.form, step + 1 from ways w join formed f on f.word = w.spot where f.form is not null),
roots as (select word, arg_max(spot, step) as root from ways group by word)
select word, form, root, n, n_near, form_n from formed join roots using (word)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_license_scan, op2_topk, op3_chat_format, op4_warc_revisits, op5_byte_bpe, op6_quality, op7_html_text, op8_sharding, op9_decontamination,
        op10_near_duplicates, op11_spelling_variants, op12_merkle_manifest, op13_token_counts,
    )
}
ORACLES = {"op4_warc_revisits": OP4_SQL, "op11_spelling_variants": OP11_SQL, "op12_merkle_manifest": OP12_SQL}
