"""MinHash near-duplicates: a multi-index Hamming join over b-bit signatures, confirmed on full shingle sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyframe.llm.common import append_columns, components, grouped
from tallyframe.session import stage

#: Rows of one signature bucket, and rows and text bytes of one candidate cluster, that are compared in one task.
#: Larger ones are cut into blocks, and every pair of blocks is compared.
BUCKET_ROWS, CLUSTER_ROWS, CLUSTER_BYTES = 4096, 4096, 8 << 20

#: Bits of the map that keeps most texts outside the candidate clusters from being shuffled: 16 MB in rows of 32,768 bits.
MAP_BITS, MAP_ROW = 1 << 27, 1 << 15


@dataclass(frozen=True)
class Rule:
    """Link two documents if 100 * |A and B| >= percent * |A or B| over sets of ``shingle``-word shingles.

    ``hashes`` (an even number of) minimum hashes of 16 bits make a signature. ``missed`` bounds the chance that the signatures of a pair
    exactly at the threshold differ in more positions than ``radius``, the distance up to which all pairs are found.
    """

    shingle: int = 3
    percent: int = 85
    hashes: int = 64
    missed: float = 1e-6

    @cached_property
    def radius(self) -> int:
        p, k = 1 - self.percent / 100, self.hashes
        tail, r = 1.0, -1
        while tail > self.missed and r < k:
            r += 1
            tail -= comb(k, r) * p**r * (1 - p) ** (k - r)
        return r

    @cached_property
    def chunks(self) -> list[np.ndarray]:
        """Chunks of positions, so many that any two signatures within the radius differ in one position of some chunk at most."""
        return np.array_split(np.arange(self.hashes), self.radius // 2 + 1)

    def factors(self) -> np.ndarray:
        return np.random.Generator(np.random.PCG64(20240229)).integers(1 << 40, 1 << 63, self.hashes, np.uint64) * np.uint64(2) + np.uint64(1)


class _WordHashes(dict):
    """64-bit hashes of words; forgotten when there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        value = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return value


_HASHES = _WordHashes()


def shingles(words: list[bytes], size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; with fewer words than ``size``, of the whole sequence."""
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    size, n = min(size, len(words)), max(len(words) - size + 1, 1)
    mixed = np.full(n, size, np.uint64)
    for i in range(size):
        mixed = (mixed ^ hashes[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def split_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased."""
    return text.encode().lower().split() if text else []


def signatures(sets: list[np.ndarray], rule: Rule) -> np.ndarray:
    """One row of 16-bit minimum hashes for each non-empty set."""
    flat, starts = np.concatenate(sets), np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), rule.hashes), np.uint16)
    for i, factor in enumerate(rule.factors()):
        out[:, i] = np.minimum.reduceat(((flat * factor) >> np.uint64(32)).astype(np.uint32), starts).astype(np.uint16)
    return out


def describe(df: DataFrame, rule: Rule, text: str, keep: list[str]) -> DataFrame:
    """Add ``words_hash, n_shingles, signature, brief`` (null for a text without words).

    ``brief`` holds the lower four bits of each position. Equal positions have equal bits, so that its distance is never
    larger than the signature's; it takes a quarter of the room where signatures are compared one by one.
    """

    def make(texts):
        names, sets = [], []
        for t in texts:
            words = split_words(t)
            names.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest() if words else None)
            sets.append(shingles(words, rule.shingle))
        full = [s for s in sets if len(s)]
        rows = iter(signatures(full, rule)) if full else iter(())
        found = [next(rows) if len(s) else None for s in sets]
        return [
            names, list(map(len, sets)), [None if f is None else f.tobytes() for f in found],
            [None if f is None else ((f[::2] & 15) << 4 | (f[1::2] & 15)).astype(np.uint8).tobytes() for f in found],
        ]

    return append_columns(df, [text], "words_hash binary, n_shingles long, signature binary, brief binary", make, keep)


def bucket_keys(classes: DataFrame, rule: Rule) -> DataFrame:
    """Rows (key, node): for each chunk of a signature and each position that may be wrong, a hash of the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column(0).to_numpy()
            found = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(len(nodes), rule.hashes).astype(np.uint64)
            for chunk in rule.chunks:
                for out in chunk:
                    key = np.full(len(nodes), int(out) + 1, np.uint64)
                    for i in chunk:
                        if i != out:
                            key = (key ^ found[:, i]) * np.uint64(0xD6E8FEB86659FD93)
                            key ^= key >> np.uint64(32)
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column(0)], ["key", "node"])

    return classes.select("node", "signature").mapInArrow(run, "key long, node long")


def _forest(n: int, linked) -> Iterator[tuple[int, int]]:
    """Links that join what ``linked`` joins among n members, by breadth-first search.

    ``linked(x, others)`` says which of ``others`` member x is linked to. Each member is compared only with members that no
    one has reached yet, so a dense group takes about one comparison for each member; no link is left untried that
    could join two parts.
    """
    rest = np.arange(n)
    while len(rest):
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            hit = linked(x, rest)
            for y in rest[hit].tolist():
                yield x, y
                queue.append(y)
            rest = rest[~hit]


def _similar_signatures(columns: list[pa.Array], rule: Rule) -> Iterator[tuple[int, int]]:
    nodes = columns[-2].to_numpy()
    found = np.frombuffer(b"".join(columns[-1].to_pylist()), np.uint8).reshape(len(nodes), rule.hashes // 2)

    def linked(x: int, rest: np.ndarray) -> np.ndarray:
        off = found[rest] ^ found[x]
        return ((off & 15) > 0).sum(1) + (off > 15).sum(1) <= rule.radius

    for x, y in _forest(len(nodes), linked):
        yield nodes[x], nodes[y]


def _similar_sets(columns: list[pa.Array], rule: Rule) -> Iterator[tuple[int, int]]:
    nodes = columns[-2].to_numpy()
    sets = [shingles(split_words(t), rule.shingle) for t in columns[-1].to_pylist()]
    sizes = np.array(list(map(len, sets)))
    ends = np.cumsum([0, *sizes])
    values, dense = np.unique(np.concatenate(sets), return_inverse=True)
    mine = np.zeros(len(values), bool)

    def linked(x: int, rest: np.ndarray) -> np.ndarray:
        if not sizes[x]:
            return np.zeros(len(rest), bool)
        near = (100 * np.minimum(sizes[rest], sizes[x]) >= rule.percent * np.maximum(sizes[rest], sizes[x])).nonzero()[0]
        hit = np.zeros(len(rest), bool)
        if len(near):
            own = dense[ends[x] : ends[x + 1]]
            mine[own] = True
            some = rest[near]
            starts = np.cumsum(sizes[some]) - sizes[some]
            at = np.repeat(ends[some] - starts, sizes[some]) + np.arange(sizes[some].sum())
            both = np.add.reduceat(mine[dense[at]].astype(np.int64), starts)
            mine[own] = False
            hit[near] = 100 * both >= rule.percent * (sizes[some] + sizes[x] - both)
        return hit

    for x, y in _forest(len(nodes), linked):
        yield nodes[x], nodes[y]


def _links(members: DataFrame, keys: list[str], what, rule: Rule) -> DataFrame:
    """Rows (a, b) that ``what`` finds in the groups of ``keys``; the last two columns are the node and its content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        for columns in grouped(batches, len(keys)):
            if len(columns[0]) > 1:
                out += what(columns, rule)
            if len(out) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])

    return members.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, StructType.fromDDL("a long, b long"))


def _block_pairs(rows: DataFrame, blocks: str, content: str) -> DataFrame:
    """Add i and j: each row of a group of ``blocks`` blocks goes to every pair of blocks that its own is part of.

    Blocks are dealt by node and content, as a node that stands for an id with many texts has many rows.
    """
    own = F.pmod(F.xxhash64("node", content), F.col(blocks)).cast("int")
    pairs = F.when(F.col(blocks) <= 1, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(
        F.transform(
            F.filter(F.sequence(F.lit(0), F.col(blocks).cast("int") - 1), lambda k: k != F.col("__own")),
            lambda k: F.struct(F.least(k, F.col("__own")).alias("i"), F.greatest(k, F.col("__own")).alias("j")),
        )
    )
    return rows.withColumn("__own", own).withColumn("__pair", F.explode(pairs)).select("*", "__pair.i", "__pair.j").drop("__own", "__pair")


def _likely(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows whose node is one of ``nodes``, and some others: a map of hashed nodes is broadcast and looked up.

    The map's size is fixed, whatever the number of nodes; with very many of them it lets more other rows pass, so that an exact join
    has to follow.
    """

    def place(prefix: str) -> list:
        bit = F.pmod(F.xxhash64("node"), F.lit(MAP_BITS))
        return [F.floor(bit / MAP_ROW).alias(f"{prefix}row"), (bit % MAP_ROW).alias(f"{prefix}bit")]

    bits = nodes.select(*place("__of_")).groupBy("__of_row").agg(F.expr("bitmap_construct_agg(__of_bit)").alias("__map"))
    found = F.expr("getbit(cast(conv(hex(substring(__map, cast(__bit div 8 as int) + 1, 1)), 16, 10) as int), cast(__bit % 8 as int)) = 1")
    placed = rows.select("*", *place("__"))
    return placed.join(F.broadcast(bits), (F.col("__row") == F.col("__of_row")) & found).select(*rows.columns)


def near_duplicates(df: DataFrame, rule: Rule = Rule(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: ``doc_id, n_shingles, component_id, kept``.

    ``component_id`` is the smallest id reachable over links (its own, if none); ``kept`` marks the document of that id. Words are
    ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, of whole texts; a text of fewer words than a shingle is one shingle; a null or
    empty text has no shingles and is linked with nothing. Rows that share an id count as linked. A null id is linked with
    nothing, has a null component and is kept. No rows give no rows; other columns are dropped.

    Texts of equal words are one class from the start, so copies are never compared. Every pair of classes whose signatures
    differ in up to ``rule.radius`` positions meets in a bucket: the positions are cut into so many chunks that the pair
    differs in at most one position of some chunk, and each chunk is indexed once with each position left out. Buckets
    with equal members are taken once; inside, a breadth-first search keeps only links that join parts. The clusters so found
    contain all true links; in each, links are confirmed on the full shingle sets (64-bit hashes) in the same
    way. Buckets and clusters beyond a fixed size are cut into blocks and all pairs of blocks are compared, so no group
    is gathered in one task and none is cut short.
    """
    rows = stage(describe(df.select(df[doc_id].cast("long").alias("doc_id"), df[text].alias("__text")), rule, "__text", ["doc_id"]), "neardup-rows")
    full = rows.where("doc_id is not null and n_shingles > 0")
    classes = stage(full.groupBy("words_hash").agg(F.min("doc_id").alias("node"), F.first("signature").alias("signature"), F.first("brief").alias("brief")), "neardup-classes")

    keys = bucket_keys(classes, rule)
    buckets = keys.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("low"), F.max("node").alias("high"), F.sum(F.shiftright(F.xxhash64("node"), 20)).alias("print")).where("n > 1")
    buckets = stage(buckets.groupBy("n", "low", "high", "print").agg(F.min("key").alias("key")), "neardup-buckets")
    couples = buckets.where("n = 2").select("key", "n", F.explode(F.array("low", "high")).alias("node"))
    # Buckets and classes grow with the input, so these joins are by shuffle at every size.
    larger = keys.join(buckets.where("n > 2").select("key", "n").hint("merge"), "key").select("key", "n", "node")
    members = couples.unionByName(larger).withColumn("blocks", F.ceil(F.col("n") / BUCKET_ROWS))
    members = members.select("key", "node", "blocks").join(classes.select("node", "brief").hint("merge"), "node")
    members = _block_pairs(members, "blocks", "brief")
    candidates = _links(members.select("key", "i", "j", "node", "brief"), ["key", "i", "j"], _similar_signatures, rule)

    clusters = stage(components(candidates, "neardup-candidates"), "neardup-clusters")
    texts = df.select(df[doc_id].cast("long").alias("node"), df[text].alias("__text")).where("node is not null and __text is not null")
    # An id with several rows has each of its texts compared once.
    several = full.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("node"))
    texts = _likely(texts, clusters).withColumn("print", F.md5("__text"))
    once = texts.join(several, "node", "left_semi").groupBy("node", "print").agg(F.first("__text").alias("__text"))
    texts = texts.join(several, "node", "left_anti").unionByName(once).drop("print").join(clusters, "node")
    sizes = texts.groupBy("component").agg(F.count("*").alias("n"), F.sum(F.octet_length("__text")).alias("bytes"))
    sizes = sizes.select("component", F.greatest(F.ceil(F.col("n") / CLUSTER_ROWS), F.ceil(F.col("bytes") / CLUSTER_BYTES)).alias("blocks"))
    compared = _block_pairs(texts.join(sizes, "component"), "blocks", "__text").select("component", "i", "j", "node", "__text")
    confirmed = _links(compared, ["component", "i", "j"], _similar_sets, rule)

    # An id that stands at several texts links their classes.
    belongs = full.join(several.withColumnRenamed("node", "doc_id"), "doc_id").join(classes.select("words_hash", "node"), "words_hash").select("doc_id", "node").distinct()
    repeated = belongs.join(belongs.groupBy("doc_id").agg(F.min("node").alias("b")), "doc_id").select(F.col("node").alias("a"), "b")
    linked = components(confirmed.unionByName(repeated), "neardup-links")
    named = classes.join(linked, "node", "left").select("words_hash", F.coalesce("component", "node").alias("component"))
    return rows.join(named, "words_hash", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        (F.col("doc_id").isNull() | (F.col("doc_id") == F.coalesce("component", "doc_id"))).alias("kept"),
    )
