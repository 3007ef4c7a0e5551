"""Helpers shared by the operators of this package: Arrow batches, words, hashes, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tallyframe.session import stage

#: Text handed to one call of a batch function, in bytes; bounds what a Python worker holds at a time.
CHUNK_BYTES = 2 << 20

#: Edges of a node that share a key in the component search, at least, and the number of keys that all edges would fill.
HUB_ROWS, HUB_PARTS = 1_000, 10_000

_AS_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256))

#: Makes one digit, letter or non-ASCII run a word: the byte table that lower-cases A-Z and blanks every other ASCII byte.
WORD_BYTES = _AS_WORDS


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased, as UTF-8. Null has none."""
    return text.encode().translate(_AS_WORDS).split() if text else []


def without(df: DataFrame, names: Sequence[str]) -> list[str]:
    """The columns of ``df`` that do not clash with ``names`` (names compare without case, as Spark does)."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def narrowed(pattern: str, newer: str) -> regex.Pattern:
    """The pattern with the characters ``newer`` taken out of its letters and numbers, for texts that hold some of them.

    Unicode tables of two libraries may differ by age: a character that the older ones do not know is neither letter nor number there.
    """
    spans: list[list[int]] = []
    for c in sorted(map(ord, newer)):
        if spans and spans[-1][1] == c - 1:
            spans[-1][1] = c
        else:
            spans.append([c, c])
    left_out = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in spans)
    for name in (r"\p{L}", r"\p{N}") if newer else ():
        pattern = pattern.replace(name, f"[{name}--[{left_out}]]")
    return regex.compile(pattern, regex.V1)


def _cuts(column: pa.Array, limit: int) -> list[int]:
    """Row numbers that cut a batch into pieces of about ``limit`` bytes; a longer row is a piece of its own."""
    n = len(column)
    if not n or column.nbytes <= limit:
        return [0, n]
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        offsets = np.frombuffer(column.buffers()[1], np.int32, n + 1, column.offset * 4).astype(np.int64)
        parts = (offsets[1:] - offsets[0]) // limit
        return [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), n]
    step = max(1, n * limit // column.nbytes)
    return [*range(0, n, step), n]


def append_columns(
    df: DataFrame, inputs: Sequence[str], outputs: str, make: Callable[..., list], keep: Sequence[str] | None = None,
    chunk: int = CHUNK_BYTES,
) -> DataFrame:
    """Add columns that ``make`` computes from whole batches of rows.

    ``make`` gets one Python list for each input column and returns one list for each column of the DDL text
    ``outputs``. Rows stay where they are: no shuffle. ``keep`` names the columns passed through (default: all);
    one whose name clashes with an output is replaced by it. ``make`` gets about ``chunk`` bytes of the last input at a time.
    """
    fields = StructType.fromDDL(outputs)
    kept = without(df.select(*keep) if keep is not None else df, fields.names)
    picked = df.select(*[df[c] for c in kept], *[df[c].alias(f"__in_{i}") for i, c in enumerate(inputs)])
    schema = StructType([df.schema[c] for c in kept] + list(fields))
    out_types = [f.type for f in to_arrow_schema(fields)]
    names, n_kept = schema.names, len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = _cuts(batch.column(n_kept + len(inputs) - 1), chunk)
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                made = make(*[part.column(n_kept + i).to_pylist() for i in range(len(inputs))])
                new = [m if isinstance(m, pa.Array) else pa.array(m, t) for m, t in zip(made, out_types)]
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(n_kept)] + new, names)

    return picked.mapInArrow(run, schema)


def grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[pa.Array]]:
    """The columns of each group of rows with equal values in the first ``keys`` columns, from sorted batches."""
    held: list[pa.RecordBatch] = []
    last = None

    def whole(parts):
        return [pa.concat_arrays([p.column(i) for p in parts]) for i in range(parts[0].num_columns)]

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        fresh = np.ones(batch.num_rows, bool)
        fresh[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
        fresh[0] = last is None or last != tuple(c[0] for c in columns)
        cuts = np.flatnonzero(fresh).tolist() if fresh[0] else [0, *np.flatnonzero(fresh).tolist()]
        for n, (a, b) in enumerate(zip(cuts, [*cuts[1:], batch.num_rows])):
            if n == 0 and not fresh[0]:
                held.append(batch.slice(a, b - a))
                continue
            if held:
                yield whole(held)
            held = [batch.slice(a, b - a)]
        last = tuple(c[-1] for c in columns)
    if held:
        yield whole(held)


def components(edges: DataFrame, label: str) -> DataFrame:
    """Connected components of an undirected graph given as rows (a, b) of longs: rows (node, component).

    Component: the smallest node reachable. Only nodes with an edge are returned. Alternates the large-star and
    small-star steps of Kiveris et al. (2014), which need a number of rounds about logarithmic in the longest path; each
    round is two grouped minima and two joins on the node, written to the shared folder, so a lost executor costs
    a re-read and nothing but a few counts comes to the driver. The edges of a node with very many of them are spread over many keys.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = stage(pairs, label)
    before, count = None, pairs.count()
    while True:
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"), F.count("*").alias("n"))
        large = _beside(both.where("b > a"), lowest, 2 * count).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        joined = _beside(large, lowest, count)
        small = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(lowest.select("a", F.col("m").alias("b")))
        pairs = stage(small.where("a <> b").distinct(), label)
        row = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.count_distinct("a")).first()
        if tuple(row) == before or (row[0] == row[2] and not _reaches(pairs)):
            break
        before, count = tuple(row), row[0]
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _beside(edges: DataFrame, lowest: DataFrame, count: int) -> DataFrame:
    """Edges (a, b) with the ``m`` of their node ``a`` from ``lowest`` (a, m, n), n being at least the node's number of edges.

    A hub, a node with more than one in ``HUB_PARTS`` of all edges, has a key for each so many of them. There are fewer than
    ``HUB_PARTS`` hubs, so they are broadcast.
    """
    rows = max(HUB_ROWS, -(-count // HUB_PARTS))
    hubs = F.broadcast(lowest.where(F.col("n") > rows).select("a", F.ceil(F.col("n") / rows).alias("parts")))
    part = F.coalesce(F.pmod(F.xxhash64("b"), F.col("parts")), F.lit(0).cast("long"))
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)) - 1))
    known = lowest.join(hubs, "a", "left").select("a", "m", parts.alias("part"))
    return edges.join(hubs, "a", "left").select("a", "b", part.alias("part")).join(known, ["a", "part"]).drop("part")


def _reaches(pairs: DataFrame) -> bool:
    """Whether some node is both the start and the end of a pair, so that the pairs are not stars yet."""
    return not pairs.select("a").intersect(pairs.select(F.col("b").alias("a"))).isEmpty()
