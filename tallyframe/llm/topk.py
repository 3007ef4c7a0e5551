"""Exact top-k by inner product over an impact-ordered index, score at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows of an index block and queries of a query block.
INDEX_ROWS, QUERY_ROWS = 8192, 4096
#: A query's list of possible members is rescored as soon as it has this many times k rows at most.
ENOUGH = 8


def _matrix(packed) -> np.ndarray:
    """Vectors as rows of int64; shorter ones are filled with zeros."""
    rows = [np.asarray(v, np.int64) for v in packed]
    out = np.zeros((len(rows), max(map(len, rows), default=0)), np.int64)
    for i, v in enumerate(rows):
        out[i, : len(v)] = v
    return out


class ImpactIndex:
    """Postings (row, dimension, value) of a block, in segments of equal quantised impact.

    The impact of a posting is the magnitude of its value, quantised to its number of bits; a segment holds the postings
    of one impact, by row, as sparse columns. ``rest[s]`` is, for each row, the length of the part of its vector that lies in the segments
    after s: no later posting can change its score by more than that times the query's length. ``times`` says how often each row
    stands, ``read`` counts the postings that searches have read.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, times: np.ndarray | None = None):
        self.ids, self.vectors, self.read = ids, vectors, 0
        self.times = np.ones(len(ids), np.int64) if times is None else times
        row, dim = np.nonzero(vectors)
        value = vectors[row, dim].astype(np.float64)
        impact = np.frexp(np.abs(value))[1]
        self.segments, self.rest = [], []
        left = np.bincount(row, value**2, len(ids))
        for level in np.unique(impact)[::-1]:
            at = np.flatnonzero(impact == level)
            left = np.maximum(left - np.bincount(row[at], value[at] ** 2, len(ids)), 0)
            self.segments.append((np.searchsorted(row[at], np.arange(len(ids) + 1)), dim[at], value[at]))
            self.rest.append(np.sqrt(left) * (1 + 1e-9) + 1e-9 * np.sqrt((vectors.astype(np.float64) ** 2).sum(1)))

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each query: its id, and ids and exact scores of the best k rows of this block."""
        dims = max(self.vectors.shape[1], queries.shape[1])
        vectors = np.pad(self.vectors, ((0, 0), (0, dims - self.vectors.shape[1])))
        queries = np.pad(queries, ((0, 0), (0, dims - queries.shape[1])))
        reach = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * dims
        for query_id, query in zip(query_ids, queries):
            others = np.flatnonzero(self.ids != query_id)
            if reach >= 2**52:  # floating point would round: score in Python's whole numbers
                scores = [sum(int(a) * int(b) for a, b in zip(query, row)) for row in vectors[others]]
                if max(map(abs, scores), default=0) >= 2**63:
                    raise OverflowError("a score does not fit into a long")
                yield query_id, *self._best(others, np.array(scores, np.int64), k)
            else:
                members = self._members(others, query.astype(np.float64), k)
                yield query_id, *self._best(members, vectors[members] @ query, k)

    def _members(self, rows: np.ndarray, query: np.ndarray, k: int) -> np.ndarray:
        """Those of ``rows`` that may be among the query's k best.

        Segment after segment is added to the scores. A row whose score can no longer reach the k-th best lower bound is
        closed, and its postings in later segments are not read; when few are open, the rest is left to exact scoring.
        """
        length, scores = float(np.sqrt((query**2).sum())) * (1 + 1e-9), np.zeros(len(rows))
        for (starts, dims, values), rest in zip(self.segments, self.rest):
            if len(rows) <= ENOUGH * k:
                break
            size = starts[rows + 1] - starts[rows]
            ends = np.cumsum(size)
            at = np.arange(ends[-1]) + np.repeat(starts[rows] - (ends - size), size)
            self.read += len(at)
            scores += np.bincount(np.repeat(np.arange(len(rows)), size), query[dims[at]] * values[at], len(rows))
            slack = length * rest[rows] + 1e-6
            bar = np.partition(scores - slack, len(rows) - k)[len(rows) - k]
            open_ = scores + slack >= bar
            rows, scores = rows[open_], scores[open_]
        return rows

    def _best(self, at: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((self.ids[at], -scores))[:k]
        order = np.repeat(order, np.minimum(self.times[at[order]], k))[:k]
        return self.ids[at[order]], scores[order]


def top_k(
    df: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 256
) -> DataFrame:
    """The k highest inner products of each query vector with all other rows: ``query_id, rank, vec_id, score``.

    Components x become floor(scale * x); scores are exact whole numbers; ties go to the smaller id; a query with fewer
    than k other rows gets all. Vectors that are null or hold a null, NaN or infinite component, and rows with a
    null id, take no part. Vectors of unequal length are filled with zeros; empty ones score 0. Rows that repeat an id
    are separate candidates, and an id is a query once, with its smallest vector; its own rows are not its candidates. No rows give no rows. Other
    columns are dropped. A score beyond a long raises an error.

    Index rows are dealt into blocks of bounded size by a hash of id and vector, queries by a hash of their ids, and every block pair is
    searched in one task, as the query set is a fixed share of the rows. Inside a block, segments are added in order of
    falling impact; rows that the Cauchy-Schwarz bound on what is left proves not to be among a query's k best drop out, and when
    few are left they are rescored from their whole vectors. At most k rows of a query leave a block.
    """
    fine = F.col("__v").isNotNull() & F.forall("__v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = (
        df.select(df[vec_id].cast("long").alias("id"), df[embedding].cast("array<double>").alias("__v"), is_query.alias("q"))
        .where(fine & F.col("id").isNotNull())
        .select("id", "q", F.transform("__v", lambda x: F.floor(x * scale).cast("long")).alias("v"))
    )
    counts = rows.agg(F.count("*"), F.count_if("q")).first()
    index_blocks, query_blocks = (max(1, -(-n // size)) for n, size in zip(counts, (INDEX_ROWS, QUERY_ROWS)))
    # Equal rows are one candidate that stands several times, so no id and no vector fills a block.
    index = rows.groupBy("id", "v").agg(F.count("*").alias("times")).select(
        "id", "v", "times", F.pmod(F.xxhash64("id", "v", F.lit("index")), F.lit(index_blocks)).cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("j"),
    )
    queries = rows.where("q").groupBy("id").agg(F.min("v").alias("v")).select(
        "id", "v", F.explode(F.sequence(F.lit(0), F.lit(index_blocks - 1))).alias("i"),
        F.pmod(F.xxhash64("id", F.lit("query")), F.lit(query_blocks)).cast("int").alias("j"),
    )

    def search(block: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(block) and len(asked):
            found = ImpactIndex(block["id"].to_numpy(), _matrix(block["v"]), block["times"].to_numpy()).search(asked["id"].to_numpy(), _matrix(asked["v"]), k)
            out = [(np.full(len(ids), q), ids, scores) for q, ids, scores in found]
        columns = [np.concatenate([np.empty(0, np.int64), *c]).astype(np.int64) for c in zip(*out)] or [np.empty(0, np.int64)] * 3
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns)))

    best = index.groupBy("i", "j").cogroup(queries.groupBy("i", "j")).applyInPandas(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
