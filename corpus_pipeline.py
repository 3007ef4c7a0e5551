"""A training corpus from raw documents: quality, near-duplicates, benchmark passages, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are written as Parquet to the shared folder and read
again as the next stage's documents. All stages but the last return the columns of documents. An empty table passes
through all stages; null texts are clean, link with nothing and have no tokens; a repeated row of one id is a near-duplicate of itself, of which
one stays.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import bpe, decontam, neardup, quality
from tallyframe.session import stage, staging

#: Documents with a lower quality score go.
LEAST_QUALITY = 0.7
#: Near-duplicates: five-word shingles, similarity of 0.8 or more.
SAME = neardup.Rule(shingle=5, percent=80)
VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def reject_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality: fitted on the labels of ``sf_dir`` outside the held-out part. Labels of one kind only reject nothing."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    if model.constant is not None:
        return docs
    rows = docs.select(F.struct("*").alias("row"), F.col("text").alias("__text"))
    return quality.score(rows, model, "__text", keep=["row"]).where(F.col("score") >= LEAST_QUALITY).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that of the smallest id; of its repeated rows, one. Null ids stay."""
    gone = neardup.near_duplicates(docs, SAME).where(~F.col("kept")).select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti")
    repeated = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    if repeated.isEmpty():
        return kept.select(*docs.columns)
    once = kept.join(repeated, "doc_id", "left_anti").select(*docs.columns)
    return once.unionByName(kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(*docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share ten consecutive words with a benchmark item go."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents, ``token_ids``, ``n_tokens``, and ``exact``: the ids decode to the text's bytes."""
    return bpe.encode(docs, VOCABULARY, public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", reject_bad),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("byte_bpe", tokenise),
]

#: Classifier, MinHash and BPE cannot be said in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``. Of the tables written on the way only the last stage's stays."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with staging(spark):  # the tables of all stages but the last
        for left, (name, step) in zip(range(len(STAGES) - 1, -1, -1), STAGES):
            with staging(spark):  # what one stage writes for itself
                docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}", keep=1 if left else 2)
    return docs
