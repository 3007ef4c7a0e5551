"""Exact ROC AUC for tables of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Rows of one score range; the number of ranges grows with the table.
_CELL_ROWS = 5_000_000


def auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row (auc, positives, negatives): area under the ROC curve, ties counted half.

    AUC = sum over scores of pos * (negatives below + half the negatives at the score) / (P * N).
    Rows are counted per score first, so ties collapse on the map side. The counted scores are then partitioned
    by range; the running count of negatives is taken inside each range - parallel and balanced, as a score is one row
    by then - and lifted by the totals of the lower ranges. NULL when a class is absent. A row without a score, or
    with a label other than 0 and 1, is an error.
    """
    x = F.col(score).cast("double")
    rows = df.select(F.when(~F.isnan(x), x).alias("x"), F.col(label).cast("int").alias("y"))
    fit = rows.agg(F.count("*").alias("n"), F.count_if(F.expr("x is not null and y in (0, 1)")).alias("fine")).first()
    if fit["fine"] < fit["n"]:
        raise ValueError(f"{fit['n'] - fit['fine']} of {fit['n']} rows have no score, or a label other than 0 and 1")
    counted = rows.groupBy("x").agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg"))
    ranged = counted.repartitionByRange(fit["n"] // _CELL_ROWS + 1, "x").withColumn("cell", F.spark_partition_id())
    before = F.sum("neg").over(W.partitionBy("cell").orderBy("x").rowsBetween(W.unboundedPreceding, 0)) - F.col("neg")
    per_cell = (
        ranged.withColumn("won", F.col("pos") * (before + F.col("neg") / 2.0))
        .groupBy("cell")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("won").alias("won"))
    )
    # One row for each range from here on.
    lower = F.sum("neg").over(W.partitionBy(F.lit(0)).orderBy("cell").rowsBetween(W.unboundedPreceding, 0)) - F.col("neg")
    total = per_cell.withColumn("won", F.col("won") + F.col("pos").cast("double") * lower).agg(
        F.coalesce(F.sum("pos"), F.lit(0)).alias("positives"),
        F.coalesce(F.sum("neg"), F.lit(0)).alias("negatives"),
        F.sum("won").alias("won"),
    )
    pairs = F.col("positives").cast("double") * F.col("negatives")
    return total.select(F.try_divide("won", F.nullif(pairs, F.lit(0.0))).alias("auc"), "positives", "negatives")


def auc_value(df: DataFrame, score: str, label: str) -> float | None:
    return auc(df, score, label).first()["auc"]
