"""Value counts shared by the category reports.

Reports over many text columns use one scan: the columns are unfolded into (column, value) and
counted with map-side combining, so hot values shrink before the shuffle. Labels are normalised
after counting - once per distinct spelling instead of once per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyframe.functions.text import normalize_label, plain_text
from tallyframe.operators.heavy import possible_leaders


def as_label(df: DataFrame, column: str) -> Column:
    """Column as text, in the same form in counts and in transformed rows."""
    return plain_text(df[column])


def value_totals(
    df: DataFrame, columns: Sequence[str], target: str | None = None, normalize: bool = False, leaders: tuple[int, int] | None = None
) -> DataFrame:
    """(column, value, n[, hits, labelled]) for each value of each column; NULL is a value.

    ``hits`` is the sum of the target and ``labelled`` the rows that have one. ``leaders`` (k, min_count) leaves out values that a
    sketch proves not to be among the k most frequent of at least min_count rows: for columns of very many values.
    """
    kept = [] if target is None else [F.col(target).cast("double").alias("hit")]
    # The sketch must see labels, as the counts of their spellings add up; so they are made before, once for each row.
    made = (lambda c: normalize_label(as_label(df, c))) if leaders and normalize else (lambda c: as_label(df, c))
    flat = df.select(*[made(c).alias(c) for c in columns], *kept).unpivot(
        [] if target is None else ["hit"], list(columns), "column", "value"
    )
    if leaders:
        flat = possible_leaders(flat, F.col("value"), *leaders, group=F.col("column"), groups=len(columns))
    first = [F.count("*").alias("n")]
    again = [F.sum("n").alias("n")]
    if target is not None:
        first += [F.sum("hit").alias("hits"), F.count("hit").alias("labelled")]
        again += [F.sum("hits").alias("hits"), F.sum("labelled").alias("labelled")]
    counted = flat.groupBy("column", "value").agg(*first)
    if normalize and not leaders:
        counted = counted.withColumn("value", normalize_label(F.col("value"))).groupBy("column", "value").agg(*again)
    return counted


def rate() -> Column:
    """Mean target of a counted group (NULL where no row has a target)."""
    return F.try_divide(F.col("hits"), F.col("labelled"))


def most_frequent(counted: DataFrame, k: int) -> DataFrame:
    """The ``k`` largest groups per column, with ``rank``.

    The rank filter is applied before the shuffle too (group limit), so no task sees more than
    ``k`` rows per column and upstream task even if a column has billions of values.
    """
    order = W.partitionBy("column").orderBy(F.desc("n"), F.col("value").asc_nulls_last())
    return counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
