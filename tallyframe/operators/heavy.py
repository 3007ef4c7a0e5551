"""The rows of the most frequent values, found by a sketch and a proof, without counting every value.

A report on the k most frequent values of a column with billions of them needs the counts of few. Here each value falls into one of a
fixed number of buckets in each of several independent lines, and three steps narrow a column down:

1. one pass counts the rows of every bucket; a value has no more rows than any of its buckets;
2. one pass counts the values whose buckets are the largest of each line; the k-th count found is a floor that the k most frequent
   values all reach, whatever the values are;
3. values with a bucket below the floor cannot be among them and are left out by a filter on the buckets.

What is left is counted exactly by the report itself, which thus gives the same rows as without this step. Shuffled are bucket counts, of a
fixed number for each task, and the values left. Nothing can be left out where all values are about as frequent: then all are counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyframe.session import stage

#: Lines of the sketch; buckets in each line of one column at most, and in each line of all columns together.
LINES, BUCKETS, ALL_BUCKETS = 3, 1 << 13, 1 << 19
#: Largest buckets of each line whose values give the floor: this many, and twice as many as values are wanted.
SEEDS = 64


def _place(line: int, buckets: int) -> Column:
    """Bucket in one line; each line reads bits of its own."""
    return F.shiftright("__hash", 13 * line).bitwiseAND(F.lit(buckets - 1).cast("long"))


def _inside(rows: DataFrame, kept: DataFrame, buckets: int) -> DataFrame:
    """Rows whose buckets are kept in every line. ``kept`` has at most ``ALL_BUCKETS`` rows for each line."""
    for line in range(LINES):
        side = kept.where(F.col("line") == line).select("__group", F.col("bucket").alias("__bucket"))
        rows = rows.withColumn("__bucket", _place(line, buckets)).join(F.broadcast(side), ["__group", "__bucket"], "left_semi")
    return rows.drop("__bucket")


def possible_leaders(
    df: DataFrame, value: Column, k: int, min_count: int = 1, group: Column | None = None, groups: int = 1, buckets: int = BUCKETS
) -> DataFrame:
    """Rows of ``df`` whose ``value`` may be one of the ``k`` most frequent, in each ``group`` by itself.

    All rows of each value that has at least ``min_count`` rows and is among the ``k`` most frequent, ties included, are kept; of other
    values all rows or none. NULL is a value. ``groups`` tells how many groups there are: with many, each has fewer buckets (``buckets``, a
    power of two up to 8,192, at most), so that the bucket table stays bounded. A null group and an empty table give no rows; columns named ``__group``,
    ``__value``, ``__hash`` and ``__bucket`` are not allowed.
    """
    while buckets > 16 and buckets * groups > ALL_BUCKETS:
        buckets //= 2
    keyed = df.withColumns({"__group": F.lit(0) if group is None else group, "__value": value})
    keyed = keyed.withColumn("__hash", F.xxhash64("__value"))
    spread = F.posexplode(F.array(*[_place(line, buckets) for line in range(LINES)])).alias("line", "bucket")
    sketch = keyed.select("__group", spread).groupBy("__group", "line", "bucket").agg(F.count("*").alias("n"))
    sketch = stage(sketch, "bucket-counts")
    largest = W.partitionBy("__group", "line").orderBy(F.desc("n"), "bucket")
    seeds = sketch.withColumn("rank", F.row_number().over(largest)).where(F.col("rank") <= max(SEEDS, 2 * k))
    counted = _inside(keyed, seeds, buckets).groupBy("__group", "__value").agg(F.count("*").alias("n"))
    by_count = W.partitionBy("__group").orderBy(F.desc("n"))
    floors = counted.withColumn("rank", F.row_number().over(by_count)).where(F.col("rank") <= k).where(F.col("rank") == k)
    floors = floors.select("__group", F.col("n").alias("floor"))
    reach = F.greatest(F.coalesce("floor", F.lit(1)), F.lit(min_count))
    kept = stage(sketch.join(floors, "__group", "left").where(F.col("n") >= reach).select("__group", "line", "bucket"), "bucket-kept")
    return _inside(keyed, kept, buckets).select(*df.columns)
