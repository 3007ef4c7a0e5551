"""Reducing columns with many values to a kept set plus ``other``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.missing import member_of
from tallyframe.functions.numeric import ratio
from tallyframe.functions.text import keep_or_other, recode
from tallyframe.operators.tables import one_pass
from tallyframe.session import rows_up_to, stage

# A kept set up to this size is written into the plan as literals; a larger one stays a table.
LITERAL_LIMIT = 1_000


def coverage(df: DataFrame, column: str, thresholds: Sequence[int] = (150, 300, 500)) -> DataFrame:
    """(threshold, kept, coverage): values and share of present rows kept at each minimum count."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return one_pass(counts, [
        {
            "threshold": F.lit(t),
            "kept": F.count_if(F.col("n") >= t),
            "coverage": ratio(F.coalesce(F.sum(F.when(F.col("n") >= t, F.col("n"))), F.lit(0)), F.sum("n")),
        }
        for t in thresholds
    ])


def keep_by_min_count(df: DataFrame, column: str, min_count: int) -> DataFrame:
    """(value, count) of present values with at least ``min_count`` rows."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
    return counts.agg(F.count("*").alias("count")).where(F.col("count") >= min_count)


def describe_keep(df: DataFrame, column: str, keep: DataFrame) -> DataFrame:
    """(kept, distinct, coverage) of a kept set; coverage is over all rows.

    The table is counted per value first, so the membership join moves distinct values only.
    """
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    marked = counts.join(keep.select("value", F.lit(True).alias("kept")), "value", "left")
    return marked.agg(
        F.count(F.when(F.col("kept"), 1)).alias("kept"),
        F.count("value").alias("distinct"),
        ratio(F.coalesce(F.sum(F.when(F.col("kept"), F.col("n"))), F.lit(0)), F.sum("n")).alias("coverage"),
    )


@dataclass(frozen=True)
class KeptValues:
    """Kept values of one column: all as literals while few, else the rest in a written table."""

    column: str
    literals: tuple[str, ...]
    table: DataFrame | None = None
    always: tuple[str, ...] = ()
    other: str = "other"

    def apply(self, df: DataFrame) -> DataFrame:
        """Collapse everything outside the kept set; a missing value also becomes ``other``."""
        c = F.col(self.column)
        known = (*self.literals, *self.always)
        if self.table is None:
            return df.withColumn(self.column, keep_or_other(c, known, self.other))
        # Frequent and missing values are settled without the table. Their rows get a salt that
        # matches nothing, so the shuffle spreads them instead of sending each value to one task.
        settled = c.isNull() | c.isin(list(known))
        salt = F.concat(F.lit("\u0000"), F.xxhash64(*df.columns).cast("string"))
        joined = df.withColumn("_key", F.when(settled, salt).otherwise(c)).join(
            self.table.select(F.col("value").alias("_key"), F.lit(True).alias("_kept")), "_key", "left"
        )
        kept = F.col("_kept").isNotNull() | member_of(c, known)
        return joined.withColumn(self.column, F.when(kept, c).otherwise(F.lit(self.other))).drop("_key", "_kept")


def fit_kept(
    keep: DataFrame, column: str, always: Sequence[str] = ("missing",), other: str = "other",
    literal_limit: int | None = None,
) -> KeptValues:
    """Freeze a kept-value table (value, count) for use on other rows."""
    limit = LITERAL_LIMIT if literal_limit is None else literal_limit
    few = rows_up_to(keep.select("value"), limit)
    if few is not None:
        return KeptValues(column, tuple(sorted(r[0] for r in few)), None, tuple(always), other)
    counts = stage(keep.select("value", "count"), f"kept-{column}")  # counted once for both uses below
    frequent = counts.orderBy(F.desc("count"), "value").limit(limit).collect()
    return KeptValues(column, tuple(r["value"] for r in frequent), counts.select("value"), tuple(always), other)


def reduce_cardinality(
    df: DataFrame,
    reference: DataFrame,
    min_counts: Mapping[str, int],
    aliases: Mapping[str, Mapping[str, str]] | None = None,
    drop: Sequence[str] = (),
    always: Sequence[str] = ("missing",),
) -> DataFrame:
    """Recode aliases, keep values frequent in ``reference``, collapse the rest, drop columns."""
    aliases = aliases or {}
    out = df.withColumns({c: recode(F.col(c), m) for c, m in aliases.items() if c in df.columns})
    for column, min_count in min_counts.items():
        if column not in df.columns:
            continue
        seen = reference.select(recode(F.col(column), aliases.get(column, {})).alias(column))
        out = fit_kept(keep_by_min_count(seen, column, min_count), column, always).apply(out)
    return out.drop(*drop)
