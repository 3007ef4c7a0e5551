"""Target rates by category, quantile bin, period, missingness and key presence.

Every report is one grouped aggregation with map-side partial sums: a value that holds a third
of the table reaches the shuffle as one row per task. NULL is a category unless a function says
it drops it. Orderings end in the group key, so results are the same on every run. Reports on the most frequent values take ``many_values``:
the same rows for more passes, but values that a sketch proves to be too rare are never shuffled (``operators/heavy``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.dates import parse_date, period_start
from tallyframe.functions.numeric import edge_bin, ratio
from tallyframe.functions.text import normalize_label
from tallyframe.operators.counts import as_label, most_frequent, rate, value_totals
from tallyframe.operators.heavy import possible_leaders
from tallyframe.operators.order import comparable, quantiles


def overall_rate(df: DataFrame, target: str) -> DataFrame:
    """One row: (rate, count)."""
    return df.agg(F.avg(target).alias("rate"), F.count("*").alias("count"))


def _by_value(df: DataFrame, column: str, target: str, dropna: bool = False) -> DataFrame:
    rows = df.where(F.col(column).isNotNull()) if dropna else df
    return rows.groupBy(F.col(column).alias("value")).agg(F.avg(target).alias("rate"), F.count("*").alias("count"))


def rate_by_category(
    df: DataFrame, column: str, target: str, min_count: int = 50, top_n: int = 10, many_values: bool = False
) -> DataFrame:
    """Rate of the ``top_n`` most frequent values with at least ``min_count`` rows, lowest rate first."""
    df = possible_leaders(df.select(column, target), F.col(column), top_n, min_count) if many_values else df
    leaders = _by_value(df, column, target).where(F.col("count") >= min_count)
    return leaders.orderBy(F.desc("count"), "value").limit(top_n).orderBy("rate", "value")


def rate_by_id(
    df: DataFrame, column: str, target: str, min_count: int = 100, top_n: int = 15, many_values: bool = False
) -> DataFrame:
    """The same for identifier columns, with thresholds that suit many values."""
    return rate_by_category(df, column, target, min_count=min_count, top_n=top_n, many_values=many_values)


def rate_nonnull(df: DataFrame, column: str, target: str) -> DataFrame:
    """Rate and count of every present value; missing is left out."""
    return _by_value(df, column, target, dropna=True).orderBy("value")


def top_category_rates(
    df: DataFrame,
    column: str,
    target: str,
    min_count: int = 20,
    top_n: int = 8,
    sort_by: str = "rate",
    ascending: bool = False,
    many_values: bool = False,
) -> DataFrame:
    """Most frequent values, then sorted by ``rate`` or ``count`` either way."""
    df = possible_leaders(df.select(column, target), F.col(column), top_n, min_count) if many_values else df
    leaders = _by_value(df, column, target).where(F.col("count") >= min_count)
    key = F.col(sort_by)
    return (
        leaders.orderBy(F.desc("count"), "value").limit(top_n).orderBy(key.asc() if ascending else key.desc(), "value")
    )


def freq_and_rate(df: DataFrame, column: str, target: str, min_count: int = 20, top_n: int = 8) -> DataFrame:
    """(value, frequency_pct, rate_pct, overall_pct): how common and how risky a value is.

    The table totals are sums over the counted groups, so the table is scanned once.
    """
    groups = df.groupBy(F.col(column).alias("value")).agg(
        F.count("*").alias("n"), F.sum(F.col(target).cast("double")).alias("hits"), F.count(target).alias("labelled")
    )
    totals = groups.agg(
        F.struct(F.sum("n").alias("n"), F.try_divide(F.sum("hits"), F.sum("labelled")).alias("rate")).alias("t")
    ).scalar()
    leaders = groups.where(F.col("n") >= min_count).orderBy(F.desc("n"), "value").limit(top_n)
    return leaders.select(
        "value",
        ratio(F.col("n") * 100, totals["n"]).alias("frequency_pct"),
        (rate() * 100).alias("rate_pct"),
        (totals["rate"] * 100).alias("overall_pct"),
    ).orderBy("rate_pct", "value")


def cat_rate_table(
    df: DataFrame,
    columns: Sequence[str],
    target: str,
    min_count: int = 20,
    top_n: int = 5,
    normalize: bool = False,
    many_values: bool = False,
) -> DataFrame:
    """One line per column: its most frequent values as ``value: rate%=.., count=..`` cells."""
    counted = value_totals(df, columns, target, normalize=normalize, leaders=(top_n, min_count) if many_values else None)
    counted = counted.where(F.col("n") >= min_count)
    cell = F.format_string(
        "%s: rate%%=%.1f, count=%d", F.coalesce(F.col("value"), F.lit("nan")), F.round(rate() * 100, 1), F.col("n")
    )
    leaders = most_frequent(counted, top_n).select("column", "rank", cell.alias("cell"))
    ranks = list(range(1, top_n + 1))
    wide = leaders.groupBy("column").pivot("rank", ranks).agg(F.first("cell"))
    return wide.select("column", *[F.col(str(r)).alias(f"top_{r}") for r in ranks]).orderBy("column")


def rate_by_bins(df: DataFrame, column: str, target: str, bins: int = 8, exact: bool = True) -> DataFrame:
    """Rate per equal-frequency bin: (bin, lo, hi, rate, count), only bins that hold rows.

    Bins are closed on the right, the lowest edge is included and repeated edges merge. The
    edges are exact quantiles found by ``order.quantiles``; the report itself is one pass.
    """
    x = comparable(df, {column: F.col(column)})[column].cast("double")
    rows = df.select(x.alias("x"), F.col(target).alias("y")).where("x is not null and y is not null")
    cuts = quantiles(rows, {"x": F.col("x")}, [i / bins for i in range(bins + 1)], exact=exact)["x"]
    edges = sorted({e for e in cuts if e is not None})
    ends = F.array(*[F.lit(e) for e in edges]) if edges else F.array().cast("array<double>")
    return (
        rows.withColumn("bin", edge_bin(F.col("x"), edges))
        .where("bin is not null")
        .groupBy("bin")
        .agg(F.avg("y").alias("rate"), F.count("*").alias("count"))
        .select("bin", F.get(ends, F.col("bin") - 1).alias("lo"), F.get(ends, F.col("bin")).alias("hi"), "rate", "count")
        .orderBy("bin")
    )


def rate_over_time(df: DataFrame, date: str, target: str, freq: str = "M") -> DataFrame:
    """(period, rate, count) per calendar period; unreadable dates are left out."""
    rows = df.select(period_start(parse_date(F.col(date)), freq).alias("period"), F.col(target).alias("y"))
    return (
        rows.where("period is not null")
        .groupBy("period")
        .agg(F.avg("y").alias("rate"), F.count("*").alias("count"))
        .orderBy("period")
    )


def missing_vs_target(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """(column, is_missing, count, rate_pct) for every column and flag that occurs, in one scan."""
    flags = df.select(F.col(target).alias("y"), *[F.col(c).isNull().alias(c) for c in columns])
    return (
        flags.unpivot("y", list(columns), "column", "is_missing")
        .groupBy("column", "is_missing")
        .agg(F.count("*").alias("count"), F.round(F.avg("y") * 100, 1).alias("rate_pct"))
        .orderBy("column", "is_missing")
    )


def presence_rate(df: DataFrame, column: str, target: str) -> DataFrame:
    """(present, count, rate) with and without a key."""
    return (
        df.groupBy(F.col(column).isNotNull().alias("present"))
        .agg(F.count("*").alias("count"), F.avg(target).alias("rate"))
        .orderBy("present")
    )


def presence_describe(df: DataFrame, column: str, target: str) -> DataFrame:
    """Full description of the target by key absence: (is_missing, count, mean, std, min, q25, q50, q75, max)."""
    y = comparable(df, {target: F.col(target)})[target].cast("double")
    keys = {"yes": F.when(F.col(column).isNull(), y), "no": F.when(F.col(column).isNotNull(), y)}
    quarts = quantiles(df, keys, (0.25, 0.5, 0.75))
    pick = lambda i: F.when(F.col("is_missing"), F.lit(quarts["yes"][i])).otherwise(F.lit(quarts["no"][i]))
    return (
        df.groupBy(F.col(column).isNull().alias("is_missing"))
        .agg(
            F.count(y).alias("count"),
            F.avg(y).alias("mean"),
            F.stddev_samp(y).alias("std"),
            F.min(y).alias("min"),
            F.max(y).alias("max"),
        )
        .select(
            "is_missing", "count", "mean", "std", "min", pick(0).alias("q25"), pick(1).alias("q50"),
            pick(2).alias("q75"), "max",
        )
        .orderBy("is_missing")
    )


def segment_means(df: DataFrame, column: str, target: str, threshold: float) -> DataFrame:
    """(segment, count, rate) at or above a threshold, below it, and missing."""
    x = comparable(df, {column: F.col(column)})[column]
    segment = F.when(x.isNull(), "missing").when(x >= threshold, "at_or_above").otherwise("below")
    return (
        df.groupBy(segment.alias("segment"))
        .agg(F.count("*").alias("count"), F.avg(target).alias("rate"))
        .orderBy("segment")
    )


def group_zscore(df: DataFrame, column: str, target: str, min_count: int = 100, percent: bool = False) -> DataFrame:
    """How far each large group's rate is from the overall rate, in standard errors.

    se = sqrt(p (1 - p) / n) with the overall rate p, which is summed from the same groups
    (missing keys included) so that the table is scanned once. ``percent`` gives the display
    version in rounded percent.
    """
    groups = df.groupBy(F.col(column).alias("value")).agg(
        F.sum(F.col(target).cast("double")).alias("hits"), F.count(target).alias("labelled")
    )
    p = groups.agg(F.try_divide(F.sum("hits"), F.sum("labelled")).alias("p")).scalar()
    large = groups.where(F.col("value").isNotNull() & (F.col("labelled") >= min_count))
    report = (
        large.select("value", F.col("labelled").alias("count"), rate().alias("mean"))
        .withColumn("se", F.sqrt(p * (1 - p) / F.col("count")))
        .withColumn("diff_from_global", F.col("mean") - p)
        .withColumn("z_score", F.try_divide(F.col("diff_from_global"), F.col("se")))
        .orderBy(F.abs("z_score").desc_nulls_last(), "value")
    )
    if percent:
        report = report.withColumnsRenamed(
            {"mean": "rate_pct", "se": "se_pct", "diff_from_global": "diff_from_global_pct"}
        ).withColumns({
            c: F.round(F.col(c) * 100, 1) for c in ("rate_pct", "se_pct", "diff_from_global_pct")
        })
    return report


def normalized(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The table with its label columns normalised (see ``functions.text.normalize_label``)."""
    return df.withColumns({c: normalize_label(as_label(df, c)) for c in columns})

