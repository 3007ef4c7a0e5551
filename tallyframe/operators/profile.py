"""Column profiles: missing values, categories, numerics, distributions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyframe.functions.numeric import equal_width_bin, ratio
from tallyframe.operators.assoc import pearson
from tallyframe.operators.counts import most_frequent, value_totals
from tallyframe.operators.heavy import possible_leaders
from tallyframe.operators.order import Span, comparable, quantiles
from tallyframe.operators.tables import by_magnitude, one_pass
from tallyframe.session import small_table, stage

# Decimals the numeric summary is shown with.
SUMMARY_DECIMALS = {"missing_pct": 1, "corr_target": 3}
SUMMARY_DEFAULT_DECIMALS = 2
# The quantiles of the upper-tail report.
LADDER = (0.9999, 0.999, 0.995, 0.99, 0.95, 0.9)
# Rows of one range of counted values in the box report.
BOX_ROWS = 5_000_000
# Shares of the rows at which a threshold for the largest values is sketched, and the sketch's accuracy.
TAILS, TAIL_ACCURACY = (0.5, 0.9, 0.99, 0.999, 0.9997), 10_000


# ---- missing values -------------------------------------------------------------------------

def null_summary(df: DataFrame, columns: Sequence[str] | None = None, only_missing: bool = True) -> DataFrame:
    """(column, null_count, null_percent), most missing first; one scan."""
    report = one_pass(df, [
        {
            "column": F.lit(c),
            "null_count": F.count_if(F.col(c).isNull()),
            "null_percent": ratio(F.count_if(F.col(c).isNull()) * 100, F.count("*")),
        }
        for c in (columns or df.columns)
    ])
    if only_missing:
        report = report.where("null_count > 0")
    return report.orderBy(F.desc("null_count"), "column")


def missing_compare(left: DataFrame, right: DataFrame, left_tag: str = "train", right_tag: str = "test") -> DataFrame:
    """Missing share and count of two tables side by side, for columns missing in either.

    A column one table lacks has NULL on that side.
    """
    def side(df: DataFrame, tag: str) -> DataFrame:
        return null_summary(df, only_missing=False).select(
            "column",
            F.col("null_percent").alias(f"{tag}_missing_pct"),
            F.col("null_count").alias(f"{tag}_missing_count"),
        )

    both = side(left, left_tag).join(side(right, right_tag), "column", "full")
    anywhere = (F.col(f"{left_tag}_missing_count") > 0) | (F.col(f"{right_tag}_missing_count") > 0)
    return both.where(anywhere).orderBy(F.col(f"{left_tag}_missing_pct").desc_nulls_last(), "column")


# ---- categories -----------------------------------------------------------------------------

def value_counts(df: DataFrame, column: str, dropna: bool = True) -> DataFrame:
    """(value, count, share), most frequent first; one scan (the total comes from the counts)."""
    rows = df.where(F.col(column).isNotNull()) if dropna else df
    counted = rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("count"))
    total = counted.agg(F.sum("count").alias("total")).scalar()
    return counted.withColumn("share", ratio(F.col("count"), total)).orderBy(F.desc("count"), "value")


def target_balance(df: DataFrame, target: str) -> DataFrame:
    """(target, count, rate_pct) per class, in class order."""
    shares = value_counts(df, target)
    return shares.select(
        F.col("value").alias(target), "count", F.round(F.col("share") * 100, 1).alias("rate_pct")
    ).orderBy(target)


def distinct_counts(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """(column, distinct): distinct present values. ``exact=False`` uses a sketch in one pass."""
    if not exact:
        return one_pass(df, [
            {"column": F.lit(c), "distinct": F.approx_count_distinct(F.col(c))} for c in columns
        ])
    return value_totals(df, columns).groupBy("column").agg(F.count("value").alias("distinct"))


def cat_summary(df: DataFrame, columns: Sequence[str], top: int = 8, normalize: bool = False) -> DataFrame:
    """Missing share and count, distinct values and the ``top`` values with their share as text."""
    counted = value_totals(df, columns, normalize=normalize)
    totals = counted.groupBy("column").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("missing_count"),
        F.count("value").alias("unique_count"),
    )
    leaders = (
        most_frequent(counted, top)
        .groupBy("column")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "value", "n"))).alias("leaders"))
    )
    label = lambda s: F.format_string(
        "%s (%.1f%%)", F.coalesce(s["value"], F.lit("nan")), F.round(s["n"] * 100 / F.col("rows"), 1)
    )
    return (
        totals.join(F.broadcast(leaders), "column")  # one row per reported column
        .select(
            "column",
            F.round(F.col("missing_count") * 100 / F.col("rows"), 1).alias("missing_pct"),
            "missing_count",
            "unique_count",
            F.transform("leaders", label).alias("top_values"),
        )
        .orderBy(F.desc("missing_count"), "column")
    )


def top_counts_by_target(df: DataFrame, column: str, target: str, k: int = 20, many_values: bool = False) -> DataFrame:
    """Counts of the ``k`` most frequent values, split by target (one scan; k rows are broadcast).

    ``many_values`` leaves out values that a sketch proves to be too rare before they are shuffled (``operators/heavy``).
    """
    present = df.where(F.col(column).isNotNull())
    present = possible_leaders(present.select(column, target), F.col(column), k) if many_values else present
    split = (
        present.groupBy(F.col(column).alias("value"), F.col(target).alias("target"))
        .agg(F.count("*").alias("count"))
    )
    leaders = split.groupBy("value").agg(F.sum("count").alias("total")).orderBy(F.desc("total"), "value").limit(k)
    return split.join(F.broadcast(leaders), "value").orderBy(F.desc("total"), "value", "target")


# ---- numerics -------------------------------------------------------------------------------

def adjusted_skewness(c: Column) -> Column:
    """Bias-adjusted skewness; 0 for a constant, NULL below three values."""
    n = F.count(c).cast("double")
    skew = F.when(F.stddev_pop(c) == 0, F.lit(0.0)).otherwise(F.skewness(c))
    return F.when(n >= 3, skew * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0)))


def column_stats(df: DataFrame, columns: Sequence[str], extra: Mapping[str, dict[str, Column]] | None = None):
    """Count, missing, mean, std, min, max (and ``extra``) of every column as dicts; one scan."""
    keys = comparable_each(df, columns)
    names, aggs = [], []
    for i, c in enumerate(columns):
        x = keys[c]
        stats = {
            "rows": F.count("*"),
            "count": F.count(x),
            "mean": F.avg(x),
            "std": F.stddev_samp(x),
            "min": F.min(x),
            "max": F.max(x),
            **(extra or {}).get(c, {}),
        }
        names.append((c, list(stats)))
        aggs += [agg.alias(f"{i}.{name}") for name, agg in stats.items()]
    row = df.agg(*aggs).first()
    return {c: {s: row[f"{i}.{s}"] for s in stats} for i, (c, stats) in enumerate(names)}


def comparable_each(df: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    """Each column as bigint or double with NaN as NULL, typed on its own."""
    return {c: comparable(df, {c: F.col(c)})[c] for c in columns}


def _known(stats: Mapping[str, Mapping]) -> dict[str, Span]:
    as_double = any(isinstance(s["min"], float) for s in stats.values())
    kind = float if as_double else int
    return {
        c: Span(s["count"], *(None if s[e] is None else kind(s[e]) for e in ("min", "max"))) for c, s in stats.items()
    }


def describe(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """(column, count, mean, std, min, q25, q50, q75, max) with exact quartiles."""
    stats = column_stats(df, columns)
    quarts = quantiles(df, {c: F.col(c) for c in columns}, (0.25, 0.5, 0.75), exact=exact, known=_known(stats))
    return small_table(
        df.sparkSession,
        [
            (c, s["count"], s["mean"], s["std"], _f(s["min"]), *quarts[c], _f(s["max"]))
            for c, s in stats.items()
        ],
        "column string, count bigint, mean double, std double, min double, q25 double, q50 double, q75 double, max double",
    )


def _f(v) -> float | None:
    return None if v is None else float(v)


def num_summary(
    df: DataFrame, columns: Sequence[str], target: str, exact: bool = True, rounded: bool = False
) -> DataFrame:
    """Missing share, correlation with the target, moments, quartiles and skew of every column.

    Two scans on small tables: all moments at once, then all quartiles at once. Strongest
    correlation first. ``rounded`` shows the usual report decimals.
    """
    label = comparable_each(df, [target])[target]
    keys = comparable_each(df, columns)
    stats = column_stats(
        df, columns, {c: {"corr": pearson(keys[c], label), "skew": adjusted_skewness(keys[c])} for c in columns}
    )
    quarts = quantiles(df, {c: F.col(c) for c in columns}, (0.25, 0.5, 0.75), exact=exact, known=_known(stats))
    report = small_table(
        df.sparkSession,
        [
            (
                c,
                100.0 * (s["rows"] - s["count"]) / s["rows"] if s["rows"] else None,
                s["rows"] - s["count"],
                s["corr"],
                s["mean"],
                quarts[c][1],
                s["std"],
                _f(s["min"]),
                _f(s["max"]),
                quarts[c][0],
                quarts[c][2],
                s["skew"],
            )
            for c, s in stats.items()
        ],
        "column string, missing_pct double, missing_count bigint, corr_target double, mean double, median double, "
        "std double, min double, max double, q25 double, q75 double, skew double",
    ).orderBy(by_magnitude("corr_target"), "column")
    if rounded:
        report = report.withColumns({
            f.name: F.round(f.name, SUMMARY_DECIMALS.get(f.name, SUMMARY_DEFAULT_DECIMALS))
            for f in report.schema.fields
            if f.dataType.typeName() == "double"
        })
    return report


def quantile_ladder(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float] = LADDER, exact: bool = True
) -> DataFrame:
    """(column, prob, value) for upper-tail quantiles."""
    ladders = quantiles(df, {c: F.col(c) for c in columns}, probs, exact=exact)
    return small_table(
        df.sparkSession,
        [(c, float(p), v) for c in columns for p, v in zip(probs, ladders[c])],
        "column string, prob double, value double",
    )


def largest_values(df: DataFrame, columns: Sequence[str], k: int = 20) -> DataFrame:
    """Distinct values among the ``k`` largest rows of each column (not the k largest distinct); NaN is missing.

    One scan sketches a value that more than ``k`` rows of a column reach but few others do, one scan counts the values from there
    on; nothing is sorted but at most ``k`` counted values of a column. A column without such a value (few rows) is counted whole.
    """
    numbers = {c: x.cast("double") for c, x in comparable(df, {c: F.col(c) for c in columns}).items()}
    aggs = [a for i, x in enumerate(numbers.values()) for a in (F.count(x).alias(f"n{i}"), F.percentile_approx(x, list(TAILS), TAIL_ACCURACY).alias(f"p{i}"))]
    seen = df.agg(*aggs).first()
    cells = []
    for i, (c, x) in enumerate(numbers.items()):
        n = seen[f"n{i}"]
        # The sketch is off by one in TAIL_ACCURACY of the rows at most.
        fine = [v for p, v in zip(TAILS, seen[f"p{i}"] or []) if n * (1 - p - 2 / TAIL_ACCURACY) > k]
        cells += [F.lit(c), F.when(x >= F.lit(fine[-1]), x) if fine else x]
    flat = df.select(F.stack(F.lit(len(columns)), *cells).alias("column", "value")).where("value is not null")
    counted = flat.groupBy("column", "value").agg(F.count("*").alias("n"))
    order = W.partitionBy("column").orderBy(F.desc("value"))
    top = counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    above = F.sum("n").over(order.rowsBetween(W.unboundedPreceding, 0)) - F.col("n")
    return top.withColumn("above", above).where(F.col("above") < k).select("column", "value").orderBy("column", F.desc("value"))


# ---- distributions --------------------------------------------------------------------------

def histogram(df: DataFrame, column: str, target: str | None = None, bins: int = 50) -> DataFrame:
    """Rows per equal-width bin between minimum and maximum, per target class if given.

    (bin, lo, hi[, target], count); a constant column is widened by half a unit each way.
    """
    x = comparable(df, {column: F.col(column)})[column].cast("double")
    rows = df.select(x.alias("x"), *([] if target is None else [F.col(target).alias("target")])).where("x is not null")
    ends = rows.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi")).alias("ends")).scalar()
    half = F.when(ends["lo"] == ends["hi"], F.lit(0.5)).otherwise(F.lit(0.0))
    lo, width = ends["lo"] - half, (ends["hi"] - ends["lo"] + half * 2) / bins
    groups = ["bin"] + ([] if target is None else ["target"])
    counted = rows.withColumn("bin", equal_width_bin(F.col("x"), ends["lo"], ends["hi"], bins))
    return (
        counted.groupBy(*groups)
        .agg(F.count("*").alias("count"))
        .withColumns({"lo": lo + width * F.col("bin"), "hi": lo + width * (F.col("bin") + 1)})
        .select("bin", "lo", "hi", *groups[1:], "count")
        .orderBy(*groups)
    )


def box_stats(df: DataFrame, column: str, by: str, levels: Sequence[float] = (), exact: bool = True) -> DataFrame:
    """Five-number summary and 1.5-IQR whiskers of ``column`` per value of ``by``, in order of ``by``.

    ``levels`` adds further quantiles (letter values) as an array column. Any number of classes, of any size: values are
    counted per class, the counts partitioned by range of (class, value) and written once, and ranks taken inside each range
    and lifted by the lower ranges of the class, so that a class with most of the rows is spread over many tasks.
    """
    x = comparable(df, {column: F.col(column)})[column].cast("double")
    rows = df.select(F.col(by).alias("class"), x.alias("x")).where("class is not null")
    sizes = rows.groupBy("class").agg(F.count("x").alias("total"))
    parts = rows.count() // BOX_ROWS + 1
    counted = rows.where("x is not null").groupBy("class", "x").agg(F.count("*").alias("n"))
    ranged = counted.repartitionByRange(parts, "class", "x").withColumn("cell", F.spark_partition_id())
    ranged = stage(ranged, "box-values")
    # One row for each class and range.
    cells = ranged.groupBy("class", "cell").agg(F.sum("n").alias("n"))
    below = F.sum("n").over(W.partitionBy("class").orderBy("cell").rowsBetween(W.unboundedPreceding, 0)) - F.col("n")
    cells = cells.withColumn("lower", below).drop("n").join(sizes, "class")

    probs = (0.0, 0.25, 0.5, 0.75, 1.0, *levels)
    if exact:
        upto = F.sum("n").over(W.partitionBy("class", "cell").orderBy("x").rowsBetween(W.unboundedPreceding, 0))
        placed = ranged.withColumn("upto", upto).join(cells, ["class", "cell"]).withColumn("upto", F.col("upto") + F.col("lower"))
        places = [(F.col("total") - 1) * F.lit(float(p)) for p in probs]
        at = lambda k: F.max(F.when((k >= F.col("upto") - F.col("n")) & (k < F.col("upto")), F.col("x")))
        ends = placed.groupBy("class", "total").agg(F.array(*[F.struct(at(F.floor(k)).alias("a"), at(F.ceil(k)).alias("b")) for k in places]).alias("found"))
        between = [
            F.when(f["a"] == f["b"], f["a"]).otherwise(f["a"] + (f["b"] - f["a"]) * (k - F.floor(k)))
            for k, f in ((k, F.col("found")[i]) for i, k in enumerate(places))
        ]
        boxes = ends.select("class", F.array(*between).alias("q"))
    else:
        boxes = rows.where("x is not null").groupBy("class").agg(F.percentile_approx("x", list(map(float, probs)), 10_000).alias("q"))
    q = lambda i: F.col("q")[i]
    reach = (q(3) - q(1)) * 1.5
    bounds = cells.join(boxes, "class").select("class", "cell", (q(1) - reach).alias("least"), (q(3) + reach).alias("most"))
    whiskers = ranged.join(bounds, ["class", "cell"]).groupBy("class").agg(
        F.min(F.when(F.col("x") >= F.col("least"), F.col("x"))).alias("whisker_lo"),
        F.max(F.when(F.col("x") <= F.col("most"), F.col("x"))).alias("whisker_hi"),
    )
    names = ("min", "q25", "median", "q75", "max")
    letters = [F.when(F.col("q").isNotNull(), F.slice("q", 6, len(levels))).alias("letter_values")] if levels else []
    report = sizes.join(boxes, "class", "left").join(whiskers, "class", "left").orderBy("class")
    return report.select(
        F.col("class").alias(by), F.col("total").alias("count"), *[q(i).alias(c) for i, c in enumerate(names)],
        "whisker_lo", "whisker_hi", *letters,
    )
