"""How a second table differs from the first: dates, numerics, categories, importances."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyframe.functions.missing import fill
from tallyframe.functions.numeric import ratio
from tallyframe.functions.text import normalize_label, source_column
from tallyframe.operators.counts import as_label
from tallyframe.operators.order import comparable, quantiles
from tallyframe.operators.tables import stack_tables
from tallyframe.session import small_table
from tallyframe.spec import NUMERIC

SOURCE = "is_test"


def tag_sources(train: DataFrame, test: DataFrame, flag: str = SOURCE) -> DataFrame:
    """Both tables in one, with a boolean source flag; columns one side lacks are NULL there."""
    return train.withColumn(flag, F.lit(False)).unionByName(
        test.withColumn(flag, F.lit(True)), allowMissingColumns=True
    )


def source_share(tagged: DataFrame, flag: str = SOURCE) -> DataFrame:
    """(test_share): share of rows from the second table."""
    return tagged.agg(F.round(F.avg(F.col(flag).cast("int")), 4).alias("test_share"))


def date_audit(train: DataFrame, test: DataFrame, date: str) -> DataFrame:
    """Date ranges of two tables and how far the second's dates occur in the first.

    Each table is reduced to one row per timestamp before anything is compared, so the join
    and the intersection only see distinct dates.
    """
    def per_date(df: DataFrame) -> DataFrame:
        return df.groupBy(F.col(date).alias("ts")).agg(F.count("*").alias("n"))

    def line(name: str, counts: DataFrame) -> DataFrame:
        return counts.agg(
            F.lit(name).alias("data"),
            F.sum("n").alias("rows"),
            F.min("ts").alias("min_date"),
            F.max("ts").alias("max_date"),
            F.count("ts").alias("unique_dates"),
        )

    def days(counts: DataFrame) -> DataFrame:
        return counts.where("ts is not null").groupBy(F.to_date("ts").alias("day")).agg(F.sum("n").alias("n"))

    a, b = per_date(train), per_date(test)
    seen = days(b).join(days(a).select("day", F.lit(1).alias("hit")), "day", "left")
    overlap = seen.agg(
        ratio(F.coalesce(F.sum(F.when(F.col("hit") == 1, F.col("n"))), F.lit(0)), F.sum("n")).alias("share"),
        F.count("hit").alias("common"),
    )
    share = overlap.select("share").scalar()
    none = F.lit(None).cast("double")
    return (
        line("train", a).withColumn("test_rows_on_train_dates", none)
        .unionByName(line("test", b).withColumn("test_rows_on_train_dates", share))
        .unionByName(
            overlap.select(
                F.lit("overlap").alias("data"),
                F.lit(None).cast("bigint").alias("rows"),
                F.lit(None).cast(dict(train.dtypes)[date]).alias("min_date"),
                F.lit(None).cast(dict(train.dtypes)[date]).alias("max_date"),
                F.col("common").alias("unique_dates"),
                F.col("share").alias("test_rows_on_train_dates"),
            )
        )
    )


_NUMERIC_REPORT = (
    "feature string, type string, train_missing_pct double, test_missing_pct double, train_mean double, "
    "test_mean double, train_p50 double, test_p50 double, train_p90 double, test_p90 double"
)


def numeric_shift(tagged: DataFrame, features: list[str], flag: str = SOURCE, exact: bool = True) -> DataFrame:
    """Missing share, mean, median and 90 % quantile of each numeric in both tables, one line each."""
    sides = {"train": ~F.col(flag), "test": F.col(flag)}
    keys, aggs = {}, []
    for i, c in enumerate(features):
        x = comparable(tagged, {c: F.col(c)})[c].cast("double")
        for side, here in sides.items():
            k = f"{side}.{i}"
            keys[k] = F.when(here, x)
            aggs += [F.avg(keys[k]).alias(f"{k}.mean"), F.count(keys[k]).alias(f"{k}.n")]
    sizes = [F.count_if(here).alias(f"{side}.rows") for side, here in sides.items()]
    row = tagged.agg(*sizes, *aggs).first()
    cuts = quantiles(tagged, keys, (0.5, 0.9), exact=exact)
    out = []
    for i, c in enumerate(features):
        cells = [c, "numeric"]
        miss = {s: 1 - row[f"{s}.{i}.n"] / row[f"{s}.rows"] if row[f"{s}.rows"] else None for s in sides}
        cells += [miss[s] for s in sides]
        cells += [row[f"{s}.{i}.mean"] for s in sides]
        cells += [cuts[f"{s}.{i}"][0] for s in sides] + [cuts[f"{s}.{i}"][1] for s in sides]
        out.append(tuple(cells))
    return small_table(tagged.sparkSession, out, _NUMERIC_REPORT)


def categorical_shifts(
    tagged: DataFrame, features: Sequence[str], flag: str = SOURCE, top: int = 8, normalize: bool = True
) -> DataFrame:
    """Share of each value in both tables and the difference; the ``top`` largest differences of each feature.

    One scan for all features: rows are counted per raw spelling, cleaning works on the counts. The rank filter is
    applied before its shuffle too (group limit), so a feature with very many values fills no task.
    """
    flat = tagged.select(flag, *[as_label(tagged, c).alias(c) for c in features]).unpivot(
        flag, list(features), "feature", "value"
    )
    raw = flat.groupBy("feature", "value").agg(F.count_if(~F.col(flag)).alias("a"), F.count_if(F.col(flag)).alias("b"))
    label = fill(normalize_label(F.col("value")) if normalize else F.col("value"), "missing")
    counted = raw.groupBy("feature", label.alias("value")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    # Every row has one value of each feature, so the totals of one feature hold for all.
    totals = raw.where(F.col("feature") == features[0]).agg(F.struct(F.sum("a").alias("a"), F.sum("b").alias("b")).alias("t")).scalar()
    shares = counted.select(
        "feature",
        F.lit("categorical").alias("type"),
        "value",
        ratio(F.col("a"), totals["a"]).alias("train_pct"),
        ratio(F.col("b"), totals["b"]).alias("test_pct"),
    ).withColumn("diff_pct", F.col("test_pct") - F.col("train_pct"))
    order = W.partitionBy("feature").orderBy(F.abs("diff_pct").desc_nulls_last(), "value")
    return shares.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= top).drop("_rank")


def categorical_shift(tagged: DataFrame, feature: str, flag: str = SOURCE, top: int = 8, normalize: bool = True) -> DataFrame:
    """The report of one feature, largest difference first."""
    return categorical_shifts(tagged, [feature], flag, top, normalize).orderBy(F.abs("diff_pct").desc_nulls_last(), "value")


def feature_shifts(tagged: DataFrame, features: Sequence[str], flag: str = SOURCE) -> DataFrame:
    """The numeric and the categorical report of several features, by column type: one set of scans for each type."""
    nums = [c for c in features if isinstance(tagged.schema[c].dataType, NUMERIC)]
    cats = [c for c in features if c not in nums]
    parts = [numeric_shift(tagged, nums, flag)] if nums else []
    return stack_tables(parts + ([categorical_shifts(tagged, cats, flag)] if cats else []))


def importance_by_column(importance: DataFrame, top_n: int = 25) -> DataFrame:
    """(model, feature, importance) summed from encoded features to table columns, top ones per model."""
    summed = importance.groupBy("model", source_column(F.col("feature")).alias("feature")).agg(
        F.sum("importance").alias("importance")
    )
    order = W.partitionBy("model").orderBy(F.desc("importance"), "feature")
    return summed.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= top_n).drop("_rank")


def top_features(by_column: DataFrame, top_n: int = 8) -> DataFrame:
    """(feature, importance) averaged over the models that list it."""
    mean = by_column.groupBy("feature").agg(F.avg("importance").alias("importance"))
    return mean.orderBy(F.desc("importance"), "feature").limit(top_n)
