"""Profiles that are kept and extended: one small row of sketches for each column and part of a table.

A full profile of a growing table scans all of it each time. Here a part (a day, say) is scanned once and leaves a state for each column: counts,
mean and squared deviations, extremes, a KLL sketch of the quantiles and a theta sketch of the distinct values. States of any parts merge into
that of their union, whatever the order, so a table and one new day cost a scan of that day.

Exact whatever is merged: rows, missing, mean, std, min, max. Estimates with a stated bound: quantiles, whose rank is off by at most
``RANK_ERROR`` of the rows (at 99 % confidence); distinct values, exact up to ``NOMINAL`` of them and with a relative standard
error of ``1 / sqrt(NOMINAL)`` beyond. :func:`exact_quantiles` makes the quantiles exact by counting between the sketched bounds.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyframe.functions.numeric import ratio
from tallyframe.operators.counts import as_label
from tallyframe.operators.order import Span, comparable, quantiles
from tallyframe.spec import NUMERIC

#: Size of the quantile sketch, and the share of the rows by which the rank of a quantile may be off (99 % confidence).
KLL_K, RANK_ERROR = 1000, 0.0028
#: Nominal entries of the sketch of distinct values, as a power of two.
LG_NOMINAL = 12
NOMINAL = 1 << LG_NOMINAL


def column_states(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, rows, present, mean, m2, lo, hi, quantile_state, distinct_state), one scan and one aggregation.

    Columns that are no numbers have rows, present and distinct values only. NaN is missing, as everywhere. Numbers are taken as doubles.
    The states of all columns of a part are put together in one row before they are shuffled, some 60 kB for each numeric column.
    """
    types = {f.name: f.dataType for f in df.schema.fields}

    def state(c: str) -> Column:
        number = isinstance(types[c], NUMERIC)
        x = comparable(df, {c: F.col(c)})[c].cast("double") if number else F.lit(None).cast("double")
        present = x if number else F.col(c)
        value = F.when(present.isNotNull(), F.xxhash64(as_label(df, c)))
        return F.struct(
            F.lit(c).alias("column"),
            F.count("*").alias("rows"),
            F.count(present).alias("present"),
            F.avg(x).alias("mean"),
            (F.var_pop(x) * F.count(x)).alias("m2"),
            F.min(x).alias("lo"),
            F.max(x).alias("hi"),
            (F.kll_sketch_agg_double(x, KLL_K) if number else F.lit(None).cast("binary")).alias("quantile_state"),
            F.theta_sketch_agg(value, LG_NOMINAL).alias("distinct_state"),
        )

    made = df.groupBy(*by).agg(F.array(*[state(c) for c in columns]).alias("states"))
    return made.select(*by, F.inline("states")).where("rows > 0")


def merge_states(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """States of all parts (or of the parts with equal ``by``) as one state for each column."""
    group = [*by, "column"]
    whole = W.partitionBy(*group)
    mean = F.sum(F.col("mean") * F.col("present")).over(whole) / F.sum(F.when(F.col("mean").isNotNull(), F.col("present"))).over(whole)
    apart = F.col("m2") + F.col("present") * F.pow(F.col("mean") - F.col("__mean"), 2)
    return (
        states.withColumn("__mean", mean)
        .groupBy(*group)
        .agg(
            F.sum("rows").alias("rows"),
            F.sum("present").alias("present"),
            F.first("__mean").alias("mean"),
            F.sum(apart).alias("m2"),
            F.min("lo").alias("lo"),
            F.max("hi").alias("hi"),
            # A column of labels has no quantiles; merging nothing leaves an empty sketch that nobody may read.
            F.when(F.count("quantile_state") > 0, F.kll_merge_agg_double("quantile_state")).alias("quantile_state"),
            F.theta_union_agg("distinct_state", LG_NOMINAL).alias("distinct_state"),
        )
    )


def record_states(df: DataFrame, columns: Sequence[str], part: str, path: str) -> None:
    """Write the states of the parts that ``df`` holds, one folder for each value of ``part``.

    Parts recorded before are replaced, others stay: a job that is run again counts nothing twice. ``df`` must hold whole parts.
    """
    made = column_states(df, columns, [part])
    made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)


def read_states(spark: SparkSession, path: str) -> DataFrame:
    """All recorded states."""
    return spark.read.parquet(path)


def _quantile(share: float) -> Column:
    # Only a sketch that holds values can be asked.
    return F.when(F.col("present") > 0, F.kll_sketch_get_quantile_double("quantile_state", F.lit(float(share))))


def describe_states(states: DataFrame, shares: Mapping[str, float] | None = None) -> DataFrame:
    """(column, rows, missing_pct, mean, std, min, one column for each of ``shares``, max, distinct) of merged states."""
    shares = {"q25": 0.25, "q50": 0.5, "q75": 0.75} if shares is None else shares
    spread = F.when(F.col("present") > 1, F.sqrt(F.col("m2") / (F.col("present") - 1)))
    return states.select(
        "column",
        "rows",
        ratio((F.col("rows") - F.col("present")) * 100, F.col("rows")).alias("missing_pct"),
        "mean",
        spread.alias("std"),
        F.col("lo").alias("min"),
        *[F.when(F.col("quantile_state").isNotNull(), _quantile(s)).alias(name) for name, s in shares.items()],
        F.col("hi").alias("max"),
        F.theta_sketch_estimate("distinct_state").alias("distinct"),
    ).orderBy("column")


def exact_quantiles(df: DataFrame, states: DataFrame, shares: Sequence[float], **tuning: int) -> dict[str, list[float | None]]:
    """Exact quantiles of the rows that the merged ``states`` describe, for each numeric column in them.

    Count and extremes come from the states, and so do the first bounds around each rank, four times ``RANK_ERROR`` wide, so the two passes that
    find them are saved. Bounds are only a start: the search counts what lies between and outside them, so a sketch that is off costs a pass, not
    a wrong value. The states must be those of ``df``.
    """
    around = sorted({min(max(s + side * 2 * RANK_ERROR, 0.0), 1.0) for s in shares for side in (-1, 1)})
    bounds = F.when(F.col("present") > 0, F.kll_sketch_get_quantile_double("quantile_state", F.array(*map(F.lit, around))))
    rows = states.where("quantile_state is not null").select("column", "present", "lo", "hi", bounds.alias("bounds")).collect()
    keys = {r["column"]: F.col(r["column"]).cast("double") for r in rows}
    known = {r["column"]: Span(r["present"], r["lo"], r["hi"]) for r in rows}
    return quantiles(df, keys, shares, known=known, bounds={r["column"]: r["bounds"] or [] for r in rows}, **tuning)


def value_overlap(left: DataFrame, right: DataFrame, left_tag: str = "train", right_tag: str = "test") -> DataFrame:
    """(column, distinct of each side, common, share of the right side's values that the left has, margin) of merged states.

    No value is shuffled or joined. ``margin`` is three standard errors of ``common``, 0 where both sketches hold every value.
    """
    a, b = f"{left_tag}_distinct", f"{right_tag}_distinct"
    both = left.select("column", F.col("distinct_state").alias("__a")).join(right.select("column", F.col("distinct_state").alias("__b")), "column")
    found = both.select(
        "column",
        F.theta_sketch_estimate("__a").alias(a),
        F.theta_sketch_estimate("__b").alias(b),
        F.theta_sketch_estimate(F.theta_intersection("__a", "__b")).alias("common"),
    )
    union = F.col(a) + F.col(b) - F.col("common")
    error = F.lit(3 / math.sqrt(NOMINAL)) * F.sqrt(F.greatest(F.col("common"), F.lit(1)) * union)
    full = F.greatest(a, b) <= NOMINAL
    return found.withColumns({
        "share": ratio(F.col("common"), F.col(b)),
        "margin": F.when(full, F.lit(0.0)).otherwise(error),
    }).orderBy("column")
