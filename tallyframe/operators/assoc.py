"""Pairwise-complete Pearson correlation, all pairs in one pass."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.tables import by_magnitude, one_pass


def pearson(a: Column, b: Column) -> Column:
    """Correlation over rows where both are present; NULL when either is constant there.

    Built from moments because ``corr`` of a constant raises a division error in ANSI mode.
    """
    x, y = (F.when(a.isNotNull() & b.isNotNull(), c.cast("double")) for c in (a, b))
    spread = F.nullif(F.stddev_pop(x), F.lit(0.0)) * F.nullif(F.stddev_pop(y), F.lit(0.0))
    return F.try_divide(F.covar_pop(x, y), spread)


def _number(df: DataFrame, name: str) -> Column:
    c = F.col(name).cast("double")
    return F.when(~F.isnan(c), c)


def corr_target(df: DataFrame, columns: Sequence[str], target: str, threshold: float | None = None) -> DataFrame:
    """(column, corr) of each column with the target, strongest first, optionally only |corr| >= threshold."""
    y = _number(df, target)
    report = one_pass(df, [{"column": F.lit(c), "corr": pearson(_number(df, c), y)} for c in columns])
    if threshold is not None:
        report = report.where(F.abs("corr") >= threshold)
    return report.orderBy(by_magnitude("corr"), "column")


def corr_pairs(df: DataFrame, columns: Sequence[str], threshold: float | None = None) -> DataFrame:
    """(feature_1, feature_2, corr) of the upper triangle, optionally only |corr| >= threshold."""
    name = lambda c: F.get(F.lit(list(columns)), F.col(c))
    report = _correlations(df, columns).where("i < j").select(name("i").alias("feature_1"), name("j").alias("feature_2"), "corr")
    if threshold is not None:
        report = report.where(F.abs("corr") >= threshold)
    return report.orderBy(by_magnitude("corr"), "feature_1", "feature_2")


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Full square matrix: one row per column, one value column per column.

    Only the upper triangle is aggregated; the lower half mirrors it.
    """
    upper = _correlations(df, columns)
    cells = upper.unionByName(upper.where("i < j").select(F.col("j").alias("i"), F.col("i").alias("j"), "corr"))
    lines = cells.groupBy("i").agg(F.transform(F.array_sort(F.collect_list(F.struct("j", "corr"))), lambda c: c["corr"]).alias("line"))
    name = F.get(F.lit(list(columns)), F.col("i")).alias("column")
    return lines.select(name, *[F.get("line", F.lit(j)).alias(c) for j, c in enumerate(columns)])


#: Sums of a pair of columns over the rows that have both: number, both columns, their squares and their product.
_SUMS = ("n", "x", "y", "xx", "yy", "xy")
# What is left of a column's spread when it is constant and only rounding moves it, as a share of its mean square.
_CONSTANT = 1e-13


def _correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(i, j, corr) for columns i <= j, over rows where both are present; NULL when either is constant there.

    Rows are read as blocks: a task adds up matrices of all pairs, as a few matrix products for each batch, and hands on one row
    for each column. Rows of a column are then added up in one place. The plan does not grow with the number of columns.
    Sums are taken around the first batch's means, and moved to common centres when they are added.
    """
    p = len(columns)
    arrays = ", ".join(f"{c} array<double>" for c in ("centre", *_SUMS))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, total = None, [np.zeros((p, p)) for _ in _SUMS]
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns], axis=1)
            here = np.isfinite(x)
            if centre is None:
                centre = np.where(here, x, 0).sum(0) / np.maximum(here.sum(0), 1)
            x = np.where(here, x - centre, 0)
            m = here.astype(np.float64)
            for t, more in zip(total, (m.T @ m, x.T @ m, m.T @ x, (x * x).T @ m, m.T @ (x * x), x.T @ x)):
                t += more
        if centre is not None:
            rows = [range(p), [centre.tolist()] * p, *([t[i, i:].tolist() for i in range(p)] for t in total)]
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), *(pa.array(r, pa.list_(pa.float64())) for r in rows[1:])], ["i", "centre", *_SUMS])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                i, centre = row[0], np.array(row[1])
                own = [np.array(v) for v in row[2:]]
                if i not in held or not held[i][1][0].any():
                    held[i] = (centre, own)
                    continue
                base, total = held[i]
                n, x, y, xx, yy, xy = own
                a, b = centre[i] - base[i], (centre - base)[i:]  # from this task's centres to the common ones
                moved = (n, x + n * a, y + n * b, xx + 2 * a * x + n * a * a, yy + 2 * b * y + n * b * b, xy + b * x + a * y + n * a * b)
                for t, more in zip(total, moved):
                    t += more
        for i, (_, (n, x, y, xx, yy, xy)) in held.items():
            with np.errstate(all="ignore"):
                vx, vy = (np.where(q * n - s * s > _CONSTANT * n * q, q * n - s * s, np.nan) for s, q in ((x, xx), (y, yy)))
                corr = (xy * n - x * y) / np.sqrt(vx * vy)
            found = pa.array([None if np.isnan(c) else float(c) for c in corr], pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array([i] * len(corr), pa.int32()), pa.array(range(i, p), pa.int32()), found], ["i", "j", "corr"])

    numbers = df.select(*[_number(df, c).alias(f"c{k}") for k, c in enumerate(columns)])
    # A row without numbers, so that an empty table has its pairs too.
    numbers = numbers.union(df.sparkSession.range(1).select(*[F.lit(None).cast("double")] * p))
    return numbers.mapInArrow(sums, f"i int, {arrays}").repartition("i").mapInArrow(merged, "i int, j int, corr double")
