"""Table-level building blocks: one-pass reports, inspection, filters, top-k, key checks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_pass(df: DataFrame, rows: Sequence[Mapping[str, Column]]) -> DataFrame:
    """A report with one line per item of ``rows``, all computed by a single aggregation.

    Every item maps output names to aggregate expressions; the one aggregated row is unfolded
    afterwards, so the table is scanned once however many columns are reported.
    """
    cells = [F.struct(*[c.alias(name) for name, c in row.items()]) for row in rows]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def features_and_target(df: DataFrame, target: str, id: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The table without its target, and the target alone; ``id`` stays on both sides, as rows have no order to match them by."""
    return df.drop(target), df.select(*([id] if id else []), target)


def first_rows(df: DataFrame, n: int, by: str | Sequence[str]) -> DataFrame:
    return df.orderBy(*([by] if isinstance(by, str) else by)).limit(n)


def by_magnitude(c: str) -> Column:
    """Sort key: largest absolute value first, missing last."""
    return F.abs(F.col(c)).desc_nulls_last()


def shape(df: DataFrame) -> DataFrame:
    """(rows, columns)."""
    return df.agg(F.count("*").alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def shapes(named: Mapping[str, DataFrame]) -> DataFrame:
    """(data, rows, columns) for several tables."""
    out = None
    for name, df in named.items():
        line = shape(df).select(F.lit(name).alias("data"), "rows", "columns")
        out = line if out is None else out.unionByName(line)
    return out


def column_catalogue(df: DataFrame) -> DataFrame:
    """(position, column, dtype, non_null) for every column, in one scan."""
    return one_pass(df, [
        {
            "position": F.lit(i),
            "column": F.lit(name),
            "dtype": F.lit(dtype),
            "non_null": F.count(F.col(name)),
        }
        for i, (name, dtype) in enumerate(df.dtypes)
    ])


def key_check(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """(rows, distinct_keys, is_unique) of a key, compared with the number of rows.

    Rows are pre-counted per key on the map side, so a repeated key is no hot spot.
    """
    names = [key] if isinstance(key, str) else list(key)
    present = F.lit(True)
    for name in names:
        present = present & F.col(name).isNotNull()
    return (
        df.groupBy(*names)
        .agg(F.count("*").alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.count(F.when(present, 1)).alias("distinct_keys"),
        )
        .withColumn("is_unique", F.col("rows") == F.col("distinct_keys"))
    )


def contradictions(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(rule, violations): rows per rule where the impossible condition holds."""
    return one_pass(df, [
        {"rule": F.lit(name), "violations": F.count_if(F.coalesce(rule, F.lit(False)))}
        for name, rule in rules.items()
    ])


def stack_tables(parts: Iterable[DataFrame]) -> DataFrame:
    """Union of tables by column name; a column one of them lacks is NULL there."""
    out = None
    for part in parts:
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def compare_scores(left: DataFrame, right: DataFrame, on: str, value: str, left_tag: str, right_tag: str) -> DataFrame:
    """Inner join of two score tables with tagged value columns and their difference, largest first."""
    a, b = f"{value}_{left_tag}", f"{value}_{right_tag}"
    joined = left.select(on, F.col(value).alias(a)).join(right.select(on, F.col(value).alias(b)), on)
    return joined.withColumn("diff", F.col(a) - F.col(b)).orderBy(F.desc("diff"), on)
