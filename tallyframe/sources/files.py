"""Reading and writing tables: CSV with missing-value tokens, parquet."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions.missing import CSV_NULL_TOKENS, nan_to_null, tokens_to_null
from tallyframe.operators.split import sample_n
from tallyframe.session import small_table
from tallyframe.sources.records import csv_fields


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan with NaN as NULL, so missing values have one form."""
    return nan_to_null(spark.read.parquet(path))


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    null_tokens: tuple[str, ...] = CSV_NULL_TOKENS,
    multi_line: bool = True,
) -> DataFrame:
    """CSV with a header; whole fields equal to a null token are missing.

    A quoted field may hold line breaks. Large files are cut among tasks all the same: see :mod:`tallyframe.sources.records`.
    ``multi_line=False`` saves the pass that needs; it is for files whose fields hold no line break.

    With a schema the file is scanned once, when used. Without one, types are found by one
    aggregation over the text: a column is long, double or boolean if every present field reads
    as such, else string.
    """
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if wanted is not None:
        # Fields arrive as text so that tokens can be recognised before they are typed.
        text = T.StructType([T.StructField(f.name, T.StringType()) for f in wanted.fields])
        raw = csv_fields(spark, path, text) if multi_line else reader.schema(text).option("enforceSchema", False).csv(path)
        return _typed(raw, {f.name: f.dataType.simpleString() for f in wanted.fields}, null_tokens, strict=True)
    raw = csv_fields(spark, path) if multi_line else reader.csv(path)
    return _typed(raw, infer_types(raw, null_tokens), null_tokens, strict=False)


_NUMBER = r"(?i)^\s*([+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?|[+-]?inf(inity)?|nan)\s*$"


def infer_types(raw: DataFrame, null_tokens: tuple[str, ...] = CSV_NULL_TOKENS) -> dict[str, str]:
    """Narrowest of bigint, double, boolean, string that reads every present field; one pass."""
    # A cast that fails costs an exception for each cell, so only texts that look like numbers are cast.
    fits = {
        "bigint": lambda c: F.when(c.rlike(r"^\s*[+-]?\d+\s*$"), c.try_cast("bigint").isNotNull()),
        "double": lambda c: F.when(c.rlike(_NUMBER), c.try_cast("double").isNotNull()),
        "boolean": lambda c: c.isin("True", "False", "TRUE", "FALSE", "true", "false"),
    }
    aggs = []
    for i, name in enumerate(raw.columns):
        c = tokens_to_null(F.col(f"`{name}`"), null_tokens)
        aggs.append(F.count(c).alias(f"{i}.present"))
        aggs += [F.count_if(fit(c)).alias(f"{i}.{kind}") for kind, fit in fits.items()]
    row = raw.agg(*aggs).first()
    kinds = {}
    for i, name in enumerate(raw.columns):
        present = row[f"{i}.present"]
        # An all-missing column is numeric, as a column of NaN is.
        kinds[name] = next((k for k in fits if present and row[f"{i}.{k}"] == present), "string" if present else "double")
    return kinds


def _typed(raw: DataFrame, kinds: dict[str, str], null_tokens: tuple[str, ...], strict: bool) -> DataFrame:
    def cell(name: str, kind: str):
        c = tokens_to_null(F.col(f"`{name}`"), null_tokens)
        if kind == "string":
            return c.alias(name)
        return (c.cast(kind) if strict else c.try_cast(kind)).alias(name)

    return raw.select(*[cell(name, kind) for name, kind in kinds.items()])


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One CSV part file per task, each with a header; missing values are empty fields."""
    writer = df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: tuple[str, ...] = ()) -> None:
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def sample_csv(spark: SparkSession, source: str, target: str, id: str, n: int = 1000, seed: int | str = 42) -> None:
    """Write an exact-size reproducible sample of a CSV table as CSV."""
    write_csv(sample_n(read_csv(spark, source), id, n, seed), target)


def write_checked(
    df: DataFrame, path: str, rules: Mapping[str, Column] | None = None, mode: str = "errorifexists", partition_by: tuple[str, ...] = ()
) -> DataFrame:
    """Write ``df`` as parquet and report on the rows written: (check, item, found), without a scan of their own.

    ``found`` is the number of rows, of columns, of present values of each column (``non_null``) and of rows that break each rule
    (``violations``; a rule that is NULL for a row is not broken). The counts are observed in the tasks that write, where a task that is run
    again counts once, and only their sums reach the driver. An empty table reports zeros.
    """
    rules = rules or {}
    counts = [F.count(F.lit(1)).alias("rows")]
    counts += [F.count(df[f"`{c}`"]).alias(f"non_null {i}") for i, c in enumerate(df.columns)]
    counts += [F.count_if(F.coalesce(rule, F.lit(False))).alias(f"violations {i}") for i, rule in enumerate(rules.values())]
    seen = Observation()
    write_parquet(df.observe(seen, *counts), path, mode, partition_by)
    found = seen.get
    report = [("shape", "rows", found["rows"]), ("shape", "columns", len(df.columns))]
    report += [("non_null", c, found[f"non_null {i}"]) for i, c in enumerate(df.columns)]
    report += [("violations", name, found[f"violations {i}"]) for i, name in enumerate(rules)]
    return small_table(df.sparkSession, report, "check string, item string, found bigint")
