"""Missing values: what counts as missing in files and labels, flags, and filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Tokens a CSV reader turns into a missing value (case-sensitive, whole field).
CSV_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Labels that mean "missing" once a category has been normalised.
PLACEHOLDERS = ("", "-", "--", ".", "?", "n/a", "na", "nan", "none", "null", "unknonwn", "unknown")


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every floating-point column, so one missing marker is left."""
    return df.withColumns({
        f.name: F.when(~F.isnan(F.col(f.name)), F.col(f.name))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.FloatType, T.DoubleType))
    })


def tokens_to_null(c: Column, tokens: tuple[str, ...] = CSV_NULL_TOKENS) -> Column:
    return F.when(~c.isin(*tokens), c)


def is_present(c: Column) -> Column:
    return c.isNotNull().cast("int")


def is_missing(c: Column) -> Column:
    return c.isNull().cast("int")


def member_of(c: Column, values) -> Column:
    """Membership test that is false, not NULL, for a missing value."""
    return F.coalesce(c.isin(list(values)), F.lit(False))


def fill(c: Column, value) -> Column:
    return F.coalesce(c, F.lit(value))
