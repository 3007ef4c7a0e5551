"""Outliers: quantile caps, fixed bounds and suspicious columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.numeric import clip, null_above
from tallyframe.operators.order import comparable, quantiles
from tallyframe.operators.profile import _f, _known, column_stats
from tallyframe.operators.tables import one_pass
from tallyframe.session import small_table


def quantile_caps(df: DataFrame, columns: Sequence[str], q: float = 0.999, exact: bool = True) -> dict[str, float]:
    found = quantiles(df, {c: F.col(c) for c in columns}, [q], exact=exact)
    return {c: found[c][0] for c in columns}


def cap_to_null(df: DataFrame, caps: Mapping[str, float | None]) -> DataFrame:
    """Values above their cap become NULL."""
    return df.withColumns({c: null_above(F.col(c), cap) for c, cap in caps.items()})


def cap_report(df: DataFrame, caps: Mapping[str, float | None]) -> DataFrame:
    """(column, cap, values_set_missing) in one pass; NaN is missing, not above a cap."""
    numbers = comparable(df, {c: F.col(c) for c in caps})
    return one_pass(df, [
        {
            "column": F.lit(c),
            "cap": F.lit(cap).cast("double"),
            "values_set_missing": F.count_if(numbers[c] > F.lit(cap).cast("double")),
        }
        for c, cap in caps.items()
    ])


def capped_copy(
    df: DataFrame, columns: Sequence[str], q: float = 0.999, exact: bool = True
) -> tuple[DataFrame, DataFrame]:
    """The table with each column capped at its own quantile, and the report of what was removed."""
    caps = quantile_caps(df, columns, q, exact)
    return cap_to_null(df, caps), cap_report(df, caps)


def clip_fixed(df: DataFrame, bounds: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    """Clip columns to fixed (lo, hi) bounds; columns the table lacks are skipped."""
    kinds = dict(df.dtypes)
    return df.withColumns({
        c: clip(F.col(c), lo, hi).cast(kinds[c] if _whole(lo, hi) else "double")
        for c, (lo, hi) in bounds.items()
        if c in kinds
    })


def _whole(*bounds: float | None) -> bool:
    return all(b is None or float(b).is_integer() for b in bounds)


def sus_columns(df: DataFrame, columns: Sequence[str], max_mult: float = 10, exact: bool = True) -> DataFrame:
    """Columns with negatives or a maximum far beyond the bulk: (column, min, max, q99, why).

    "Far" is more than ``max_mult`` times the largest of the 99 % quantile, the IQR and 1.
    """
    stats = column_stats(df, columns)
    found = quantiles(df, {c: F.col(c) for c in columns}, (0.25, 0.75, 0.99), exact=exact, known=_known(stats))
    table = small_table(
        df.sparkSession,
        [
            (i, c, _f(x["min"]), _f(x["max"]), *found[c], f"max={x['max']:g} vs q99={found[c][2]:g}" if x["max"] is not None else None)
            for i, (c, x) in enumerate(stats.items())
        ],
        "place int, column string, min double, max double, q25 double, q75 double, q99 double, far string",
    )
    far = F.col("max") > F.greatest(F.col("q99"), F.col("q75") - F.col("q25"), F.lit(1.0)) * max_mult
    why = F.concat_ws(", ", F.when(F.col("min") < 0, "negative"), F.when(far, F.col("far")))
    report = table.where("q99 is not null").withColumn("why", why).where("why <> ''").orderBy("place")
    return report.select("column", "min", "max", "q99", "why")
