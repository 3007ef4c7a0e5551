"""Numbers: clipping, masking, bins, match flags and ANSI-safe ratios."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip(c: Column, lo: float | None = None, hi: float | None = None) -> Column:
    """Limit to [lo, hi]. NULL stays NULL (``greatest``/``least`` would turn it into a bound)."""
    out = c
    if hi is not None:
        out = F.when(c > F.lit(hi), F.lit(hi)).otherwise(out)
    if lo is not None:
        out = F.when(c < F.lit(lo), F.lit(lo)).otherwise(out)
    return out


def null_above(c: Column, cap: float | None) -> Column:
    """Values above ``cap`` become NULL; with no cap nothing is known, so all are NULL."""
    return F.when(c <= F.lit(cap).cast("double"), c)


def matches(a: Column, b: Column) -> Column:
    """1 where both sides hold the same value, else 0 (a missing side never matches)."""
    return F.coalesce(a == b, F.lit(False)).cast("int")


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def edge_bin(c: Column, edges: Sequence[float]) -> Column:
    """1-based right-closed bin between ascending distinct ``edges``; the lowest edge is included.

    NULL where there is no value or fewer than two edges.
    """
    if len(edges) < 2:
        return F.lit(None).cast("int")
    above = F.lit(1)
    for edge in edges[1:-1]:
        above = above + (c > F.lit(edge)).cast("int")
    return F.when(c.isNotNull(), above)


def equal_width_bin(c: Column, lo: Column, hi: Column, bins: int) -> Column:
    """0-based equal-width bin over [lo, hi]; the top edge belongs to the last bin."""
    slot = F.floor((c - lo) / F.nullif(hi - lo, F.lit(0.0)) * bins)
    return F.when(c.isNotNull() & (hi == lo), F.lit(bins // 2)).otherwise(F.least(slot, F.lit(bins - 1))).cast("int")
