"""Exact order statistics and quantiles without sorting the table or gathering it anywhere.

Spark's exact ``percentile`` keeps a value-to-count map of the whole column in one task, which
fails once a column has billions of distinct values. Here the search runs as a few aggregations:

1. one pass takes count, minimum and maximum of every column;
2. while the interval that holds a wanted rank has more than ``finish_rows`` rows, one pass sketches the values a little
   below and above each wanted rank, and one pass counts the rows between these values and at each of them. The part with
   the rank then holds about 4 rows in ``accuracy``, whatever the values are: the search narrows by rank, not by
   value, so that 10^9 rows take one such round and 10^13 rows two;
3. a last pass counts rows per distinct value inside the remaining small intervals.

Repeated values never hurt: they are counted, not listed, and an interval of one value is done.
All columns and ranks share each pass. Only interval bounds come back to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.session import stage
from tallyframe.spec import INTEGRAL

ACCURACY = 10_000
FINISH_ROWS = 1_000_000


@dataclass(frozen=True)
class Span:
    """Number of non-missing values and their extremes."""

    rows: int
    lo: float | int | None
    hi: float | int | None


@dataclass(frozen=True)
class Ranked:
    """The value at a rank, with how many rows are smaller and how many are equal."""

    value: float | int
    below: int
    rows: int


@dataclass(frozen=True)
class _Interval:
    key: str
    lo: float | int
    hi: float | int
    below: int
    rows: int
    ranks: tuple[int, ...]
    stuck: bool = False


def comparable(df: DataFrame, keys: Mapping[str, Column]) -> dict[str, Column]:
    """Keys as one common type: bigint when all are whole numbers, else double with NaN as NULL."""
    types = {f.name: f.dataType for f in df.select(*[c.alias(k) for k, c in keys.items()]).schema.fields}
    if all(isinstance(t, INTEGRAL) for t in types.values()):
        return {k: c.cast("bigint") for k, c in keys.items()}
    out = {}
    for k, c in keys.items():
        number = c.cast("double")
        out[k] = F.when(~F.isnan(number), number) if isinstance(types[k], (T.FloatType, T.DoubleType)) else number
    return out


def spans(df: DataFrame, keys: Mapping[str, Column]) -> dict[str, Span]:
    """Count, minimum and maximum of every key in one aggregation."""
    keys = comparable(df, keys)
    aggs = []
    for i, c in enumerate(keys.values()):
        aggs += [F.count(c).alias(f"n{i}"), F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
    row = df.agg(*aggs).first()
    return {k: Span(row[f"n{i}"], row[f"lo{i}"], row[f"hi{i}"]) for i, k in enumerate(keys)}


def order_statistics(
    df: DataFrame,
    keys: Mapping[str, Column],
    ranks: Mapping[str, Sequence[int]],
    known: Mapping[str, Span] | None = None,
    accuracy: int = ACCURACY,
    finish_rows: int = FINISH_ROWS,
    bounds: Mapping[str, Sequence[float]] | None = None,
) -> dict[tuple[str, int], Ranked]:
    """Exact values at 0-based ``ranks`` of each key, missing values left out.

    ``bounds`` holds values known to lie near the ranks (of a stored sketch), which save the first pass of the search.
    """
    known = known or spans(df, keys)
    keys = comparable(df, keys)
    todo = [
        _Interval(k, known[k].lo, known[k].hi, 0, known[k].rows, tuple(sorted(set(rs))))
        for k, rs in ranks.items()
        if known[k].rows and rs
    ]
    found: dict[tuple[str, int], Ranked] = {}
    while todo:
        for part in (p for p in todo if p.lo == p.hi):
            found.update({(part.key, r): Ranked(part.lo, part.below, part.rows) for r in part.ranks})
        todo = [p for p in todo if p.lo != p.hi]
        wide = [p for p in todo if p.rows > finish_rows and not p.stuck]
        if not wide:
            break
        todo = [p for p in todo if p not in wide] + _narrow(df, keys, wide, accuracy, bounds)
        bounds = None
    for part in _single_values(df, keys, todo) if todo else []:
        found.update({(part.key, r): Ranked(part.lo, part.below, part.rows) for r in part.ranks})
    return found


def _edges(df: DataFrame, keys: Mapping[str, Column], parts: list[_Interval], accuracy: int) -> list[list[float | int]]:
    """For each interval, values about ``2 / accuracy`` of its rows below and above each wanted rank; one pass."""
    aggs = []
    for i, part in enumerate(parts):
        x = keys[part.key]
        # Distances from the lower end keep every digit of whole numbers, once the interval is narrow enough.
        seen = (x - F.lit(part.lo)).cast("double") if _exact_offset(part) else x.cast("double")
        at = {min(max((r - part.below) / part.rows + side / accuracy, 0.0), 1.0) for r in part.ranks for side in (-2, 2)}
        inside = F.when(x.between(F.lit(part.lo), F.lit(part.hi)), seen)
        aggs.append(F.percentile_approx(inside, sorted(at), accuracy).alias(f"e{i}"))
    row = df.agg(*aggs).first()
    out = []
    for i, part in enumerate(parts):
        found = row[f"e{i}"] or []
        if isinstance(part.lo, int):
            found = [int(v) + (part.lo if _exact_offset(part) else 0) for v in found]
        out.append(sorted({min(max(v, part.lo), part.hi) for v in found}))
    return out


def _exact_offset(part: _Interval) -> bool:
    return isinstance(part.lo, int) and part.hi - part.lo < 2**62


def _slot(x: Column, edges: Sequence[float | int]) -> Column:
    """Twice the number of edges below x, plus one if x is an edge: every edge has a slot of its own."""
    slot = F.lit(2 * len(edges))
    for i, edge in reversed(list(enumerate(edges))):
        slot = F.when(x < F.lit(edge), 2 * i).when(x == F.lit(edge), 2 * i + 1).otherwise(slot)
    return slot.cast("bigint")


def _tagged(df: DataFrame, keys: Mapping[str, Column], parts: list[_Interval], code) -> DataFrame:
    """(code, value) for every key whose value lies in one of its intervals (they are disjoint)."""
    cells = []
    for k, x in keys.items():
        tag = None
        for i, part in enumerate(parts):
            if part.key == k:
                inside = x.between(F.lit(part.lo), F.lit(part.hi))
                tag = F.when(inside, code(i, part, x)) if tag is None else tag.when(inside, code(i, part, x))
        if tag is not None:
            cells += [tag, x]
    return df.select(F.stack(F.lit(len(cells) // 2), *cells).alias("code", "value")).where("code is not null")


def _with_rank(counted: DataFrame, parts: list[_Interval], order: str) -> list[Row]:
    """Rows of ``counted`` that hold a wanted rank, with the rows before them in their interval."""
    wanted = F.create_map(*[
        piece
        for i, part in enumerate(parts)
        for piece in (F.lit(i).cast("bigint"), F.array(*[F.lit(r - part.below).cast("bigint") for r in part.ranks]))
    ])
    upto = F.sum("n").over(W.partitionBy("part").orderBy(order).rowsBetween(W.unboundedPreceding, 0))
    ranked = counted.withColumn("before", upto - F.col("n"))
    holds = F.exists(wanted[F.col("part")], lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("n")))
    return ranked.where(holds).collect()


def _next(parts: list[_Interval], rows: list[Row]) -> list[_Interval]:
    out = []
    for row in rows:
        old = parts[row["part"]]
        below = old.below + row["before"]
        ranks = tuple(r for r in old.ranks if below <= r < below + row["n"])
        same = (row["lo"], row["hi"]) == (old.lo, old.hi)
        out.append(_Interval(old.key, row["lo"], row["hi"], below, row["n"], ranks, stuck=same))
    return out


def _narrow(
    df: DataFrame,
    keys: Mapping[str, Column],
    parts: list[_Interval],
    accuracy: int,
    bounds: Mapping[str, Sequence[float]] | None = None,
) -> list[_Interval]:
    if bounds is None:
        edges = _edges(df, keys, parts, accuracy)
    else:
        edges = [sorted({min(max(v, p.lo), p.hi) for v in bounds[p.key]}) for p in parts]
    slots = 2 * max(map(len, edges)) + 1

    def code(i: int, part: _Interval, x: Column) -> Column:
        return F.lit(i * slots).cast("bigint") + _slot(x, edges[i])

    counted = (
        _tagged(df, keys, parts, code)
        .groupBy("code")
        .agg(F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
        .withColumn("part", F.floor(F.col("code") / slots).cast("bigint"))
    )
    return _next(parts, _with_rank(counted, parts, "code"))


def _single_values(df: DataFrame, keys: Mapping[str, Column], parts: list[_Interval]) -> list[_Interval]:
    counted = (
        _tagged(df, keys, parts, lambda i, part, x: F.lit(i).cast("bigint"))
        .groupBy(F.col("code").alias("part"), "value")
        .agg(F.count("*").alias("n"))
        .withColumns({"lo": F.col("value"), "hi": F.col("value")})
    )
    return _next(parts, _with_rank(counted, parts, "value"))


def numbered(df: DataFrame, keys: Sequence[str], name: str, label: str, range_rows: int = 1_000_000) -> DataFrame:
    """Add ``name``: the place from 0 of each row in the order of ``keys``, which should be unique.

    Rows are dealt by range, sorted there and written with their place in the range; the rows of the lower ranges are added. One row for each
    range is broadcast.
    """
    parts = df.count() // range_rows + 1
    dealt = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    # The number holds the range in its upper bits and the place in it in the lower 33; it is fixed once written.
    dealt = stage(dealt.withColumn(name, F.monotonically_increasing_id()), label)
    cell = F.shiftright(name, 33).alias("__range")
    held = dealt.groupBy(cell).agg(F.count("*").alias("__n"))
    upto = F.sum("__n").over(W.partitionBy(F.lit(0)).orderBy("__range").rowsBetween(W.unboundedPreceding, 0))
    lower = held.select("__range", (upto - F.col("__n")).alias("__lower"))
    placed = dealt.withColumn("__range", cell).join(F.broadcast(lower), "__range")
    return placed.withColumn(name, F.col(name).bitwiseAND((1 << 33) - 1) + F.col("__lower")).select(*df.columns, name)


def quantiles(
    df: DataFrame,
    keys: Mapping[str, Column],
    probs: Sequence[float],
    exact: bool = True,
    known: Mapping[str, Span] | None = None,
    **tuning: int,
) -> dict[str, list[float | None]]:
    """Quantiles of each key at ``probs`` with linear interpolation between neighbours.

    ``exact=False`` takes one pass with Spark's bounded-error sketch instead.
    """
    if not keys:
        return {}
    if not exact:
        typed = comparable(df, keys)
        row = df.agg(*[
            F.percentile_approx(c.cast("double"), list(map(float, probs)), 10_000).alias(f"q{i}")
            for i, c in enumerate(typed.values())
        ]).first()
        return {k: list(row[f"q{i}"] or [None] * len(probs)) for i, k in enumerate(typed)}
    known = known or spans(df, keys)
    places = {k: [(known[k].rows - 1) * p for p in probs] if known[k].rows else [] for k in keys}
    ranks = {k: [r for at in ats for r in (math.floor(at), math.ceil(at))] for k, ats in places.items()}
    values = order_statistics(df, keys, ranks, known=known, **tuning)
    out: dict[str, list[float | None]] = {}
    for k, ats in places.items():
        out[k] = [None] * len(probs)
        for i, at in enumerate(ats):
            left, right = (float(values[k, r].value) for r in (math.floor(at), math.ceil(at)))
            out[k][i] = left if left == right else left + (right - left) * (at - math.floor(at))
    return out
