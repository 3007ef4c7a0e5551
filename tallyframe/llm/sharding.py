"""Sharding by sampled splitters: equal bytes in every shard, built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows that the splitter sample has on average, and how often a range may exceed its share before it is subdivided.
SAMPLE, OVERFULL = 20_000, 2.0
#: Ranges at most, and parts that an overfull range is cut into at most: both lists of splitters reach the driver, whatever the rows.
MOST_RANGES, MOST_PARTS = 4_096, 64


def spread_key(group: Column, row: Column) -> Column:
    """A long that orders rows by a hash of ``group`` (upper 40 bits), inside it by a hash of ``row``.

    Equal groups stand side by side, and a group of any size can be cut into parts.
    """
    return F.shiftright(F.xxhash64(group), 24) * F.lit(1 << 24) + F.shiftrightunsigned(F.xxhash64(row), 40)


def range_of(key: Column, splitters: list[int]) -> Column:
    """Number of splitters that are not above the key, by binary search."""
    if not splitters:
        return F.lit(0)
    steps = 1 << (len(splitters).bit_length() - 1)
    known = F.lit(splitters)

    def move(found: Column, step: Column) -> Column:
        ahead = F.get(known, found + step - 1)
        return F.when(ahead <= key, found + step).otherwise(found)

    return F.aggregate(F.lit([steps >> i for i in range(steps.bit_length())]), F.lit(0), move)


def _quantiles(rows: DataFrame, parts: int) -> list[int]:
    """Up to ``parts - 1`` keys that cut the sampled rows into parts of equal count. One row reaches the driver."""
    at = [i / parts for i in range(1, parts)]
    found = rows.agg(F.percentile_approx("key", at, 10 * parts)).first()[0] or []
    return sorted(set(found))


def _sampled(sized: DataFrame, total: int, wanted: int) -> DataFrame:
    """Draw rows with a probability in proportion to their size, by a hash of the key: the same rows on every run."""
    chance = F.least(F.lit(1.0), F.col("size") * F.lit(wanted / max(total, 1)))
    uniform = F.pmod(F.xxhash64("key", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return sized.where(uniform < chance)


def splitters(sized: DataFrame, total: int, ranges: int) -> list[int]:
    """Keys that cut rows (key, size) into ranges of about equal bytes.

    Quantiles of a size-weighted sample of about ``SAMPLE`` rows (or 20 for each range), and for each range that
    then holds more than ``OVERFULL`` times its share, quantiles of a sample inside it. All overfull ranges are cut in one pass, into
    as many parts as the fullest needs, ``MOST_PARTS`` at most.
    """
    first = _quantiles(_sampled(sized, total, max(SAMPLE, 20 * ranges)), ranges)
    share = total / ranges
    part = range_of(F.col("key"), first).alias("part")
    loads = sized.groupBy(part).agg(F.sum("size").alias("bytes"))
    overfull = loads.where(F.col("bytes") > OVERFULL * share).collect()  # at most ranges / OVERFULL rows
    if not overfull:
        return first
    parts = min(MOST_PARTS, int(max(r["bytes"] for r in overfull) / share) + 1)
    # A share has 1,000 sampled rows or more.
    inside = _sampled(sized, total, 1000 * ranges).withColumn("part", part).where(F.col("part").isin([r["part"] for r in overfull]))
    found = inside.groupBy("part").agg(F.percentile_approx("key", [i / parts for i in range(1, parts)], 10 * parts).alias("cuts")).collect()
    return sorted({*first, *(c for r in found for c in r["cuts"] or [])})


def shard(df: DataFrame, shards: int, size: Column, group: Column, row: Column, rows_in_range: int = 50_000) -> DataFrame:
    """Add ``shard int`` (0 to ``shards`` - 1) and ``slot long`` (from 0 in each shard, without gaps).

    Law: a row goes to the shard in which its middle falls when all rows stand in order of
    :func:`spread_key` and every shard has the same number of bytes; so the bytes of a shard are off by less than one of the
    largest rows. The order is global, but nothing is sorted globally: splitters from a size-weighted
    sample cut the keys into ranges of a bounded number of rows, each range is numbered by itself, and the bytes and
    rows of the ranges before it are added. Equal keys (repeated rows) are ordered by size and may take any order among
    full equals. A null size or a negative one counts as 0; a null group or row is a value like any other. Texts take no part but
    through the given columns, so their length does not matter. ``df`` must give the same rows each time it is read. No rows give no rows.
    Columns named ``shard`` or ``slot`` are replaced; a column named ``key`` or ``size`` is kept. Beyond ``MOST_RANGES`` ranges these grow
    instead: each is one sort that may spill.
    """
    kept = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    row_of = F.struct(*[df[c] for c in kept]).alias("row")
    keyed = df.select(row_of, spread_key(group, row).alias("key"), F.greatest(size.cast("long"), F.lit(0)).alias("size"))
    sized = keyed.select("key", "size")
    total, count = sized.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    ranges = max(shards, min(MOST_RANGES, -(-count // rows_in_range)))
    cuts = splitters(sized, total, ranges)
    parted = keyed.withColumn("part", range_of(F.col("key"), cuts))
    loads = parted.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    # One row for each range: a table of a few thousand rows for billions of input rows.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = loads.select(
        "part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before")
    )
    inside = Window.partitionBy("part").orderBy("key", "size")
    placed = (
        parted.withColumn("n", F.row_number().over(inside))
        .withColumn("b", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
        .join(offsets, "part")
        .select(
            "row",
            (F.col("n") - 1 + F.col("rows_before")).alias("at"),
            F.expr(f"cast(least({shards - 1}, (2 * (b + bytes_before) + size) * {shards} div {max(2 * total, 1)}) as int)").alias("shard"),
        )
    )
    starts = placed.groupBy("shard").agg(F.min("at").alias("start"))  # one row for each shard
    return placed.join(F.broadcast(starts), "shard").select("row.*", "shard", (F.col("at") - F.col("start")).alias("slot"))
