"""Reproducible exact-size splits and samples as row-wise conditions.

A split ranks rows by a hash of their id (or by date) and takes the first k. Ranking itself
would sort each class in one task, so only the k-th row is looked up; the split is then the
plain comparison "not after the k-th row", which needs no shuffle of the table and gives the
same rows however often, and on however many machines, it is evaluated. Ids must be unique: a repeated id that
would change the size of a split raises an error.

scikit-learn's and pandas' random streams cannot be reproduced; sizes and proportions are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyframe.operators.order import order_statistics, spans
from tallyframe.session import rows_up_to, small_table, stage

# Digest digits per narrowing step: 16**3 = 4,096 groups per class, so map-side counts stay small.
_STEP = 3
_STEPS = 3
# A class is ranked directly once the group with its k-th row has at most this many rows.
_RANK_ROWS = 100_000
_CLASS_LIMIT = 100_000
_LAST = 2**63 - 1


def shuffle_key(id: Column, seed: int | str) -> Column:
    """A fixed pseudo-random order of ids: hexadecimal digest of the id followed by the seed."""
    return F.md5(F.concat(id.cast("string"), F.lit(str(seed))))


def _first_k(df: DataFrame, by: Column, id: str, seed: int | str, sizes: DataFrame) -> DataFrame:
    """Per class the (digest, id) of its k-th row: (class, last). ``sizes`` is (at_class, rest), rest >= 1.

    Each step counts rows per (class, digest prefix) and keeps the prefix that holds the rank;
    after at most three steps one part in 4,096**3 of a class is left to rank. Only counts
    shuffle. Digests are uniform, so a hot value or a sorted table makes no difference.
    """
    keyed = df.select(by.alias("class"), shuffle_key(F.col(id), seed).alias("digest"), F.col(id).alias("id"))
    holder, small, digits = sizes, False, 0
    for step in range(1, _STEPS + 1):
        pool, digits = _at(keyed, holder, digits), step * _STEP
        slots = pool.groupBy("class", F.substring("digest", 1, digits).alias("prefix")).agg(F.count("*").alias("n"))
        upto = F.sum("n").over(W.partitionBy("class").orderBy("prefix").rowsBetween(W.unboundedPreceding, 0))
        wanted = F.broadcast(holder) if small else holder
        holder = (
            slots.withColumn("before", upto - F.col("n"))
            .join(wanted.select("at_class", "rest"), F.col("class").eqNullSafe(F.col("at_class")))
            .where((F.col("before") < F.col("rest")) & (F.col("rest") <= F.col("before") + F.col("n")))
            .select("at_class", (F.col("rest") - F.col("before")).alias("rest"), F.col("prefix").alias("at"), "n")
        )
        holder, small = _frozen(holder)
        if small and all(r["n"] <= _RANK_ROWS for r in holder.collect()):
            break
    place = F.row_number().over(W.partitionBy("class").orderBy("digest", "id"))
    near = _at(keyed, F.broadcast(holder) if small else holder, digits, "rest")
    alike = W.partitionBy("class", "digest", "id")
    repeated = F.when(F.row_number().over(alike.orderBy("digest")) < F.count("*").over(alike), F.raise_error("ids are not unique: a repeated id lies at the border of the split"))
    return (
        near.withColumn("place", place)
        .withColumn("repeated", F.when(F.col("place") == F.col("rest"), repeated))
        .where((F.col("place") == F.col("rest")) & F.col("repeated").isNull())
        .select("class", F.struct("digest", "id").alias("last"))
    )


def _at(keyed: DataFrame, holder: DataFrame, digits: int, *keep: str) -> DataFrame:
    """Rows whose digest starts with their class's found prefix (all rows before the first step)."""
    if digits == 0:
        return keyed
    here = F.col("class").eqNullSafe(F.col("at_class")) & (F.substring("digest", 1, digits) == F.col("at"))
    return keyed.join(holder.select("at_class", "at", *keep), here).select(*keyed.columns, *keep)


def _frozen(df: DataFrame) -> tuple[DataFrame, bool]:
    """Fitted class table as literal rows if it is proven small, else written, so that no later step works it out again."""
    df = stage(df, "split-classes")
    rows = rows_up_to(df, _CLASS_LIMIT)
    if rows is None:
        return df, False
    return small_table(df.sparkSession, [tuple(r) for r in rows], df.schema), True


def mark_stratified(
    df: DataFrame, id: str, target: str, share: float = 0.2, seed: int | str = 42, flag: str = "is_valid"
) -> DataFrame:
    """Add a boolean ``flag`` that is true for ceil(share * n) rows of every target class.

    Per-class rounding up may exceed ceil(share * n) of the whole table by less than one row
    per class.
    """
    size = F.ceil(F.count("*") * F.lit(share)).cast("bigint")
    sizes = df.groupBy(F.col(target).alias("at_class")).agg(size.alias("rest")).where("rest > 0")
    limits, small = _frozen(_first_k(df, F.col(target), id, seed, sizes))
    limits = limits.select(F.col("class").alias("_class"), F.col("last").alias("_last"))
    limits = F.broadcast(limits) if small else limits
    row = F.struct(shuffle_key(F.col(id), seed).alias("digest"), F.col(id).alias("id"))
    return (
        df.join(limits, F.col(target).eqNullSafe(F.col("_class")), "left")
        .withColumn(flag, F.coalesce(row <= F.col("_last"), F.lit(False)))
        .drop("_class", "_last")
    )


def _halves(marked: DataFrame, flag: str) -> tuple[DataFrame, DataFrame]:
    return marked.where(~F.col(flag)).drop(flag), marked.where(F.col(flag)).drop(flag)


def stratified_split(
    df: DataFrame, id: str, target: str, share: float = 0.2, seed: int | str = 42
) -> tuple[DataFrame, DataFrame]:
    """(train, valid) with the class mix of the whole table."""
    return _halves(mark_stratified(df, id, target, share, seed, "_valid"), "_valid")


def sample_n(df: DataFrame, id: str, n: int = 1000, seed: int | str = 42) -> DataFrame:
    """Exactly ``n`` reproducible rows (all rows if there are fewer); the table never shuffles."""
    if n <= 0:
        return df.where(F.lit(False))
    # One class, "the id is not missing": rows without an id cannot be sampled.
    sizes = df.agg(F.count(id).alias("rows")).select(
        F.lit(False).alias("at_class"), F.least(F.col("rows"), F.lit(n)).cast("bigint").alias("rest")
    ).where("rest > 0")
    found = _first_k(df, F.col(id).isNull(), id, seed, sizes).first()
    if found is None:
        return df.where(F.lit(False))
    digest, last_id = found["last"]
    key = shuffle_key(F.col(id), seed)
    return df.where((key < digest) | ((key == digest) & (F.col(id) <= F.lit(last_id))))


def mark_chronological(df: DataFrame, date: str, id: str, share: float = 0.2, flag: str = "is_valid") -> DataFrame:
    """True for the latest rows: the first int(n * (1 - share)) rows by date stay false.

    Missing dates sort last. Rows of the boundary date are ordered by id (numeric), or by the
    digest of the id when it is text.
    """
    if dict(df.dtypes)[date] not in ("date", "timestamp", "timestamp_ntz"):
        raise TypeError(f"{date} must be a parsed date")
    when = F.coalesce(F.unix_micros(F.col(date).cast("timestamp")), F.lit(_LAST))
    numeric_id = dict(df.dtypes)[id] in ("tinyint", "smallint", "int", "bigint")
    tie = F.col(id).cast("bigint") if numeric_id else F.conv(F.substring(F.md5(F.col(id)), 1, 15), 16, 10).cast("bigint")
    tie = F.coalesce(tie, F.lit(_LAST))  # a missing id comes last, so that every row is in one half
    known = spans(df, {"when": when})
    k = int(known["when"].rows * (1 - share))
    if k <= 0 or known["when"].rows == 0:
        return df.withColumn(flag, F.lit(True))
    edge = order_statistics(df, {"when": when}, {"when": [k - 1]}, known=known)["when", k - 1]
    rest = k - edge.below
    late = when > F.lit(edge.value)
    if rest < edge.rows:
        ties = df.where(when == F.lit(edge.value))
        last = order_statistics(ties, {"tie": tie}, {"tie": [rest - 1]})["tie", rest - 1].value
        late = late | ((when == F.lit(edge.value)) & (tie > F.lit(last)))
    return df.withColumn(flag, late)


def chronological_split(df: DataFrame, date: str, id: str, share: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """(earlier, later) rows."""
    return _halves(mark_chronological(df, date, id, share, "_valid"), "_valid")


SPLITS = {
    "random": lambda df, id, target, date, share, seed: stratified_split(df, id, target, share, seed),
    "chronological": lambda df, id, target, date, share, seed: chronological_split(df, date, id, share),
}


def make_split(
    df: DataFrame, kind: str, id: str, target: str, date: str | None = None, share: float = 0.2, seed: int | str = 42
) -> tuple[DataFrame, DataFrame]:
    """Two halves by one of ``SPLITS``: by class shares, or by date (which then must be given)."""
    if kind not in SPLITS or (kind == "chronological" and not date):
        raise ValueError(f"unknown split kind, or no date column for it: {kind!r}; kinds are {sorted(SPLITS)}")
    return SPLITS[kind](df, id, target, date, share, seed)
