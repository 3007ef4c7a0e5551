"""Turning a prepared table into model features: standard scaling and one-hot encoding.

Categories are a written table (column, value, slot) of any size. Rows meet it by a join in which the most frequent values are
broadcast and all others shuffled, and their sparse vectors are put together from the slots they found: nothing about a single
category comes to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.ml.feature import StandardScaler, StandardScalerModel
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tallyframe.functions.text import ONEHOT_PREFIX, ONEHOT_SEPARATOR
from tallyframe.operators.counts import as_label, value_totals
from tallyframe.operators.order import numbered
from tallyframe.operators.profile import comparable_each
from tallyframe.session import small_table, stage

FEATURES = "features"
SCALED = "scaled_features"
#: Parts of the encoded rows, for models that do not read vectors: slots of the categories, numbers, and a key of the row.
SLOTS, NUMBERS, KEY = "feature_slots", "feature_numbers", "feature_key"
#: Most frequent categories that are broadcast. Any other is in fewer than one of so many rows, so that its join key is no hot one.
HOT = 1_000
#: Columns that are met one by one by broadcast joins, if all categories together are no more than ``HOT``.
JOINED = 50


def scale_standard(df: DataFrame, columns: Sequence[str], reference: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population std per column, fitted on ``reference`` (default: the table itself).

    A constant column is only centred, as its spread would divide by zero.
    """
    base = reference if reference is not None else df
    keys = comparable_each(base, columns)
    aggs = [a for i, c in enumerate(columns) for a in (F.avg(keys[c]).alias(f"m{i}"), F.stddev_pop(keys[c]).alias(f"s{i}"))]
    fit = base.agg(*aggs).first()
    return df.withColumns({
        c: (F.col(c) - F.lit(fit[f"m{i}"])) / F.lit(fit[f"s{i}"] or 1.0) for i, c in enumerate(columns)
    })


def lookup(flat: DataFrame, known: DataFrame, on: Sequence[str], value: str, row: str) -> DataFrame:
    """Left join of ``flat`` to the written table ``known`` (``on``, n, ``value``), whose keys are unique: adds ``value``, null where there is none.

    The most frequent keys are broadcast, a fixed number of them. Rows that met one of these go through the shuffle under their own
    ``row`` instead of the key, so they are spread however hot the key is.
    """
    most = known.orderBy(F.desc("n"), *on).limit(HOT).select(*on, F.col(value).alias("__hot"))
    met = flat.join(F.broadcast(most), list(on), "left")
    keys = [F.when(F.col("__hot").isNull(), F.col(c)).alias(f"__{c}") for c in on[:-1]]
    keys.append(F.when(F.col("__hot").isNull(), F.col(on[-1])).otherwise(F.col(row).cast("string")).alias(f"__{on[-1]}"))
    others = known.select(*[F.col(c).alias(f"__{c}") for c in on], F.col(value).alias("__found"))
    joined = met.select("*", *keys).join(others, [f"__{c}" for c in on], "left")
    return joined.withColumn(value, F.coalesce("__hot", "__found")).drop("__hot", "__found", *[f"__{c}" for c in on])


def onehot_long(df: DataFrame, id: str, columns: Sequence[str], reference: DataFrame) -> DataFrame:
    """One-hot features as (id, feature, value) rows holding only the ones.

    Categories come from ``reference``; a value unseen there gives no row, that is, all zeros.
    """
    flat = df.select(F.col(id), *[as_label(df, c).alias(c) for c in columns]).unpivot(
        id, list(columns), "column", "level"
    )
    known = value_totals(reference, columns).where("value is not null").withColumnRenamed("value", "level")
    known = stage(known.withColumn("is_known", F.lit(1)), "onehot-categories")
    name = F.concat_ws(ONEHOT_SEPARATOR, F.lit(ONEHOT_PREFIX), "column", "level")
    ones = lookup(flat, known, ["column", "level"], "is_known", id).where("is_known is not null")
    return ones.select(id, name.alias("feature"), F.lit(1.0).alias("value"))


def encoded_width(df: DataFrame, cats: Sequence[str], nums: Sequence[str]) -> int:
    """Number of encoded columns: numerics plus distinct category values."""
    if not cats:
        return len(nums)
    return len(nums) + value_totals(df, cats).where("value is not null").count()


def fit_categories(train: DataFrame, cats: Sequence[str]) -> DataFrame:
    """The written table (column, value, n, slot): every category, missing as a level, numbered from 0 by column and value."""
    filled = train.select(*[F.coalesce(as_label(train, c), F.lit("missing")).alias(c) for c in cats])
    place = F.array_position(F.array(*map(F.lit, cats)), F.col("column"))
    counted = stage(value_totals(filled, cats).withColumn("place", place), "categories")
    return stage(numbered(counted, ["place", "value"], "slot", "categories-numbered").drop("place"), "categories-slots")


@dataclass(frozen=True)
class Encoder:
    """Fitted encoding: adds ``features`` (sparse) and, if asked, ``scaled_features``.

    Numbers come first, then the slots of the categories: those of ``table``, or ``hashed`` many that a hash of column and value chooses.
    """

    cats: tuple[str, ...]
    nums: tuple[str, ...]
    table: DataFrame | None
    slots: int
    hashed: bool = False
    scaler: StandardScalerModel | None = None
    rows: int = 0

    @property
    def width(self) -> int:
        return len(self.nums) + self.slots

    def feature_names(self, spark) -> DataFrame:
        """(slot, feature): the name of each encoded column."""
        fixed = [*self.nums, *(f"hashed__{i}" for i in range(self.slots if self.hashed else 0))]
        names = small_table(spark, enumerate(fixed), "slot long, feature string")
        if self.table is None:
            return names
        name = F.concat_ws(ONEHOT_SEPARATOR, F.lit(ONEHOT_PREFIX), "column", "value").alias("feature")
        return names.unionByName(self.table.select((F.col("slot") + len(self.nums)).alias("slot"), name))

    @property
    def names(self) -> tuple[str, ...]:
        """All names in order, for encodings known to be narrow: they are listed on the driver."""
        spark = self.table.sparkSession if self.table is not None else None
        if spark is None:
            return (*self.nums, *(f"hashed__{i}" for i in range(self.slots)))
        return tuple(r["feature"] for r in self.feature_names(spark).orderBy("slot").collect())

    def transform(self, df: DataFrame, keep: Sequence[str] | None = None, parts: bool = False) -> DataFrame:
        """The columns of ``df`` (or those of ``keep``) and the vectors, written once in the shared folder.

        A value unseen in training gives zeros; a number without a value is an error. With ``parts`` also ``SLOTS`` (sorted),
        ``NUMBERS`` and ``KEY``, a hash of the first kept column.
        """
        kept = list(df.columns if keep is None else keep)
        numbers = [F.col(c).cast("double") for c in self.nums]
        missing = F.raise_error(F.lit("a number to be encoded is missing")).cast("double")
        checked = F.array(*[F.when(x.isNotNull() & ~F.isnan(x), x).otherwise(missing) for x in numbers]).cast("array<double>")
        own = F.struct(F.struct(*[df[c] for c in kept]).alias("row"), checked.alias("numbers")).alias("own")
        values = [F.coalesce(as_label(df, c), F.lit("missing")) for c in self.cats]
        if not self.hashed and 0 < self.slots <= HOT and len(self.cats) <= JOINED:
            found = self._met(df.select(own, *[v.alias(f"__level{i}") for i, v in enumerate(values)]))
            return self._vectors(found, df.select(*kept).schema, parts)
        levels = F.array(*[F.struct(F.lit(c).alias("column"), v.alias("value")) for c, v in zip(self.cats, values)])
        rows = df.select(own, levels.alias("levels"))
        if not self.cats:
            found = rows.select("own", F.array().cast("array<int>").alias("slots"))
        elif self.hashed:
            found = rows.select("own", F.array_sort(F.transform("levels", lambda x: F.pmod(F.xxhash64(x["column"], x["value"]), F.lit(self.slots)).cast("int"))).alias("slots"))
        else:
            found = self._found(rows)
        return self._vectors(found, df.select(*kept).schema, parts)

    def with_scaling(self, coded: DataFrame) -> Encoder:
        """This encoder with the spread of encoded training rows."""
        scaler = StandardScaler(inputCol=FEATURES, outputCol=SCALED, withMean=False, withStd=True).fit(coded.select(FEATURES))
        return replace(self, scaler=scaler, rows=coded.count())

    def _met(self, rows: DataFrame) -> DataFrame:
        """As :meth:`_found` for few categories: those of each column are broadcast, and a row meets them where it is read."""
        for i, c in enumerate(self.cats):
            known = self.table.where(F.col("column") == F.lit(c)).select(F.col("value").alias(f"__level{i}"), F.col("slot").cast("int").alias(f"__slot{i}"))
            rows = rows.join(F.broadcast(known), f"__level{i}", "left")
        met = F.array(*[F.col(f"__slot{i}") for i in range(len(self.cats))])
        return rows.select("own", F.sort_array(F.array_compact(met)).alias("slots"))

    def _found(self, rows: DataFrame) -> DataFrame:
        """Each row's own part and its slots. A row is taken apart into its categories and put together again by its number."""
        rows = stage(rows.withColumn("number", F.monotonically_increasing_id()), "encode-rows")
        flat = rows.select("number", "own", F.posexplode("levels").alias("place", "level"))
        flat = flat.select("number", F.when(F.col("place") == 0, F.col("own")).alias("own"), "level.column", "level.value")
        met = lookup(flat, self.table, ["column", "value"], "slot", "number")
        slots = F.array_sort(F.collect_list(F.col("slot").cast("int")))
        return met.groupBy("number").agg(F.first("own", ignorenulls=True).alias("own"), slots.alias("slots"))

    def _vectors(self, found: DataFrame, kept: StructType, parts: bool) -> DataFrame:
        """Sparse vectors, as the struct that MLlib stores them in, written and read as vectors."""
        k = len(self.nums)
        number = [F.get("own.numbers", F.lit(i)) for i in range(k)]
        filled = F.array_compact(F.array(*[F.when(x != 0, F.lit(i)) for i, x in enumerate(number)]).cast("array<int>"))
        given = F.array_compact(F.array(*[F.when(x != 0, x) for x in number]).cast("array<double>"))
        if self.hashed:  # values of several columns may share a slot
            distinct = F.array_distinct("slots")
            ones = F.transform(distinct, lambda s: F.size(F.filter("slots", lambda t: t == s)).cast("double"))
        else:
            distinct, ones = F.col("slots"), F.array_repeat(F.lit(1.0), F.size("slots"))
        indices = F.concat(filled, F.transform(distinct, lambda s: s + k))
        values = F.concat(given, ones)
        vector = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(self.width).alias("size"), indices.alias("indices"), values.alias("values"))
        extra = [F.col("slots").alias(SLOTS), F.col("own.numbers").alias(NUMBERS)] if parts else []
        out = found.select("own.row.*", vector.alias(FEATURES), *extra)
        if parts:
            out = out.withColumn(KEY, F.xxhash64(kept.names[0]))
        schema = StructType([StructField(f.name, VectorUDT()) if f.name == FEATURES else f for f in out.schema])
        coded = stage(out, "encoded-rows", schema=schema)
        return self.scaler.transform(coded) if self.scaler is not None else coded


def _sized(table: DataFrame) -> int:
    n = table.count()
    if n >= 2**31:
        raise ValueError("a vector holds fewer than 2^31 features; give `hashed`, or reduce cardinality (see operators.cardinality)")
    return n


def fit_encoder(
    train: DataFrame, cats: Sequence[str], nums: Sequence[str], scale: bool = False, hashed: int | None = None
) -> Encoder:
    """Fit one-hot categories (and scaling) on training rows.

    Vectors stay sparse: scaling divides by the spread without centring, which leaves a linear
    model with an unpenalised intercept unchanged.

    ``hashed`` puts the categories into that many slots by a hash of column and value, for any number of
    categories: none is counted or unknown later, and values that share a slot add up.
    """
    cats, nums = tuple(cats), tuple(nums)
    table = fit_categories(train, cats) if cats and hashed is None else None
    slots = 0 if not cats else hashed if hashed is not None else _sized(table)
    encoder = Encoder(cats, nums, table, slots, hashed is not None)
    return encoder.with_scaling(encoder.transform(train, keep=train.columns[:1])) if scale else encoder
