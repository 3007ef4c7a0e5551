"""Column roles of a labelled table, derived from its schema and overridable."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType, T.BooleanType)
INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def columns_of_type(df: DataFrame, *kinds: type, exclude: tuple[str, ...] = ()) -> list[str]:
    """Names of the columns whose Spark type is one of ``kinds``, in table order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds) and f.name not in exclude]


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return columns_of_type(df, *NUMERIC, exclude=exclude)


def text_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return columns_of_type(df, T.StringType, exclude=exclude)


@dataclass(frozen=True)
class TableSpec:
    """Which column is the row id, the 0/1 target, the date, a category or a true number.

    ``id_like`` columns are numeric identifiers that act as categories (agent, company).
    """

    id: str
    target: str | None = None
    date: str | None = None
    id_like: tuple[str, ...] = ()
    cats: tuple[str, ...] = ()
    nums: tuple[str, ...] = ()

    @classmethod
    def infer(
        cls,
        df: DataFrame,
        id: str,
        target: str | None = None,
        date: str | None = None,
        id_like: tuple[str, ...] = (),
        ignore: tuple[str, ...] = (),
    ) -> TableSpec:
        """Strings become categories, numbers and booleans (0 and 1) become numerics, minus the named roles."""
        taken = tuple(c for c in (id, target, date, *id_like, *ignore) if c)
        return cls(
            id=id,
            target=target,
            date=date,
            id_like=tuple(c for c in id_like if c in df.columns),
            cats=tuple(text_columns(df, exclude=taken)),
            nums=tuple(numeric_columns(df, exclude=taken)),
        )

    def with_roles(self, **changes) -> TableSpec:
        return replace(self, **changes)

    @property
    def features(self) -> tuple[str, ...]:
        return (*self.nums, *self.cats, *self.id_like)
