"""Category labels: normalising, recoding, collapsing, and identifiers as text."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyframe.functions.missing import PLACEHOLDERS, member_of

# A one-hot feature is named <prefix><separator><column><separator><value>.
ONEHOT_PREFIX = "ohe"
ONEHOT_SEPARATOR = "__"

# The word that becomes "&", and the characters a clean label may hold.
# (?U) keeps word boundaries Unicode-aware on every JDK.
_AND_WORD = r"(?U)\band\b"
_FOREIGN_CHARS = r"[^a-z0-9&() ]+"
_SPACE_RUN = r" {2,}"


def normalize_label(c: Column) -> Column:
    """Fold spelling variants of one label together; placeholders become NULL.

    Deleting foreign characters also deletes tabs and newlines, so afterwards plain spaces are
    the only white space and trimming once at the end covers both ends.
    """
    text = F.lower(c)
    # Plain substring tests are far cheaper than a regular expression that finds nothing.
    text = F.when(F.contains(text, F.lit("and")), F.regexp_replace(text, _AND_WORD, "&")).otherwise(text)
    text = F.regexp_replace(text, _FOREIGN_CHARS, "")
    text = F.when(F.contains(text, F.lit("  ")), F.regexp_replace(text, _SPACE_RUN, " ")).otherwise(text)
    text = F.trim(text)
    return F.when(~text.isin(*PLACEHOLDERS), text)


def trim_lower(c: Column) -> Column:
    """Light normalising: outer white space off, lower case."""
    return F.lower(F.regexp_replace(c, r"^\s+|\s+$", ""))


def plain_text(c: Column) -> Column:
    """A value as text. Whole numbers held as floating point become plain digits: no exponent, no trailing .0."""
    number = c.try_cast("double")
    digits = F.when(F.typeof(c).isin("double", "float") & (number == F.floor(number)), number.try_cast("bigint").cast("string"))
    return F.coalesce(digits, c.cast("string"))


def id_to_text(c: Column, missing: str = "missing") -> Column:
    """An identifier as text, as :func:`plain_text` gives it; NULL becomes a level."""
    return F.coalesce(plain_text(c), F.lit(missing))


def recode(c: Column, mapping: Mapping[str, str]) -> Column:
    """Replace whole values by ``mapping``; other values and NULL stay."""
    out = None
    for old, new in mapping.items():
        hit = c == F.lit(old)
        out = F.when(hit, F.lit(new)) if out is None else out.when(hit, F.lit(new))
    return c if out is None else out.otherwise(c)


def keep_or_other(c: Column, keep: Iterable[str], other: str = "other") -> Column:
    return F.when(member_of(c, keep), c).otherwise(F.lit(other))


def onehot_name(column: str, value: str) -> str:
    return ONEHOT_SEPARATOR.join((ONEHOT_PREFIX, column, value))


def source_column(feature: Column) -> Column:
    """The table column an encoded feature came from (plain features name themselves)."""
    pieces = F.split(feature, ONEHOT_SEPARATOR, 3)
    return F.when(feature.startswith(ONEHOT_PREFIX + ONEHOT_SEPARATOR), F.get(pieces, 1)).otherwise(feature)
