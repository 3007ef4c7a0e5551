"""Leakage-safe preparation: fit on training rows once, apply to any rows as one projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.dates import month_of, parse_date, weekday_of
from tallyframe.functions.missing import fill, is_missing, is_present
from tallyframe.functions.numeric import matches
from tallyframe.functions.text import id_to_text, normalize_label, recode, trim_lower
from tallyframe.operators.cardinality import LITERAL_LIMIT, KeptValues, fit_kept
from tallyframe.operators.counts import value_totals
from tallyframe.operators.order import comparable, quantiles
from tallyframe.operators.outliers import clip_fixed
from tallyframe.session import rows_up_to
from tallyframe.spec import TableSpec

MISSING = "missing"


@dataclass(frozen=True)
class PrepareRules:
    """What the preparation does besides filling; every name is an argument, none is built in.

    presence: column -> name of its has-a-value flag. missing_flags: columns that get a
    ``<column>_missing`` flag. min_counts: category -> rows a value needs to be kept. aliases:
    category -> {old: new}. match: (flag, requested, assigned). caps: column -> (lo, hi).
    drop_reduced / drop_features: columns to drop after reduction / after the match flag.
    """

    presence: Mapping[str, str] = field(default_factory=dict)
    missing_flags: Sequence[str] = ()
    min_counts: Mapping[str, int] = field(default_factory=dict)
    aliases: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    drop_reduced: Sequence[str] = ()
    match: tuple[str, str, str] | None = None
    drop_features: Sequence[str] = ()
    caps: Mapping[str, tuple[float | None, float | None]] = field(default_factory=dict)
    keep_id: bool = True


@dataclass(frozen=True)
class Prepared:
    """Everything learned from the training rows."""

    spec: TableSpec
    rules: PrepareRules
    medians: Mapping[str, float | None]
    kept: tuple[KeptValues, ...]


def _clean_label(df: DataFrame, c: str, id_like: Sequence[str]) -> Column:
    return id_to_text(F.col(c), MISSING) if c in id_like else fill(normalize_label(F.col(c)), MISSING)


def fit_prepare(train: DataFrame, spec: TableSpec, rules: PrepareRules, exact: bool = True) -> Prepared:
    """Medians of the numerics and kept values of the reduced categories, from training rows only.

    One search for all medians and one count for all reduced columns. Values are counted raw and
    cleaned afterwards, so text cleaning runs per distinct value.
    """
    nums = [c for c in spec.nums if c in train.columns]
    medians = {c: v[0] for c, v in quantiles(train, {c: F.col(c) for c in nums}, [0.5], exact=exact).items()}
    reduced = [c for c in rules.min_counts if c in train.columns]
    kept = _fit_kept(train, spec, rules, reduced) if reduced else []
    return Prepared(spec, rules, medians, tuple(kept))


def _fit_kept(train: DataFrame, spec: TableSpec, rules: PrepareRules, reduced: Sequence[str]) -> list[KeptValues]:
    label, least = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    for c in reduced:
        # value_totals already gives identifiers as plain digits.
        clean = fill(F.col("value") if c in spec.id_like else normalize_label(F.col("value")), MISSING)
        here = F.col("column") == c
        label = F.when(here, recode(clean, rules.aliases.get(c, {}))).otherwise(label)
        least = F.when(here, F.lit(rules.min_counts[c])).otherwise(least)
    frequent = (
        value_totals(train, reduced)
        .groupBy("column", label.alias("value"))
        .agg(F.sum("n").alias("count"))
        .where(F.col("count") >= least)
    )
    few = rows_up_to(frequent, LITERAL_LIMIT * len(reduced))
    if few is None:  # too many for literals: each column gets a written table
        return [fit_kept(frequent.where(F.col("column") == c), c, always=(MISSING,)) for c in reduced]
    return [
        KeptValues(c, tuple(sorted(r["value"] for r in few if r["column"] == c)), always=(MISSING,)) for c in reduced
    ]


def complete_missing(df: DataFrame, fitted: Prepared) -> DataFrame:
    """Flags first (so placeholders are not flagged), then medians, cleaned labels, ids as text."""
    spec, rules = fitted.spec, fitted.rules
    out: dict[str, Column] = {}
    for c in df.columns:
        if c in spec.nums:
            out[c] = fill(comparable(df, {c: F.col(c)})[c].cast("double"), fitted.medians.get(c))
        elif c in spec.cats or c in spec.id_like:
            out[c] = _clean_label(df, c, spec.id_like)
    flags = {name: is_present(F.col(c)) for c, name in rules.presence.items() if c in df.columns}
    flags.update({f"{c}_missing": is_missing(F.col(c)) for c in rules.missing_flags if c in df.columns})
    # All right-hand sides refer to the incoming columns, so flags see the raw values.
    # A number without any value in the training rows has nothing to be filled with and goes.
    done = df.withColumns({**flags, **out}).drop(*[c for c in spec.nums if fitted.medians.get(c) is None])
    return done if rules.keep_id else done.drop(spec.id)


def prepare(df: DataFrame, fitted: Prepared) -> DataFrame:
    """The whole chain: complete, drop the date, reduce categories, match flag, drops, caps."""
    spec, rules = fitted.spec, fitted.rules
    out = complete_missing(df, fitted)
    if spec.date:
        out = out.drop(spec.date)
    out = out.withColumns({c: recode(F.col(c), m) for c, m in rules.aliases.items() if c in out.columns})
    for kept in fitted.kept:
        if kept.column in out.columns:
            out = kept.apply(out)
    out = out.drop(*rules.drop_reduced)
    if rules.match:
        out = add_match_flag(out, *rules.match)
    return clip_fixed(out.drop(*rules.drop_features), rules.caps)


def add_match_flag(df: DataFrame, name: str, requested: str, assigned: str) -> DataFrame:
    return df.withColumn(name, matches(F.col(requested), F.col(assigned)))


def prepare_from(df: DataFrame, train: DataFrame, spec: TableSpec, rules: PrepareRules) -> DataFrame:
    """Fit on ``train`` and apply to ``df`` in one call."""
    return prepare(df, fit_prepare(train, spec, rules))


def prepare_calendar(
    df: DataFrame, date: str, missing_flags: Sequence[str], presence: Mapping[str, str], strict: bool = True
) -> DataFrame:
    """The earlier preparation: missing flags, presence flags replacing their column, month and
    weekday (Monday = 0) replacing the date, labels trimmed and lower-cased.
    """
    when = parse_date(F.col(date), strict=strict)
    labels = [n for n, kind in df.dtypes if kind == "string" and n != date and n not in presence]
    return df.withColumns({
        **{f"{c}_is_missing": is_missing(F.col(c)) for c in missing_flags},
        **{name: is_present(F.col(c)) for c, name in presence.items()},
        f"{date}_month": month_of(when),
        f"{date}_weekday": weekday_of(when),
        **{c: trim_lower(F.col(c)) for c in labels},
    }).drop(date, *presence)
