"""Adversarial validation: can a model tell the second table from the first, and by what?"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.missing import fill
from tallyframe.functions.text import normalize_label
from tallyframe.operators.drift import SOURCE, feature_shifts, importance_by_column, top_features
from tallyframe.operators.metrics import auc_value
from tallyframe.operators.models import FOREST, LABEL, ModelChoice, source_models
from tallyframe.operators.order import quantiles
from tallyframe.operators.split import stratified_split
from tallyframe.plans.benchmark import PROBABILITY, cached, encode_pair, importance_table, positive_probability
from tallyframe.session import checkpoint_dir, small_table
from tallyframe.spec import numeric_columns, text_columns

# Fixed value: the name a stray index column gets when a table was written with its row numbers.
STRAY_INDEX = "Unnamed: 0"
WEIGHT = "class_weight"


@dataclass(frozen=True)
class SourceModels:
    """Source AUC per model, encoded-feature importances, class weights, and rows fitted on and held out."""

    scores: DataFrame
    importance: DataFrame
    weights: Mapping[float, float]
    rows: int
    held_out: int


def prepare_sources(tagged: DataFrame, id: str, leaks: Sequence[str], flag: str = SOURCE) -> DataFrame:
    """Drop fields that give the source away, fill numerics with medians of both tables together,
    clean labels. The id stays for splitting and is not a feature.
    """
    slim = tagged.drop(*leaks, STRAY_INDEX)
    nums = numeric_columns(slim, exclude=(id, flag))
    cats = text_columns(slim, exclude=(id, flag))
    medians = quantiles(slim, {c: F.col(c) for c in nums}, [0.5])
    return slim.withColumns({
        **{c: fill(F.col(c).cast("double"), medians[c][0]) for c in nums if medians[c][0] is not None},
        **{c: fill(normalize_label(F.col(c)), "missing") for c in cats},
        flag: F.col(flag).cast("int"),
    }).drop(*[c for c in nums if medians[c][0] is None])


def balanced_weights(df: DataFrame, label: str) -> dict[float, float]:
    """n / (classes * class size) for every class."""
    sizes = {r[0]: r["n"] for r in df.groupBy(label).agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    return {c: total / (len(sizes) * n) for c, n in sizes.items()}


def fit_source_models(
    prepared: DataFrame, id: str, flag: str = SOURCE, share: float = 0.25,
    models: Mapping[str, ModelChoice] | None = None,
) -> SourceModels:
    """Stratified split on the source, class-balanced forest and boosting, AUC on held-out rows."""
    models = models or source_models()
    spark = prepared.sparkSession
    checkpoint_dir(spark)
    train, valid = stratified_split(prepared, id, flag, share)
    scores, weights_by_model = [], None
    encoder, a, b = encode_pair(train, valid, id, flag, scale=False)
    with cached(a, b) as (a, b):
        weights = balanced_weights(a, LABEL)
        weight = F.lit(1.0)
        for value, w in weights.items():
            weight = F.when(F.col(LABEL) == F.lit(value), F.lit(w)).otherwise(weight)
        weighted, rows, held_out = a.withColumn(WEIGHT, weight), encoder.rows, b.count()
        for name, choice in models.items():
            extra = {"weightCol": WEIGHT} if name == FOREST else {}
            model = choice.fit(weighted, rows, **extra)
            scores.append((name, auc_value(positive_probability(model.transform(b), id, LABEL), PROBABILITY, LABEL)))
            table = importance_table(spark, model, encoder).select(F.lit(name).alias("model"), "feature", "importance")
            weights_by_model = table if weights_by_model is None else weights_by_model.unionByName(table)
    result = small_table(spark, scores, "model string, source_auc double")
    return SourceModels(result.orderBy(F.col("source_auc").desc_nulls_last(), "model"), weights_by_model, weights, rows, held_out)


def drift_report(tagged: DataFrame, fitted: SourceModels, flag: str = SOURCE, top_n: int = 8) -> DataFrame:
    """Value-level shift of the columns that tell the tables apart best (at most ``top_n`` of them)."""
    leaders = top_features(importance_by_column(fitted.importance), top_n).collect()
    return feature_shifts(tagged, [r["feature"] for r in leaders], flag)
