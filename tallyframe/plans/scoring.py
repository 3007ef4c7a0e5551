"""Pick the best model on a held-out split, refit on everything, score new rows, write them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.models import ModelChoice, default_models
from tallyframe.operators.split import stratified_split
from tallyframe.plans.benchmark import (
    PROBABILITY, _score_table, cached, encode_pair, fit_models, positive_probability,
)
from tallyframe.plans.prepare import PrepareRules, fit_prepare, prepare
from tallyframe.session import checkpoint_dir
from tallyframe.sources.files import write_csv
from tallyframe.spec import TableSpec


@dataclass(frozen=True)
class BestPrediction:
    """Predictions of the selected model with the scores that selected it."""

    model: str
    auc: float | None
    scores: DataFrame
    predictions: DataFrame


def fit_predict(train: DataFrame, rows: DataFrame, id: str, target: str, choice: ModelChoice) -> DataFrame:
    """(id, probability) for ``rows``; the id travels with its row."""
    checkpoint_dir(train.sparkSession)
    encoder, a, b = encode_pair(train, rows, id, target, scale=choice.scale)
    with cached(a, scaler=encoder.scaler) as (a,):
        model = choice.fit(a, encoder.rows)
    return positive_probability(model.transform(b), id)


def predict_best(
    labelled: DataFrame,
    scoring: DataFrame,
    spec: TableSpec,
    rules: PrepareRules,
    models: Mapping[str, ModelChoice] | None = None,
    share: float = 0.2,
    output: str | None = None,
) -> BestPrediction:
    """Benchmark on a stratified split, refit the winner on all labelled rows, score and write."""
    models = models or default_models()
    train, valid = stratified_split(labelled, spec.id, spec.target, share)
    held_out = fit_prepare(train, spec, rules)
    scores, _ = fit_models(prepare(train, held_out), prepare(valid, held_out), spec.id, spec.target, models)
    best = max(scores, key=lambda name: (scores[name] is not None, scores[name] or 0.0))
    full = fit_prepare(labelled, spec, rules)
    predictions = fit_predict(
        prepare(labelled, full), prepare(scoring.drop(spec.target), full), spec.id, spec.target, models[best]
    )
    if output:
        write_csv(predictions, output)
    return BestPrediction(best, scores[best], _score_table(labelled, scores), predictions)


def prediction_table(scored: DataFrame, id: str, id_name: str, probability_name: str) -> DataFrame:
    """The two-column submission table under its own names."""
    return scored.select(F.col(id).alias(id_name), F.col(PROBABILITY).alias(probability_name))
