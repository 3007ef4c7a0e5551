"""Fit, score and compare classifiers on prepared tables."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import replace

from pyspark import StorageLevel
from pyspark.ml.feature import StandardScalerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.encode import SCALED, Encoder, fit_encoder
from tallyframe.operators.metrics import auc_value
from tallyframe.operators.models import FOREST, LABEL, ModelChoice, default_models, older_models
from tallyframe.operators.order import quantiles
from tallyframe.operators.split import make_split
from tallyframe.operators.tables import compare_scores
from tallyframe.plans.prepare import PrepareRules, Prepared, fit_prepare, prepare
from tallyframe.session import checkpoint_dir, small_table, stage
from tallyframe.spec import TableSpec

SCORES = "model string, auc double"
PROBABILITY = "probability"
#: Rows of a part that a model is fitted on, and parts at least.
PART_ROWS, LEAST_PARTS = 1_000_000, 32


@contextmanager
def cached(*frames: DataFrame, scaler: StandardScalerModel | None = None) -> Iterator[list[DataFrame]]:
    """Keep encoded rows on the executors' disks while several models read them; lost blocks are recomputed.

    In memory, as column buffers of some MB each, they used up a heap of which Spark counted little more than a third for them, beside what MLlib keeps itself.
    With a ``scaler`` the scaled features are not kept, but worked out as the rows are read.
    """
    kept = [(f if scaler is None else f.drop(SCALED)).persist(StorageLevel.DISK_ONLY) for f in frames]
    try:
        yield [f if scaler is None else scaler.transform(f) for f in kept]
    finally:
        for f in kept:
            f.unpersist()


def roles(df: DataFrame, id: str, target: str | None) -> tuple[list[str], list[str]]:
    """(categories, numerics) of a prepared table."""
    spec = TableSpec.infer(df, id=id, target=target)
    return list(spec.cats), list(spec.nums)


def fit_parts(rows: int, part_rows: int = PART_ROWS, least: int = LEAST_PARTS) -> int:
    """Parts of training rows: they follow from the rows alone, so that a model does not depend on the machine."""
    return max(least, -(-rows // part_rows))


def dealt(df: DataFrame, id: str, parts: int) -> DataFrame:
    """Training rows in a given number of parts, in a fixed order, whatever the machine and the file layout.

    The forest draws its samples per part, so this makes a fitted model repeatable.
    """
    return df.repartition(parts, id).sortWithinPartitions(id)


def encode_pair(
    train: DataFrame, other: DataFrame, id: str, target: str, scale: bool, hashed: int | None = None
) -> tuple[Encoder, DataFrame, DataFrame]:
    """Encoder fitted on ``train``, and both tables reduced to what a model reads; each is encoded once."""
    cats, nums = roles(train, id, target)
    train = stage(train, "prepared-rows")  # read for the categories, then encoded
    encoder = fit_encoder(train, cats, nums, hashed=hashed)

    def slim(df: DataFrame) -> DataFrame:
        label = [F.col(target).cast("double").alias(LABEL)] if target in df.columns else []
        rows = df.select(id, *label, *cats, *nums)
        return encoder.transform(rows, keep=[id, *([LABEL] if label else [])], parts=True)

    a, b = slim(train), slim(other)
    rows = a.count()
    encoder = encoder.with_scaling(a) if scale else encoder
    a = dealt(a, id, fit_parts(rows))
    if scale:
        a, b = encoder.scaler.transform(a), encoder.scaler.transform(b)
    return replace(encoder, rows=rows), a, b


def positive_probability(scored: DataFrame, id: str, *keep: str) -> DataFrame:
    return scored.select(id, *keep, vector_to_array("probability")[1].alias(PROBABILITY))


def benchmark_models(
    train: DataFrame, valid: DataFrame, id: str, target: str, models: Mapping[str, ModelChoice] | None = None,
    hashed: int | None = None,
) -> DataFrame:
    """(model, auc) on ``valid``, best first. Encoding is fitted and kept once for all models; ``hashed`` as in ``fit_encoder``."""
    scores, _ = fit_models(train, valid, id, target, models, hashed)
    return _score_table(train, scores)


def _score_table(df: DataFrame, scores: Mapping[str, float | None]) -> DataFrame:
    return small_table(df.sparkSession, list(scores.items()), SCORES).orderBy(F.col("auc").desc_nulls_last(), "model")


def fit_models(
    train: DataFrame, valid: DataFrame, id: str, target: str, models: Mapping[str, ModelChoice] | None = None,
    hashed: int | None = None,
) -> tuple[dict[str, float | None], tuple[Encoder, dict[str, object]]]:
    """AUC of each model on ``valid``, the encoder, and the fitted models."""
    models = models or default_models()
    checkpoint_dir(train.sparkSession)  # tree boosting cuts its lineage there
    scores, fitted = {}, {}
    encoder, a, b = encode_pair(train, valid, id, target, any(m.scale for m in models.values()), hashed)
    with cached(a, scaler=encoder.scaler) as (a,):  # the held-out rows are read from where they were written
        for name, choice in models.items():
            fitted[name] = choice.fit(a, encoder.rows)
            scores[name] = auc_value(positive_probability(fitted[name].transform(b), id, LABEL), PROBABILITY, LABEL)
    return scores, (encoder, fitted)


def score_model(train: DataFrame, valid: DataFrame, id: str, target: str, choice: ModelChoice) -> float | None:
    """AUC of one model."""
    return fit_models(train, valid, id, target, {"model": choice})[0]["model"]


def ablation(
    train: DataFrame,
    valid: DataFrame,
    id: str,
    target: str,
    column: str,
    models: Mapping[str, ModelChoice] | None = None,
) -> DataFrame:
    """(model, auc_with, auc_without, diff): what one column is worth to each model."""
    with_it = benchmark_models(train, valid, id, target, models)
    without = benchmark_models(train.drop(column), valid.drop(column), id, target, models)
    return compare_scores(with_it, without, "model", "auc", "with", "without")


def run_benchmark(
    df: DataFrame,
    spec: TableSpec,
    rules: PrepareRules,
    kind: str = "random",
    share: float = 0.2,
    models: Mapping[str, ModelChoice] | None = None,
) -> DataFrame:
    """(split, model, auc): split, prepare with training rows only, benchmark."""
    train, valid = make_split(df, kind, spec.id, spec.target, spec.date, share)
    fitted: Prepared = fit_prepare(train, spec, rules)
    scores = benchmark_models(prepare(train, fitted), prepare(valid, fitted), spec.id, spec.target, models)
    return scores.select(F.lit(kind).alias("split"), "model", "auc")


def importance_table(spark, model, encoder: Encoder) -> DataFrame:
    """(feature, importance) of a fitted tree model; one row per encoded column. Only features that a tree uses are listed on the driver."""
    weights = model.featureImportances
    used = small_table(spark, [(int(i), float(w)) for i, w in zip(weights.indices, weights.values)], "slot long, importance double")
    return encoder.feature_names(spark).join(used, "slot", "left").select("feature", F.coalesce("importance", F.lit(0.0)).alias("importance"))


def feature_importance(
    train: DataFrame, id: str, target: str, choice: ModelChoice | None = None, top_n: int | None = 70
) -> DataFrame:
    """Most important encoded features of a forest fitted on ``train``."""
    choice = choice or default_models()[FOREST]
    encoder, a, _ = encode_pair(train, train.limit(0), id, target, scale=choice.scale)
    with cached(a, scaler=encoder.scaler) as (a,):
        model = choice.fit(a, encoder.rows)
    table = importance_table(train.sparkSession, model, encoder).orderBy(F.desc("importance"), "feature")
    return table if top_n is None else table.limit(top_n)


def impute_plain(train: DataFrame, *others: DataFrame, id: str, target: str, label: str = "unknown") -> list[DataFrame]:
    """Typed column preparation: numerics filled with training medians, labels with a constant."""
    cats, nums = roles(train, id, target)
    medians = {c: v[0] for c, v in quantiles(train, {c: F.col(c) for c in nums}, [0.5]).items()}
    fills = {
        **{c: F.coalesce(F.col(c).cast("double"), F.lit(medians[c])) for c in nums if medians[c] is not None},
        **{c: F.coalesce(F.col(c), F.lit(label)) for c in cats},
    }
    empty = [c for c in nums if medians[c] is None]
    return [df.withColumns({c: e for c, e in fills.items() if c in df.columns}).drop(*empty) for df in (train, *others)]


def older_benchmark(
    train: DataFrame, valid: DataFrame, id: str, target: str, models: Mapping[str, ModelChoice] | None = None
) -> tuple[dict[str, float | None], tuple[Encoder, dict[str, object]]]:
    """The earlier pipeline: medians and a constant for missing values, scaling and one-hot, its own models. Returns as :func:`fit_models`."""
    a, b = impute_plain(train, valid, id=id, target=target)
    return fit_models(a, b, id, target, models or older_models())


def raw_vs_clean(
    tables: Mapping[str, tuple[DataFrame, DataFrame]], id: str, target: str, choice: ModelChoice
) -> DataFrame:
    """(data, auc): the same model on several versions of the same split."""
    rows = []
    spark = None
    for name, (train, valid) in tables.items():
        spark = train.sparkSession
        a, b = impute_plain(train, valid, id=id, target=target)
        rows.append((name, score_model(a, b, id, target, choice)))
    return small_table(spark, rows, "data string, auc double").orderBy(F.col("auc").desc_nulls_last(), "data")
