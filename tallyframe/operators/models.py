"""The model registry: classifiers with the settings of the surveyed models, all overridable."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.sql import DataFrame, SparkSession

from tallyframe.operators.boosting import SecondOrderBoosting
from tallyframe.operators.encode import FEATURES, SCALED
from tallyframe.session import checkpoint_dir, remove

LABEL = "label"


@dataclass(frozen=True)
class ModelChoice:
    """How to build a classifier for ``rows`` training rows, and whether it needs scaled features."""

    build: Callable[..., object]
    scale: bool = False
    options: Mapping[str, object] = field(default_factory=dict)

    def classifier(self, rows: int, **extra):
        return self.build(rows, **{**self.options, **extra})

    def fit(self, df: DataFrame, rows: int, **extra):
        """The model fitted on ``df``, which has ``rows`` rows."""
        return without_summary(df.sparkSession, self.classifier(rows, **extra).fit(df))


def without_summary(spark: SparkSession, model):
    """A fitted model without its training summary.

    MLlib sends the whole model to the tasks that score rows, its summary with it, and that holds the session, which cannot be sent once
    anything was observed in it (``DataFrame.observe``). A saved model has no summary.
    """
    if not getattr(model, "hasSummary", False):
        return model
    path = f"{checkpoint_dir(spark).rstrip('/')}/fitted-model-{uuid.uuid4().hex}"
    model.write().save(path)
    plain = type(model).load(path)
    remove(spark, path)
    return plain


def _logistic(rows: int, max_iter: int = 2000, c: float = 1.0, **extra):
    """L2 logistic regression whose penalty matches strength ``c`` on the summed loss.

    The solver averages the loss, hence 1 / (c * rows). Features were divided by the sample
    spread; the factor (rows - 1) / rows restores the penalty for population-scaled features.
    """
    rows = max(rows, 1)
    penalty = max(rows - 1, 1) / (c * rows * rows)
    return LogisticRegression(
        featuresCol=SCALED, labelCol=LABEL, maxIter=max_iter, regParam=penalty, elasticNetParam=0.0,
        standardization=False, tol=1e-6, **extra,
    )


def _forest(rows: int, trees: int = 300, depth: int = 12, min_leaf: int = 1, seed: int = 42, **extra):
    return RandomForestClassifier(
        featuresCol=FEATURES, labelCol=LABEL, numTrees=trees, maxDepth=depth, minInstancesPerNode=min_leaf,
        featureSubsetStrategy="sqrt", seed=seed, **extra,
    )


def _boosted(rows: int, **settings):
    return SecondOrderBoosting(label=LABEL, **settings)


def _first_order(rows: int, rounds: int = 300, depth: int = 5, rate: float = 0.05, seed: int = 42, **extra):
    return GBTClassifier(
        featuresCol=FEATURES, labelCol=LABEL, maxIter=rounds, maxDepth=depth, stepSize=rate,
        subsamplingRate=0.9, featureSubsetStrategy="0.9", seed=seed, **extra,
    )


LOGISTIC, FOREST, BOOSTED = "Logistic Regression", "Random Forest", "Boosted Trees"


def default_models(**settings: Mapping[str, object]) -> dict[str, ModelChoice]:
    """The three benchmarked models; keyword ``logistic``/``forest``/``boosted`` options override."""
    return {
        LOGISTIC: ModelChoice(_logistic, scale=True, options=settings.get("logistic", {})),
        FOREST: ModelChoice(_forest, options=settings.get("forest", {})),
        BOOSTED: ModelChoice(_boosted, options=settings.get("boosted", {})),
    }


def first_order_boosting(**options: object) -> ModelChoice:
    """MLlib's own boosting, which fits trees to first-order residuals and draws columns for each node."""
    return ModelChoice(_first_order, options=options)


def older_models(**settings: Mapping[str, object]) -> dict[str, ModelChoice]:
    """The earlier settings: fewer iterations, shallower forest with leaves of at least two rows."""
    return {
        LOGISTIC: ModelChoice(_logistic, scale=True, options={"max_iter": 1000, **settings.get("logistic", {})}),
        FOREST: ModelChoice(_forest, options={"depth": 10, "min_leaf": 2, **settings.get("forest", {})}),
    }


def source_models(**settings: Mapping[str, object]) -> dict[str, ModelChoice]:
    """Models that tell two tables apart (adversarial validation)."""
    return {
        FOREST: ModelChoice(_forest, options={"depth": 10, "min_leaf": 20, **settings.get("forest", {})}),
        BOOSTED: ModelChoice(_boosted, options={"depth": 4, **settings.get("boosted", {})}),
    }
