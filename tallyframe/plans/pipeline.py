"""Preparation and encoding as stages of an MLlib pipeline: fitted once, then saved, loaded and applied together with the model."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import asdict, replace

from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.feature import StandardScalerModel
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.cardinality import KeptValues
from tallyframe.operators.encode import Encoder, fit_encoder
from tallyframe.operators.models import LABEL, ModelChoice
from tallyframe.plans.benchmark import cached, dealt, fit_parts, positive_probability, roles
from tallyframe.plans.prepare import Prepared, PrepareRules, fit_prepare, prepare
from tallyframe.session import checkpoint_dir
from tallyframe.spec import TableSpec

Tables = Mapping[str, DataFrame]


class _StageWriter(MLWriter):
    """Saves a fitted stage: its state as JSON beside the stage's name, its tables as Parquet, a scaler in MLlib's form."""

    def __init__(self, fitted: FittedStage):
        super().__init__()
        self.fitted = fitted

    def saveImpl(self, path: str) -> None:
        state, tables, scaler = self.fitted.parts()
        DefaultParamsWriter.saveMetadata(self.fitted, path, self.sparkSession, extraMetadata={"state": json.dumps(state)})
        for name, table in tables.items():
            table.write.parquet(f"{path}/tables/{name}")
        if scaler is not None:
            scaler.write().save(f"{path}/scaler")


class _StageReader(MLReader):
    def __init__(self, kind: type[FittedStage]):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> FittedStage:
        about = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        state = json.loads(about["state"])
        fitted = self.kind.of(
            state, lambda name: self.sparkSession.read.parquet(f"{path}/tables/{name}"), lambda: StandardScalerModel.load(f"{path}/scaler")
        )
        fitted._resetUid(about["uid"])
        return fitted


class FittedStage(Transformer, MLWritable, MLReadable):
    """A fitted step that a ``PipelineModel`` can hold."""

    def parts(self) -> tuple[dict, Tables, StandardScalerModel | None]:
        raise NotImplementedError

    @classmethod
    def of(cls, state: dict, table: Callable[[str], DataFrame], scaler: Callable[[], StandardScalerModel]) -> FittedStage:
        raise NotImplementedError

    def write(self) -> MLWriter:
        return _StageWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _StageReader(cls)


class PrepareStage(FittedStage):
    """:func:`prepare` with what was learned from the training rows."""

    def __init__(self, fitted: Prepared | None = None):
        super().__init__()
        self.fitted = fitted

    def _transform(self, df: DataFrame) -> DataFrame:
        return prepare(df, self.fitted)

    def parts(self):
        kept = [{**{k: v for k, v in vars(x).items() if k != "table"}, "table": x.table is not None} for x in self.fitted.kept]
        state = {"spec": asdict(self.fitted.spec), "rules": asdict(self.fitted.rules), "medians": dict(self.fitted.medians), "kept": kept}
        return state, {str(i): x.table for i, x in enumerate(self.fitted.kept) if x.table is not None}, None

    @classmethod
    def of(cls, state, table, scaler):
        tuples = lambda d: {k: tuple(v) if isinstance(v, list) else v for k, v in d.items()}
        rules = tuples(state["rules"])
        rules["caps"] = {c: tuple(b) for c, b in rules["caps"].items()}
        kept = tuple(
            KeptValues(**{**tuples(x), "table": table(str(i)) if x["table"] else None}) for i, x in enumerate(state["kept"])
        )
        return cls(Prepared(TableSpec(**tuples(state["spec"])), PrepareRules(**rules), state["medians"], kept))


class EncodeStage(FittedStage):
    """:meth:`Encoder.transform` with the categories and the spread of the training rows."""

    def __init__(self, encoder: Encoder | None = None):
        super().__init__()
        self.encoder = encoder

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.encoder.transform(df)

    def parts(self):
        e = self.encoder
        state = {"cats": e.cats, "nums": e.nums, "slots": e.slots, "hashed": e.hashed, "rows": e.rows, "scaled": e.scaler is not None}
        return state, {} if e.table is None else {"categories": e.table}, e.scaler

    @classmethod
    def of(cls, state, table, scaler):
        known = table("categories") if state["cats"] and not state["hashed"] else None
        spread = scaler() if state["scaled"] else None
        return cls(Encoder(tuple(state["cats"]), tuple(state["nums"]), known, state["slots"], state["hashed"], spread, state["rows"]))


class PrepareEstimator(Estimator):
    """Fits a :class:`PrepareStage`."""

    def __init__(self, spec: TableSpec, rules: PrepareRules):
        super().__init__()
        self.spec, self.rules = spec, rules

    def _fit(self, df: DataFrame) -> PrepareStage:
        return PrepareStage(fit_prepare(df, self.spec, self.rules))


class EncodeEstimator(Estimator):
    """Fits an :class:`EncodeStage` on prepared rows."""

    def __init__(self, id: str, target: str | None, scale: bool = False, hashed: int | None = None):
        super().__init__()
        self.id, self.target, self.scale, self.hashed = id, target, scale, hashed

    def _fit(self, df: DataFrame) -> EncodeStage:
        cats, nums = roles(df, self.id, self.target)
        return EncodeStage(fit_encoder(df, cats, nums, self.scale, self.hashed))


def fit_pipeline(train: DataFrame, spec: TableSpec, rules: PrepareRules, choice: ModelChoice, hashed: int | None = None) -> PipelineModel:
    """Preparation, encoding and model fitted on raw training rows: one model for raw rows, that ``write().save`` and ``load`` take as a whole.

    A saved pipeline carries its category and kept-value tables along; one in memory reads them from the shared folder.
    """
    checkpoint_dir(train.sparkSession)
    preparing = PrepareEstimator(spec, rules).fit(train)
    rows = preparing.transform(train)
    cats, nums = roles(rows, spec.id, spec.target)
    encoder = fit_encoder(rows, cats, nums, hashed=hashed)
    coded = encoder.transform(rows.withColumn(LABEL, F.col(spec.target).cast("double")), keep=[spec.id, LABEL], parts=True)
    encoder = encoder.with_scaling(coded) if choice.scale else encoder
    n = coded.count()
    with cached(dealt(coded, spec.id, fit_parts(n)), scaler=encoder.scaler) as (coded,):
        model = choice.fit(coded, n)
    return PipelineModel([preparing, EncodeStage(replace(encoder, rows=n)), model])


def score(fitted: PipelineModel, rows: DataFrame, id: str) -> DataFrame:
    """(id, probability) of raw rows."""
    return positive_probability(fitted.transform(rows), id)
