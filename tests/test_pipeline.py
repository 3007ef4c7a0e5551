import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tallyframe.operators.models import BOOSTED, LOGISTIC, default_models
from tallyframe.plans import pipeline, prepare
from tallyframe.spec import TableSpec
from tests.test_models import SMALL, people

RULES = prepare.PrepareRules(
    presence={"k": "has_k"}, missing_flags=("x",), min_counts={"k": 5, "town": 2}, aliases={"k": {"yes": "yep"}}, caps={"x": (None, 2.5)}, drop_features=("noise",)
)


@pytest.fixture(scope="module")
def rows(spark):
    some = people(spark, 300).withColumn("town", F.concat(F.lit("t"), (F.col("id") % 90).cast("string")))
    return some.withColumn("x", F.when(F.col("id") % 17 != 0, F.col("x"))).cache()


@pytest.mark.parametrize(("name", "limit"), [(LOGISTIC, 1_000), (BOOSTED, 1)])
def test_a_reloaded_pipeline_scores_raw_rows_alike(spark, rows, tmp_path, monkeypatch, name, limit):
    monkeypatch.setattr(prepare, "LITERAL_LIMIT", limit)  # one value only: the others of `town` are a table that is saved with the stage
    monkeypatch.setattr("tallyframe.operators.cardinality.LITERAL_LIMIT", limit)
    spec = TableSpec.infer(rows, id="id", target="y")
    fitted = pipeline.fit_pipeline(rows.where("id < 200"), spec, RULES, default_models(**SMALL)[name])
    assert any(k.table is not None for k in fitted.stages[0].fitted.kept) == (limit == 1)
    new = rows.where("id >= 200").drop("y")
    before = {r["id"]: r["probability"] for r in pipeline.score(fitted, new, "id").collect()}
    fitted.write().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    assert again.stages[0].fitted.rules == RULES and again.stages[1].encoder.names == fitted.stages[1].encoder.names
    assert {r["id"]: r["probability"] for r in pipeline.score(again, new, "id").collect()} == before
    assert len(before) == 100 and min(before.values()) < 0.5 < max(before.values())


def test_stages_of_a_pipeline(rows):
    spec = TableSpec.infer(rows, id="id", target="y")
    prepared = pipeline.PrepareEstimator(spec, RULES).fit(rows)
    coded = pipeline.EncodeEstimator("id", "y", hashed=16).fit(prepared.transform(rows))
    assert coded.transform(prepared.transform(rows)).first()["features"].size == len(coded.encoder.nums) + 16
