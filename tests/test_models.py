import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tallyframe.operators.boosting import SecondOrderBoosting
from tallyframe.operators.encode import SCALED
from tallyframe.operators.models import BOOSTED, FOREST, LOGISTIC, ModelChoice, default_models, older_models, source_models
from tallyframe.operators.split import stratified_split
from tallyframe.operators.drift import tag_sources
from tallyframe.plans import adversarial, benchmark, prepare, scoring
from tallyframe.session import checkpoint_dir
from tallyframe.sources.files import read_csv
from tallyframe.spec import TableSpec

SMALL = {"logistic": {"max_iter": 30}, "forest": {"trees": 8, "depth": 4}, "boosted": {"rounds": 4, "depth": 3}}
RULES = prepare.PrepareRules(min_counts={"k": 5})


def people(spark, n=600, shift=0.0, seed=5, noise=0.3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=n) + shift
    k = np.where(rng.random(n) < 0.5, "Yes", "no!")
    y = ((x - shift) + (k == "Yes") * 2.0 + rng.normal(size=n) * noise > 1.0).astype(int)
    pdf = pd.DataFrame({"id": range(n), "y": y, "x": x, "k": k, "noise": rng.normal(size=n)})
    return spark.createDataFrame(pdf)


@pytest.fixture(scope="module")
def labelled(spark):
    return people(spark).cache()


@pytest.fixture(scope="module")
def spec(labelled):
    return TableSpec.infer(labelled, id="id", target="y")


def kept(spark, before=()):
    """(bytes in memory, bytes on disk) of cached blocks by RDD, without those of ``before``."""
    return {x.id(): (x.memSize(), x.diskSize()) for x in spark.sparkContext._jsc.sc().getRDDStorageInfo() if x.id() not in before}


def test_encoded_rows_are_kept_on_disk_and_without_scaled_features(spark, labelled):
    encoder, a, b = benchmark.encode_pair(labelled, labelled, "id", "y", scale=True)
    read = lambda df: df.select("id", "label", "features", SCALED).collect()
    plain, names, before = read(a), a.columns, kept(spark)
    with benchmark.cached(a, scaler=encoder.scaler) as (rows,):
        assert read(rows) == plain and set(rows.columns) == set(names)  # in the same order
        assert rows.rdd.getNumPartitions() == a.rdd.getNumPartitions() == benchmark.LEAST_PARTS
        blocks = kept(spark, before)
        assert len(blocks) == 1 and all(m == 0 and d > 0 for m, d in blocks.values()), blocks
        whole = sum(d for _, d in blocks.values())
    with benchmark.cached(b) as (rows,):  # without a scaler nothing is left out
        assert sorted(read(rows)) == sorted(read(b))
    assert encoder.scaler is not None
    before = kept(spark)
    with benchmark.cached(a) as (rows,):
        rows.count()
        assert sum(d for _, d in kept(spark, before).values()) > whole


def test_nothing_is_kept_in_memory_while_models_are_fitted(spark, labelled, monkeypatch):
    """Seen as each classifier begins and at each tree of the boosting, of two benchmarks in a row."""
    labelled.count()  # it is cached itself
    before, seen = kept(spark), []
    root, choose = SecondOrderBoosting._root, ModelChoice.classifier

    def look(call):
        def wrapped(*args, **options):
            found = call(*args, **options)
            seen.append(kept(spark, before))
            return found
        return wrapped

    monkeypatch.setattr(benchmark, "fit_parts", lambda rows: 4)
    monkeypatch.setattr(SecondOrderBoosting, "_root", look(root))
    monkeypatch.setattr(ModelChoice, "classifier", look(choose))
    train, valid = stratified_split(labelled, "id", "y")
    models = {k: m for k, m in default_models(logistic={"max_iter": 2}, boosted={"rounds": 5, "depth": 1}).items() if k != FOREST}
    got = benchmark.ablation(train, valid, "id", "y", "x", models).collect()
    assert {r["model"] for r in got} == {LOGISTIC, BOOSTED}
    assert len(seen) == 2 * (2 + 5) and any(d > 0 for s in seen for _, d in s.values())
    assert all(m == 0 for s in seen for m, _ in s.values()), seen


def test_separable_rows_reach_a_high_auc(labelled, spec):
    scores = benchmark.run_benchmark(labelled, spec, RULES, models=default_models(**SMALL)).collect()
    assert {r["model"] for r in scores} == {LOGISTIC, FOREST, BOOSTED}
    assert all(r["auc"] > 0.95 for r in scores), scores
    assert [r["auc"] for r in scores] == sorted((r["auc"] for r in scores), reverse=True)


def test_shuffled_labels_stay_near_chance(spark, labelled, spec):
    shuffled = labelled.withColumn("y", (F.xxhash64("id") % 2 == 0).cast("int"))
    row = benchmark.run_benchmark(shuffled, spec, RULES, models={LOGISTIC: default_models(**SMALL)[LOGISTIC]}).first()
    assert row["auc"] == pytest.approx(0.5, abs=0.15)


def test_logistic_solves_the_penalised_problem(labelled):
    """Gradient of sum-of-losses + 0.5 |w|^2 over population-scaled features is zero at the fit."""
    train = labelled.select("id", "y", "x", "noise")
    encoder, a, _ = benchmark.encode_pair(train, train, "id", "y", scale=True)
    model = default_models(logistic={"max_iter": 200})[LOGISTIC].classifier(encoder.rows).fit(a)
    pdf = train.toPandas()
    x = pdf[["x", "noise"]].to_numpy()
    w = model.coefficients.toArray() * x.std(axis=0) / x.std(axis=0, ddof=1)
    z = x / x.std(axis=0)
    p = 1 / (1 + np.exp(-(z @ w + model.intercept)))
    assert np.abs(z.T @ (p - pdf["y"]) + w).max() < 0.05
    assert abs((p - pdf["y"]).sum()) < 0.05


def test_models_score_rows_after_something_was_observed_in_the_session(spark, labelled):
    """A model that carries its training summary carries the session, which cannot be sent to the tasks from then on."""
    seen = Observation()
    labelled.observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 600}
    train, valid = stratified_split(labelled, "id", "y")
    scores, (_, fitted) = benchmark.fit_models(train, valid, "id", "y", default_models(**SMALL))
    assert set(scores) == {LOGISTIC, FOREST, BOOSTED} and all(s > 0.8 for s in scores.values())
    assert not fitted[LOGISTIC].hasSummary and not fitted[FOREST].hasSummary
    assert fitted[LOGISTIC].getMaxIter() == 30 and fitted[FOREST].getNumTrees == 8


def test_a_model_without_its_summary_is_the_same_model(labelled):
    encoder, a, _ = benchmark.encode_pair(labelled, labelled, "id", "y", scale=True)
    models = default_models(**SMALL)
    first, second = models[LOGISTIC].classifier(encoder.rows).fit(a), models[LOGISTIC].fit(a, encoder.rows)
    assert (first.coefficients, first.intercept, first.getRegParam()) == (second.coefficients, second.intercept, second.getRegParam())
    first, second = models[FOREST].classifier(encoder.rows).fit(a), models[FOREST].fit(a, encoder.rows)
    assert first.toDebugString.split("\n", 1)[1] == second.toDebugString.split("\n", 1)[1]
    assert first.featureImportances == second.featureImportances


def test_ablation_of_the_useful_column(labelled):
    train, valid = stratified_split(labelled, "id", "y")
    models = {LOGISTIC: default_models(**SMALL)[LOGISTIC]}
    row = benchmark.ablation(train, valid, "id", "y", "x", models).first()
    assert row["diff"] == pytest.approx(row["auc_with"] - row["auc_without"]) and row["diff"] > 0.02


def test_importance_finds_the_useful_columns(labelled):
    table = benchmark.feature_importance(labelled, "id", "y", default_models(**SMALL)[FOREST], top_n=3).collect()
    assert {r["feature"] for r in table} == {"x", "ohe__k__Yes", "ohe__k__no!"}


def test_raw_and_clean_versions(labelled):
    halves = stratified_split(labelled, "id", "y")
    dull = tuple(df.drop("x") for df in halves)
    got = benchmark.raw_vs_clean({"full": halves, "dull": dull}, "id", "y", older_models()[LOGISTIC]).collect()
    assert [r["data"] for r in got] == ["full", "dull"]


def test_predict_best_writes_one_probability_per_row(spark, labelled, spec, tmp_path):
    models = {k: m for k, m in default_models(**SMALL).items() if k != BOOSTED}
    rows = people(spark, n=150, seed=9)
    out = str(tmp_path / "predictions")
    best = scoring.predict_best(labelled, rows, spec, RULES, models, output=out)
    assert best.model in models and best.auc > 0.95
    written = read_csv(spark, out)
    assert written.dtypes == [("id", "bigint"), ("probability", "double")] and written.count() == 150
    joined = written.join(rows, "id")
    gap = joined.groupBy("y").agg(F.avg("probability")).orderBy("y").collect()
    assert gap[1][1] - gap[0][1] > 0.3
    named = scoring.prediction_table(best.predictions, "id", "Client_ID", "Drop_Probability")
    assert named.columns == ["Client_ID", "Drop_Probability"]


def test_adversarial_finds_the_shifted_column(spark):
    a = people(spark, n=300, seed=1).withColumn("id", F.col("id") * 2)
    b = people(spark, n=200, seed=2, shift=3.0).drop("y").withColumn("id", F.col("id") * 2 + 1)
    tagged = tag_sources(a, b)
    prepared = adversarial.prepare_sources(tagged, "id", leaks=["y"])
    settings = {"forest": {"trees": 8, "min_leaf": 5}, "boosted": {"rounds": 4}}
    fitted = adversarial.fit_source_models(prepared, "id", models=source_models(**settings))
    assert all(r["source_auc"] > 0.9 for r in fitted.scores.collect())
    report = adversarial.drift_report(tagged, fitted, top_n=1).collect()
    assert report[0]["feature"] == "x" and report[0]["test_mean"] - report[0]["train_mean"] > 2


def test_balanced_weights(spark):
    df = spark.createDataFrame([(0.0,)] * 3 + [(1.0,)], "label double")
    assert adversarial.balanced_weights(df, "label") == {0.0: pytest.approx(4 / 6), 1.0: 2.0}


def test_reference_settings_are_the_defaults():
    models = default_models()
    forest, boosted = models[FOREST].classifier(100), models[BOOSTED].classifier(100)
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getFeatureSubsetStrategy()) == (300, 12, "sqrt")
    assert (boosted.rounds, boosted.depth, boosted.rate, boosted.share, boosted.columns) == (300, 5, 0.05, 0.9, 0.9)
    assert models[LOGISTIC].classifier(100).getMaxIter() == 2000
    assert source_models()[FOREST].classifier(1).getMinInstancesPerNode() == 20


def test_checkpoint_folder_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or checkpoint_dir(spark) == configured
