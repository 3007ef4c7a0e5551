import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyframe.operators import boosting
from tallyframe.operators.boosting import BINS, SecondOrderBoosting
from tallyframe.operators.encode import fit_encoder
from tallyframe.operators.models import BOOSTED, default_models
from tallyframe.plans import benchmark


def table(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    x, z = rng.normal(size=n).round(2), rng.integers(0, 4, n).astype(float)
    k = rng.choice(["a", "b", "c"], n)
    y = (x + (k == "b") * 1.5 + rng.normal(size=n) * 0.5 > 0.5).astype(float)
    return spark.createDataFrame(pd.DataFrame({"id": range(n), "label": y, "x": x, "z": z, "k": k}))


def encoded(df):
    encoder = fit_encoder(df, ["k"], ["x", "z"])
    return encoder, encoder.transform(df, keep=["id", "label"], parts=True)


def plain(features, cuts, y, rounds, depth, rate, penalty, least):
    """Second-order boosting with all rows and columns, one candidate after the other; margins of all rows after each tree."""
    margin, after = np.zeros(len(y)), []
    binned = [np.searchsorted(cuts[j], features[:, j], "right") if j < len(cuts) else features[:, j].astype(int) for j in range(features.shape[1])]

    def grow(rows, level):
        g, h = grad[rows].sum(), hess[rows].sum()
        best = (1e-6, None)
        for j, b in enumerate(binned if level < depth else []):
            for least_bin in sorted(set(b[rows].tolist()) - {0}):
                right = b[rows] >= least_bin
                gr, hr = grad[rows][right].sum(), hess[rows][right].sum()
                if hr >= least and h - hr >= least:
                    gain = (g - gr) ** 2 / (h - hr + penalty) + gr**2 / (hr + penalty) - g**2 / (h + penalty)
                    if gain > best[0] + 1e-9:
                        best = (gain, (j, least_bin))
        if best[1] is None:
            step[rows] = -rate * g / (h + penalty)
            return
        j, least_bin = best[1]
        right = binned[j][rows] >= least_bin
        grow(rows[~right], level + 1)
        grow(rows[right], level + 1)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        grad, hess, step = p - y, p * (1 - p), np.zeros(len(y))
        grow(np.arange(len(y)), 0)
        margin = margin + step
        after.append(margin)
    return after


def test_trees_are_those_of_a_plain_version(spark, monkeypatch):
    monkeypatch.setattr(boosting, "CUT", 2)  # rows are written on the way
    df = table(spark)
    _, rows = encoded(df)
    settings = SecondOrderBoosting(rounds=5, depth=3, rate=0.3, share=1.0, columns=1.0, bins=16, exact=True)
    grown = settings.grow(rows)
    assert len(grown.trees) == 5 and grown.width == 5 and all(len(c) <= 15 for c in grown.cuts)
    pdf = rows.select("id", "label", vector_to_array("features").alias("f")).orderBy("id").toPandas()
    want = plain(np.stack(pdf["f"]), grown.cuts, pdf["label"].to_numpy(), 5, 3, 0.3, 1.0, 1.0)
    model = boosting.to_mllib(spark, grown, 0.3, 1.0)
    got = model.transform(rows).select("id", vector_to_array("probability")[1].alias("p"), vector_to_array("rawPrediction")[1].alias("m")).orderBy("id").toPandas()
    assert np.allclose(2 * got["m"], want[-1], atol=1e-9) and np.allclose(got["p"], 1 / (1 + np.exp(-want[-1])), atol=1e-9)


def leaves(node, path=()):
    if node.code is None:
        return [(path, node.rows, node.gradient, node.hessian)]
    return [x for side, c in enumerate(node.children) for x in leaves(c, (*path, (*divmod(node.code, BINS), side)))]


def test_sums_of_the_first_tree(spark):
    _, rows = encoded(table(spark))
    root = SecondOrderBoosting(rounds=1, depth=4, share=1.0, columns=1.0, bins=32, exact=True).grow(rows).trees[0]
    assert root.rows == 400 == sum(n for _, n, _, _ in leaves(root)) and root.hessian == 100.0
    assert sum(g for _, _, g, _ in leaves(root)) == pytest.approx(root.gradient)
    assert all(h >= 1.0 and h == n / 4 for _, n, _, h in leaves(root))


def test_draws_do_not_depend_on_the_layout(spark):
    df = table(spark)
    settings = SecondOrderBoosting(rounds=4, depth=3, share=0.7, columns=0.7)
    models = [settings.grow(encoded(d)[1]) for d in (df, df.repartition(7), df.orderBy(F.desc("id")).coalesce(1))]
    shapes = [[leaves(t) for t in m.trees] for m in models]
    for other in shapes[1:]:
        assert [[(p, n) for p, n, *_ in t] for t in other] == [[(p, n) for p, n, *_ in t] for t in shapes[0]]
    assert {m.trees[0].rows for m in models} != {400}


def test_as_a_model_it_is_saved_and_explains_itself(spark, tmp_path):
    df = table(spark, 600)
    encoder, rows = encoded(df)
    model = default_models(boosted={"rounds": 20, "depth": 3, "rate": 0.3})[BOOSTED].classifier(600).fit(rows)
    PipelineModel([model]).write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    p = lambda m: [r[0] for r in m.transform(rows).orderBy("id").select(vector_to_array("probability")[1]).collect()]
    assert p(model) == p(again)
    weights = {r["feature"]: r["importance"] for r in benchmark.importance_table(spark, model, encoder).collect()}
    assert set(weights) == set(encoder.names) and sum(weights.values()) == pytest.approx(1.0) and weights["x"] == max(weights.values())


def test_degenerate_rows(spark):
    same = spark.createDataFrame([(i, 1.0, 2.0, "a") for i in range(9)], "id long, label double, x double, k string")
    encoder = fit_encoder(same, ["k"], ["x"])
    model = SecondOrderBoosting(rounds=3).fit(encoder.transform(same, keep=["id", "label"], parts=True))
    assert model.getNumTrees == 3 and model.totalNumNodes == 3
    with pytest.raises(ValueError):
        SecondOrderBoosting(rounds=1).fit(encoder.transform(same.limit(0), keep=["id", "label"], parts=True))


def test_parts_grow_with_the_rows():
    assert benchmark.fit_parts(0) == benchmark.fit_parts(32_000_000) == 32
    assert benchmark.fit_parts(10**10) == 10_000 and benchmark.fit_parts(100, part_rows=10, least=1) == 10


def test_the_number_of_tasks_of_a_fit_follows_the_rows(spark, monkeypatch):
    monkeypatch.setattr(benchmark, "fit_parts", lambda rows: rows // 50)
    df = table(spark).withColumnRenamed("label", "y")
    _, a, _ = benchmark.encode_pair(df, df.limit(0), "id", "y", scale=False)
    assert a.rdd.getNumPartitions() == 8


def test_sums_in_place_are_those_of_sorted_keys(monkeypatch):
    """Two numbers and three categories, several batches; sums in place need no sorting at all."""
    rng = np.random.default_rng(3)
    batches = []
    for _ in range(3):
        entries = [sorted({int(rng.integers(1, 256)), 256 + int(rng.integers(1, 256)), (2 + int(rng.integers(3))) * 256 + 1}) for _ in range(500)] + [[]]
        columns = [pa.array(rng.integers(0, 4, 501), pa.int32()), pa.array(rng.normal(size=501)), pa.array(rng.random(501)), pa.array(entries, pa.list_(pa.int64()))]
        batches.append(pa.RecordBatch.from_arrays(columns, ["node", "g", "h", "entries"]))
    read = lambda: pa.Table.from_batches(boosting._histograms(iter(batches), 4, 2, 5)).to_pydict()
    with monkeypatch.context() as patch:
        patch.setattr(boosting, "DENSE", 0)
        plain = read()
    monkeypatch.setattr(boosting, "_summed", None)
    assert read() == plain and sum(plain["n"]) == 4500
