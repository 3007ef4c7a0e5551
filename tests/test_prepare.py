from functools import partial

import pytest
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from tallyframe.operators import encode
from tallyframe.operators.order import numbered
from tallyframe.plans import prepare
from tallyframe.spec import TableSpec
from tests.conftest import pairs

SCHEMA = "id bigint, y int, d string, hours double, cost double, agent double, company double, ask string, got string, lanyard string"
TRAIN = [
    (1, 0, "2015-07-01", 1.0, 10.0, 9.0, None, "Std PC!", "std pc", "Blu#e"),
    (2, 1, "2015-07-02", 10000.0, None, 9.0, 3.0, "?", "std pc", "red"),
    (3, 1, "2015-07-02", 3.0, 600.0, None, None, None, "mac", "red"),
    (4, 0, None, -5.0, 30.0, 4.0, None, "MAC", "mac", "Unknown"),
]
RULES = prepare.PrepareRules(
    presence={"company": "has_company"}, missing_flags=("agent", "cost", "ask"), min_counts={"agent": 2},
    drop_reduced=("company", "agent_missing"), match=("received", "ask", "got"), drop_features=("got", "lanyard"),
    caps={"hours": (0, 8), "cost": (None, 500)},
)


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame(TRAIN, SCHEMA)


@pytest.fixture(scope="module")
def spec(train):
    return TableSpec.infer(train, id="id", target="y", date="d", id_like=("agent", "company"))


def test_roles(spec):
    assert spec.nums == ("hours", "cost") and spec.cats == ("ask", "got", "lanyard")


def test_whole_chain(train, spec):
    fitted = prepare.fit_prepare(train, spec, RULES)
    assert dict(fitted.medians) == {"hours": 2.0, "cost": 30.0}
    got = {r.pop("id"): r for r in pairs(prepare.prepare(train, fitted))}
    assert got[1] == {"y": 0, "hours": 1.0, "cost": 10.0, "agent": "9", "ask": "std pc", "has_company": 0,
                      "cost_missing": 0, "ask_missing": 0, "received": 1}
    # A placeholder becomes "missing" but is not flagged; flags look at the raw value.
    assert (got[2]["ask"], got[2]["ask_missing"], got[2]["cost"], got[2]["cost_missing"]) == ("missing", 0, 30.0, 1)
    assert (got[3]["ask"], got[3]["ask_missing"], got[3]["agent"], got[3]["cost"]) == ("missing", 1, "missing", 500.0)
    assert (got[4]["agent"], got[4]["hours"], got[4]["received"]) == ("other", 0.0, 1)
    assert got[2]["hours"] == 8.0 and got[2]["has_company"] == 1


def test_other_rows_do_not_move_fitted_values(train, spec, spark):
    fitted = prepare.fit_prepare(train, spec, RULES)
    odd = spark.createDataFrame([(9, 1, "x", None, None, 77.0, None, "zz", "zz", None)], SCHEMA)
    row = prepare.prepare(odd, fitted).first()
    assert (row["hours"], row["cost"], row["agent"], row["received"]) == (2.0, 30.0, "other", 1)
    scoring = prepare.prepare(odd.drop("y", "company"), fitted)
    assert "y" not in scoring.columns and "has_company" not in scoring.columns


def test_many_kept_values_use_a_table(train, spec, monkeypatch):
    want = sorted(map(tuple, prepare.prepare_from(train, train, spec, RULES).collect()))
    monkeypatch.setattr(prepare, "LITERAL_LIMIT", 0)
    monkeypatch.setattr("tallyframe.operators.cardinality.LITERAL_LIMIT", 0)
    fitted = prepare.fit_prepare(train, spec, RULES)
    assert fitted.kept[0].table is not None
    assert sorted(map(tuple, prepare.prepare(train, fitted).collect())) == want


def test_preparation_is_one_projection(train, spec):
    fitted = prepare.fit_prepare(train, spec, RULES)
    plan = prepare.prepare(train, fitted)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_calendar_preparation(train, spark):
    df = train.where("d is not null").select("id", "d", "agent", "company", "lanyard")
    row = prepare.prepare_calendar(df, "d", ["agent"], {"company": "has_company"}).orderBy("id").first()
    assert row.asDict() == {"id": 1, "agent": 9.0, "lanyard": "blu#e", "agent_is_missing": 0, "has_company": 0,
                            "d_month": 7, "d_weekday": 2}


@pytest.mark.parametrize("hot", [1_000, 1])
def test_one_hot_with_broadcast_and_with_shuffled_categories(spark, monkeypatch, hot):
    monkeypatch.setattr(encode, "HOT", hot)
    a = spark.createDataFrame([(i, "hot" if i % 3 else f"v{i % 7}") for i in range(50)], "id bigint, k string")
    got = {tuple(r) for r in encode.onehot_long(a.where("id > 5"), "id", ["k"], a.where("id < 15")).collect()}
    seen = {r["k"] for r in a.where("id < 15").collect()}
    assert got == {(r["id"], f"ohe__k__{r['k']}", 1.0) for r in a.where("id > 5").collect() if r["k"] in seen}


def test_one_hot_ignores_unseen_values(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id bigint, k string")
    b = spark.createDataFrame([(7, "z"), (8, "a")], "id bigint, k string")
    assert [tuple(r) for r in encode.onehot_long(b, "id", ["k"], a).collect()] == [(8, "ohe__k__a", 1.0)]
    encoder = encode.fit_encoder(a, ["k"], [])
    assert encoder.names == ("ohe__k__a", "ohe__k__b", "ohe__k__c")
    rows = {r["id"]: r["features"].toArray().tolist() for r in encoder.transform(b).collect()}
    assert rows == {7: [0.0, 0.0, 0.0], 8: [1.0, 0.0, 0.0]}


def test_columns_with_different_numbers_of_values(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("b", "x", 2.0), (None, "x", 3.0)], "k string, l string, n double")
    encoder = encode.fit_encoder(df, ["k", "l"], ["n"], scale=True)
    assert encoder.names == ("n", "ohe__k__a", "ohe__k__b", "ohe__k__missing", "ohe__l__x")
    assert encode.encoded_width(df.fillna("missing"), ["k", "l"], ["n"]) == 5
    first = encoder.transform(df).select("features", "scaled_features").first()
    assert first[0].toArray().tolist() == [1.0, 1.0, 0.0, 0.0, 1.0]
    assert first[1].toArray().tolist()[0] == pytest.approx(1.0)


def test_many_categories_give_the_vectors_of_a_plain_listing(spark, monkeypatch):
    """More categories than are broadcast, a hot one, values unseen in training, several ranges of slots, numbers that are zero."""
    monkeypatch.setattr(encode, "HOT", 3)
    monkeypatch.setattr(encode, "numbered", partial(numbered, range_rows=100))
    rows = [(i, "hot" if i % 3 else f"v{i % 700}", None if i % 5 == 0 else f"w{i % 11}", float(i % 4)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id bigint, k string, l string, x double")
    train = df.where("id < 2500")
    encoder = encode.fit_encoder(train, ["k", "l"], ["x"])
    levels = [sorted({(r[c] or "missing") for r in rows[:2500]}) for c in (1, 2)]
    assert encoder.names == ("x", *(f"ohe__k__{v}" for v in levels[0]), *(f"ohe__l__{v}" for v in levels[1]))
    got = {r["id"]: r["features"] for r in encoder.transform(df, keep=["id"]).collect()}
    assert len(got) == 3000
    for i, k, l, x in rows:
        slots = [1 + levels[0].index(k)] if k in levels[0] else []
        slots += [1 + len(levels[0]) + levels[1].index(l or "missing")]
        want = SparseVector(encoder.width, {**({0: x} if x else {}), **dict.fromkeys(slots, 1.0)})
        assert got[i] == want and list(got[i].indices) == sorted(got[i].indices)


def test_repeated_rows_are_encoded_each(spark):
    df = spark.createDataFrame([(1, "a", 1.0)] * 5 + [(1, "b", 2.0)], "id bigint, k string, x double")
    encoder = encode.fit_encoder(df, ["k"], ["x"])
    assert sorted(map(str, (r["features"] for r in encoder.transform(df).collect()))) == ["(3,[0,1],[1.0,1.0])"] * 5 + ["(3,[0,2],[2.0,1.0])"]
    with pytest.raises(Exception, match="missing"):
        encoder.transform(df.withColumn("x", F.lit(None).cast("double"))).collect()


def test_hashed_encoding_has_no_limit_and_keeps_every_value(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("b", "x", 2.0), (None, "y", 3.0)], "k string, l string, n double")
    encoder = encode.fit_encoder(df, ["k", "l"], ["n"], scale=True, hashed=64)
    assert encoder.names == ("n", *(f"hashed__{i}" for i in range(64)))
    out = encoder.transform(df)
    assert set(out.columns) == {"k", "l", "n", "features", "scaled_features"}
    vectors = [r["features"].toArray() for r in out.orderBy("n").collect()]
    assert [v[0] for v in vectors] == [1.0, 2.0, 3.0] and all(len(v) == 65 and v[1:].sum() == 2 for v in vectors)
    unseen = encoder.transform(spark.createDataFrame([("z", "x", 1.0)], df.schema)).first()["features"].toArray()
    assert unseen[1:].sum() == 2
    assert encode.fit_encoder(df, [], ["n"], hashed=64).names == ("n",)


def test_scaling_uses_the_population_spread(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "x double, c double")
    got = [tuple(r) for r in encode.scale_standard(df, ["x", "c"]).collect()]
    assert [r[0] for r in got] == pytest.approx([-1.224745, 0.0, 1.224745], abs=1e-6)
    assert [r[1] for r in got] == [0.0, 0.0, 0.0]


def test_preparation_also_runs_on_a_stream(train, spec, spark, tmp_path):
    fitted = prepare.fit_prepare(train, spec, RULES)
    source = str(tmp_path / "in")
    train.write.parquet(source)
    stream = prepare.prepare(spark.readStream.schema(train.schema).parquet(source), fitted)
    query = stream.writeStream.format("memory").queryName("prepared_rows").outputMode("append").start()
    query.processAllAvailable()
    query.stop()
    assert spark.table("prepared_rows").count() == 4


def test_few_categories_give_the_vectors_of_the_shuffled_way_without_it(spark, monkeypatch):
    """Few categories are met where a row is read: the rows are not written, taken apart and shuffled for that."""
    rows = [(i, None if i % 7 == 0 else f"v{i % 5}", f"w{i % 3}", float(i % 4), -0.0 if i % 2 else 2.5) for i in range(200)]
    df = spark.createDataFrame(rows, "id bigint, k string, l string, x double, z double")
    encoder = encode.fit_encoder(df.where("id < 150 and l <> 'w2'"), ["k", "l"], ["x", "z"])
    staged, written = encode.stage, []
    monkeypatch.setattr(encode, "stage", lambda rows, label, **more: written.append(label) or staged(rows, label, **more))
    read = lambda: [tuple(r) for r in encoder.transform(df, keep=["id"], parts=True).orderBy("id").collect()]
    direct = read()
    assert written == ["encoded-rows"] and len(direct) == 200
    monkeypatch.setattr(encode, "JOINED", 0)
    assert read() == direct
    assert written == ["encoded-rows", "encode-rows", "encoded-rows"]
