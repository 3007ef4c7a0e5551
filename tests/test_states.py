"""Stored profiles: merged states against a full profile, quantiles made exact, overlaps within their margin."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.operators import order, states
from tests.conftest import pairs

COLUMNS = ["x", "n", "flag", "label", "none"]


@pytest.fixture(scope="module")
def table(spark):
    rnd = random.Random(11)
    rows = [
        (i, i % 5, rnd.choice([None, math.nan, rnd.gauss(1e6, 3), 0.0, -0.0]), rnd.choice([None, rnd.randrange(300)]),
         rnd.choice([True, False, None]), rnd.choice(["", "a", "b", None, f"v{rnd.randrange(900)}"]), None)
        for i in range(6000)
    ]
    return spark.createDataFrame(rows, "id long, day int, x double, n int, flag boolean, label string, none double").cache()


def check(report, table):
    pdf = table.toPandas()
    for row in pairs(report):
        c = row["column"]
        values = pdf[c].dropna()
        if c == "label":
            values = pdf[c][[v is not None for v in pdf[c]]]
            assert row["mean"] is row["std"] is row["min"] is row["q50"] is None
        assert row["rows"] == len(pdf) and row["missing_pct"] == pytest.approx(100 * (1 - len(values) / len(pdf)))
        assert row["distinct"] == values.nunique()
        if c not in ("label", "none"):
            numbers = np.sort(values.astype(float).to_numpy())
            assert row["mean"] == pytest.approx(numbers.mean()) and row["std"] == pytest.approx(numbers.std(ddof=1), rel=1e-9)
            assert (row["min"], row["max"]) == (numbers[0], numbers[-1])
            low, high = (numbers[int(len(numbers) * (0.5 + side * 2 * states.RANK_ERROR))] for side in (-1, 1))
            assert low <= row["q50"] <= high


def test_states_of_parts_are_those_of_the_table(spark, table):
    by_day = states.column_states(table, COLUMNS, ["day"])
    assert by_day.count() == 25
    once = states.merge_states(by_day)
    twice = states.merge_states(states.merge_states(by_day.where("day < 2")).unionByName(states.merge_states(by_day.where("day >= 2"))))
    for merged in (states.column_states(table, COLUMNS), once, twice):
        assert merged.count() == 5
        check(states.describe_states(merged), table)
    assert states.column_states(table.limit(0), COLUMNS).collect() == []
    assert states.describe_states(states.merge_states(by_day.limit(0))).collect() == []


def test_recording_a_part_again_replaces_it(spark, table, tmp_path):
    path = str(tmp_path / "states")
    states.record_states(table.where("day < 4"), COLUMNS, "day", path)
    states.record_states(table.where("day = 4"), COLUMNS, "day", path)
    states.record_states(table.where("day = 2"), COLUMNS, "day", path)
    merged = states.merge_states(states.read_states(spark, path))
    check(states.describe_states(merged), table)


def test_exact_quantiles_save_the_first_passes(spark, table, monkeypatch):
    shares = (0.0, 0.1, 0.5, 0.999, 1.0)
    keys = {c: F.col(c) for c in ("x", "n", "flag", "none")}
    merged = states.merge_states(states.column_states(table, COLUMNS, ["day"]))
    want = order.quantiles(table, keys, shares, finish_rows=500)
    refuse = lambda *a: pytest.fail("a pass that the states save")
    monkeypatch.setattr(order, "spans", refuse)
    monkeypatch.setattr(order, "_edges", refuse)
    assert states.exact_quantiles(table, merged, shares, finish_rows=500) == want


def test_bounds_that_are_off_cost_passes_only(spark, table):
    want = order.quantiles(table, {"x": F.col("x")}, (0.3, 0.5), finish_rows=200)
    for bounds in ([], [-1e9, 1e9], [0.0], [1e6, 1e6 + 1]):
        assert order.quantiles(table, {"x": F.col("x")}, (0.3, 0.5), finish_rows=200, bounds={"x": bounds}) == want


def test_overlap(spark):
    left = spark.range(50_000).select(F.col("id").alias("many"), (F.col("id") % 900).cast("string").alias("few"), F.lit(None).cast("int").alias("none"))
    right = spark.range(30_000).select((F.col("id") + 35_000).alias("many"), (F.col("id") % 1500 + 100).cast("string").alias("few"), F.lit(None).cast("int").alias("none"))
    got = {r["column"]: r for r in pairs(states.value_overlap(*[states.column_states(d, ["many", "few", "none"]) for d in (left, right)]))}
    few, many, none = got["few"], got["many"], got["none"]
    assert (few["train_distinct"], few["test_distinct"], few["common"], few["margin"]) == (900, 1500, 800, 0)
    assert few["share"] == pytest.approx(800 / 1500)
    assert abs(many["common"] - 15_000) <= many["margin"] < 3000
    assert abs(many["train_distinct"] - 50_000) < 3 / 64 * 50_000
    assert (none["train_distinct"], none["common"], none["share"]) == (0, 0, None)
