"""Exact order statistics against numpy, forced through every stage of the search."""

import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyframe.operators.order import order_statistics, quantiles

PROBS = (0.0, 0.01, 0.25, 1 / 3, 0.5, 0.9, 0.999, 1.0)
TUNING = [{}, {"finish_rows": 10, "accuracy": 4}, {"finish_rows": 1, "accuracy": 2}, {"finish_rows": 50, "accuracy": 64}]


def frame(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")


@pytest.mark.parametrize("tuning", TUNING)
def test_skewed_distribution_with_a_hot_value_and_far_outliers(spark, tuning):
    rng = random.Random(1)
    values = [7.0] * 400 + [rng.expovariate(1.0) for _ in range(700)] + [1e12, -1e12, 5e-300, 0.0]
    got = quantiles(frame(spark, values), {"x": F.col("x")}, PROBS, **tuning)["x"]
    assert got == pytest.approx(list(np.quantile(values, PROBS)), rel=1e-12)


def test_several_columns_and_missing_values_share_the_passes(spark):
    rows = [(float(i % 17), i, None if i % 3 else float(i)) for i in range(500)]
    df = spark.createDataFrame(rows, "a double, b bigint, c double")
    got = quantiles(df, {c: F.col(c) for c in "abc"}, PROBS, finish_rows=20, accuracy=8)
    for i, c in enumerate("abc"):
        present = [r[i] for r in rows if r[i] is not None]
        assert got[c] == pytest.approx(list(np.quantile(present, PROBS)))


def test_large_integers_keep_every_digit(spark):
    values = [2**62 + i for i in range(100)] + [-(2**62)]
    df = spark.createDataFrame([(v,) for v in values], "x bigint")
    found = order_statistics(df, {"x": F.col("x")}, {"x": [0, 1, 50, 100]}, finish_rows=2, accuracy=4)
    ordered = sorted(values)
    assert [found["x", r].value for r in (0, 1, 50, 100)] == [ordered[r] for r in (0, 1, 50, 100)]


def test_rank_tells_rows_below_and_equal(spark):
    found = order_statistics(frame(spark, [1, 2, 2, 2, 3]), {"x": F.col("x")}, {"x": [2]})
    assert (found["x", 2].value, found["x", 2].below, found["x", 2].rows) == (2.0, 1, 3)


def test_nan_counts_as_missing_and_infinity_is_a_value(spark):
    df = frame(spark, [math.nan, 1.0, 2.0, math.inf, -math.inf, None])
    found = order_statistics(df, {"x": F.col("x")}, {"x": [0, 1, 2, 3]}, finish_rows=1, accuracy=2)
    assert [found["x", r].value for r in range(4)] == [-math.inf, 1.0, 2.0, math.inf]


def test_empty_and_all_missing(spark):
    assert quantiles(frame(spark, [None, None]), {"x": F.col("x")}, [0.5])["x"] == [None]
    assert quantiles(frame(spark, []).where("x > 0"), {"x": F.col("x")}, [0.1, 0.9])["x"] == [None, None]


def test_sketch_mode_is_close(spark):
    df = spark.range(10_000).select(F.col("id").cast("double").alias("x"))
    assert quantiles(df, {"x": F.col("x")}, [0.5], exact=False)["x"][0] == pytest.approx(5000, abs=5)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=32), min_size=1, max_size=60))
def test_any_values_match_sorting(spark, values):
    values = [float(v) for v in values]
    ranks = sorted({0, len(values) // 3, len(values) - 1})
    found = order_statistics(frame(spark, values), {"x": F.col("x")}, {"x": ranks}, finish_rows=3, accuracy=3)
    assert [found["x", r].value for r in ranks] == [sorted(values)[r] for r in ranks]


@pytest.mark.parametrize("shape", ["powers", "pareto", "hot", "outliers", "whole"])
def test_number_of_passes_does_not_depend_on_the_values(spark, shape, monkeypatch):
    from tallyframe.operators import order

    rng = random.Random(8)
    values = {
        "powers": [10.0 ** (i % 600 - 300) for i in range(6000)],
        "pareto": [rng.paretovariate(0.1) for _ in range(6000)],
        "hot": [1.0] * 4000 + [rng.random() for _ in range(2000)],
        "outliers": [rng.random() for _ in range(5990)] + [10.0**k for k in range(10, 310, 30)],
        "whole": [2**62 + i * i for i in range(6000)],
    }[shape]
    passes = {"n": 0}

    def counted(name):
        inner = getattr(order, name)

        def run(*args):
            passes["n"] += 1
            return inner(*args)

        monkeypatch.setattr(order, name, run)

    for name in ("spans", "_edges", "_with_rank"):  # one pass over the table each
        counted(name)
    kind = "bigint" if shape == "whole" else "double"
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    ranks = [0, 1500, 3000, 5400, 5999]
    found = order.order_statistics(df, {"x": F.col("x")}, {"x": ranks}, finish_rows=600, accuracy=100)
    assert [found["x", r].value for r in ranks] == [sorted(values)[r] for r in ranks]
    assert passes["n"] <= 5
