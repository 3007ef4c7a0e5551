"""Leaders by a sketch and a proof: the same rows as with every value counted, and few values counted."""

import random
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyframe.operators import heavy, profile, rates
from tests.conftest import pairs


@pytest.fixture
def few_seeds(monkeypatch):
    monkeypatch.setattr(heavy, "SEEDS", 2)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.none() | st.integers(0, 40), max_size=120), st.integers(1, 6), st.integers(1, 4), st.sampled_from([1, 4, 16]))
def test_no_leader_is_left_out(spark, few_seeds, values, k, least, buckets):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v int, i int")
    kept = Counter(r["v"] for r in heavy.possible_leaders(df, F.col("v"), k, least, buckets=buckets).collect())
    counts = Counter(values)
    assert all(kept[v] == counts[v] for v in kept)
    large = sorted((n for n in counts.values() if n >= least), reverse=True)
    floor = large[min(k, len(large)) - 1] if large else 1
    assert all(v in kept for v, n in counts.items() if n >= max(floor, least))


def test_rare_values_are_not_counted(spark):
    """200,000 values of one row and 30 of many: hardly any of the rare ones are left."""
    hot = spark.range(30 * 2000).select((-F.col("id") % 30 - 1).alias("v"))
    df = spark.range(200_000).select(F.col("id").alias("v")).union(hot)
    kept = heavy.possible_leaders(df, F.col("v"), 20)
    assert kept.where("v < 0").count() == 30 * 2000
    assert kept.where("v >= 0").distinct().count() < 200


def test_bucket_counts_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(heavy, "ALL_BUCKETS", 256)
    seen = []
    stage = heavy.stage
    monkeypatch.setattr(heavy, "stage", lambda df, label: seen.append(stage(df, label)) or seen[-1])
    df = spark.range(20_000).select((F.col("id") % 8).alias("g"), F.col("id").alias("v"))
    assert heavy.possible_leaders(df, F.col("v"), 3, group=F.col("g"), groups=8).count() == 20_000  # all as frequent as each other
    assert [part.count() for part in seen] == [3 * 256] * 2


@pytest.mark.parametrize("normalize", [False, True])
def test_reports_give_the_same_rows(spark, normalize):
    rnd = random.Random(6)
    spelled = ["Alpha", "alpha!", " ALPHA ", "beta", "Beta and Co", "beta & co", None, "?", "nan"]
    rows = [(rnd.choice(spelled) if rnd.random() < 0.5 else f"rare {rnd.randrange(400)}", rnd.randrange(60), rnd.choice([0, 1, None])) for _ in range(1500)]
    df = spark.createDataFrame(rows, "label string, id int, y int")
    df = df.coalesce(2)
    want = pairs(rates.cat_rate_table(df, ["label", "id"], "y", 3, 4, normalize))
    assert pairs(rates.cat_rate_table(df, ["label", "id"], "y", 3, 4, normalize, many_values=True)) == want
    if normalize:
        return
    for report, column, kwargs in (
        (rates.rate_by_category, "label", {"top_n": 3}),
        (rates.rate_by_id, "id", {"min_count": 2}),
        (rates.top_category_rates, "id", {"min_count": 1}),
        (profile.top_counts_by_target, "label", {"k": 5}),
    ):
        assert pairs(report(df, column, "y", many_values=True, **kwargs)) == pairs(report(df, column, "y", **kwargs))
    assert pairs(rates.rate_by_category(df.limit(0), "id", "y", many_values=True)) == []
