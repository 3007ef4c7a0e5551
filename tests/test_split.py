import math

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import split


@pytest.fixture(scope="module")
def orders(spark):
    """Two thirds of all rows in one class and on one date."""
    return spark.range(1000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "a").otherwise(F.when(F.col("id") == 500, None).otherwise("b")).alias("y"),
        F.when(F.col("id") % 3 > 0, F.lit("2020-01-05"))
        .otherwise(F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 10).cast("int")).cast("string"))
        .cast("timestamp").alias("d"),
    ).cache()


@pytest.mark.parametrize("rank_rows", [split._RANK_ROWS, 0])
def test_stratified_sizes_partition_and_repeatability(orders, monkeypatch, rank_rows):
    monkeypatch.setattr(split, "_RANK_ROWS", rank_rows)
    train, valid = split.stratified_split(orders, "id", "y", share=0.2)
    sizes = {r[0]: r[1] for r in orders.groupBy("y").count().collect()}
    taken = {r[0]: r[1] for r in valid.groupBy("y").count().collect()}
    assert taken == {c: math.ceil(n * 0.2) for c, n in sizes.items()}
    assert train.count() + valid.count() == 1000 and train.join(valid, "id").count() == 0
    again = split.stratified_split(orders.repartition(7), "id", "y", share=0.2)[1]
    assert sorted(r["id"] for r in valid.collect()) == sorted(r["id"] for r in again.collect())


def test_stratified_takes_the_first_rows_by_digest(orders):
    valid = split.stratified_split(orders, "id", "y", share=0.3, seed=7)[1]
    rows = [(r["y"], r["id"], r["key"]) for r in orders.withColumn("key", split.shuffle_key(F.col("id"), 7)).collect()]
    want = set()
    for c in ("a", "b", None):
        members = sorted((key, i) for y, i, key in rows if y == c)
        want |= {i for _, i in members[: math.ceil(len(members) * 0.3)]}
    assert {r["id"] for r in valid.collect()} == want


def test_many_classes_stay_a_table(spark, monkeypatch):
    monkeypatch.setattr(split, "_CLASS_LIMIT", 3)
    df = spark.range(200).withColumn("y", F.col("id") % 10)
    taken = split.stratified_split(df, "id", "y", share=0.25)[1].groupBy("y").count().collect()
    assert [r["count"] for r in taken] == [5] * 10


def test_sample_is_exact_and_repeatable(orders):
    got = split.sample_n(orders, "id", 137)
    assert got.count() == got.select("id").distinct().count() == 137
    assert split.sample_n(orders, "id", 5000).count() == 1000
    assert split.sample_n(orders, "id", 0).count() == 0
    smaller = {r["id"] for r in split.sample_n(orders, "id", 50).collect()}
    assert smaller <= {r["id"] for r in got.collect()}


@pytest.mark.parametrize("share", [0.2, 0.5, 0.999, 0.0])
def test_chronological_cut_inside_a_hot_date(orders, share):
    train, valid = split.chronological_split(orders, "d", "id", share=share)
    ordered = [r["id"] for r in orders.orderBy("d", "id").collect()]
    cut = int(1000 * (1 - share))
    assert sorted(r["id"] for r in train.collect()) == sorted(ordered[:cut])
    assert valid.count() == 1000 - cut


def test_chronological_missing_dates_come_last_and_text_ids_work(spark):
    rows = [("a", "2020-01-02"), ("b", None), ("c", "2020-01-01"), ("d", "2020-01-01"), ("e", None)]
    df = spark.createDataFrame(rows, "id string, d string").withColumn("d", F.to_timestamp("d"))
    train, valid = split.chronological_split(df, "d", "id", share=0.4)
    assert {r["id"] for r in valid.collect()} == {"b", "e"}


def test_unknown_kind_is_an_error(orders):
    with pytest.raises(ValueError, match="unknown split kind"):
        split.make_split(orders, "weekly", "id", "y")
    with pytest.raises(TypeError, match="parsed date"):
        split.chronological_split(orders.withColumn("t", F.lit("2020-01-01")), "t", "id")


def test_a_split_is_a_condition_without_shuffle(orders, spark):
    plan = split.mark_stratified(orders, "id", "y")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan
    plan = split.sample_n(orders, "id", 10)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
