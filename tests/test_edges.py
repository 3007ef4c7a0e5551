"""Rows that the given tables never hold: missing and repeated ids, NaN, booleans, line breaks, odd identifiers."""

import math

import pytest
from pyspark.sql import functions as F

from tallyframe.functions.text import id_to_text
from tallyframe.operators import metrics, outliers, profile, rates, split
from tallyframe.operators.counts import as_label
from tallyframe.plans import prepare
from tallyframe.plans.benchmark import encode_pair
from tallyframe.sources.files import read_csv, write_csv
from tallyframe.spec import TableSpec


def test_csv_field_with_a_line_break(spark, tmp_path):
    df = spark.createDataFrame([("a\nb", 1), ('say "x"\r\ny', 2), ("plain", None)], "label string, n long")
    write_csv(df, f"{tmp_path}/t")
    assert sorted(map(tuple, read_csv(spark, f"{tmp_path}/t").collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("kind,value,text", [("double", 12.5, "12.5"), ("double", 12345678.0, "12345678"), ("string", "A-7", "A-7"), ("string", "007", "007"), ("bigint", 5, "5"), ("double", None, "missing")])
def test_identifiers_have_one_text_in_counts_and_rows(spark, kind, value, text):
    df = spark.createDataFrame([(value,)], f"c {kind}")
    assert df.select(id_to_text(F.col("c"))).first()[0] == text
    assert value is None or df.select(as_label(df, "c")).first()[0] == text


def test_chronological_halves_add_up_with_missing_and_repeated_ids(spark):
    rows = [(None, "2024-01-01"), (None, "2024-01-01"), (1, "2024-01-01"), (1, "2024-01-01"), (2, None)]
    df = spark.createDataFrame(rows, "id long, d string").withColumn("d", F.to_date("d"))
    a, b = split.chronological_split(df, "d", "id", 0.4)
    assert a.count() + b.count() == 5


def test_a_repeated_id_at_the_border_is_an_error(spark):
    df = spark.createDataFrame([(7, 0)] * 100, "id long, y int")
    with pytest.raises(Exception, match="not unique"):
        split.stratified_split(df, "id", "y")[1].count()


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(math.nan, 1), (1.0, 0), (5.0, 1), (None, 0)], "x double, y int")
    assert [r["value"] for r in profile.largest_values(df, ["x"]).collect()] == [5.0, 1.0]
    assert outliers.cap_report(df, {"x": 2.0}).first()["values_set_missing"] == 1
    assert {r["segment"]: r["count"] for r in rates.segment_means(df, "x", "y", 2.0).collect()} == {"missing": 2, "at_or_above": 1, "below": 1}


def test_auc_takes_no_rows_away(spark):
    fine = spark.createDataFrame([(0.1, 0), (0.9, 1)], "s double, y int")
    assert metrics.auc_value(fine, "s", "y") == 1.0
    for odd in [(None, 1), (math.nan, 0), (0.5, 2), (0.5, None)]:
        with pytest.raises(ValueError, match="1 of 3 rows"):
            metrics.auc(fine.union(spark.createDataFrame([odd], "s double, y int")), "s", "y")


def test_boolean_and_empty_columns_in_the_preparation(spark):
    rows = [(i, i % 2, i % 3 == 0 if i % 5 else None, None, float("nan") if i % 7 == 0 else 1.0 * i, "ab"[i % 2]) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, y int, flag boolean, nothing double, x double, c string")
    spec = TableSpec.infer(df, id="id", target="y")
    assert set(spec.nums) == {"flag", "nothing", "x"}
    assert {r["column"] for r in profile.num_summary(df, ["flag", "x"], "y").collect()} == {"flag", "x"}
    done = prepare.prepare_from(df, df, spec, prepare.PrepareRules(keep_id=True))
    assert "nothing" not in done.columns and done.where("flag is null or x is null or isnan(x)").count() == 0
    _, a, _ = encode_pair(done, done, "id", "y", scale=True)
    assert a.count() == 60
