import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyframe.operators import assoc, cardinality, drift, metrics, outliers, profile, rates, tables
from tests.conftest import pairs


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(3)
    rows = [
        (i, int(rng.random() < 0.4), ["a", "b", "c", None][int(rng.integers(4))], float(rng.normal()),
         None if i % 7 == 0 else float(rng.integers(5)))
        for i in range(400)
    ]
    return spark.createDataFrame(rows, "id bigint, y int, k string, x double, z double").cache()


def test_null_group_is_kept_or_dropped(spark):
    df = spark.createDataFrame([("a", 1), (None, 0), (None, 1)], "k string, y int")
    kept = rates.rate_by_category(df, "k", "y", min_count=1)
    assert [(r["value"], r["rate"], r["count"]) for r in pairs(kept)] == [(None, 0.5, 2), ("a", 1.0, 1)]
    assert [r["value"] for r in pairs(rates.rate_nonnull(df, "k", "y"))] == ["a"]
    assert [r["value"] for r in pairs(profile.value_counts(df, "k"))] == ["a"]


def test_top_n_is_by_count_then_shown_by_rate(spark):
    df = spark.createDataFrame([("a", 0)] * 5 + [("b", 1)] * 4 + [("c", 1)] * 3 + [("d", 0)] * 3, "k string, y int")
    got = [r["value"] for r in pairs(rates.rate_by_category(df, "k", "y", min_count=3, top_n=3))]
    assert got == ["a", "b", "c"]
    assert [r["value"] for r in pairs(rates.rate_by_category(df, "k", "y", min_count=4))] == ["a", "b"]
    by_count = rates.top_category_rates(df, "k", "y", min_count=1, sort_by="count", ascending=True)
    assert [r["value"] for r in pairs(by_count)] == ["c", "d", "b", "a"]


def test_bins_match_pandas(sample):
    pdf = sample.toPandas()
    for column, bins in (("x", 8), ("z", 6)):
        sub = pdf[[column, "y"]].dropna()
        want = sub.groupby(pd.qcut(sub[column], bins, duplicates="drop"), observed=True)["y"].agg(["mean", "size"])
        got = rates.rate_by_bins(sample, column, "y", bins).toPandas()
        assert got["rate"].tolist() == pytest.approx(want["mean"].tolist())
        assert got["count"].tolist() == want["size"].tolist()
        assert got["hi"].tolist() == pytest.approx([i.right for i in want.index], abs=1e-3)


def test_bins_of_repeated_and_constant_values(spark):
    mostly_zero = spark.createDataFrame([(0.0, 1)] * 20 + [(1.0, 0), (2.0, 1)], "x double, y int")
    assert sum(r["count"] for r in pairs(rates.rate_by_bins(mostly_zero, "x", "y"))) == 22
    constant = spark.createDataFrame([(1.0, 1)] * 5, "x double, y int")
    assert pairs(rates.rate_by_bins(constant, "x", "y")) == []


def test_zscore_matches_recorded_row(spark):
    """Published group: n=6551, mean 0.734850, overall 0.4143924 over 63,464 rows -> z 52.651970."""
    hits, n, total = 4814, 6551, 63_464
    rest = round(0.4143924114458591 * total) - hits
    df = spark.createDataFrame([(218.0, 1, hits), (218.0, 0, n - hits), (None, 1, rest), (None, 0, total - n - rest)],
                               "agent double, y int, times int")
    df = df.select("agent", "y", F.explode(F.sequence(F.lit(1), "times")))
    row = rates.group_zscore(df, "agent", "y").first()
    assert row["count"] == n
    assert row["se"] == pytest.approx(0.006086, abs=5e-7)
    assert row["diff_from_global"] == pytest.approx(0.320457, abs=5e-7)
    assert row["z_score"] == pytest.approx(52.651970, abs=5e-5)


def test_target_balance_matches_recorded_share(spark):
    df = spark.range(50_771).select((F.col("id") < 21_039).cast("int").alias("y"))
    assert [tuple(r) for r in profile.target_balance(df, "y").collect()] == [(0, 29_732, 58.6), (1, 21_039, 41.4)]


def test_category_summary_text(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 3 + [(None,)], "k string")
    row = profile.cat_summary(df, ["k"]).first()
    assert tuple(row) == ("k", 10.0, 1, 2, ["a (60.0%)", "b (30.0%)", "nan (10.0%)"])


def test_cat_rate_table_cells(spark):
    df = spark.createDataFrame([("PRT", 1)] * 16 + [("prt", 0)] * 9 + [("x", 1)] * 3, "c string, y int")
    row = rates.cat_rate_table(df, ["c"], "y", normalize=True).first()
    assert row["top_1"] == "prt: rate%=64.0, count=25" and row["top_2"] is None


def test_numeric_summary_matches_pandas(sample):
    pdf = sample.toPandas()
    for row in pairs(profile.num_summary(sample, ["x", "z"], "y")):
        s = pdf[row["column"]]
        want = {
            "missing_pct": s.isna().mean() * 100, "missing_count": s.isna().sum(), "corr_target": s.corr(pdf["y"]),
            "mean": s.mean(), "median": s.median(), "std": s.std(), "min": s.min(), "max": s.max(),
            "q25": s.quantile(0.25), "q75": s.quantile(0.75), "skew": s.skew(),
        }
        for name, value in want.items():
            assert row[name] == pytest.approx(value), name


def test_skew_of_five_values(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, 4.0, 10.0)], "x double")
    assert df.agg(profile.adjusted_skewness(F.col("x"))).first()[0] == pytest.approx(1.697056, abs=1e-6)
    ladder = pairs(profile.quantile_ladder(df, ["x"], (0.5, 0.9)))
    assert [r["value"] for r in ladder] == [3.0, pytest.approx(7.6)]


def test_constant_column_has_no_correlation_and_no_error(spark):
    df = spark.createDataFrame([(1.0, 0), (1.0, 1), (1.0, None)], "x double, y int")
    assert pairs(assoc.corr_target(df, ["x"], "y")) == [{"column": "x", "corr": None}]
    assert profile.num_summary(df, ["x"], "y").first()["corr_target"] is None


def test_correlations_are_pairwise_complete(sample):
    want = sample.toPandas()[["y", "x", "z"]].corr()
    got = assoc.corr_matrix(sample, ["y", "x", "z"]).toPandas().set_index("column")
    assert np.allclose(got.loc[["y", "x", "z"], ["y", "x", "z"]], want)
    pairs_ = assoc.corr_pairs(sample, ["y", "x", "z"], threshold=0.0)
    assert {(r[0], r[1]) for r in pairs_.collect()} == {("y", "x"), ("y", "z"), ("x", "z")}


def test_suspicious_columns_rule(spark):
    """Bulk 0-3 with entry errors -5 and 10000, as in the published table."""
    rows = [(float(i % 4), float(i % 3)) for i in range(1000)] + [(-5.0, 1.0), (10000.0, 2.0)]
    df = spark.createDataFrame(rows, "hours double, fine double")
    assert [tuple(r) for r in outliers.sus_columns(df, ["hours", "fine"]).collect()] == [
        ("hours", -5.0, 10000.0, 3.0, "negative, max=10000 vs q99=3")
    ]


def test_cap_keeps_missing_and_reports(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1000)] + [(None,)], "x double")
    capped, report = outliers.capped_copy(df, ["x"], q=0.99)
    assert report.first() == ("x", pytest.approx(989.01), 10)
    assert capped.where("x is null").count() == 11


def test_largest_rows_not_largest_distinct(spark):
    df = spark.createDataFrame([(9.0,)] * 19 + [(8.0,)] * 5 + [(7.0,)], "x double")
    assert [r["value"] for r in pairs(profile.largest_values(df, ["x"]))] == [9.0, 8.0]


def test_histogram_counts_everything_once(sample):
    x = sample.toPandas()["x"]
    got = profile.histogram(sample, "x", bins=10).toPandas().set_index("bin")["count"]
    want, _ = np.histogram(x, bins=10)
    assert [int(got.get(i, 0)) for i in range(10)] == want.tolist()
    assert profile.histogram(sample, "x", "y").agg(F.sum("count")).first()[0] == 400


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(2.0,)] * 4, "x double")
    row = profile.histogram(df, "x").first()
    assert (row["count"], row["lo"] <= 2.0 <= row["hi"]) == (4, True)


def test_box_statistics(spark):
    df = spark.createDataFrame([(0, float(v)) for v in (1, 2, 3, 4, 100)] + [(1, 5.0)], "y int, x double")
    assert [tuple(r) for r in profile.box_stats(df, "x", "y").collect()] == [
        (0, 5, 1.0, 2.0, 3.0, 4.0, 100.0, 1.0, 4.0), (1, 1, 5.0, 5.0, 5.0, 5.0, 5.0, 5.0, 5.0),
    ]
    assert profile.box_stats(df, "x", "y", levels=(0.875,)).first()["letter_values"] == [pytest.approx(52.0)]


def test_coverage_and_kept_sets(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 3 + [("c",)] + [(None,)] * 2, "k string")
    assert [tuple(r) for r in cardinality.coverage(df, "k", (3, 7)).collect()] == [(3, 2, 0.9), (7, 0, 0.0)]
    keep = cardinality.keep_by_min_count(df, "k", 3)
    assert {r["value"] for r in pairs(keep)} == {"a", "b"}
    assert tuple(cardinality.describe_keep(df, "k", keep).first()) == (2, 3, 0.75)


@pytest.mark.parametrize("limit", [1000, 1, 0])
def test_collapse_is_the_same_with_literals_and_with_a_table(spark, limit):
    df = spark.createDataFrame([("a",)] * 6 + [("c",)] * 4 + [("b",), (None,), ("missing",)], "k string")
    kept = cardinality.fit_kept(cardinality.keep_by_min_count(df, "k", 3), "k", literal_limit=limit)
    assert (kept.table is None) == (limit > 1) and len(kept.literals) == min(limit, 2)
    out = kept.apply(df).groupBy("k").count()
    assert {tuple(r) for r in out.collect()} == {("a", 6), ("c", 4), ("other", 2), ("missing", 1)}


@pytest.mark.parametrize("n, distinct, cell_rows", [(300, 5, 20_000), (300, 5, 1), (2000, 1500, 1), (2000, 1500, 37)])
def test_auc_matches_rank_formula(spark, monkeypatch, n, distinct, cell_rows):
    monkeypatch.setattr(metrics, "_CELL_ROWS", cell_rows)
    rng = np.random.default_rng(n)
    score, label = rng.integers(distinct, size=n).astype(float), rng.integers(2, size=n)
    df = spark.createDataFrame(pd.DataFrame({"s": score, "y": label}))
    ranks = pd.Series(score).rank().to_numpy()
    pos = int(label.sum())
    want = (ranks[label == 1].sum() - pos * (pos + 1) / 2) / (pos * (n - pos))
    assert metrics.auc_value(df, "s", "y") == pytest.approx(want, abs=1e-12)
    flipped = df.withColumn("s", -F.col("s"))
    assert metrics.auc_value(flipped, "s", "y") == pytest.approx(1 - want, abs=1e-12)
    stretched = df.withColumn("s", F.exp(F.col("s") / distinct))
    assert metrics.auc_value(stretched, "s", "y") == pytest.approx(want, abs=1e-12)


@pytest.mark.parametrize("box_rows", [5_000_000, 40])
def test_boxes_of_many_classes_and_of_a_large_one(spark, monkeypatch, box_rows):
    """Ranges cut through classes give the same boxes as numpy; a class without values has an empty box."""
    monkeypatch.setattr(profile, "BOX_ROWS", box_rows)
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"k": np.where(rng.random(900) < 0.4, 7, rng.integers(60, size=900)), "x": rng.normal(size=900).round(2)})
    df = spark.createDataFrame(pdf).union(spark.createDataFrame([(99, None)], "k long, x double"))
    got = profile.box_stats(df, "x", "k", levels=(0.9,)).collect()
    assert [r["k"] for r in got] == sorted({*pdf["k"], 99})
    assert tuple(got[-1]) == (99, 0, *[None] * 8)
    for r in got[:-1]:
        x = pdf["x"][pdf["k"] == r["k"]].to_numpy()
        want = np.quantile(x, [0, 0.25, 0.5, 0.75, 1])
        reach = 1.5 * (want[3] - want[1])
        ends = [x[x >= want[1] - reach].min(), x[x <= want[3] + reach].max()]
        assert r["count"] == len(x) and list(r)[2:9] == pytest.approx([*want, *ends])
        assert r["letter_values"] == [pytest.approx(np.quantile(x, 0.9))]


def test_auc_of_one_class_and_of_nothing(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 0)], "s double, y int")
    assert metrics.auc_value(df, "s", "y") is None
    assert metrics.auc_value(df.where("s > 1"), "s", "y") is None


def test_auc_with_one_score_for_a_third_of_all_rows(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0.5)).otherwise(F.rand(1)).alias("s"), (F.col("id") % 2).alias("y")
    ).cache()
    pdf = df.toPandas()
    ranks, pos = pdf["s"].rank(), int(pdf["y"].sum())
    want = (ranks[pdf["y"] == 1].sum() - pos * (pos + 1) / 2) / (pos * (len(pdf) - pos))
    assert metrics.auc_value(df, "s", "y") == pytest.approx(want, abs=1e-12)


def test_missing_compare_keeps_columns_of_one_side(spark):
    a = spark.createDataFrame([(1, None), (2, 3)], "x int, only int")
    b = spark.createDataFrame([(None,), (2,)], "x int")
    got = {r["column"]: r for r in pairs(profile.missing_compare(a, b))}
    assert got["only"]["test_missing_pct"] is None and got["only"]["train_missing_count"] == 1
    assert got["x"]["test_missing_pct"] == 50.0


def test_key_check_and_contradictions(spark):
    df = spark.createDataFrame([(1, 5), (1, 2), (None, 9)], "a int, b int")
    assert tuple(tables.key_check(df, "a").first()) == (3, 1, False)
    assert tuple(tables.key_check(df, "b").first()) == (3, 3, True)
    assert tables.contradictions(df, {"r": F.col("a") < F.col("b")}).first()["violations"] == 2


def test_date_audit(spark):
    a = spark.createDataFrame([("2015-07-01",), ("2015-07-02",), (None,)], "d string").select(F.to_timestamp("d").alias("d"))
    b = spark.createDataFrame([("2015-07-02",), ("2015-07-02",), ("2016-01-01",)], "d string").select(F.to_timestamp("d").alias("d"))
    got = {r["data"]: r for r in pairs(drift.date_audit(a, b, "d"))}
    assert (got["train"]["rows"], got["train"]["unique_dates"]) == (3, 2)
    assert got["test"]["test_rows_on_train_dates"] == pytest.approx(2 / 3)
    assert got["overlap"]["unique_dates"] == 1 and got["overlap"]["rows"] is None


def test_shift_reports(spark):
    a = spark.createDataFrame([(1.0, "Blu#e"), (None, "red"), (3.0, "BLUE"), (5.0, None)], "x double, c string")
    b = spark.createDataFrame([(10.0, "blue"), (20.0, "?")], "x double, c string")
    tagged = drift.tag_sources(a, b)
    row = drift.numeric_shift(tagged, ["x"]).first()
    assert row["train_missing_pct"] == 0.25 and row["train_p50"] == 3.0 and row["test_p90"] == 19.0
    shift = {r["value"]: (r["train_pct"], r["test_pct"]) for r in pairs(drift.categorical_shift(tagged, "c"))}
    assert shift == {"blue": (0.5, 0.5), "red": (0.25, 0.0), "missing": (0.25, 0.5)}


def test_importance_rolls_up(spark):
    rows = [("m", "ohe__k__a", 0.2), ("m", "ohe__k__b__c", 0.3), ("m", "x", 0.4), ("n", "x", 0.1)]
    table = spark.createDataFrame(rows, "model string, feature string, importance double")
    rolled = drift.importance_by_column(table)
    assert {(r[0], r[1]): round(r[2], 6) for r in rolled.collect()} == {("m", "k"): 0.5, ("m", "x"): 0.4, ("n", "x"): 0.1}
    assert [(r[0], round(r[1], 6)) for r in drift.top_features(rolled, 1).collect()] == [("k", 0.5)]


def test_every_report_takes_an_empty_table(spark):
    df = spark.createDataFrame([], "id bigint, y int, k string, x double, d timestamp")
    reports = [
        rates.rate_by_category(df, "k", "y"), rates.rate_by_bins(df, "x", "y"), rates.rate_over_time(df, "d", "y"),
        rates.missing_vs_target(df, ["k", "x"], "y"), rates.cat_rate_table(df, ["k"], "y"), rates.freq_and_rate(df, "k", "y"),
        rates.presence_describe(df, "k", "y"), rates.group_zscore(df, "k", "y"), rates.segment_means(df, "x", "y", 1.0),
        profile.null_summary(df), profile.value_counts(df, "k"), profile.cat_summary(df, ["k"]), profile.describe(df, ["x"]),
        profile.num_summary(df, ["x"], "y"), profile.quantile_ladder(df, ["x"]), profile.largest_values(df, ["x"]),
        profile.histogram(df, "x"), profile.box_stats(df, "x", "y"), profile.top_counts_by_target(df, "k", "y"),
        profile.distinct_counts(df, ["k"]), assoc.corr_pairs(df, ["x", "y"]), outliers.sus_columns(df, ["x"]),
        outliers.capped_copy(df, ["x"])[0], outliers.capped_copy(df, ["x"])[1], cardinality.coverage(df, "k"),
        tables.key_check(df, "id"), tables.shape(df), tables.column_catalogue(df), drift.date_audit(df, df, "d"),
    ]
    for report in reports:
        for row in report.collect():
            assert not any(isinstance(v, float) and math.isnan(v) for v in row)


def test_shift_of_several_features_equals_single_reports(spark):
    rows = [(i % 3 == 0, f"v{i % 5}", None if i % 4 == 0 else "A and b" if i % 7 else "a & B", float(i), i % 6) for i in range(60)]
    tagged = spark.createDataFrame(rows, "is_test boolean, c string, m string, x double, k int")
    several = drift.feature_shifts(tagged, ["c", "x", "m", "k"])
    singles = [drift.categorical_shift(tagged, "c"), drift.categorical_shift(tagged, "m"), drift.numeric_shift(tagged, ["x"]), drift.numeric_shift(tagged, ["k"])]
    key = lambda r: sorted((k, str(v)) for k, v in r.items() if v is not None)
    assert sorted(map(key, pairs(several))) == sorted(key(r) for df in singles for r in pairs(df))
    assert several.where("feature = 'm' and value = 'missing'").count() == 1


def test_correlations_of_blocks_are_those_of_pandas(spark):
    """Missing values, a constant column, a constant on the rows of one pair, far centres, and many tasks with different first rows."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 4))
    pdf = pd.DataFrame({"a": x[:, 0] + 1e6, "b": x[:, 0] * 3 + x[:, 1], "c": x[:, 2] ** 3, "k": 7.25, "g": np.arange(3000) * 1e3 + x[:, 3]})
    pdf.loc[::3, "b"] = np.nan
    pdf.loc[1::5, "c"] = np.nan
    pdf["h"] = np.where(pdf["b"].isna(), x[:, 1], 1234.5678)  # constant wherever b is present
    pdf["e"] = np.nan
    df = spark.createDataFrame(pdf).orderBy("g").repartition(5)
    want = pdf.corr()
    want.loc["h", "b"] = want.loc["b", "h"] = np.nan
    for frame in (df, df.coalesce(1)):
        got = {r["column"]: r.asDict() for r in assoc.corr_matrix(frame, list(pdf.columns)).collect()}
        for a in pdf.columns:
            for b in pdf.columns:
                assert got[a][b] == (None if np.isnan(want.loc[a, b]) else pytest.approx(want.loc[a, b], abs=1e-9)), (a, b)
    upper = assoc.corr_pairs(df, ["a", "b", "c"], threshold=0.5).collect()
    assert [(r["feature_1"], r["feature_2"]) for r in upper] == [("a", "b")]
    assert [tuple(r) for r in assoc.corr_pairs(df.limit(0), ["a", "b"]).collect()] == [("a", "b", None)]


def test_the_plan_of_correlations_does_not_grow_with_the_pairs(spark):
    wide = spark.range(50).select(*[(F.col("id") * (k % 7) + k % 3 * F.rand(k)).alias(f"x{k}") for k in range(120)])
    assert assoc.corr_pairs(wide, wide.columns).count() == 120 * 119 // 2


@pytest.mark.parametrize("hot", [0, 3, 4000])
def test_largest_values_of_many_rows(spark, hot):
    """Distinct values among the 20 largest rows, also where one value stands on more rows than are wanted."""
    rng = np.random.default_rng(hot)
    x = np.concatenate([rng.integers(0, 9000, 9000).astype(float), np.full(hot, 8995.0), [np.nan] * 50])
    df = spark.createDataFrame(pd.DataFrame({"x": x, "few": [1.0] * 5 + [np.nan] * (len(x) - 5)}))
    want = sorted(set(np.sort(x[~np.isnan(x)])[::-1][:20].tolist()), reverse=True)
    got = profile.largest_values(df, ["x", "few"]).collect()
    assert [r["value"] for r in got if r["column"] == "x"] == want and [r["value"] for r in got if r["column"] == "few"] == [1.0]
