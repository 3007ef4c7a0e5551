import pytest
from pyspark.sql import functions as F

from tallyframe.functions.dates import parse_date, period_start, weekday_of
from tallyframe.functions.missing import PLACEHOLDERS, fill, member_of, nan_to_null
from tallyframe.functions.numeric import clip, edge_bin, matches, null_above
from tallyframe.functions.text import (
    id_to_text, keep_or_other, normalize_label, onehot_name, recode, source_column, trim_lower,
)
from tallyframe.operators.outliers import clip_fixed


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("x"))).collect()]


@pytest.mark.parametrize("raw, clean", [
    ("Prepaid (Non-Refundable)", "prepaid (nonrefundable)"),
    ("blu#e", "blue"),
    ("  SaaS  and Software   Houses ", "saas & software houses"),
    ("B2B Platforms & Resellers", "b2b platforms & resellers"),
    ("2015-10-16", "20151016"),
    ("R and D", "r & d"),
    ("sandy brand", "sandy brand"),
    ("a\tb", "ab"),
    ("NA", None), ("n/a", None), ("--", None), (".", None), ("?", None), ("", None), ("  ", None),
    ("unknonwn", None), ("Unknown!", None), ("N/A", None),
    (None, None),
])
def test_normalize_label(spark, raw, clean):
    assert column(spark, [raw], "string", normalize_label) == [clean]


def test_normalising_twice_changes_nothing(spark):
    raws = ["R and D", "x  and  and y", "(a) & B", "é and x", "BLU#e and", "and"]
    once = column(spark, raws, "string", normalize_label)
    assert column(spark, once, "string", normalize_label) == once


def test_placeholders_are_twelve():
    assert len(PLACEHOLDERS) == len(set(PLACEHOLDERS)) == 12


def test_trim_lower_takes_all_white_space(spark):
    assert column(spark, ["\t A b\n", None], "string", trim_lower) == ["a b", None]


def test_identifiers_keep_all_digits(spark):
    assert column(spark, [12345678.0, None, 218.0], "double", id_to_text) == ["12345678", "missing", "218"]
    assert column(spark, [9007199254740993], "bigint", id_to_text) == ["9007199254740993"]


def test_recode_and_collapse(spark):
    assert column(spark, ["cn", "fra", None], "string", lambda c: recode(c, {"cn": "chn"})) == ["chn", "fra", None]
    assert column(spark, ["a", "b", None], "string", lambda c: keep_or_other(c, ["a"])) == ["a", "other", "other"]


def test_membership_of_missing_is_false(spark):
    assert column(spark, ["a", "b", None], "string", lambda c: member_of(c, ["a"])) == [True, False, False]


def test_clip_keeps_missing(spark):
    assert column(spark, [None, 5.0, -1.0, 2.0], "double", lambda c: clip(c, 0.0, 3.0)) == [None, 3.0, 0.0, 2.0]
    assert column(spark, [None, 5.0, -1.0], "double", lambda c: clip(c, None, 3.0)) == [None, 3.0, -1.0]


def test_clip_fixed_skips_absent_columns_and_keeps_whole_types(spark):
    df = spark.createDataFrame([(-5, 7.0)], "h bigint, k double")
    out = clip_fixed(df, {"h": (0, 8), "k": (None, 2.5), "gone": (0, 1)})
    assert out.dtypes == [("h", "bigint"), ("k", "double")] and out.first() == (0, 2.5)


def test_null_above_keeps_the_cap_itself(spark):
    assert column(spark, [1.0, 2.0, 3.0, None], "double", lambda c: null_above(c, 2.0)) == [1.0, 2.0, None, None]
    assert column(spark, [1.0], "double", lambda c: null_above(c, None)) == [None]


def test_edges_belong_to_the_lower_bin(spark):
    got = column(spark, [0.0, 1.0, 1.5, 2.0, 3.0, None], "double", lambda c: edge_bin(c, [0.0, 1.0, 2.0, 3.0]))
    assert got == [1, 1, 2, 2, 3, None]


def test_matching_needs_both_sides(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), (None, "a"), (None, None)], "p string, q string")
    assert [r[0] for r in df.select(matches(F.col("p"), F.col("q"))).collect()] == [1, 0, 0, 0]


def test_dates(spark):
    texts = ["2015-07-01", "not a date", None, "2015-07-31"]
    got = column(spark, texts, "string", lambda c: period_start(parse_date(c), "M").cast("string"))
    assert got == ["2015-07-01", None, None, "2015-07-01"]
    assert column(spark, ["2024-01-01", "2024-01-07"], "string", lambda c: weekday_of(parse_date(c, strict=True))) == [0, 6]
    with pytest.raises(Exception, match="CAST_INVALID|CANNOT_PARSE|CAST"):
        column(spark, ["not a date"], "string", lambda c: parse_date(c, strict=True).cast("string"))


def test_encoded_names_map_back(spark):
    names = [onehot_name("Agent", "9"), onehot_name("Terms", "a__b"), "cost", "ohelike"]
    assert column(spark, names, "string", source_column) == ["Agent", "Terms", "cost", "ohelike"]


def test_nan_becomes_missing(spark):
    df = spark.createDataFrame([(float("nan"), "NaN"), (1.0, "a")], "x double, s string")
    assert [tuple(r) for r in nan_to_null(df).collect()] == [(None, "NaN"), (1.0, "a")]


def test_fill(spark):
    assert column(spark, ["a", None], "string", lambda c: fill(c, "missing")) == ["a", "missing"]
