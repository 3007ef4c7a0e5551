import csv
import random

import pytest
from pyspark.sql import functions as F

from tallyframe.functions.missing import CSV_NULL_TOKENS
from tallyframe.operators.drift import tag_sources
from tallyframe.session import rows_up_to, small_table, stage, staging
from tallyframe.sources.records import csv_fields, csv_records
from tallyframe.sources.files import read_csv, read_parquet, sample_csv, write_checked, write_csv, write_parquet


def write_text(path, text):
    path.write_text(text)
    return str(path)


def test_tokens_and_types(spark, tmp_path):
    path = write_text(tmp_path / "t.csv", 'id,n,f,s,b,gone,mixed\n1,5,1.5,NA,True,,1\n2,,2,n/a,False,NaN,x\n3,7,nan,"a, ""b""",True,NULL,2\n')
    df = read_csv(spark, path)
    assert dict(df.dtypes) == {"id": "bigint", "n": "bigint", "f": "double", "s": "string", "b": "boolean", "gone": "double", "mixed": "string"}
    rows = [tuple(r) for r in df.orderBy("id").collect()]
    assert rows == [(1, 5, 1.5, None, True, None, "1"), (2, None, 2.0, None, False, None, "x"), (3, 7, None, 'a, "b"', True, None, "2")]


def test_tokens_are_case_sensitive_and_whole_fields(spark, tmp_path):
    path = write_text(tmp_path / "t.csv", "s\nna\nNa\nNA\nN/A\n?\nnone\nNone\nnan value\n")
    got = [r[0] for r in read_csv(spark, path).collect()]
    assert got == ["na", "Na", None, None, "?", "none", None, "nan value"]
    assert len(CSV_NULL_TOKENS) == 19


def test_declared_schema_wins(spark, tmp_path):
    path = write_text(tmp_path / "t.csv", "id,x\n1,NA\n2,3\n")
    df = read_csv(spark, path, schema="id string, x double")
    assert df.dtypes == [("id", "string"), ("x", "double")]
    assert [tuple(r) for r in df.orderBy("id").collect()] == [("1", None), ("2", 3.0)]


def test_csv_round_trip_keeps_spaces_quotes_and_missing(spark, tmp_path):
    df = spark.createDataFrame([(1, "  a ", 1.25), (2, None, None), (3, 'x,"y"', -0.5)], "id bigint, s string, x double")
    out = str(tmp_path / "out")
    write_csv(df, out)
    assert sorted(map(str, read_csv(spark, out).collect())) == sorted(map(str, df.collect()))


def test_parquet_round_trip_turns_nan_into_missing(spark, tmp_path):
    df = spark.createDataFrame([(1, float("nan")), (2, 2.0)], "id bigint, x double")
    out = str(tmp_path / "p")
    write_parquet(df, out, partition_by=("id",))
    assert {r["x"] for r in read_parquet(spark, out).collect()} == {None, 2.0}


def test_union_of_tables_with_different_columns(spark):
    a = spark.createDataFrame([(1, 0)], "id int, y int")
    b = spark.createDataFrame([(2,)], "id int")
    assert sorted(tuple(r) for r in tag_sources(a, b).select("id", "is_test").collect()) == [(1, False), (2, True)]
    assert tag_sources(a, b).where("is_test").first()["y"] is None


def test_small_tables_and_limits(spark):
    df = small_table(spark, [("a", 1, None), ("b", 2, [1.0])], "k string, n bigint, v array<double>")
    assert [tuple(r) for r in df.collect()] == [("a", 1, None), ("b", 2, [1.0])]
    assert small_table(spark, [], "k string").count() == 0
    assert rows_up_to(df, 1) is None and len(rows_up_to(df, 2)) == 2


def test_staged_tables_are_files(spark):
    df = stage(spark.range(10).withColumn("s", F.lit("x")), "unit")
    assert df.count() == 10 and df.inputFiles()


@pytest.mark.parametrize("column", ["s"])
def test_staged_scan_reads_only_needed_columns(spark, column):
    df = stage(spark.range(3).withColumn("s", F.lit("x")), "unit").select(column)
    assert "ReadSchema: struct<s:string>" in df._jdf.queryExecution().executedPlan().toString()


def test_sampled_file_has_exactly_n_rows(spark, tmp_path):
    source, target = str(tmp_path / "all"), str(tmp_path / "some")
    write_csv(spark.range(50).withColumn("s", F.lit("x y")), source)
    sample_csv(spark, source, target, "id", n=7)
    assert read_csv(spark, target).count() == 7


def test_staged_tables_live_as_long_as_their_block(spark):
    from pathlib import Path
    from urllib.parse import urlparse

    folder = lambda df: Path(urlparse(df.inputFiles()[0]).path).parent
    outside = stage(spark.range(3), "kept")
    with staging(spark):
        with staging(spark):
            one, two, three = (stage(spark.range(3), "block", keep=k) for k in range(3))
            places = [folder(x) for x in (one, two, three)]
            assert all(p.exists() for p in places)
        assert [p.exists() for p in places] == [False, True, True] and two.count() == 3
    assert [p.exists() for p in places] == [False, False, True] and folder(outside).exists()
    with pytest.raises(RuntimeError), staging(spark):
        places = [folder(stage(spark.range(3), "block"))]
        raise RuntimeError
    assert not places[0].exists()


@pytest.mark.parametrize("piece", ["40", "150", "4000"])
def test_quoted_line_breaks_in_files_cut_into_ranges(spark, tmp_path, piece):
    """Ranges that begin and end inside fields, or lie in one as a whole: the rows are those of a reader that takes each file whole."""
    rnd = random.Random(int(piece))
    some = ["", "x", "a,b", 'say "hi"', '""', "one\ntwo", "\n\n", "long " * 60, 'q"\n"q,\n', "é\nü", "\n".join(["line"] * 40)]
    for name in ("a", "b", "c"):
        with open(tmp_path / f"{name}.csv", "w", newline="") as file:
            out = csv.writer(file, lineterminator="\n")
            out.writerow(["id", "t", "other name"])
            for i in range(60 if name != "c" else 0):
                out.writerow([f"{name}{i}", rnd.choice(some), rnd.choice(some)])
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", piece)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        whole = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True).csv(str(tmp_path))
        got = csv_fields(spark, str(tmp_path))
        assert got.columns == whole.columns == ["id", "t", "other name"]
        rows = sorted(map(tuple, whole.collect()), key=str)
        assert len(rows) == 120 and sorted(map(tuple, got.collect()), key=str) == rows
        assert piece == "4000" or csv_records(spark, str(tmp_path)).rdd.getNumPartitions() > 20
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)


@pytest.mark.parametrize("rows", [400, 0])
def test_checks_while_writing(spark, tmp_path, rows):
    df = spark.range(400).select("id", F.when(F.col("id") % 4 > 0, F.col("id") % 7).alias("a.b"), F.lit(None).cast("int").alias("none")).where(F.col("id") < rows)
    rules = {"a over 4": F.col("`a.b`") > 4, "no id": F.col("id").isNull()}
    for i, by in enumerate(((), ("none",))):
        report = write_checked(df.repartition(5), str(tmp_path / f"out{i}"), rules, partition_by=by)
        want = [v for v in range(rows) if v % 4]
        assert [tuple(r) for r in report.collect()] == [
            ("shape", "rows", rows), ("shape", "columns", 3), ("non_null", "id", rows), ("non_null", "a.b", len(want)), ("non_null", "none", 0),
            ("violations", "a over 4", sum(v % 7 > 4 for v in want)), ("violations", "no id", 0),
        ]
        assert spark.read.schema(df.schema).parquet(str(tmp_path / f"out{i}")).count() == rows
