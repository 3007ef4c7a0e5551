"""Every registered query with an SQL equivalent gives the same rows on the smallest data set."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracles import TABLES, canonical
from workload.oracles import ORACLES
from workload.queries import REGISTRY

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_DIR}/{t}.parquet')")
    return con


def test_every_oracle_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())
    assert {q for q in REGISTRY if q not in oracle_sql()} == {
        "model_benchmark", "model_split_compare", "model_ablation", "model_importance", "model_raw_vs_clean",
        "predict_best", "adversarial_scores", "adversarial_drift",
    }


def test_entry(spark):
    assert entry(spark).columns == ["value", "rate", "count"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    df = queries()[name](spark, SF_DIR)
    want = con.sql(oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(want.columns, want.fetchall())
