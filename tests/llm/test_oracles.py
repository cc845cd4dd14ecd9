"""Registered queries of the subpackage against their oracle SQL."""

import glob
import os

import duckdb
import pandas as pd
import pytest
from lexstrata.llm import queries as Q

SF = "/root/testdata/sf0.001"


def rows(df):
    df = df[sorted(df.columns)]
    return sorted(map(tuple, df.map(lambda v: "" if v is None or v is pd.NaT or v != v else str(v)).to_numpy().tolist()))


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return con


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query(spark, con, name):
    got = Q.queries()[name](spark, SF).toPandas()
    assert rows(got) == rows(con.execute(Q.oracle_sql()[name]).df())


@pytest.mark.parametrize("name", sorted(set(Q.queries()) - set(Q.oracle_sql())))
def test_query_without_oracle_covers_its_table(spark, name):
    out = Q.queries()[name](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert out.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
