"""Every registered query with an oracle gives what DuckDB gives; none of them is empty."""

import glob
import os

import duckdb
import pandas as pd
import pytest
from lexstrata.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return con


def plain(v):
    if v is None or v is pd.NaT or v != v:
        return ""
    if isinstance(v, pd.Timestamp) and v == v.normalize():
        return str(v.date())
    return str(int(v)) if isinstance(v, float) and v == int(v) else str(v)


def rows(df):
    df = df[sorted(df.columns)]
    return sorted(map(tuple, df.map(plain).to_numpy().tolist()))


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query(spark, con, name):
    got = catalogue.QUERIES[name](spark, SF).toPandas()
    want = con.execute(catalogue.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) > 0
    assert rows(got) == rows(want)


def test_every_kind_occurs(spark):
    kinds = {r["kind"] for r in catalogue.QUERIES["kind_histogram"](spark, SF).collect()}
    assert kinds == {"blank", "quote", "table", "name", "transitory", "ordinal_article", "article", "part", "transitory_ordinal", "fraction", "clause", "text"}


def test_entry_without_the_optional_parts(tmp_path):
    """The entry file imports and runs where the training-data folder and the pipeline are gone."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/lexstrata", tmp_path / "lexstrata", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'coverage_index' in q and not any(x.startswith('op') for x in q if x[2:3].isdigit()); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
