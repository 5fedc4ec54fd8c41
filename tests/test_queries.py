"""Every registered engine query with SQL gives the rows that DuckDB gives on the same tables."""

import os

import duckdb
import pandas as pd
import pytest

from skyfilm.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def one(x):
    if x is None or x is pd.NA or x is pd.NaT or (isinstance(x, float) and x != x):
        return "null"
    if hasattr(x, "dtype") and x.dtype.kind in "biuf":
        x = x.item()
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, (int, float)):
        return f"{x:.9g}"
    if hasattr(x, "year") and pd.Timestamp(x) == pd.Timestamp(x).normalize():
        return str(pd.Timestamp(x).date())
    return str(x)


def rows(df):
    df = df.reindex(sorted(df.columns), axis=1)
    return sorted(map(tuple, pd.DataFrame({c: [one(x) for x in df[c].astype(object)] for c in df.columns}).to_numpy().tolist()))


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_against_sql(spark, duck, name):
    got, want = registry.QUERIES[name](spark, SF).toPandas(), duck.sql(registry.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert os.path.exists(SF)
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
