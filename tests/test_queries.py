"""Every query with SQL against DuckDB on small tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
NAMES = [n for n in __spark_entry__.catalog.QUERIES if n in __spark_entry__.catalog.ORACLES]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")


def rows(df):
    def plain(v):
        if v is None or v is pd.NA or v is pd.NaT or v != v:
            return None
        if hasattr(v, "isoformat"):
            return str(v)[:10]
        if isinstance(v, float) and v.is_integer():
            return int(v)
        return v.item() if hasattr(v, "item") else v

    return sorted(repr([plain(v) for v in r]) for r in df[sorted(df.columns)].astype(object).itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_equals_sql(spark, duck, name):
    got = __spark_entry__.catalog.QUERIES[name](spark, SF).toPandas()
    want = duck.sql(__spark_entry__.catalog.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
