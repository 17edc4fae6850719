"""Every core query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from raqim.plans import catalog


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def rows(df: pd.DataFrame) -> list[tuple]:
    def plain(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return ""
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            return f"{float(v):.9g}"
        return str(v).replace("+00:00", "")

    return sorted(tuple(plain(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_same_rows(spark, db, sf, name):
    sql = catalog.oracle_sql()[name]
    got, want = catalog.queries()[name](spark, sf).toPandas(), db.sql(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
