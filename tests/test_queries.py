"""Every registered query that has SQL gives the same rows as DuckDB; the others give rows."""

import os

import pytest
from stationflow.plans import FLAGSHIP, ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")


@pytest.fixture(scope="module")
def con():
    import duckdb

    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents".split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def tidy(df, cols):
    return sorted(map(repr, df[cols].astype(object).where(df[cols].notna(), None).values.tolist()))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, con, name):
    want, got = con.sql(ORACLES[name]).df(), QUERIES[name](spark, SF).toPandas()
    cols = sorted(want.columns)
    assert cols == sorted(got.columns)
    assert tidy(got, cols) == tidy(want, cols)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == QUERIES[FLAGSHIP](spark, SF).count() > 0
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql()) and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
