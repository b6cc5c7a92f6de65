"""Every registered query against its SQL, on the small tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from eventlake.workloads.oracles import ORACLES
from eventlake.workloads.queries import QUERIES

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="needs the given tables")


@pytest.fixture(scope="module")
def sql():
    db = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        db.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return db


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    return str(value)


def rows(frame):
    columns = sorted(frame.columns)
    records = frame[columns].astype(object).itertuples(index=False)
    return columns, sorted(tuple(map(normal, r)) for r in records)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sql, name):
    got = contract.queries()[name](spark, str(DATA)).toPandas()
    want = sql.sql(contract.oracle_sql()[name]).df()
    for column in got.columns:
        if str(want[column].dtype).startswith("datetime"):
            want[column] = want[column].astype("datetime64[us]")
            got[column] = got[column].astype("datetime64[us]")
    assert rows(got) == rows(want)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
