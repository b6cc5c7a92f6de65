"""Every registered query that has SQL, against it, on the small tables."""

from pathlib import Path

import duckdb
import pytest

from eventlake.llm.oracles import ORACLES
from eventlake.llm.queries import QUERIES

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="needs the given tables")


def compared(spark, name, data=DATA):
    db = duckdb.connect()
    for file in data.glob("*.parquet"):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    got = QUERIES[name](spark, str(data)).toPandas()
    want = db.execute(ORACLES[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    order = [c for c in columns if c.endswith("_id")] or columns
    got = got[columns].sort_values(order).reset_index(drop=True)
    want = want[columns].sort_values(order).reset_index(drop=True)
    return got, want


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    got, want = compared(spark, name)
    assert len(got) == len(want)
    for column in want.columns:
        left, right = got[column], want[column]
        if right.dtype == float:
            assert (left - right).abs().fillna(0).max() < 1e-6, column
        else:
            same = (left == right) | (left.isna() & right.isna())
            assert same.all(), (column, left[~same].head(), right[~same].head())
