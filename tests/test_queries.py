from __future__ import annotations

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from railweave.plans import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    c = duckdb.connect()
    for f in os.listdir(SF):
        path = f"{SF}/{f}"
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return c


def canonical(df: pd.DataFrame) -> list[tuple]:
    cell = lambda v: "" if pd.isna(v) else f"{v:.9g}" if isinstance(v, float) else str(v)
    return sorted(tuple(map(cell, r)) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_same_as_sql(spark, oracle, name):
    got, want = queries.QUERIES[name](spark, SF).toPandas(), oracle.execute(queries.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def test_entry(spark):
    assert entry.entry(spark).columns == ["trip_id", "stop_id", "stop_sequence", "dep_min"]
    assert set(queries.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
