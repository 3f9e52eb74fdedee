"""Every check query against its SQL in DuckDB, over the whole test tables."""

import os
from pathlib import Path

import duckdb
import pytest

from sftprep.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        con.sql(f"create view {path.stem} as select * from '{path}'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(repr(row[i]) for i in order) for row in rows), key=lambda r: tuple(map(str, r))
    )


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equal_to_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    expected = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(expected.columns)
    got = rows_of(df.columns, df.collect())
    want = rows_of(expected.columns, expected.fetchall())
    assert len(got) == len(want) and got == want
    assert got
