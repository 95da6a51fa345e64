"""Queries that SQL can express, against their SQL."""

import glob
import os

import duckdb
import pytest

from stridelake.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLES)
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    cursor = con.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    want = sorted(cursor.fetchall(), key=str)
    result = QUERIES[name](spark, SF_DIR)
    assert sorted(result.columns) == sorted(names)
    assert sorted((tuple(r[n] for n in names) for r in result.collect()), key=str) == want
