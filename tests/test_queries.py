"""Every registered query against its SQL counterpart on the small tables."""

import glob
import math
import os

import duckdb
import pytest

from __spark_entry__ import base_oracle_sql, base_queries, entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = base_queries()
ORACLES = base_oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    yield con
    con.close()


def _key(row):
    return tuple((v is None, "" if v is None else f"{v:.5f}" if isinstance(v, float) else str(v)) for v in row)


def _same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, abs_tol=2e-6)
    return type(a) is type(b) and a == b


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(ORACLES[name])
    expected_names = [c[0] for c in cursor.description]
    assert sorted(result.columns) == sorted(expected_names)
    names = sorted(expected_names)
    got = sorted((tuple(r[n] for n in names) for r in result.collect()), key=_key)
    order = [expected_names.index(n) for n in names]
    want = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=_key)
    assert len(got) == len(want)
    if name != "report_kpis_empty" and "user" not in name:
        assert want
    wrong = [(g, w) for g, w in zip(got, want) if not all(map(_same, g, w))]
    assert not wrong, wrong[:3]
    plan = result._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "MapInPandas", "MapInArrow"):
        assert operator not in plan


def test_entry_has_rows(spark):
    result = entry(spark)
    assert result.columns[:2] == ["date", "username"]
    assert not result.isEmpty()


def test_dict_rows_stay_in_spark(spark):
    plan = QUERIES["adhoc_dict_rows"](spark, SF_DIR)._jdf.queryExecution().analyzed().toString()
    assert "LocalRelation" not in plan and "LogicalRDD" not in plan and "map(" in plan
