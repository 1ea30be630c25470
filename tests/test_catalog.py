"""Every registered query against its DuckDB oracle on the smallest tables."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]
# every query of the library itself has SQL; the training-data operators are
# tested beside their subpackage
ROWS_ONLY: set[str] = set()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["word", "total"] and 0 < len(rows) <= 10


def test_every_query_has_an_oracle_or_is_rows_only():
    assert set(E.catalog.queries()) - set(E.catalog.oracle_sql()) == ROWS_ONLY


@pytest.mark.parametrize("name", sorted(E.catalog.queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.catalog.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    sql = E.catalog.oracle_sql().get(name)
    if sql is None:
        assert len(got) > 0
        return
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert _rows(df.columns, got) == _rows(cols, cur.fetchall())


PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas",
                "FlatMapGroupsInPandas", "PythonMapInArrow")


def test_no_python_in_any_query_plan(spark):
    """Every registered query runs JVM-side: no Python UDF node in any plan."""
    for name, fn in E.catalog.queries().items():
        plan = fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert not any(p in plan for p in PYTHON_NODES), name
