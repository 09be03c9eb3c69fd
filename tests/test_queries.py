"""Every registered query on sf0.001, built once: plan shape (no nested-loop
or cartesian joins, no Python evaluation), it runs, and — where an oracle
exists — rows, column names and values equal DuckDB's (the driver's gate)."""

import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    return v.isoformat() if hasattr(v, "isoformat") else v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = sorted((tuple(_norm(r[i]) for i in order) for r in recs), key=repr)
    return [cols[i] for i in order], out


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(E.queries()))
def test_query(spark, duck, key):
    df = E.queries()[key](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython",
                "MapInPandas"):
        assert bad not in plan, bad
    sc, srows = _rows(df.columns, [tuple(r) for r in df.collect()])
    oracle = E.oracle_sql().get(key)
    if oracle is None:
        return
    d = duck.execute(oracle)
    dc, drows = _rows([x[0] for x in d.description], d.fetchall())
    assert sc == dc
    assert srows == drows
