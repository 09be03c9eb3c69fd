"""Driver contract: entry runs; oracle keys ⊆ query keys (every query runs in test_queries)."""

import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "net_profit" in df.columns


def test_oracles_cover_registered_queries():
    qs, orc = E.queries(), E.oracle_sql()
    assert set(orc) <= set(qs)
    assert len(qs) >= 100
