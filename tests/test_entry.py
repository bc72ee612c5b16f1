"""Driver contract."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["lang", "n_docs", "n_tokens", "n_distinct_tokens"]


def test_registry_shapes():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert all(callable(f) for f in qs.values())
    assert len(qs) >= 57
