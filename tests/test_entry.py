"""Driver contract: entry runs, every query has a callable, oracle keys are a subset."""

import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert {"domain_name", "visit_count", "quality_score", "top_url"} <= set(df.columns)


def test_registry_shape():
    qs, os_ = E.queries(), E.oracle_sql()
    assert len(qs) >= 50
    assert set(os_) <= set(qs)
