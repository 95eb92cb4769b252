"""Every registry query against its DuckDB oracle (rows-only where none)."""

import pytest

from zoneflow.plans import oracle_check, registry

registry.load_all()
NAMES = sorted(registry.QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf001, name):
    r = oracle_check.compare(spark, name, registry.QUERIES[name], registry.ORACLE.get(name), sf001)
    assert r["status"] in ("match", "rows-only"), r
    if r["status"] == "rows-only":
        assert r["spark_rows"] > 0


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["_id", "text_to_embed", "source"]
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
