"""Every registered query against its DuckDB twin at sf0.01 (the driver's
correctness gate); queries without a twin must at least run."""

import pytest

from duetlog.catalog import registry

from .oracle import compare, duck_connect

registry.load_all()
KEYS = sorted(registry.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck_connect()


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    r = compare(key, spark, con, verbose=True)
    assert r["ok"] is not False, r
