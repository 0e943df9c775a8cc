"""Every registered query against its DuckDB oracle on the smallest scale."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracle import compare, duck_conn  # noqa: E402
from custfold.catalog import REGISTRY, load_all  # noqa: E402

from conftest import SMALL  # noqa: E402

load_all()


@pytest.fixture(scope="module")
def con():
    return duck_conn(SMALL)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, con, name):
    fn, sql = REGISTRY[name]
    r = compare(spark, con, name, fn, sql, SMALL)
    assert sql and r.get("ok") is True, r


def test_entry_smoke(spark):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
