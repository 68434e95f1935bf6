"""Every registered query against its DuckDB oracle (smallest scale factor;
the driver repeats this at sf0.01)."""
import os

import pytest

import __spark_entry__ as E
from tools.check_oracle import compare, duck

SF = os.environ.get("GAFFER_ORACLE_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, SF, name)
    assert res[1] in ("ok", "no-oracle"), res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "horizon_expected_points" in df.columns


def test_oracle_types_recorded_for_every_sql_query():
    from gaffer.plans.catalog import QUERIES
    from gaffer.plans.oracle_types import _types
    recorded = _types()
    missing = [n for n, (_, sql) in QUERIES.items() if sql is not None and n not in recorded]
    assert not missing, f"run tools/gen_oracle_types.py: {missing}"
