"""Every registered query against its DuckDB oracle at sf0.01 (the driver's
correctness gate, run locally)."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

from conftest import SF01  # noqa: E402

NAMES = sorted(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, name, E.queries()[name], E.oracle_sql().get(name), SF01, con)
    assert res["status"] in ("match", "rows-only"), res


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 4 and df.columns == ["check_order", "check", "passed", "metric", "detail", "message"]
