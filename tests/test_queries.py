"""Every registered query against DuckDB on the smallest test data."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as contract  # noqa: E402
from check_oracle import compare, connect  # noqa: E402

SF = "/root/testdata/sf0.001"
ORACLES = contract.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test data not present")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, SF)
    if name in ORACLES:
        assert compare(df, duck, ORACLES[name])[0] == "ok"
    else:
        assert df.columns and df.count() >= 0


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 5
