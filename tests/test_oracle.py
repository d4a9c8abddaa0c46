"""Every registered query against its DuckDB oracle (the driver's check,
here at sf0.001 to keep the suite quick; tests/run_compare.py runs sf0.01)."""

import os

import pytest

import __spark_entry__ as E
from compare import compare, duck
from skyfold.plans.queries import queries

SF = os.environ.get("SKYFOLD_TEST_SF", "/root/testdata/sf0.001")
NAMES = sorted(queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    r = compare(df, con, E.oracle_sql()[name])
    assert r["hash_match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "dep_otp_pct" in df.columns
