"""Every registered query against its independent SQL oracle (DuckDB)."""

import pytest

import __spark_entry__ as E
from compare import compare, duck
from conftest import SF_MID, SF_SMALL

KEYS = sorted(E.queries())
ORACLE = E.oracle_sql()

# The heaviest chains also run at the mid scale.
MID_KEYS = ["raw_credit", "int_ecl_inputs", "mart_portfolio_summary", "mart_npl_analysis",
            "mart_ecl_estimates", "mart_vintage_curves", "mart_regulatory_ratios", "fn_round",
            "dq_all", "surrogate_id"]


@pytest.fixture(scope="module")
def con_small():
    return duck(SF_SMALL)


@pytest.fixture(scope="module")
def con_mid():
    return duck(SF_MID)


def test_every_key_has_an_oracle():
    own = [k for k in KEYS if k != "pipeline" and not k.startswith("op")]
    assert sorted(k for k in ORACLE if not k.startswith("op")) == own


@pytest.mark.parametrize("key", [k for k in KEYS if k in ORACLE])
def test_small(spark, con_small, key):
    ok, msg = compare(E.queries()[key](spark, SF_SMALL), con_small, ORACLE[key])
    assert ok, msg


@pytest.mark.parametrize("key", MID_KEYS)
def test_mid(spark, con_mid, key):
    ok, msg = compare(E.queries()[key](spark, SF_MID), con_mid, ORACLE[key])
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "loan_count" in df.columns
