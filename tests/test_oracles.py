"""Every query with SQL gives exactly the rows of that SQL."""

import pytest
from conftest import SMALL

import __spark_entry__ as contract
from checks import oracles
from checks import queries as registered
from checks.compare import connect, differences

SQL = oracles.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    got = registered.queries()[name](spark, SMALL).toArrow()
    assert len(got) > 0
    assert differences(con, got, SQL[name]) == []


def test_only_trained_models_lack_sql():
    assert set(registered.queries()) - set(SQL) == {"cv_rf", "cv_lr", "cv_dt", "cv_gbt", "score_pairs"}


def test_entry_has_the_wide_schema(spark):
    from patronlens import FeatureConfig

    df = contract.entry(spark)
    assert df.columns == FeatureConfig().full_columns()
    assert {kind for _, kind in df.dtypes} == {"double"}
    assert df.count() == 4330


def test_registering_needs_no_session():
    import subprocess
    import sys

    from conftest import ROOT

    code = "import __spark_entry__ as c; assert len(c.queries()) >= 58 and len(c.oracle_sql()) >= 53"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
