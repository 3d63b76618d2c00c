"""Every query with SQL against the other engine, on the smallest data; types included."""

import pytest

import __spark_entry__ as entry_points
from verification.compare import connect, difference
from verification.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"
# Learning takes a minute; test_model.py trains small forests instead.
SLOW = {"train_gbt", "train_random_forest", "model_comparison"}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(ORACLE))
def test_matches_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLE and n not in SLOW])
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.count() == 150
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
