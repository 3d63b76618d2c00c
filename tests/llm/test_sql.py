"""Queries of the text operators against SQL on the smallest tables."""

import pytest

from telcolake.llm.queries import ORACLE, QUERIES
from verification.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE))
def test_matches_sql(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLE[name]) is None


def test_names():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline")
    assert numbers == list(range(1, 14))
