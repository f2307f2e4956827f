"""Every registered query against its SQL statement, on the smallest tables."""

import os

import pytest

import __spark_entry__ as E
from compare import duck, frame_digest
from strata.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_entry_runs(spark):
    df = E.entry(spark)
    out = df.collect()
    assert 0 < len(out) <= 10
    assert df.columns == ["p_type", "total_sales"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    df = E.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    cols, expect = duck(SF, E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(expect)
    assert frame_digest(df.columns, got) == frame_digest(cols, expect)
