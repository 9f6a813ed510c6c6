"""Every registered query against its SQL, on the smallest data."""

import os

import pytest

from tests.oracle import compare, connect
from twinproof.workload.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data here")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLE:
        assert compare(df, connect(SF), ORACLE[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
