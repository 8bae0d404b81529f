"""Every registered query against its SQL on the smallest tables."""

import pytest
from checking import connect, differences

from pulsegrid.plans.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name in ORACLES:
        assert differences(got, con.execute(ORACLES[name]).df()) == []
    else:
        assert len(got) > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
