"""Every registered query equals its SQL twin run by DuckDB on the same tables."""

import pytest

from strata.plans.registry import ORACLE_SQL, QUERIES, load_all
from strata.testing import compare, duck
from tests.conftest import SF_SMALL

load_all()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_a_twin():
    assert set(ORACLE_SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = con.execute(ORACLE_SQL[name]).df()
    reason = compare(got, want)
    assert reason is None, reason
