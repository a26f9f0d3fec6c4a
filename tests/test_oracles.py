"""Every registered query against its SQL on the small tables."""

import pytest

from compare import connect, differences
from patronlens.plans import oracles, registry

SF = "/root/testdata/sf0.001"
NAMES = sorted(registry.queries())


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(registry.queries()) == set(oracles.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, con, name):
    df = registry.queries()[name](spark, SF)
    assert differences(df, con, oracles.oracle_sql()[name]) is None
