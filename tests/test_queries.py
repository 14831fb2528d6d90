"""Every registered query against its SQL on the given tables."""

import pytest

from corpusloom.catalog.oracles import ORACLES
from corpusloom.catalog.queries import QUERIES

from oracle import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf_dir, con):
    got_names, got, want_names, want = compare(QUERIES[name](spark, sf_dir), con, ORACLES[name])
    assert got_names == want_names
    assert len(got) == len(want)
    assert got == want
