"""Queries of this subpackage against their SQL."""

import pytest
from oracle import compare, connect

from corpusloom.llm.common import ORACLES
from corpusloom.llm.queries import QUERIES


REGISTERED = range(1, 14)


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == sorted(REGISTERED)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(name, spark, sf_dir, con):
    got_names, got, want_names, want = compare(QUERIES[name](spark, sf_dir), con, ORACLES[name])
    assert got_names == want_names
    assert got == want
