"""Components far beyond those of embeddings keep their exact values."""

import random

import pytest
from test_topk import brute, run

from corpusloom.llm import topk as K


def test_components_of_a_million(spark, monkeypatch):
    monkeypatch.setattr(K, "BLOCK_ROWS", 50)
    rng = random.Random(6)
    rows = [(i, [rng.choice([-1e6, 1e6, 1e6 + 1, 999_999.5, 524_288.0, 0.25]) for _ in range(64)]) for i in range(150)]
    assert run(spark, rows, set(range(0, 150, 10))) == brute(rows, set(range(0, 150, 10)), 5)
    ties = [(0, [1.0]), (1, [600_000.0]), (2, [700_000.0]), (3, [-700_000.0]), (4, [-600_000.0])]
    assert [r[2] for r in run(spark, ties, {0})] == [2, 1, 4, 3]


def test_scores_up_to_64_bits(spark):
    rows = [(0, [2.0 ** -8, 0.0]), (1, [2.0 ** 54, 2.0 ** 54]), (2, [-2.0 ** 54, 2.0 ** 50]), (3, [0.0, -2.0 ** 54]), (4, [1.5, 2.5])]
    assert run(spark, rows, {0}) == brute(rows, {0}, 5)
    for beyond in ([(0, [1.0]), (1, [2.0 ** 54])], [(0, [1.0]), (1, [2.0 ** 56])]):
        with pytest.raises(Exception, match="beyond 64 bits"):
            run(spark, beyond, {0})
