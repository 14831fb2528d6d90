import math
import random
from collections import Counter
from functools import lru_cache

import numpy as np
from brute import DOCUMENTS, classes, documents, words

from corpusloom.llm import neardup as N
from corpusloom.llm.components import components


def judge(spark, rows):
    """Weighted Jaccard over TF-IDF of five-word shingles by dictionaries; rarer shingles than ``COMMON`` count as frequent as that."""
    def bag(text):
        w = words(text)
        return Counter(tuple(w[i:i + N.SHINGLE]) for i in range(max(1, len(w) - N.SHINGLE + 1))) if w else Counter()
    found = Counter(s for _, text in rows for s in bag(text))
    least = max(2, math.ceil(N.COMMON * len(rows)))

    @lru_cache(None)
    def vector(text):
        out = {}
        for shingle, n in bag(text).items():
            log = math.log1p(len(rows) / max(least, found[shingle]))
            out[shingle] = log / (log + 0.5) * (1 + math.log(n))
        return out

    def near(a, b):
        x, y = vector(a), vector(b)
        shared = sum(min(w, y[s]) for s, w in x.items() if s in y)
        return bool(x and y) and shared >= N.THRESHOLD * (sum(x.values()) + sum(y.values()) - shared)
    return near


def check(spark, rows):
    got = sorted(((r.doc_id, r.class_id) for r in N.near_duplicates(documents(spark, rows).repartition(3)).collect()), key=repr)
    want = sorted(zip([i for i, _ in rows], classes(rows, judge(spark, rows)), strict=True), key=repr)
    assert got == want


def test_awkward_rows(spark):
    check(spark, DOCUMENTS)
    assert N.near_duplicates(documents(spark, [])).count() == 0


def edited(rng, text, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


def test_groups_of_near_copies_and_shared_passages(spark, monkeypatch):
    """One large group whose members agree with the original more than with each other, beside documents that share a passage."""
    monkeypatch.setattr(N, "BLOCK", 16)
    rng = random.Random(5)
    base = [" ".join(f"w{rng.randrange(5000)}" for _ in range(300)) for _ in range(12)]
    passage = " ".join(f"p{i}" for i in range(150))
    rows = [(1000 + i, edited(rng, base[0], 7)) for i in range(120)] + [(2, base[0])]
    rows += [(3000 + i, edited(rng, base[1 + i % 4], rng.randrange(1, 9))) for i in range(60)]
    rows += [(5000 + i, f"{passage} " + " ".join(f"o{i}x{j}" for j in range(120))) for i in range(60)]
    check(spark, rows)


def test_agreement_estimates_weighted_jaccard():
    rng = np.random.default_rng(1)
    shared, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (700, 150, 150))
    hashes = np.concatenate([np.sort(np.r_[shared, a]), np.sort(np.r_[shared, b])])
    weight = {int(h): w for h, w in zip(np.r_[shared, a, b].tolist(), rng.uniform(0.3, 3, 1000), strict=True)}
    weights = np.array([weight[int(h)] for h in hashes.tolist()], np.float32)
    got = N.samples(hashes, weights, np.array([0, 850]), 3000)
    want = N.weighted_jaccard((hashes[:850], weights[:850]), (hashes[850:], weights[850:]))
    assert abs((got[0] == got[1]).mean() - want) < 0.03


def test_components(spark):
    edges = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(60)] + [("x", "y"), ("hub", "a1"), ("hub", "a2"), ("hub", "a3")]
    got = dict(components(spark.createDataFrame(edges, "a string, b string")).collect())
    assert {got[f"n{i:03d}"] for i in range(61)} == {"n000"}
    assert (got["y"], got["a3"], got["hub"]) == ("x", "a1", "a1")
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_document_frequencies_do_not_depend_on_how_rows_are_dealt(spark, monkeypatch):
    """Histograms put out as many rows a task for few documents as for many, and find exactly the common shingles."""
    monkeypatch.setattr(N, "COMMON", 1 / 20)
    rows = [(i, " ".join(f"c{i % 7}x{j}" for j in range(12)) + f" own{i} a{i} b{i} c{i} d{i}") for i in range(400)]
    texts = documents(spark, rows).select("text")
    few, many = (N.fit_weights(texts.repartition(n), 1 / 20) for n in (2, 64))
    assert len(few.lookup.known) == 7 * 8  # shingles within the shared words; the others are in one document
    assert (few.lookup.known == many.lookup.known).all() and (few.idf == many.idf).all()
    assert texts.repartition(64).mapInArrow(N._histogram(14), "part int, counts binary").count() <= 64 * 2 * N.SLICES
