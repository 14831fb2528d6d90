import math
import random

from corpusloom.llm import topk as K


def brute(rows, queries, k):
    whole = {}
    out = []
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for i, v in usable:
        whole.setdefault(i, []).append(v)
    for q in sorted(queries & set(whole)):
        own = min(whole[q])
        scored = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in usable if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return out


def run(spark, rows, queries, k=5):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id bigint, embedding array<float>, x string, block int")
    vectors = K.quantise(df)
    got = K.top_k(vectors, vectors.filter(vectors.vec_id.isin(sorted(queries))), k)
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect())


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(K, "BLOCK_ROWS", 100)
    monkeypatch.setattr(K, "QUERIES_PER_UNIT", 7)
    random.seed(3)
    rows = [(i, [random.choice([-1.5, -0.25, 0.0, 0.125, 3.0]) for _ in range(5)]) for i in range(400)]
    assert run(spark, rows, set(range(0, 400, 20))) == brute(rows, set(range(0, 400, 20)), 5)


def test_awkward_vectors(spark):
    rows = [(0, [0.5, -0.5]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]), (None, [1.0, 1.0]), (5, [0.5, -0.5]), (5, [0.5, -0.5]),
            (6, [0.0, 0.0]), (7, [-9.0]), (8, []), (9, [1000.0, -1000.0])]
    assert run(spark, rows, {0, 5, 6, 7, 8, 1}) == brute(rows, {0, 5, 6, 7, 8}, 5)
    assert run(spark, rows[:1], {0}) == []
    assert run(spark, [], {0}) == []
