import random

import numpy as np
import pytest
from brute import DOCUMENTS, documents, repeats
from pyspark.sql import functions as F

from corpusloom.llm import repeats as R
from corpusloom.llm.suffixes import permuted_lcp, suffix_array


def run(spark, rows):
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["length"])
    got = R.remove_repeats(documents(spark, rows).repartition(3)).select("doc_id", "n_bytes", removed, F.size("spans"), F.sha2("kept", 256)).collect()
    return sorted((2**63 - 1 if r[0] is None else r[0], tuple(r[1:])) for r in got)


@pytest.mark.parametrize(("chunk", "hot"), [(4 << 20, 20_000), (600, 20_000), (600, 2)])
def test_against_brute_force(spark, monkeypatch, chunk, hot):
    monkeypatch.setattr(R, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(R, "HOT", hot)
    rng = random.Random(chunk + hot)
    rows = [r for r in DOCUMENTS if len(r[1] or "") < 10_000]
    passages = ["".join(rng.choice("abé ") for _ in range(n)) for n in (48, 50, 51, 60, 130)]
    rows += [(100 + i, "".join(rng.choice([*passages, "xyz", "é", "\n", "aaaa"]) for _ in range(rng.randrange(6)))) for i in range(60)]
    want = sorted(repeats(rows))
    assert run(spark, rows) == want
    assert sum(w[1][1] for w in want) > 1000


def test_empty_table_and_decoded_texts(spark):
    assert run(spark, []) == []
    rows = [(1, "é" * 60), (2, "x" + "é" * 60 + "ü"), (3, "y" + "é" * 60 + "中")]  # é and ü share their first byte
    got = {r.doc_id: r.kept for r in R.remove_repeats(documents(spark, rows), decoded=True).collect()}
    assert got == {1: "é" * 60, 2: "x", 3: "y中"}


def test_suffix_arrays_and_prefixes():
    rng = random.Random(2)
    for _ in range(300):
        s = np.array([rng.randrange(rng.choice([1, 2, 3, 256])) for _ in range(rng.randrange(70))], np.int64)
        if rng.random() < 0.3 and len(s):
            s = np.tile(s[:max(1, len(s) // 6)], 6)
        order = suffix_array(s)
        assert order.tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
        shared = permuted_lcp(s.astype(np.uint8), order, 20)
        for a, b in zip(order[:-1], order[1:], strict=True):
            n = 0
            while n < 20 and max(a, b) + n < len(s) and s[a + n] == s[b + n]:
                n += 1
            assert shared[b] == n


def test_equal_windows_have_equal_anchors():
    rng = random.Random(3)
    data = bytes(rng.choice(b"abc \xc3\xa9") for _ in range(3000))
    for text in (data, b"a" * 700 + data[:900], data[:49], b""):
        at, _ = R.anchors(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        places = set(at.tolist())
        for p in range(len(text) - 49):
            alone, _ = R.anchors(np.frombuffer(text[p:p + 50], np.uint8), np.array([0, 50]))
            assert len(alone) and {p + i for i in alone.tolist()} <= places


def test_very_long_texts_and_many_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(R, "CHUNK_BYTES", 40_000)
    monkeypatch.setattr(R, "HOT", 300)
    same = "the same passage over and over, of more than fifty bytes, by one id; "
    rows = [*DOCUMENTS, *[(500, same)] * 700, (400, "x" + same * 3), (600, same[5:60]), (None, same), (None, same)]
    assert run(spark, rows) == sorted(repeats(rows))


def test_equal_rows_do_not_meet_in_one_chunk(spark, monkeypatch):
    monkeypatch.setattr(R, "CHUNK_BYTES", 4000)
    seen = spark.sparkContext.accumulator(0)

    def counted(parts):
        work = original(parts)

        def run_(table):
            seen.add(1)
            return work(table)
        return run_
    original = R._anchor_counts
    monkeypatch.setattr(R, "_anchor_counts", counted)
    rows = [(7, "one text that is said a thousand times and has more than fifty bytes")] * 1000
    assert R.remove_repeats(documents(spark, rows)).filter("size(spans) > 0").count() == 0
    assert seen.value > 8


def test_counts_travel_whole():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**63, 500, dtype=np.uint64))
    occurrences, several = rng.choice([1, 2, 126, 127, 128, 255, 70_000], len(keys)), rng.random(len(keys)) < 0.5
    got = R._unpacked(R._packed(keys, occurrences, several))
    assert all((a == b).all() for a, b in zip(got, (keys, occurrences, several)))
    assert all(len(x) == 0 for x in R._unpacked(R._packed(keys[:0], occurrences[:0], several[:0])))


def test_texts_without_anything_in_common(spark):
    rows = [(i, "".join(chr(97 + (i * 31 + j * j * (i + 3)) % 26) for j in range(200))) for i in range(12)]
    assert sum(r[1][1] for r in repeats(rows)) == 0
    assert run(spark, rows) == sorted(repeats(rows))


def units_of(texts):
    """The one shard's input, with the anchors of all texts taken for shared ones."""
    n = len(texts)
    rows = R.pa.table({"chunk": R.pa.array([0] * n, R.pa.int64()), "doc_id": R.pa.array(range(n), R.pa.int64()),
                       "digest": R.pa.array(range(n), R.pa.int64()), "text": texts})
    chunk = R.Chunk(rows)
    units = R.Units(chunk, np.ones(len(chunk.known), np.uint8))
    return units, R._table(R.UNITS, [(p, 0, *blobs) for p, *blobs in units.blobs(1)])


def test_strings_that_share_no_window_are_not_sorted(monkeypatch):
    rng, sorted_strings = random.Random(5), []

    def watched(strings, sizes, firsts):
        sorted_strings.append(len(sizes))
        return original(strings, sizes, firsts)
    original = R.repeated_windows
    monkeypatch.setattr(R, "repeated_windows", watched)

    def noise(n):
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    passage, short = noise(50), noise(30)
    units, table = units_of([noise(90) + short + noise(90) for _ in range(200)])
    key = units.distinct.view(np.uint8).reshape(len(units.distinct), -1)[:, :8].copy().view(">u8")[:, 0]
    assert np.unique(key, return_counts=True)[1].max() > 50  # many strings around one anchor
    answers = R._shard(table)
    assert not any(np.frombuffer(b"".join(answers["masks"].to_pylist()), "<u8"))
    assert sum(sorted_strings) < 20
    masks = np.frombuffer(b"".join(R._shard(units_of([noise(90) + passage + noise(90) for _ in range(20)])[1])["masks"].to_pylist()), "<u8")
    assert np.count_nonzero(masks) >= 19


def test_single_windows_around_anchors_at_every_place(spark):
    rng, rows, places = random.Random(6), [], set()

    def noise(n):
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    for i in range(150):
        window = noise(50)
        places |= set(R.anchors(np.frombuffer(window.encode(), np.uint8), np.array([0, 50]))[0].tolist())
        before, after = (0, 40) if i % 5 == 0 else (40, 0) if i % 5 == 1 else (40, 40)
        rows += [(2 * i, noise(before) + "A" * (before > 0) + window + "B" * (after > 0) + noise(after)),
                 (2 * i + 1, noise(before) + "C" * (before > 0) + window + "D" * (after > 0) + noise(after))]
    assert places == set(range(R.SPAN))
    want = sorted(repeats(rows))
    assert sum(w[1][1] for w in want) >= 150 * 50 and run(spark, rows) == want
