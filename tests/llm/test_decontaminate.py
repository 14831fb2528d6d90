from brute import DOCUMENTS, LINE, contamination, documents
from pyspark.sql import functions as F

from corpusloom.llm import decontaminate as D

ITEMS = [(1, f"{LINE} indeed"), (2, "Short, item"), (None, "it's 12345"), (4, None), (5, "..."), (10, LINE), (1, "word5 35 more word6 42 more word7 49 more word8 56"), (6, "short"),
         (7, "ΟΔΟΣ 中文字"), (8, "a " * 30)]


def run(spark, rows, items):
    benchmark = spark.createDataFrame([(*i, "x") for i in items], "item_id bigint, text string, words string")
    found = D.find_contamination(documents(spark, rows), benchmark)
    return sorted(((r.doc_id, r.n_words, r.hit, list(r["items"])) for r in found.withColumn("hit", D.hit_words(F.col("runs"))).collect()), key=repr)


def test_awkward_rows(spark):
    rows = DOCUMENTS + [(30, "a a A, a;a a a a a a a a"), (31, " ".join(LINE.split()[3:14])), (32, LINE.upper().replace(" ", "--"))]
    want = sorted(contamination(rows, ITEMS), key=repr)
    assert run(spark, rows, ITEMS) == want
    assert sum(w[2] > 0 for w in want) > 8


def test_many_passes_agree_with_one(spark, monkeypatch):
    monkeypatch.setattr(D, "WINDOWS_PER_PASS", 7)
    assert run(spark, DOCUMENTS, ITEMS) == sorted(contamination(DOCUMENTS, ITEMS), key=repr)


def test_empty_tables(spark):
    assert run(spark, DOCUMENTS, []) == sorted(contamination(DOCUMENTS, []), key=repr)
    assert run(spark, [], ITEMS) == []


def test_small_slices(spark, monkeypatch, sf_dir):
    from corpusloom.llm import words
    monkeypatch.setattr(words, "SLICE_BYTES", 100)
    assert run(spark, DOCUMENTS, ITEMS) == sorted(contamination(DOCUMENTS, ITEMS), key=repr)
