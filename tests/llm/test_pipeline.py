"""Each stage against a plain version on its own input."""

import corpus_pipeline as C
import pytest
from brute import DOCUMENTS, classes, contamination, documents, repeats
from test_neardup import judge

from corpusloom.session import stage


@pytest.fixture(scope="module")
def staged(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, step in C.STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
        out.append(docs)
    return out


def rows(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_columns_and_counts(staged):
    assert all(tuple(df.columns) == C.COLUMNS for df in staged[:-1])
    counts = [df.count() for df in staged]
    assert counts[0] > counts[1] > counts[2] >= counts[3] > counts[4] > 0


def test_toxic_documents_go(staged, spark, sf_dir):
    toxic = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").filter("toxic = 1").collect()}
    clean = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").filter("toxic = 0").collect()}
    kept = {i for i, _ in rows(staged[1])}
    assert len(toxic & kept) <= len(toxic) // 2 and clean <= kept


def test_one_of_each_class_stays(staged, spark):
    before = rows(staged[1])
    first = classes(before, judge(spark, before))
    assert rows(staged[2]) == sorted(r for r, c in zip(before, first, strict=True) if r[0] == c)


def test_repeats_are_cut(staged):
    before = rows(staged[2])
    after = dict(rows(staged[3]))
    for (i, text), (_, (size, removed, _, _)) in zip(before, repeats(before), strict=True):
        if removed == 0:
            assert after[i] == text
        elif removed == size:
            assert i not in after
        elif i in after:
            assert 0 <= size - removed - len(after[i].encode()) <= 12


def test_contaminated_documents_go(staged, spark, sf_dir):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    before = rows(staged[3])
    assert rows(staged[4]) == sorted(r for r, found in zip(before, contamination(before, items), strict=True) if not found[2])


def test_all_documents_are_packed(staged):
    assert {r.doc_id for r in staged[5].collect()} == {i for i, _ in rows(staged[4])}


def test_awkward_rows_pass_every_stage(spark, sf_dir):
    """Nulls, empty and very long texts, repeated rows, columns of clashing names: what each stage keeps of them."""
    docs, items = documents(spark), [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]

    def kept(step):
        out = step(spark, docs, sf_dir)
        assert tuple(out.columns) == C.COLUMNS
        return sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    everything = sorted(DOCUMENTS, key=repr)
    assert kept(C.drop_toxic) == everything
    numbered = [(n, t) for n, (_, t) in enumerate(DOCUMENTS)]
    one = kept(C.drop_near_duplicates)
    assert len(one) == len(set(classes(numbered, judge(spark, numbered)))) and set(one) <= set(DOCUMENTS)
    cut = kept(C.cut_repeats)
    left = [(i, t, size - removed) for (i, t), (_, (size, removed, _, _)) in zip(DOCUMENTS, repeats(DOCUMENTS), strict=True) if not removed or size > removed]
    assert sorted(((i, t) for i, t, n in left if n == len((t or "").encode())), key=repr) == sorted((r for r in cut if r in DOCUMENTS), key=repr)
    assert {i for i, _ in cut} <= {i for i, _, _ in left}
    assert kept(C.drop_contaminated) == sorted((r for r, found in zip(DOCUMENTS, contamination(DOCUMENTS, items), strict=True) if not found[2]), key=repr)
    pieces = C.pack_sequences(spark, docs, sf_dir).collect()
    assert sorted((r.doc_id for r in pieces if r.piece == 0), key=repr) == sorted((i for i, _ in DOCUMENTS), key=repr)
    for _, step in C.STAGES:
        assert step(spark, documents(spark, []), sf_dir).count() == 0
