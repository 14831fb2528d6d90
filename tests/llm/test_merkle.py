import hashlib
import zlib
from collections import defaultdict

import pytest
from brute import DOCUMENTS, documents
from pyspark.sql import functions as F

from corpusloom.llm import merkle as M


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    shown = [None if v is None else str(v) for v in (row[0], row[1], row[2], row[3], text)]
    return digest(*("-" if v is None else f"{len(v.encode())}:{v}" for v in shown))


def climb(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i:i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) by plain lists."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append((row[0] is not None, row[0], leaf(row, row[4]), row))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for source in order:
        groups[source].sort(key=lambda x: (x[0], x[1] if x[0] else 0, x[2]))
    levels = {s: climb([x[2] for x in groups[s]]) for s in order}
    top, out = climb([levels[s][-1][0] for s in order]), []
    for nth, source in enumerate(order):
        for place, (_, doc_id, own, row) in enumerate(groups[source]):
            odd = doc_id is not None and row[4] is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0
            node, siblings = (leaf(row, row[4].replace("\n", "")) if odd else own), []
            for found, at in ((levels[source], place), (top, nth)):
                for level in found[:-1]:
                    first = at - at % 3
                    left, right = level[first:at], level[at + 1:first + 3]
                    siblings += left + right
                    node, at = digest(*left, node, *right), at // 3
            out.append((doc_id, own, levels[source][-1][0], top[-1][0], digest(*siblings), node, node == top[-1][0]))
    return sorted(out, key=repr)


def run(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, source string, lang string, n_chars bigint, text string, grp string, pos int").repartition(3)
    got = M.merkle_manifest(docs, F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"))))
    got = got.select("doc_id", "leaf", "subroot", "root", M.proof(F.col("path")).alias("proof"), "folded_root", (F.col("folded_root") == F.col("root")).alias("ok"))
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize("levels", (1, 2, 6))
def test_manifest_equals_plain_lists(spark, monkeypatch, levels):
    """With blocks of 3, 9 and 729 nodes: groups of one node, of a block and a bit, of several heights, awkward values, repeated rows."""
    monkeypatch.setattr(M, "CLIMB", levels)
    sources = ["a", "b", None, "", "ä", "z"]
    rows = [(i, "hot", "en", 3, f"line {i}\nmore {i}") for i in range(100)]
    rows += [(i, sources[n % 6], None if n % 4 else "en", n, t) for n, (i, t) in enumerate(DOCUMENTS)]
    rows += [(200 + i, f"s{i % 10}", "en", None, "x\n") for i in range(31)]
    assert run(spark, rows) == manifest(rows)


def test_small_and_empty_tables(spark):
    for rows in ([], [(1, "a", "en", 1, "x")], [(1, "a", "en", 1, "x\n"), (2, None, None, None, None)], [(7, "a", "en", 1, None)] * 5):
        assert run(spark, rows) == manifest(rows)


def test_block_strings_are_bounded(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("source", F.lit("one"))
    tree_rows = M.merkle_manifest(docs)
    assert tree_rows.filter(F.size("path") != F.lit(5)).count() == 0  # 200 leaves below one source: five runs up
    assert tree_rows.filter("folded_root <> root").count() == 0
