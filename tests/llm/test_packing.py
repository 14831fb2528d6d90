import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from brute import DOCUMENTS, documents

from corpusloom.llm import packing as P
from corpusloom.llm.queries import tokenizer_file


def plain_pieces(rows):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(tokenizer_file())
    tokenizer.encode_special_tokens = True
    out = []
    for i, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start:start + 4096]
            out.append((i, piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return sorted(out, key=repr)


def check(rows, got):
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == plain_pieces(rows)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(r.length for r in got)
    assert len(bins) <= -(-total // 4096) * 11 // 9 + 1  # best fit decreasing never needs more
    return len(bins)


def test_awkward_rows(spark):
    check(DOCUMENTS, P.pack_documents(documents(spark, DOCUMENTS).repartition(3), tokenizer_file()).collect())
    assert P.pack_documents(documents(spark, []), tokenizer_file()).count() == 0


def test_whole_table(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(P, "WORDS_KEPT", 3000)  # the word table is emptied on the way
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = P.pack_documents(docs, tokenizer_file()).collect()
    assert check(rows, got) <= -(-sum(r.length for r in got) // 4096) + 1


def test_plan_keeps_every_capacity():
    rng = random.Random(4)
    for tokens, pieces, attention in ((100, 100, 10_000), (100, 3, 10_000), (100, 100, 3000)):
        lengths = [rng.choice([rng.randint(1, 50), 7, 33]) for _ in range(500)]
        bins, seen = defaultdict(list), Counter()
        for length, first, count, each, sequence, offset in P.best_fit(Counter(lengths), tokens, pieces, attention):
            assert first == seen[length]
            seen[length] += count
            for i in range(count):
                bins[sequence + i // each].append((offset + i % each * length, length))
        assert seen == Counter(lengths)
        for places in bins.values():
            places.sort()
            assert [o for o, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))]
            assert sum(n for _, n in places) <= tokens and len(places) <= pieces and sum(n * n for _, n in places) <= attention
        if attention == 10_000 and pieces == 100:
            assert len(bins) <= -(-sum(lengths) // tokens) + 1
