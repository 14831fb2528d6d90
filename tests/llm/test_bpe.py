import hashlib
import random

import numpy as np
import pytest
from brute import DOCUMENTS, documents

from corpusloom.llm import bpe as B
from corpusloom.llm import chunks as C
from corpusloom.llm.queries import QUERIES, tokenizer_file


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_file())


@pytest.fixture(scope="module")
def vocabulary():
    return B.Vocabulary(tokenizer_file())


def encode(encoder, texts):
    parts = [t.encode() for t in texts]
    flat, counts = encoder.encode(np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)]))
    ends = np.cumsum(counts)
    return [flat[e - n:e].tolist() for e, n in zip(ends, counts)]


def odd_texts():
    rng = random.Random(3)
    letters = ["aeinrsthoéüñ", "ab", "!?-.'", "".join(map(chr, [*range(33, 127), *range(0xA0, 0x250), *range(0x370, 0x400), *range(0x4E00, 0x4E40), 0x1F600, 0x301, 0x2028, 0x85]))]
    words = ["".join(rng.choice(some) for _ in range(rng.randrange(1, 90))) for some in letters for _ in range(700)]
    words += ["a" * n for n in (1, 2, 3, 63, 64, 65, 5000)] + ["don't", "'sir", "we'll'", "<|endoftext|>x<|startoftext|>", "İ", "ΟΔΟΣ", "\x00\x01", "a\tb c", "q" * 300 + "z"]
    rng.shuffle(words)
    return ["", " ", "\n\n"] + [" ".join(words[i:i + 7]) for i in range(0, len(words), 7)]


def test_odd_words_have_the_tokenizers_ids(tokenizer, vocabulary):
    encoder = B.Encoder(tokenizer_file(), vocabulary)
    texts = odd_texts()
    assert encode(encoder, texts) == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert 0 < encoder.speculator.failed < encoder.speculator.tried  # both ways were taken


def test_borders_decide_as_exact_merging_does(vocabulary):
    """Two tokens fit exactly if merging their letters side by side gives them again."""
    rng = np.random.default_rng(5)
    made = np.flatnonzero(np.isin(np.arange(len(vocabulary.names)), vocabulary.token))
    spelt = {t: [vocabulary.letters[c] for c in vocabulary.names[t].removesuffix("</w>")] for t in made.tolist()}
    inner = np.array([t for t in made.tolist() if not vocabulary.names[t].endswith("</w>")])
    short = np.array([t for t in made.tolist() if len(spelt[t]) <= 3])
    a = rng.choice(np.intersect1d(inner, short), 3000)
    b = rng.choice(short, 3000)
    fits = vocabulary.fits(a, b)
    assert 200 < fits.sum() < 2800
    for x, y, fit in zip(a.tolist(), b.tolist(), fits.tolist()):
        symbols = spelt[x] + spelt[y]
        symbols[-1] += B.FINAL * vocabulary.names[y].endswith("</w>")
        assert (vocabulary.merge(symbols) == [x, y]) == fit


def test_exact_merging_of_long_words(tokenizer, vocabulary):
    for word in ("thththerererer" * 300, "a" * 4097, "ab" * 3000 + "z"):
        assert vocabulary.merge([*word[:-1].encode(), ord(word[-1]) + B.FINAL]) == tokenizer.encode(word, add_special_tokens=False).ids


def test_emptied_and_colliding_tables(tokenizer, vocabulary, monkeypatch):
    texts = odd_texts()
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    monkeypatch.setattr(C, "KEPT", 50)
    encoder = B.Encoder(tokenizer_file(), vocabulary)
    assert [ids for i in range(0, len(texts), 9) for ids in encode(encoder, texts[i:i + 9])] == want
    monkeypatch.setattr(C, "_MIX", np.uint64(1 << 60))  # nearly all hashes are equal: spelling decides
    encoder = B.Encoder(tokenizer_file(), vocabulary)
    assert encode(encoder, texts) == want
    assert encoder.table.odd


def expected(tokenizer, rows):
    out = []
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        out.append((doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                    hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_awkward_rows(spark, tokenizer):
    got = B.decode_documents(B.encode_documents(documents(spark).repartition(3), tokenizer_file(), keep=("doc_id", "node", "key")), tokenizer_file()).collect()
    want = [(i, tokenizer.encode(t or "", add_special_tokens=False).ids) for i, t in DOCUMENTS]
    assert sorted(((r.doc_id, r.ids) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r.decoded == tokenizer.decode(r.ids, skip_special_tokens=False) for r in got)
    assert {(r.node, r.key) for r in got} == {("x", 2)}
    both = B.encode_documents(documents(spark), tokenizer_file(), decoded=True).collect()
    assert sorted(((r.doc_id, r.ids, r.decoded) for r in both), key=repr) == sorted(((r.doc_id, r.ids, r.decoded) for r in got), key=repr)
    empty = B.decode_documents(B.encode_documents(documents(spark, []), tokenizer_file()), tokenizer_file())
    assert empty.count() == 0
    nothing = spark.createDataFrame([(1, None), (2, [])], "doc_id bigint, ids array<int>")
    assert [r.decoded for r in B.decode_documents(nothing, tokenizer_file()).collect()] == ["", ""]


def test_whole_table(spark, sf_dir, tokenizer):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in QUERIES["op13_speculative_bpe"](spark, sf_dir).collect()), key=repr)
    assert got == expected(tokenizer, rows)


def test_other_vocabularies_are_refused(tmp_path):
    import public_tokenizers
    with pytest.raises(ValueError):
        B.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
