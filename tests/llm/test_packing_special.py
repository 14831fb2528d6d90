"""Literals of special tokens in the registered query and the pipeline: the tokenizer's own default decides."""

import zlib

import numpy as np
from brute import documents
from tokenizers import Tokenizer

import corpus_pipeline
from corpusloom.llm.packing import WordEncoder
from corpusloom.llm.queries import QUERIES, tokenizer_file

TEXTS = ["hello <|endoftext|> world", "<|startoftext|>a<|endoftext|>", "hello<|endoftext|>world.", "x <|ENDOFTEXT|>\n<|endoftext|><|endoftext|> é\t<|endoftext|>!",
         "don't <|endoftext |> <|endof\ntext|>", "plain words only", "", None]


def ids(text):
    return Tokenizer.from_file(tokenizer_file()).encode(text or "", add_special_tokens=False).ids


def test_literals_are_special_tokens(spark, tmp_path):
    assert ids(TEXTS[0]) == [3306, 49407, 1002]
    docs = documents(spark, list(enumerate(TEXTS)))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = [(i, len(ids(t)) + 1, zlib.crc32(np.array([*ids(t), 1], "<u4").tobytes())) for i, t in enumerate(TEXTS)]
    for got in (QUERIES["op5_best_fit_packing"](spark, str(tmp_path)), corpus_pipeline.pack_sequences(spark, docs, str(tmp_path))):
        assert sorted((r.doc_id, r.length, r.ids_crc32) for r in got.collect()) == want


def test_encoder_equals_tokenizer_on_whole_texts():
    flat, counts = WordEncoder(tokenizer_file()).encode([t or "" for t in TEXTS])
    assert [part.tolist() for part in np.split(flat, np.cumsum(counts)[:-1])] == [ids(t) for t in TEXTS]
