"""Vector best-fit packing of tokenised documents into sequences of bounded size."""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import stage

from .chunks import ChunkTable, PlainChunks, slices
from .common import tidy

#: Capacities of a sequence: tokens, pieces, attention cost (sum of squared piece lengths).
TOKENS = 4096
PIECES = TOKENS  # a document has one token at least, so this one binds only if set lower
ATTENTION = TOKENS * TOKENS
#: Weights of the three residuals, each relative to its capacity, in the choice of a bin.
WEIGHTS = (1.0, 0.05, 0.05)
END_ID = 1
#: The table of words is emptied when it holds this many.
WORDS_KEPT = 600_000
TEXT_BATCH = 1 << 20

PIECE_SCHEMA = "task int, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, nth bigint"


class Merges:
    """Byte-pair merging of many words at once: all words still open take their best merge in one array step."""

    def __init__(self, model: dict) -> None:
        vocab = model["vocab"]
        # Byte-level alphabet: printable bytes stand for themselves, the others for the code points from 256 on, in order.
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in plain]
        letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}
        ending = model.get("end_of_word_suffix") or ""
        self.inner = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        self.final = np.array([vocab[letters[b] + ending] for b in range(256)], np.int64)
        pairs = [(vocab[a], vocab[b], vocab[a + b]) for a, b in model["merges"]]
        self.width = max(vocab.values()) + 1
        keys = np.array([a * self.width + b for a, b, _ in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.rank = keys[order], order.astype(np.int64)
        self.made = np.array([c for _, _, c in pairs], np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.rank[at], len(self.keys))

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of at most ``LONGEST`` bytes, end to end, and their numbers."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(sizes, kind="stable")
        named, sized, held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for start in range(0, len(words), 32_768):
            block = order[start:start + 32_768]
            size = sizes[block]
            raw = np.frombuffer(b"".join(words[i] for i in block.tolist()), np.uint8)
            ids = np.full((len(block), int(size.max()) + 1), -1, np.int64)
            inside = np.arange(ids.shape[1])[None, :] < size[:, None]
            ids[inside] = self.inner[raw]
            ids[np.arange(len(block)), size - 1] = self.final[raw[np.cumsum(size) - 1]]
            rank = np.full(ids.shape, len(self.keys), np.int64)
            rank[:, :-1] = self.ranks(ids[:, :-1], ids[:, 1:])
            names = block
            while True:
                at = rank.argmin(axis=1)
                best = rank[np.arange(len(at)), at]
                open_ = best < len(self.keys)
                done = ids[~open_]
                named.append(names[~open_])
                sized.append((done >= 0).sum(axis=1))
                held.append(done[done >= 0])
                if not open_.any():
                    break
                names, ids, rank, at, best = names[open_], ids[open_], rank[open_], at[open_], best[open_]
                row = np.arange(len(at))
                ids[row, at] = self.made[best]
                left = np.ones(ids.shape, bool)
                left[row, at + 1] = False  # every open word loses one symbol
                ids, rank = (x[left].reshape(len(at), -1) for x in (ids, rank))
                if ids.shape[1] < 2:
                    ids = np.concatenate([ids, np.full((len(at), 1), -1)], axis=1)
                    rank = np.concatenate([rank, np.full((len(at), 1), len(self.keys))], axis=1)
                after = np.minimum(at + 1, ids.shape[1] - 1)
                rank[row, at] = np.where(at + 1 < ids.shape[1], self.ranks(ids[row, at], ids[row, after]), len(self.keys))
                before = np.maximum(at - 1, 0)
                rank[row, before] = np.where(at > 0, self.ranks(ids[row, before], ids[row, before + 1]), rank[row, before])
        number, flat = np.concatenate(sized), np.concatenate(held)
        back = np.argsort(np.concatenate(named))  # from the order of completion to that of the words
        starts, number = (np.cumsum(number) - number)[back], number[back]
        shift = np.repeat(starts - (np.cumsum(number) - number), number)
        return flat[shift + np.arange(len(shift))].astype(np.uint32), number


class WordEncoder:
    """Ids of whole texts from a tokenizer that drops white space and splits at it, each distinct word encoded once.

    A text's ids are those of its blank-separated words in order, which a ``ChunkTable`` finds on the text's bytes. Of new words the letters of plain ones
    (letters, then perhaps marks) are merged here, many at once; all others go to the tokenizer itself. The literal of a special token is
    that token, or with ``special_as_text`` spelled out; no such literal may hold a blank.
    """

    def __init__(self, path: str, special_as_text: bool = False) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        # The table below asks for a chunk once; the tokenizer's own cache would help none and outlive it, one more with every task.
        getattr(self.tokenizer.model, "_resize_cache", lambda size: None)(0)
        plain = PlainChunks(Merges(json.loads(self.tokenizer.to_str())["model"]).encode, self._others)
        self.table = ChunkTable(self._others, plain.learn_words, WORDS_KEPT)

    def _others(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        encoded = [e.ids for e in self.tokenizer.encode_batch_fast([c.decode("utf-8", "surrogatepass") for c in chunks], add_special_tokens=False)]
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
        return np.fromiter((i for ids in encoded for i in ids), np.uint32, int(sizes.sum())), sizes

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, end to end, and how many each has."""
        parts = [t.encode("utf-8", "surrogatepass") for t in texts]
        return self.table.encode(np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)]))


def _cutter(path: str, tokens: int, end_id: int, special_as_text: bool) -> Callable:
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces of each document, numbered within their task by length."""
        encoder, task, seen = WordEncoder(path, special_as_text), TaskContext.get().partitionId(), {}
        types = [pa.int32(), pa.int64(), pa.int32(), *[pa.int64()] * 4]
        for batch in batches:
            for at, to, data, bounds in slices(batch, size=TEXT_BATCH):
                flat, counts = encoder.table.encode(data, bounds)
                ends = np.cumsum(counts)
                ids, rows = np.insert(flat, ends, np.uint32(end_id)).astype("<u4"), []
                for doc_id, end, count in zip(batch["doc_id"].slice(at, to - at).to_pylist(), (ends + np.arange(1, len(ends) + 1)).tolist(), (counts + 1).tolist(), strict=True):
                    for piece, start in enumerate(range(0, count, tokens)):
                        part = ids[end - count + start:min(end, end - count + start + tokens)]
                        nth = seen.get(len(part), 0)
                        seen[len(part)] = nth + 1
                        rows.append((task, doc_id, piece, start, len(part), zlib.crc32(part), nth))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], [f.split()[0] for f in PIECE_SCHEMA.split(", ")])
    return cut


def pieces_of(docs: DataFrame, tokenizer: str, tokens: int = TOKENS, end_id: int = END_ID, special_as_text: bool = False) -> DataFrame:
    """Stage the pieces of all documents; ids themselves are not kept, they can be had again from text and start."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stage(rows.mapInArrow(tidy(_cutter(tokenizer, tokens, end_id, special_as_text)), PIECE_SCHEMA), "pieces")


def best_fit(histogram: dict[int, int], tokens: int = TOKENS, pieces: int = PIECES, attention: int = ATTENTION,
             weights: tuple[float, float, float] = WEIGHTS) -> list[tuple[int, int, int, int, int, int]]:
    """Plan for all pieces of each length: rows ``(length, first, count, each, sequence, offset)``.

    Pieces ``first`` to ``first + count - 1`` of that length go, ``each`` to a sequence, to sequences from ``sequence`` on, the
    first of a sequence at ``offset``. Lengths are placed in descending order. Equal open bins are kept as one kind
    (residual tokens, pieces, attention) with a multiplicity, so the plan depends on the histogram alone, which has no more
    entries than a sequence has tokens, and not on the number of pieces. A kind fits if the piece keeps every capacity;
    among fitting kinds the least weighted norm of the residuals left is chosen, ties go to the larger weighted dot product of
    piece and residual. Without a fitting kind a new bin is opened, filled with as many pieces of that length as it holds.
    """
    capacity = (tokens, pieces, attention)
    scale = np.array(weights) / np.array(capacity)
    kinds = np.zeros((1024, 3), np.int64)  # residuals of each kind; a row of zeros is free and fits nothing
    row_of: dict[tuple[int, int, int], int] = {}
    runs: dict[tuple[int, int, int], list[tuple[int, int]]] = {}  # kind -> (first sequence, number)
    free = list(range(len(kinds)))[::-1]

    def put(kind: tuple[int, int, int], start: int, number: int) -> None:
        nonlocal kinds
        if kind not in runs:
            if not free:
                free.extend(range(2 * len(kinds) - 1, len(kinds) - 1, -1))
                kinds = np.concatenate([kinds, np.zeros_like(kinds)])
            row_of[kind], runs[kind] = free.pop(), []
            kinds[row_of[kind]] = kind
        runs[kind].append((start, number))

    plan, sequences = [], 0
    for length in sorted(histogram, reverse=True):
        left, first = histogram[length], 0
        need = np.array([length, 1, length * length], np.int64)
        while left:
            fits = np.flatnonzero((kinds >= need).all(axis=1))
            if len(fits):
                residual = (kinds[fits] - need) * scale
                norms, dots = np.square(residual).sum(axis=1), ((kinds[fits] * scale) * (need * scale)).sum(axis=1)
                best = np.flatnonzero(norms == norms.min())
                kind = tuple(kinds[fits[best[np.argmax(dots[best])]]].tolist())
                start, number = runs[kind].pop()
                if not runs[kind]:
                    del runs[kind]
                    free.append(row_of.pop(kind))
                    kinds[free[-1]] = 0
            else:
                kind, start, number = capacity, sequences, left
            # As many pieces as a bin of the kind holds, at once: repeats of the same choice.
            each = min(left, *(k // n for k, n in zip(kind, need.tolist(), strict=True)))
            used = min(number, left // each)
            plan.append((length, first, used * each, each, start, tokens - kind[0]))
            if start == sequences:
                sequences += used  # of new bins only those that are filled are opened
            elif number > used:
                put(kind, start + used, number - used)
            after = (kind[0] - each * length, kind[1] - each, kind[2] - each * length * length)
            if min(after) > 0:
                put(after, start, used)
            left, first = left - used * each, first + used * each
    return plan


def pack(pieces: DataFrame, tokens: int = TOKENS, limit_pieces: int = PIECES, attention: int = ATTENTION) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` of staged pieces.

    The driver sees the histogram of lengths only, at most ``tokens`` rows whatever the corpus. A piece's number among its
    length is its number within its task plus the counts of earlier tasks, so no task or group meets all pieces of a
    length; the plan turns it into a place. Plan rows are bounded by the histogram and travel with the task function.
    """
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = counts.select("length", "task", (F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")).alias("before"))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = np.array(sorted(best_fit(histogram, tokens, limit_pieces, attention)), np.int64).reshape(-1, 6)
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        widest = int(plan[:, 1].max(initial=0)) + 1
        keys = plan[:, 0] * widest + plan[:, 1]  # ascending, for the plan is sorted by length and first number
        for batch in batches:
            length, rank = np.asarray(batch["length"], dtype=np.int64), np.asarray(batch["rank"])
            row = plan[np.searchsorted(keys, length * widest + np.minimum(rank, widest - 1), side="right") - 1]
            nth = rank - row[:, 1]
            sequence, offset = row[:, 4] + nth // np.maximum(row[:, 3], 1), row[:, 5] + nth % np.maximum(row[:, 3], 1) * length
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in names[:5]), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names)

    ranked = pieces.join(before, ["length", "task"]).withColumn("rank", F.col("before") + F.col("nth")).select(*names[:5], "rank")
    return ranked.mapInArrow(place, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, tokenizer: str, special_as_text: bool = True) -> DataFrame:
    """Tokenise, cut and pack all rows; only documents longer than a sequence are cut.

    A null or empty text is the end id alone. Equal and repeated rows are packed as often as they occur; other columns are
    not read; an empty table gives no rows. Literals of special tokens (``<|endoftext|>``) are spelled out as text, or with
    ``special_as_text=False`` are those tokens, as by the tokenizer's own default; the query and the pipeline use the latter.
    """
    return pack(pieces_of(docs, tokenizer, special_as_text=special_as_text))
