"""Byte-pair encoding and decoding of whole texts: longest matches are proposed, their borders verified, failing words merged exactly."""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import ChunkTable, PlainChunks, gather, slices
from .common import tidy
from .packing import Merges

#: Words of up to so many bytes are worked on many at once.
SHORT = 64
FINAL = 256  # the last byte of a word is symbol 256 + byte: with the end-of-word mark it is another letter


class Vocabulary:
    """Arrays of a word-end byte-pair vocabulary, made once on the driver: trie of its tokens, merges, and the tokens along both rims of each token."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("dropout") or not model.get("end_of_word_suffix"):
            raise ValueError("a byte-level BPE vocabulary with word ends is needed")
        if not isinstance(model["merges"][0], list):
            model["merges"] = [m.split(" ") for m in model["merges"]]
        self.merges = merges = Merges(model)
        vocab, ending = model["vocab"], model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        width = max([*vocab.values(), *self.special.values()]) + 1
        self.names = [""] * width
        for name, i in (vocab | self.special).items():
            self.names[i] = name
        # Byte-level alphabet, back from letters to bytes.
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        self.letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        self.born = np.full(width, -1, np.int64)  # rank of the merge that makes a token; letters are there from the beginning
        self.left, self.right = np.full(width, -1, np.int64), np.full(width, -1, np.int64)
        for rank, (a, b) in enumerate(model["merges"]):
            token = vocab[a + b]
            if self.born[token] >= 0 or max(self.born[vocab[a]], self.born[vocab[b]]) >= rank:
                raise ValueError(f"merge {rank} comes before its parts or makes a token anew")
            self.born[token], self.left[token], self.right[token] = rank, vocab[a], vocab[b]
        self._trie(self._symbols(vocab, ending))

    def _symbols(self, vocab: dict[str, int], ending: str) -> dict[int, tuple[int, ...]]:
        """Symbols of each token that merging its own letters gives; no other is ever made."""
        spelt = {}
        for name, i in vocab.items():
            letters = name.removesuffix(ending)
            if letters and all(c in self.letters for c in letters) and (self.born[i] >= 0 or len(letters) == 1):
                spelt[i] = tuple(self.letters[c] for c in letters[:-1]) + (self.letters[letters[-1]] + FINAL * name.endswith(ending),)
        tokens = [i for i, s in spelt.items() if len(s) <= SHORT and len(s) > 1]
        whole = [i for i in tokens if spelt[i][-1] >= FINAL]
        flat, sizes = self.merges.encode([bytes(s % FINAL for s in spelt[i]) for i in whole]) if whole else (np.zeros(0), np.zeros(0, int))
        firsts = np.cumsum(sizes) - sizes
        unmade = {i for i, n, f in zip(whole, sizes.tolist(), firsts.tolist(), strict=True) if n != 1 or flat[f] != i}
        inner = [i for i in tokens if spelt[i][-1] < FINAL]
        unmade |= {i for i in inner if self.merge(spelt[i]) != [i]}
        return {i: s for i, s in spelt.items() if i not in unmade}

    def _trie(self, spelt: dict[int, tuple[int, ...]]) -> None:
        nodes: dict[tuple[int, int], int] = {}
        ends = {0: -1}
        for token, symbols in spelt.items():
            node = 0
            for s in symbols:
                node = nodes.setdefault((node, s), len(nodes) + 1)
                ends.setdefault(node, -1)
            ends[node] = token
        keys = np.array([n * 2 * FINAL + s for n, s in nodes], np.int64)
        order = np.argsort(keys)
        self.trie, self.child = keys[order], np.array(list(nodes.values()), np.int64)[order]
        self.token = np.array([ends[i] for i in range(len(ends))], np.int64)
        self.deepest = max(map(len, spelt.values()))
        if any((0, s) not in nodes for s in range(2 * FINAL)):
            raise ValueError("the vocabulary lacks a byte")

    @cached_property
    def edges(self) -> dict[str, list[tuple[np.ndarray, np.ndarray]]]:
        return {"right": self._rim(self.right), "left": self._rim(self.left)}  # worked out where needed, not sent

    def _rim(self, child: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Tokens along one rim, from each token inwards: (token or -1, rank of the merge that uses it up)."""
        never = len(self.merges.keys)
        rim = [(np.arange(len(child)), np.full(len(child), never))]
        while (rim[-1][0] >= 0).any():
            at = rim[-1][0]
            rim.append((np.where(at >= 0, child[at], -1), np.where(at >= 0, self.born[at], -1)))
        return rim[:-1]

    # --- borders -------------------------------------------------------------------------------------------------------------

    def fits(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether tokens ``a`` and ``b`` stay apart when their letters are merged side by side.

        Merges are done in order of rank, so a token on the right rim of ``a`` and one on the left rim of ``b`` meet if neither is used up before
        their own merge is due; of equal merges the leftmost is done first. A sequence is the encoding of its word if all its neighbours fit.
        """
        apart = np.ones(len(a), bool)
        for x, x_used in self.edges["right"]:
            left, until = x[a], x_used[a]
            if not (left >= 0).any():
                break
            for y, y_used in self.edges["left"]:
                right = y[b]
                if not (right >= 0).any():
                    break
                due = self.merges.ranks(left, right)
                apart &= (due >= until) | (due > y_used[b]) | (due >= len(self.merges.keys))
        return apart

    # --- exact merging -------------------------------------------------------------------------------------------------------

    def merge(self, symbols: Iterable[int]) -> list[int]:
        """Ids of one word by merging pairs in order of rank, leftmost first; for words of any size."""
        merges = self.merges
        ids = [int(merges.final[s - FINAL] if s >= FINAL else merges.inner[s]) for s in symbols]
        following, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        ranks = merges.ranks(np.array(ids[:-1], np.int64), np.array(ids[1:], np.int64)) if len(ids) > 1 else np.zeros(0, np.int64)
        never = len(merges.keys)
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(ranks.tolist()) if r < never]
        heapq.heapify(heap)
        known: dict[tuple[int, int], int] = {}
        while heap:
            rank, at, a, b = heapq.heappop(heap)
            after = following[at] if ids[at] == a else len(ids)
            if after >= len(ids) or ids[after] != b:
                continue
            ids[at], ids[after] = int(merges.made[rank]), -1
            following[at] = following[after]
            if following[at] < len(ids):
                before[following[at]] = at
            for i, j in ((before[at], at), (at, following[at])):
                if i >= 0 and j < len(ids):
                    pair = (ids[i], ids[j])
                    if pair not in known:
                        known[pair] = int(merges.ranks(np.array([pair[0]]), np.array([pair[1]]))[0])
                    if known[pair] < never:
                        heapq.heappush(heap, (known[pair], i, *pair))
        return [i for i in ids if i >= 0]


class Speculator:
    """Ids of distinct words. ``tried`` and ``failed`` count words proposed and words that had to be merged."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.pairs, self.good = np.zeros(0, np.int64), np.zeros(0, bool)
        self.tried = self.failed = 0

    def _propose(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(number of the word, token) of longest matches from left to right, for words of up to ``SHORT`` bytes."""
        v = self.vocabulary
        size = np.fromiter(map(len, words), np.int64, len(words))
        symbols = np.full((len(words), int(size.max()) + 1), -1, np.int64)
        symbols[np.arange(symbols.shape[1])[None, :] < size[:, None]] = np.frombuffer(b"".join(words), np.uint8)
        symbols[np.arange(len(words)), size - 1] += FINAL
        at, open_, of, tokens = np.zeros(len(words), np.int64), np.arange(len(words)), [], []
        while len(open_):
            node, row, place = np.zeros(len(open_), np.int64), np.arange(len(open_)), at[open_]
            best, length = np.full(len(open_), -1, np.int64), np.zeros(len(open_), np.int64)
            for depth in range(1, v.deepest + 1):
                symbol = symbols[open_[row], np.minimum(place[row] + depth - 1, size[open_[row]])]
                key = node[row] * 2 * FINAL + symbol
                found = np.minimum(np.searchsorted(v.trie, key), len(v.trie) - 1)
                there = (v.trie[found] == key) & (symbol >= 0)
                row = row[there]
                if not len(row):
                    break
                node[row] = v.child[found[there]]
                token = v.token[node[row]]
                best[row[token >= 0]], length[row[token >= 0]] = token[token >= 0], depth
            of.append(open_)
            tokens.append(best)
            at[open_] += length
            open_ = open_[at[open_] < size[open_]]
        of, tokens = np.concatenate(of), np.concatenate(tokens)
        order = np.argsort(of, kind="stable")
        return of[order], tokens[order]

    def _propose_long(self, word: bytes) -> np.ndarray:
        v, tokens, at = self.vocabulary, [], 0
        if not hasattr(self, "step"):
            self.step = dict(zip(v.trie.tolist(), v.child.tolist(), strict=True))
            self.token = v.token.tolist()
        step, token = self.step, self.token
        while at < len(word):
            node, best, end = 0, -1, at
            for place in range(at, len(word)):
                node = step.get(node * 2 * FINAL + word[place] + FINAL * (place == len(word) - 1))
                if node is None:
                    break
                if token[node] >= 0:
                    best, end = token[node], place + 1
            tokens.append(best)
            at = end
        return np.array(tokens, np.int64)

    def _verified(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether each pair of neighbours fits; every distinct pair is worked out once."""
        key = a * len(self.vocabulary.names) + b
        distinct, back = np.unique(key, return_inverse=True)
        at = np.minimum(np.searchsorted(self.pairs, distinct), max(0, len(self.pairs) - 1))
        new = distinct[self.pairs[at] != distinct] if len(self.pairs) else distinct
        if len(new):
            if len(self.pairs) > 2_000_000:
                self.pairs, self.good, new = self.pairs[:0], self.good[:0], distinct
            fits = self.vocabulary.fits(new // len(self.vocabulary.names), new % len(self.vocabulary.names))
            pairs = np.concatenate([self.pairs, new])
            order = np.argsort(pairs)
            self.pairs, self.good = pairs[order], np.concatenate([self.good, fits])[order]
        return self.good[np.searchsorted(self.pairs, distinct)][back]

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of non-empty words, end to end, and their numbers."""
        short = [i for i, w in enumerate(words) if len(w) <= SHORT]
        of, tokens = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for start in range(0, len(short), 32_768):
            block = np.array(short[start:start + 32_768], np.int64)
            place, found = self._propose([words[i] for i in block.tolist()])
            of.append(block[place])
            tokens.append(found)
        for i, w in enumerate(words):
            if len(w) > SHORT:
                tokens.append(self._propose_long(w))
                of.append(np.full(len(tokens[-1]), i))
        of, tokens = np.concatenate(of), np.concatenate(tokens)
        order = np.argsort(of, kind="stable")
        of, tokens = of[order], tokens[order]
        inner = np.flatnonzero(of[1:] == of[:-1])
        wrong = np.unique(of[inner[~self._verified(tokens[inner], tokens[inner + 1])]]) if len(inner) else inner
        self.tried, self.failed = self.tried + len(words), self.failed + len(wrong)
        if len(wrong):
            left = ~np.isin(of, wrong)
            of, tokens = [of[left]], [tokens[left]]
            few = [i for i in wrong.tolist() if len(words[i]) <= SHORT]
            if few:
                flat, sizes = self.vocabulary.merges.encode([words[i] for i in few])
                of.append(np.repeat(np.array(few), sizes))
                tokens.append(flat.astype(np.int64))
            for i in wrong.tolist():
                if len(words[i]) > SHORT:
                    ids = self.vocabulary.merge([*words[i][:-1], words[i][-1] + FINAL])
                    of.append(np.full(len(ids), i))
                    tokens.append(np.array(ids, np.int64))
            of, tokens = np.concatenate(of), np.concatenate(tokens)
            order = np.argsort(of, kind="stable")
            of, tokens = of[order], tokens[order]
        return tokens.astype(np.uint32), np.bincount(of, minlength=len(words))


class Words:
    """Words of chunks as the tokenizer cuts them, as byte strings, by its own normaliser and splitter."""

    def __init__(self, path: str, vocabulary: Vocabulary) -> None:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.normal, self.split, self.letters = tokenizer.normalizer, tokenizer.pre_tokenizer, vocabulary.letters
        names = sorted(vocabulary.special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.known = vocabulary.special

    def of(self, chunk: str) -> list[bytes | int]:
        """Words, and numbers of special tokens where their literals stand."""
        out: list[bytes | int] = []
        for part in self.special.split(chunk) if self.special else [chunk]:
            if part in self.known:
                out.append(self.known[part])
            elif part:
                for word, _ in self.split.pre_tokenize_str(self.normal.normalize_str(part)):
                    out.append(bytes(map(self.letters.__getitem__, word)))
        return out


class Encoder:
    """Ids of whole texts; each distinct chunk is cut into words once, and the letters of plain chunks are encoded once."""

    def __init__(self, path: str, vocabulary: Vocabulary) -> None:
        self.words, self.speculator = Words(path, vocabulary), Speculator(vocabulary)
        self.table = ChunkTable(self._others, PlainChunks(self.speculator.encode, self._others).learn_words)
        self.encode = self.table.encode

    def _others(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        cut = [self.words.of(c.decode("utf-8", "surrogatepass")) for c in chunks]
        distinct = list(dict.fromkeys(w for words in cut for w in words if isinstance(w, bytes) and w))
        flat, sizes = self.speculator.encode(distinct) if distinct else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        special = sorted({w for words in cut for w in words if isinstance(w, int)})
        flat, sizes = np.concatenate([flat, np.array(special, np.uint32)]), np.concatenate([sizes, np.ones(len(special), np.int64)])
        number = {w: i for i, w in enumerate([*distinct, *special])}
        codes = np.array([number[w] for words in cut for w in words if w != b""], np.int64)
        per_chunk = np.array([sum(w != b"" for w in words) for words in cut], np.int64)
        firsts = np.cumsum(sizes) - sizes
        until = np.r_[0, np.cumsum(sizes[codes])]
        return gather(flat, firsts[codes], sizes[codes]), np.diff(until[np.r_[0, np.cumsum(per_chunk)]])


class Spellings:
    """Texts of ids: the tokens' spellings joined by blanks, which is what a vocabulary without a decoder of its own gives."""

    def __init__(self, names: list[str]) -> None:
        spelt = [f"{n} ".encode() for n in names]
        self.data, self.sizes = np.frombuffer(b"".join(spelt), np.uint8), np.fromiter(map(len, spelt), np.int64, len(spelt))
        self.firsts = np.cumsum(self.sizes) - self.sizes

    def decode(self, flat: np.ndarray, counts: np.ndarray) -> pa.Array:
        """Texts of runs of ids."""
        ends, out = np.cumsum(counts), []
        for end, n in zip(ends.tolist(), counts.tolist(), strict=True):
            ids = flat[end - n:end]
            out.append(gather(self.data, self.firsts[ids], self.sizes[ids])[:-1].tobytes())
        return pa.array(out, pa.binary()).cast(pa.string())


def _encoder(path: str, vocabulary: Vocabulary, keep: list[str], decoded: bool) -> Callable:
    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, spellings = Encoder(path, vocabulary), Spellings(vocabulary.names)
        for batch in batches:
            for at, to, data, bounds in slices(batch):
                flat, counts = encoder.encode(data, bounds)
                ids = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(flat.view(np.int32)))
                texts = {"decoded": spellings.decode(flat, counts)} if decoded else {}
                yield pa.RecordBatch.from_arrays([*(batch[c].slice(at, to - at) for c in keep), ids, *texts.values()], [*keep, "ids", *texts])
    return encode


def encode_documents(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text", decoded: bool = False) -> DataFrame:
    """``(*keep, ids)``: the tokenizer's ids of every whole text, special literals read as their tokens, none added; and with
    ``decoded`` what these ids decode to.

    A null or empty text has no ids; repeated rows are encoded each; other columns are not read; an empty table gives no rows. A task holds
    about a megabyte of text (one text at least) and its table of chunks. The tokenizer file has to lie at the same path on every executor.
    """
    rows = docs.select(F.struct(*keep).alias("row"), F.col(text).cast("string").alias("text"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, ids array<int>" + ", decoded string" * decoded
    found = rows.mapInArrow(tidy(_encoder(path, Vocabulary(path), ["row"], decoded)), schema)
    return found.select(*[F.col("row")[c].alias(c) for c in keep], *found.columns[1:])


def _decoder(names: list[str]) -> Callable:
    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spellings = Spellings(names)
        for batch in batches:
            ids = batch["ids"]
            counts = ids.value_lengths().fill_null(0).to_numpy()
            flat = ids.flatten().to_numpy()
            yield pa.RecordBatch.from_arrays([*batch.columns, spellings.decode(flat, counts)], [*batch.schema.names, "decoded"])
    return decode


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """Add ``decoded`` to rows with ``ids``. Ids outside the vocabulary fail the job; null or empty ids give an empty text."""
    rows = encoded.select(F.struct(*[c for c in encoded.columns if c != "ids"]).alias("row"), "ids")
    schema = f"row {rows.schema['row'].dataType.simpleString()}, ids array<int>, decoded string"
    found = rows.mapInArrow(_decoder(Vocabulary(path).names), schema)
    return found.select(*[F.col("row")[c].alias(c) for c in encoded.columns if c != "ids"], "ids", "decoded")
