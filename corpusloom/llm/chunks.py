"""Blank-separated chunks of many texts, each distinct one known by a number, found on Arrow's own buffers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
#: The table is emptied before a slice once it holds this many chunks or this many of their bytes.
KEPT, KEPT_BYTES = 600_000, 64 << 20
#: Chunks of more bytes than this are looked up one by one.
LONGEST = 32
WORD = 8  # bytes compared at once

_MIX = np.uint64(0xBF58476D1CE4E5B9)
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(WORD)] + [(1 << 64) - 1], np.uint64)


def slices(batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, last row + 1, bytes, bounds)`` of runs of rows with about ``size`` bytes of text, one row at least; null is empty."""
    text = batch[column].cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
    at = 0
    while at < batch.num_rows:
        to = min(max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1), batch.num_rows)
        yield at, to, data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]
        at = to


def cut(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last byte of each chunk: what stands between blanks, line feeds and the bounds of texts."""
    inside = (data != 0x20) & (data != 0x0A)
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cuts = bounds[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    begins[cuts] = inside[cuts]
    ends[cuts - 1] = inside[cuts - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def gather(values: np.ndarray, firsts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs ``values[first:first + size]``, end to end."""
    total = int(sizes.sum())
    return values[np.repeat(firsts - (np.cumsum(sizes) - sizes), sizes) + np.arange(total)]


def _roomy(values: np.ndarray, used: int, needed: int) -> np.ndarray:
    """``values`` or, if they are fewer than ``needed``, a copy of those used in an array twice as long or more, the rest of which is not touched yet."""
    room = len(values)
    if room >= needed:
        return values
    while room < needed:
        room *= 2
    out = np.zeros((room, *values.shape[1:]), values.dtype)
    out[:used] = values[:used]
    return out


class ChunkTable:
    """Ids of whole texts from ``learn``, which gives those of a list of chunks (all ids end to end, and each chunk's number);
    ``learn_words``, if given, does the same for chunks of up to ``LONGEST`` bytes as rows of machine words, and their sizes.

    A chunk of up to ``LONGEST`` bytes is a few machine words. Their hash finds its number, and comparing all of them verifies the spelling; longer
    chunks, and chunks whose hash another one has, go through a plain dictionary.
    """

    def __init__(self, learn: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]],
                 learn_words: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]] | None = None, kept: int | None = None) -> None:
        self.learn, self.learn_words, self.kept = learn, learn_words, kept or KEPT
        self._clear()

    def _clear(self) -> None:
        self.count, self.bytes = 0, 0
        self.spelt = np.zeros((1024, LONGEST // WORD), np.uint64)
        self.size, self.first, self.number = (np.zeros(1024, np.int64) for _ in range(3))
        self.ids, self.filled = np.zeros(1 << 16, np.uint32), 0
        self.bits = 12
        self.hashes, self.codes = np.zeros(1 << self.bits, np.uint64), np.zeros(1 << self.bits, np.int32)
        self.odd: dict[bytes, int] = {}

    # --- hash table with open addressing; a free slot holds hash 0 -------------------------------------------------------

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        found = np.full(len(hashes), -1, np.int64)
        open_, slot, mask = np.arange(len(hashes)), (hashes >> np.uint64(64 - self.bits)).astype(np.int64), (1 << self.bits) - 1
        while len(open_):
            held = self.hashes[slot]
            hit = held == hashes[open_]
            found[open_[hit]] = self.codes[slot[hit]]
            on = ~hit & (held != 0)
            open_, slot = open_[on], (slot[on] + 1) & mask
        return found

    def _enter(self, hashes: np.ndarray, codes: np.ndarray) -> None:
        """Distinct hashes that the table lacks."""
        if 2 * (self.count + len(hashes)) > 1 << self.bits:
            held = self.hashes != 0
            hashes, codes = np.concatenate([self.hashes[held], hashes]), np.concatenate([self.codes[held], codes])
            while 4 * len(hashes) > 1 << self.bits:
                self.bits += 1
            self.hashes, self.codes = np.zeros(1 << self.bits, np.uint64), np.zeros(1 << self.bits, np.int32)
        slot, mask = (hashes >> np.uint64(64 - self.bits)).astype(np.int64), (1 << self.bits) - 1
        while len(hashes):
            free = self.hashes[slot] == 0
            self.hashes[slot[free]] = hashes[free]
            own = free & (self.hashes[slot] == hashes)  # of several at a free slot one has got it
            self.codes[slot[own]] = codes[own]
            hashes, codes, slot = hashes[~own], codes[~own], (slot[~own] + 1) & mask

    # --- chunks ----------------------------------------------------------------------------------------------------------

    def _keep(self, ids: np.ndarray, numbers: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Numbers of chunks newly learnt."""
        codes = np.arange(self.count, self.count + len(sizes))
        self.size, self.first, self.number, self.spelt = (_roomy(x, self.count, self.count + len(sizes)) for x in (self.size, self.first, self.number, self.spelt))
        self.ids = _roomy(self.ids, self.filled, self.filled + len(ids))
        self.ids[self.filled:self.filled + len(ids)] = ids
        self.size[codes] = sizes
        self.number[codes], self.first[codes] = numbers, self.filled + np.cumsum(numbers) - numbers
        self.filled += len(ids)
        self.count += len(sizes)
        self.bytes += int(np.sum(sizes)) + 4 * len(ids)
        return codes

    def _short(self, words: list[tuple[np.ndarray, np.ndarray]], size: np.ndarray) -> np.ndarray:
        """Numbers of chunks given as machine words: per k, which chunks have a k-th one, and those."""
        hashes = size.astype(np.uint64)
        for which, held in words:
            mixed = (hashes[which] ^ held) * _MIX
            hashes[which] = (mixed ^ (mixed >> np.uint64(29))) * _MIX
        hashes |= np.uint64(1)
        codes = self._find(hashes)
        new = np.flatnonzero(codes < 0)
        if len(new):
            known, place, back = np.unique(hashes[new], return_index=True, return_inverse=True)
            some = new[place]
            spelt = _matrix(words, some, len(size))
            fresh = self._keep(*(self.learn_words or self._learn_listed)(spelt, size[some]), size[some])
            self.spelt[fresh] = spelt
            self._enter(known, fresh.astype(np.int32))
            codes[new] = fresh[back]
        same = self.size[codes] == size
        for k, (which, held) in enumerate(words):
            same[which] &= self.spelt[codes[which], k] == held
        if not same.all():
            other = np.flatnonzero(~same)
            codes[other] = self._odd(listed(_matrix(words, other, len(size)), size[other]))
        return codes

    def _learn_listed(self, spelt: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.learn(listed(spelt, size))

    def _odd(self, chunks: list[bytes]) -> np.ndarray:
        fresh = [c for c in dict.fromkeys(chunks) if c not in self.odd]
        if fresh:
            self.odd.update(zip(fresh, self._keep(*self.learn(fresh), np.fromiter(map(len, fresh), np.int64, len(fresh))).tolist(), strict=True))
        return np.array([self.odd[c] for c in chunks], np.int64)

    def known(self, spelt: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Numbers of chunks of up to ``LONGEST`` bytes, given as rows of machine words."""
        self._make_room()
        words = []
        for k in range(LONGEST // WORD):
            which = np.flatnonzero(size > WORD * k)
            if not len(which):
                break
            words.append((which, spelt[which, k]))
        return self._short(words, size)

    def _make_room(self) -> None:
        if self.count > self.kept or self.bytes > KEPT_BYTES:
            self._clear()

    def read(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The chunks' numbers in order, and how many chunks each text has."""
        first, last = cut(data, bounds)
        size = last - first
        per_text = np.diff(np.searchsorted(first, bounds))
        self._make_room()
        codes = np.full(len(first), -1, np.int64)
        short = size <= LONGEST
        if short.any():
            at = np.flatnonzero(short) if not short.all() else np.arange(len(first))
            codes[at] = self._short(_words(data, first[at], size[at]), size[at])
        if not short.all():
            odd = np.flatnonzero(~short).tolist()
            codes[odd] = self._odd([data[a:b].tobytes() for a, b in zip(first[odd].tolist(), last[odd].tolist(), strict=True)])
        return codes, per_text

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, end to end, and how many each has."""
        codes, per_text = self.read(data, bounds)
        numbers = self.number[codes]
        until = np.r_[0, np.cumsum(numbers)]
        return gather(self.ids, self.first[codes], numbers), np.diff(until[np.r_[0, np.cumsum(per_text)]])


def _words(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    padded = np.concatenate([data, np.zeros(WORD, np.uint8)])
    loads = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    which, out = np.arange(len(first)), []
    for k in range(LONGEST // WORD):
        left = size[which] - WORD * k
        which, left = which[left > 0], left[left > 0]
        if not len(which):
            break
        out.append((which, loads[first[which] + WORD * k] & _MASKS[np.minimum(left, WORD)]))
    return out


def _matrix(words: list[tuple[np.ndarray, np.ndarray]], some: np.ndarray, of: int) -> np.ndarray:
    """Rows of machine words of ``some`` of ``of`` chunks."""
    row = np.full(of, -1, np.int64)
    row[some] = np.arange(len(some))
    out = np.zeros((len(some), LONGEST // WORD), np.uint64)
    for k, (which, held) in enumerate(words):
        at = row[which]
        out[at[at >= 0], k] = held[at >= 0]
    return out


def listed(spelt: np.ndarray, size: np.ndarray) -> list[bytes]:
    """The same chunks as byte strings."""
    raw = np.ascontiguousarray(spelt, "<u8").tobytes()
    return [raw[at:at + n] for at, n in zip(range(0, len(raw), LONGEST), size.tolist(), strict=True)]


# --- plain chunks: letters, then perhaps marks ---------------------------------------------------------------------------

#: Kinds of bytes: letter, mark, none, other. Letters are A-Z, a-z, and U+00C0 to U+00FF but the two signs among them.
LETTER, MARK, NONE, OTHER = range(4)
MARKS = b".,;:!?"
_KIND = np.full(256, OTHER, np.uint8)
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), 0xC3]] = LETTER
_KIND[list(MARKS)] = MARK
_KIND[0] = NONE
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def plain_parts(spelt: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(plain, core, core size, tail)`` of chunks given as rows of machine words: which are letters and up to eight marks, their letters
    in lower case, and the marks as one machine word."""
    width = LONGEST if len(size) and size.max() > 16 else 16
    if width > 16 and size.min() <= 16:  # the few long ones apart, so that the others need narrow arrays
        small = size <= 16
        out = (np.zeros(len(size), bool), np.zeros_like(spelt), np.zeros(len(size), np.int64), np.zeros(len(size), np.uint64))
        for part in (small, ~small):
            for whole, found in zip(out, plain_parts(spelt[part], size[part]), strict=True):
                whole[part] = found
        return out
    raw = np.ascontiguousarray(spelt[:, :width // WORD], "<u8").view(np.uint8).reshape(len(size), width)
    kind, low = _KIND[raw], _LOWER[raw]
    after = np.zeros(raw.shape, bool)
    after[:, 1:] = raw[:, :-1] == 0xC3
    kind[after & (raw >= 0x80) & (raw != 0x97) & (raw != 0xB7)] = LETTER
    low[after & (raw >= 0x80) & (raw <= 0x9E) & (raw != 0x97)] += 32
    letters, marks = (kind == LETTER).sum(axis=1), (kind == MARK).sum(axis=1)
    plain = (letters > 0) & (marks <= WORD) & (letters + marks == size) & (kind[:, 1:] >= kind[:, :-1]).all(axis=1)
    core = np.zeros_like(spelt)
    core[:, :width // WORD] = np.where(np.arange(width)[None, :] < letters[:, None], low, 0).astype(np.uint8).view("<u8")
    wide = np.concatenate([raw, np.zeros((len(size), WORD), np.uint8)], axis=1)
    tail = np.take_along_axis(wide, np.minimum(letters, width)[:, None] + np.arange(WORD)[None, :], axis=1)
    return plain, core, letters.astype(np.int64), np.where(plain, np.ascontiguousarray(tail).view("<u8").ravel(), np.uint64(0))


class PlainChunks:
    """What a ``ChunkTable`` learns new chunks with: ids of plain ones are those of their letters, from ``cores``, and of their marks; those of all
    others, and of marks alone, come from ``others``. Both give all ids end to end and each one's number.
    """

    def __init__(self, cores: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], others: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]) -> None:
        self.cores, self.others = ChunkTable(cores), others
        self.marks: dict[int, np.ndarray] = {0: np.zeros(0, np.uint32)}

    def learn_words(self, spelt: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        plain, core, letters, tail = plain_parts(spelt, size)
        codes = self.cores.known(core[plain], letters[plain])
        tails, tail_of = np.unique(tail[plain], return_inverse=True)
        for t in tails.tolist():
            if t not in self.marks:
                self.marks[t] = self.others([t.to_bytes(WORD, "little").rstrip(b"\0")])[0].astype(np.uint32)
        marks = [self.marks[t] for t in tails.tolist()]
        rest, counts = self.others(listed(spelt[~plain], size[~plain])) if not plain.all() else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        # every chunk has two runs of ids, in one array: of its letters and of its marks, or all of its own and none
        pool = np.concatenate([self.cores.ids[:self.cores.filled], rest, *marks]).astype(np.uint32)
        marks_size = np.array([len(m) for m in marks], np.int64)
        marks_first = self.cores.filled + len(rest) + np.cumsum(marks_size) - marks_size
        first, number = np.zeros((len(size), 2), np.int64), np.zeros((len(size), 2), np.int64)
        first[plain, 0], number[plain, 0] = self.cores.first[codes], self.cores.number[codes]
        first[plain, 1], number[plain, 1] = marks_first[tail_of], marks_size[tail_of]
        first[~plain, 0], number[~plain, 0] = self.cores.filled + np.cumsum(counts) - counts, counts
        return gather(pool, first.ravel(), number.ravel()), number.sum(axis=1)
