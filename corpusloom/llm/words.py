"""Words of many texts at once, as arrays over Arrow's own buffers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
# A word is a run of bytes other than ASCII separators, A-Z lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Separators become 0, A-Z become a-z, other bytes stay.
FOLD = np.zeros(256, np.uint8)
for _lo, _hi, _add in ((0x30, 0x39, 0), (0x41, 0x5A, 32), (0x61, 0x7A, 0), (0x80, 0xFF, 0)):
    FOLD[_lo:_hi + 1] = np.arange(_lo, _hi + 1) + _add
STEP, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class Words:
    """Words of consecutive texts as arrays: hash, first and last byte, and the text each belongs to."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray) -> None:
        self.low = FOLD[data]
        inside = self.low != 0
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        cuts = bounds[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(data))]
        begins[cuts] = inside[cuts]  # words do not cross texts
        ends[cuts - 1] = inside[cuts - 1]
        self.first, self.last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.size = self.last - self.first
        self.text = np.searchsorted(bounds, self.first, side="right") - 1
        if len(self.first):
            place = np.arange(len(data))[inside] - np.repeat(self.first, self.size)
            power = np.cumprod(np.full(int(self.size.max()), STEP))
            held = (self.low[inside].astype(np.uint64) + np.uint64(1)) * power[place]
            self.hash = np.add.reduceat(held, np.cumsum(self.size) - self.size)
            self.hash ^= self.hash >> np.uint64(31)
            self.hash *= MIX
        else:
            self.hash = np.zeros(0, np.uint64)

    def rolled(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the ``width`` words from each word on, and whether they are all in one text."""
        n = max(0, len(self.hash) - width + 1)
        out = np.zeros(n, np.uint64)
        for j in range(width):
            out = out * STEP + self.hash[j:n + j]
        return out, self.text[:n] == self.text[width - 1:n + width - 1]

    def spelled(self, start: int, width: int) -> tuple[bytes, bytes]:
        """Letters and word lengths of a window: equal for equal words only."""
        return (self.low[self.first[start]:self.last[start + width - 1]].tobytes().translate(None, b"\0"),
                self.size[start:start + width].astype("<i8").tobytes())


def of_strings(texts: list[str]) -> Words:
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    return Words(np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)]))


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Words]]:
    """Rows of a batch in slices of about ``SLICE_BYTES`` (one row at least), read from Arrow's own buffers."""
    for batch in batches:
        text = batch["text"].cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
        data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, side="right")) - 1)
            to = min(to, batch.num_rows)
            yield batch.slice(at, to - at), Words(data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at])
            at = to


class Lookup:
    """Places of known hashes in an array: a bitmap drops most, a sorted search decides."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.known = np.unique(hashes)
        self.bits = np.uint64(64 - min(24, max(12, (8 * len(self.known)).bit_length())))
        self.seen = np.zeros(1 << (64 - int(self.bits)), bool)
        self.seen[self._cell(self.known)] = True

    def _cell(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes * MIX) >> self.bits

    def find(self, hashes: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(self.seen[self._cell(hashes)] & good)
        slot = np.minimum(np.searchsorted(self.known, hashes[at]), max(0, len(self.known) - 1))
        hit = self.known[slot] == hashes[at] if len(self.known) else np.zeros(0, bool)
        return at[hit], slot[hit]
