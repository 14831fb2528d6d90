"""Exact repeats across documents: suffix arrays of shards, induced by sorting, with permuted common prefixes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import parts_for, text_bytes, tidy_pair, tidy_table
from .suffixes import permuted_lcp, suffix_array

#: Shortest repeat, and the length of the anchors that lead equal repeats to one shard.
REPEAT, ANCHOR = 50, 16
SPAN = REPEAT - ANCHOR + 1
#: A window has this many bytes at least before its anchor, or after it.
SIDE = (REPEAT - ANCHOR + 1) // 2
CHUNK_BYTES = 4 << 20
#: Distinct strings around an anchor from which they are dealt to shards window by window; copies of one string are one.
HOT = 20_000
#: Chunks that rows equal in id and text are dealt to.
DEALT = 4096
LAST = np.int64((1 << 63) - 1)
MIX_A, MIX_B, MIX_C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xBF58476D1CE4E5B9)

CODES = "chunk bigint, part bigint, codes binary"
UNITS = "part bigint, chunk bigint, keys binary, lefts binary, sizes binary, firsts binary, strings binary"
ANSWERS = "chunk bigint, part bigint, firsts binary, masks binary"


class Chunk:
    """Texts of one chunk end to end, in a fixed order of their rows."""

    def __init__(self, table: pa.Table) -> None:
        ids = table["doc_id"].combine_chunks().fill_null(int(LAST))
        text = table["text"].combine_chunks().cast(pa.large_string()).fill_null("")
        order = np.lexsort((np.asarray(table["digest"].combine_chunks()), np.asarray(ids)))
        text, self.rows = text.take(pa.array(order)), table.take(pa.array(order))
        self.ids = np.asarray(ids)[order]
        offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
        self.data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        self.bounds = offsets - offsets[0]
        self.at, self.hash = anchors(self.data, self.bounds)
        self.doc = np.searchsorted(self.bounds, self.at, side="right") - 1
        self.known, self.slot = np.unique(self.hash, return_inverse=True)


def anchors(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and keys of the least-hashed ``ANCHOR``-byte strings of all ``REPEAT``-byte windows inside a text.

    A window's anchors depend on its bytes alone, so equal windows have equal anchors at equal places.
    """
    n, block = len(data), 1 << 16  # what a block needs stays near the processor
    if n < REPEAT:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    padded = np.zeros(n + 2 * REPEAT, np.uint8)
    padded[:n] = data
    eight = np.ndarray((n + 2 * REPEAT - 7,), "<u8", padded.tobytes(), 0, (1,))
    inside = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(n) >= REPEAT
    places, hashes = [], []
    for start in range(0, n, block):
        # Anchors in [start, stop): their windows begin up to SPAN - 1 earlier, and reach as many places further.
        stop, lo = min(n, start + block), max(0, start - SPAN + 1)
        hi = min(n, stop + SPAN - 1)
        h = np.full(hi - lo + SPAN, np.uint64(2**64 - 1))
        own = eight[lo:min(hi + SPAN, n)] * MIX_A ^ eight[lo + 8:min(hi + SPAN, n) + 8] * MIX_B
        own ^= own >> np.uint64(29)
        own *= MIX_C
        own ^= own >> np.uint64(32)
        h[:len(own)] = own
        least = _sliding(h, SPAN, np.minimum)[:stop - lo]
        least[~inside[lo:stop]] = 0
        most = _sliding(np.concatenate([np.zeros(max(0, SPAN - 1 - (start - lo)), np.uint64), least]), SPAN, np.maximum)
        found = np.flatnonzero(most[:stop - start] == h[start - lo:stop - lo])
        places.append(found + start)
        hashes.append(h[start - lo:stop - lo][found])
    # Least hashes are small ones: mixed again, they fill the key ranges evenly.
    keys = np.concatenate(hashes) * MIX_B
    keys ^= keys >> np.uint64(32)
    return np.concatenate(places), keys * MIX_C


def _sliding(x: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    done = 1
    while 2 * done <= width:
        x = pick(x[:-done], x[done:])
        done *= 2
    return pick(x[:len(x) - (width - done)], x[width - done:]) if width > done else x


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    """Range of an (ascending) 64-bit key: ``parts`` equal ranges."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _cuts(parts: np.ndarray) -> Iterator[tuple[int, int, int]]:
    if not len(parts):
        return
    edge = np.flatnonzero(np.r_[True, parts[1:] != parts[:-1]])
    yield from zip(parts[edge].tolist(), edge.tolist(), np.r_[edge[1:], len(parts)].astype(int).tolist(), strict=True)


def _table(schema: str, rows: list[tuple]) -> pa.Table:
    kinds = {"bigint": pa.int64(), "binary": pa.large_binary(), "int": pa.int32()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) or [[]] * len(fields)
    return pa.table([pa.array(c, kinds[k] if k != "binary" else pa.binary()) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


# --- which anchors occur in more than one document ---------------------------------------------------------------------

SEVEN_BITS = 127


def _packed(keys: np.ndarray, strings: np.ndarray, several: np.ndarray) -> bytes:
    """Number of anchors, their keys, a byte each (strings up to 126 and whether in several rows), and the larger numbers."""
    short = np.minimum(strings, SEVEN_BITS).astype(np.uint8) * 2 + several
    return np.uint32(len(keys)).tobytes() + keys.tobytes() + short.tobytes() + strings[strings >= SEVEN_BITS].astype("<u4").tobytes()


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = int(np.frombuffer(blob, "<u4", 1)[0])
    keys, short = np.frombuffer(blob, "<u8", n, 4), np.frombuffer(blob, np.uint8, n, 4 + 8 * n)
    strings = (short >> 1).astype(np.int64)
    strings[strings == SEVEN_BITS] = np.frombuffer(blob, "<u4", offset=4 + 9 * n)
    return keys, strings, (short & 1).astype(bool)


def _strings(chunk: Chunk) -> np.ndarray:
    """For each distinct anchor the number of distinct strings around it, told apart by a hash of their bytes."""
    often = np.flatnonzero(np.bincount(chunk.slot, minlength=len(chunk.known))[chunk.slot] > 1)  # an anchor found once has one
    at, doc = chunk.at[often], chunk.doc[often]
    begin, end = np.maximum(chunk.bounds[doc], at - SPAN + 1), np.minimum(chunk.bounds[doc + 1], at + REPEAT)
    room = REPEAT + SPAN + 8
    eight = np.ndarray((len(chunk.data) + room - 7,), "<u8", np.r_[chunk.data, np.zeros(room, np.uint8)].tobytes(), 0, (1,))
    kept = np.array([(1 << 8 * n) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)
    around = (end - begin).astype(np.uint64)
    for j in range(0, REPEAT + SPAN, 8):
        around = (around ^ (eight[begin + j] & kept[np.clip(end - begin - j, 0, 8)])) * MIX_A
        around ^= around >> np.uint64(29)
    _, one = np.unique(around * MIX_B + chunk.hash[often], return_index=True)
    return np.maximum(np.bincount(chunk.slot[often[one]], minlength=len(chunk.known)), 1)


def _anchor_counts(parts: int) -> Callable:
    def counted(table: pa.Table) -> pa.Table:
        """A chunk's distinct anchors by key range, with their distinct strings, and whether more than one of its rows holds them."""
        chunk = Chunk(table)
        # Anchors come row by row: of equal ones, the first and the last tell whether there are more rows than one.
        first, last = np.zeros(len(chunk.known), np.int64), np.zeros(len(chunk.known), np.int64)
        first[chunk.slot[::-1]] = chunk.doc[::-1]
        last[chunk.slot] = chunk.doc
        several = first != last
        strings = _strings(chunk)
        where, id_ = _part(chunk.known, parts), table["chunk"][0].as_py()
        return _table(CODES, [(id_, p, _packed(chunk.known[a:b], strings[a:b], several[a:b])) for p, a, b in _cuts(where)])
    return counted


def _anchor_codes(table: pa.Table) -> pa.Table:
    """For every chunk of a key range: 0 for an anchor of one row, 1 for more, 2 for one of more rows with very many strings."""
    blobs = [_unpacked(b) for b in table["codes"].to_pylist()]
    keys, strings, several = (np.concatenate(x) for x in zip(*blobs))
    _, slot = np.unique(keys, return_inverse=True)
    shared = (np.bincount(slot) > 1) | (np.bincount(slot, several) > 0)
    codes = (shared.astype(np.uint8) + (shared & (np.bincount(slot, strings) >= HOT)))[slot]
    at, out = 0, []
    for chunk, part, (own, _, _) in zip(table["chunk"].to_pylist(), table["part"].to_pylist(), blobs, strict=True):
        out.append((chunk, part, codes[at:at + len(own)].tobytes()))
        at += len(own)
    return _table(CODES, out)


# --- strings around shared anchors -----------------------------------------------------------------------------------

class Units:
    """The strings a chunk sends to the shards, one for each distinct (key, place of the anchor, bytes).

    An anchor's string holds all windows around it: up to ``REPEAT - ANCHOR`` bytes before, ``REPEAT`` from it on, cut at the
    text's ends. Windows of a very frequent anchor are units of their own, keyed by their bytes, so that no anchor can
    fill a shard.
    """

    def __init__(self, chunk: Chunk, codes: np.ndarray) -> None:
        code = codes[chunk.slot]
        at, doc = chunk.at[code > 0], chunk.doc[code > 0]
        key, hot = chunk.hash[code > 0], code[code > 0] == 2
        begin = np.maximum(chunk.bounds[doc], at - SPAN + 1)
        size = np.minimum(chunk.bounds[doc + 1], at + REPEAT) - begin
        left = at - begin
        windows = size[hot] - REPEAT + 1
        shift = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        apart = np.repeat(begin[hot], windows) + shift
        self.begin, self.size = np.r_[begin[~hot], apart], np.r_[size[~hot], np.full(len(apart), REPEAT, np.int64)]
        self.doc = np.r_[doc[~hot], np.repeat(doc[hot], windows)]
        width = REPEAT + SPAN - 1
        padded = np.r_[chunk.data, np.zeros(width, np.uint8)]
        plain, plain_of = _distinct(self._records(key[~hot], left[~hot], size[~hot], _bytes(padded, begin[~hot], size[~hot], width)))
        # Windows are made distinct by their bytes before they are laid out like the others.
        single, single_of = _distinct(_bytes(padded, apart, None, REPEAT))
        raw = single.view(np.uint8).reshape(len(single), REPEAT)
        own = np.zeros(len(single), np.uint64)
        for j in range(0, REPEAT, 2):
            own = (own ^ raw[:, j:j + 2].copy().view("<u2")[:, 0]) * MIX_A
            own ^= own >> np.uint64(31)
        laid = np.zeros((len(single), width), np.uint8)
        laid[:, :REPEAT] = raw
        whole = self._records(own, np.full(len(single), SPAN), np.full(len(single), REPEAT), laid)
        self.distinct, of = _distinct(np.concatenate([plain.view(np.uint8).reshape(len(plain), whole.shape[1]), whole]))
        self.of = np.r_[of[:len(plain)][plain_of], of[len(plain):][single_of]]
        self.first = np.full(len(self.distinct), LAST)
        np.minimum.at(self.first, self.of, chunk.ids[self.doc])

    @staticmethod
    def _records(key: np.ndarray, left: np.ndarray, size: np.ndarray, wide: np.ndarray) -> np.ndarray:
        """Rows that sort by key, then by place, size and bytes."""
        return np.concatenate([key.byteswap().view(np.uint8).reshape(-1, 8), left.astype(np.uint8)[:, None], size.astype(np.uint8)[:, None], wide], axis=1)

    def blobs(self, parts: int) -> Iterator[tuple]:
        record = self.distinct.view(np.uint8).reshape(len(self.distinct), self.distinct.dtype.itemsize)
        key = record[:, :8].copy().view(">u8")[:, 0].astype(np.uint64)
        left, size, wide = record[:, 8], record[:, 9], record[:, 10:]
        for p, a, b in _cuts(_part(key, parts)):
            strings = wide[a:b][np.arange(wide.shape[1])[None, :] < size[a:b, None]]
            yield p, key[a:b].tobytes(), left[a:b].tobytes(), size[a:b].tobytes(), _squeezed(self.first[a:b]), _squeezed(strings)


def _bytes(padded: np.ndarray, begin: np.ndarray, size: np.ndarray | None, width: int) -> np.ndarray:
    """Rows of ``width`` bytes from each beginning on, 0 beyond a row's size."""
    rows = np.ndarray((len(padded) - width + 1,), f"V{width}", padded, 0, (1,))
    wide = rows[begin].view(np.uint8).reshape(len(begin), width)
    if size is not None:
        wide[np.arange(width)[None, :] >= size[:, None]] = 0
    return wide


def _distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of bytes in order, and for each row its place among them."""
    return np.unique(np.ascontiguousarray(rows).view(f"V{rows.shape[1]}")[:, 0], return_inverse=True)


def _squeezed(values: np.ndarray) -> bytes:
    """Strings and ids shrink to about half; the shuffle's own codec only finds repeats."""
    return pa.compress(values.tobytes(), codec="zstd", asbytes=True)


def _codes_of(answers: pa.Table) -> np.ndarray:
    """A chunk's codes, its key ranges in order."""
    if not answers.num_rows:
        return np.zeros(0, np.uint8)
    ordered = answers.sort_by("part")
    return np.frombuffer(b"".join(ordered["codes"].to_pylist()), np.uint8)


def _unit_rows(parts: int) -> Callable:
    def rows(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not texts.num_rows or not answers.num_rows:
            return _table(UNITS, [])
        chunk, id_ = Chunk(texts), texts["chunk"][0].as_py()
        return _table(UNITS, [(p, id_, *blobs) for p, *blobs in Units(chunk, _codes_of(answers)).blobs(parts)])
    return rows


# --- shards ------------------------------------------------------------------------------------------------------------

def repeated_windows(strings: list[bytes] | np.ndarray, sizes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """For each string a mask: bit i is set if the ``REPEAT`` bytes from i on are also in a string of smaller ``firsts``.

    The strings are joined with separators below all bytes, their suffixes sorted by inducing, and neighbours compared in text
    order; a run of neighbours that share ``REPEAT`` bytes is one window, whose least document decides.
    """
    flat = np.asarray(strings, np.uint8)
    total = int(sizes.sum()) + len(sizes)
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    inside = np.ones(total, bool)
    inside[starts + sizes] = False
    symbols = np.zeros(total, np.uint16)
    symbols[inside] = flat.astype(np.uint16) + 1
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes + 1)
    place = (np.arange(total) - np.repeat(starts, sizes + 1)).astype(np.int32)
    order = suffix_array(symbols)
    shared = permuted_lcp(np.where(inside, symbols - 1, 0).astype(np.uint8), order, REPEAT)
    whole = place + REPEAT <= sizes[owner]  # suffixes that hold a window of their own string
    # Separators compare like bytes 0, so a prefix counts only between suffixes that both hold a whole window.
    ranked = order[whole[order]]
    skipped = np.flatnonzero(whole[order])
    adjoining = np.r_[False, np.diff(skipped) == 1]
    head = np.flatnonzero(~(adjoining & (shared[ranked] >= REPEAT))) if len(ranked) else np.zeros(0, np.int64)
    masks = np.zeros(len(sizes), np.uint64)
    if len(head):
        least = np.repeat(np.minimum.reduceat(firsts[owner[ranked]], head), np.diff(np.r_[head, len(ranked)]))
        hit = ranked[least < firsts[owner[ranked]]]
        np.bitwise_or.at(masks, owner[hit], np.uint64(1) << place[hit].astype(np.uint64))
    return masks


def _may_share(keys: np.ndarray, lefts: np.ndarray, sizes: np.ndarray, wide: np.ndarray) -> np.ndarray:
    """Whether another string of the key agrees on the ``SIDE`` bytes before the anchor, or on those after it.

    Two equal windows hold their anchor at one place and at least ``SIDE`` bytes on one side of it, so strings that agree with no
    other on either side share none. Sides are told apart by a hash: an equal one only costs a string that is sorted for nothing.
    """
    lefts, found = lefts.astype(np.int64), np.zeros(len(keys), bool)
    flat = np.r_[wide.ravel(), np.zeros(8, np.uint8)]
    eight = np.ndarray((len(flat) - 7,), "<u8", flat.data, 0, (1,))
    for begin in (lefts - SIDE, lefts + ANCHOR):
        held = np.flatnonzero((begin >= 0) & (begin + SIDE <= sizes))
        at, side = held * wide.shape[1] + begin[held], keys[held].astype(np.uint64)
        for j in [*range(0, SIDE - 8, 8), SIDE - 8]:
            side = (side ^ eight[at + j]) * MIX_A
            side ^= side >> np.uint64(29)
        order = np.argsort(side)
        equal = np.diff(side[order]) == 0
        twin = np.zeros(len(held), bool)
        twin[1:] |= equal
        twin[:-1] |= equal
        found[held[order[twin]]] = True
    return found


def _shard(table: pa.Table) -> pa.Table:
    """A shard's answer to each chunk: least document of every unit, and its windows that a smaller document has."""
    def joined(name: str, kind: str) -> np.ndarray:
        return np.frombuffer(b"".join(table[name].to_pylist()), kind)
    counts = [len(b) for b in table["lefts"].to_pylist()]
    lengths = [int(np.frombuffer(b, np.uint8).sum()) for b in table["sizes"].to_pylist()]

    def unpacked(name: str, kind: str, sizes: list[int]) -> np.ndarray:
        return np.frombuffer(b"".join(pa.decompress(b, n, codec="zstd", asbytes=True) for b, n in zip(table[name].to_pylist(), sizes, strict=True)), kind)
    keys, lefts, sizes = joined("keys", "<u8"), joined("lefts", np.uint8), joined("sizes", np.uint8).astype(np.int64)
    firsts, flat = unpacked("firsts", "<i8", [8 * n for n in counts]), unpacked("strings", np.uint8, lengths)
    width = REPEAT + SPAN - 1
    wide = np.zeros((len(sizes), width), np.uint8)
    wide[np.arange(width)[None, :] < sizes[:, None]] = flat
    record = np.concatenate([keys.byteswap().view(np.uint8).reshape(-1, 8), lefts[:, None], sizes.astype(np.uint8)[:, None], wide], axis=1)
    _, one, of = np.unique(np.ascontiguousarray(record).view(f"V{record.shape[1]}")[:, 0], return_index=True, return_inverse=True)
    first = np.full(len(one), LAST)
    np.minimum.at(first, of, firsts)
    # A string that no other can share a window with needs no sorting: its least document is that of all its windows.
    several = _may_share(keys[one], lefts[one], sizes[one], wide[one])
    masks = np.zeros(len(one), np.uint64)
    if several.any():
        held = one[several]
        masks[several] = repeated_windows(wide[held][np.arange(width)[None, :] < sizes[held, None]], sizes[held], first[several])
    at, out = 0, []
    for chunk, part, n in zip(table["chunk"].to_pylist(), table["part"].to_pylist(), counts, strict=True):
        out.append((chunk, part, first[of[at:at + n]].tobytes(), masks[of[at:at + n]].tobytes()))
        at += n
    return _table(ANSWERS, out)


# --- removal -----------------------------------------------------------------------------------------------------------

def _remover(decoded: bool) -> Callable:
    def remove(texts: pa.Table, answers: pa.Table) -> pa.Table:
        rows, sizes, spans, kept = _removed(texts, answers)
        if decoded:
            kept = [b.decode("utf-8", "ignore") for b in kept]  # parts of characters go
        return pa.table({"row": rows, "n_bytes": pa.array(sizes, pa.int64()), "spans": pa.array(spans, SPANS), "kept": pa.array(kept, pa.string() if decoded else pa.binary())})
    return remove


def _removed(texts: pa.Table, answers: pa.Table) -> tuple[pa.Array, np.ndarray, list, list[bytes]]:
    chunk = Chunk(texts)
    n = len(chunk.data)
    change = np.zeros(n + 1, np.int32)
    coded = answers.filter(answers["codes"].is_valid())
    if coded.num_rows:
        units = Units(chunk, _codes_of(coded))
        told = answers.filter(answers["codes"].is_null()).sort_by("part")
        first = np.frombuffer(b"".join(told["firsts"].to_pylist()), "<i8")[units.of]
        mask = np.frombuffer(b"".join(told["masks"].to_pylist()), "<u8")[units.of]
        later = chunk.ids[units.doc] > first  # a smaller document has the whole string
        np.add.at(change, units.begin[later], 1)
        np.add.at(change, (units.begin + units.size)[later], -1)
        own = np.flatnonzero(~later & (mask != 0))
        for bit in range(SPAN):
            some = units.begin[own[(mask[own] >> np.uint64(bit)) & np.uint64(1) == 1]] + bit
            np.add.at(change, some, 1)
            np.add.at(change, some + REPEAT, -1)
    gone = np.cumsum(change[:-1]) > 0
    spans, kept, sizes = [], [], np.diff(chunk.bounds)
    for a, b in zip(chunk.bounds[:-1].tolist(), chunk.bounds[1:].tolist(), strict=True):
        cut = gone[a:b]
        if cut.any():
            edge = np.flatnonzero(np.diff(np.r_[False, cut, False].astype(np.int8)))
            spans.append([{"start": s, "length": e - s} for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)])
            kept.append(chunk.data[a:b][~cut].tobytes())
        else:
            spans.append([])
            kept.append(chunk.data[a:b].tobytes())
    return chunk.rows["row"].combine_chunks(), sizes, spans, kept


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))


def remove_repeats(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), decoded: bool = False) -> DataFrame:
    """``(*keep, n_bytes, spans, kept)``: removed byte runs and the bytes left of every row of ``(doc_id, text)``.

    A byte goes if a ``REPEAT``-byte string that covers it also starts in a row of smaller doc_id, judged on the input. A null
    text is empty; a null id counts as larger than all others; rows of equal id never cut each other; texts shorter than a
    repeat stay; repeated rows are rows of their own; one text is one piece of work, however long. ``kept`` is binary, for a run may end inside a character; ``decoded`` makes it a text without such remains. An
    empty table gives no rows.

    Texts are dealt into chunks once, and that exchange serves all three steps over texts. Equal windows share an anchor, so
    (1) anchors are counted by key range, (2) strings around anchors of several rows go, copies collapsed, to the anchor's
    shard, where suffixes are sorted, (3) answers return to the chunks. Blobs per (chunk, range) carry the data, so what
    moves is proportional to the text; a task holds one chunk or one shard, both of bounded size.
    """
    total = text_bytes(docs)
    chunks, parts = parts_for(total, CHUNK_BYTES), parts_for(total, CHUNK_BYTES // 2)  # a sorted byte takes more room than a read one
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), F.struct(*keep).alias("row"))
    # Rows equal in id and text are dealt to several chunks too; within one their order does not matter.
    deal = F.xxhash64("digest", F.monotonically_increasing_id() % DEALT)
    rows = rows.withColumn("digest", F.xxhash64("doc_id", "text")).withColumn("chunk", F.pmod(deal, F.lit(chunks)).cast("bigint"))
    texts = rows.select("chunk", "doc_id", "digest", "text", "row")
    codes = (texts.groupBy("chunk").applyInArrow(tidy_table(_anchor_counts(parts)), CODES).groupBy("part").applyInArrow(tidy_table(_anchor_codes), CODES))
    units = texts.groupBy("chunk").cogroup(codes.groupBy("chunk")).applyInArrow(tidy_pair(_unit_rows(parts)), UNITS)
    answers = units.groupBy("part").applyInArrow(tidy_table(_shard), ANSWERS)
    both = (codes.select("chunk", "part", "codes", F.lit(None).cast("binary").alias("firsts"), F.lit(None).cast("binary").alias("masks"))
            .unionByName(answers.select("chunk", "part", F.lit(None).cast("binary").alias("codes"), "firsts", "masks")))
    kept = f"row {rows.schema['row'].dataType.simpleString()}, n_bytes bigint, spans array<struct<start:bigint,length:bigint>>, kept {'string' if decoded else 'binary'}"
    cut = texts.groupBy("chunk").cogroup(both.groupBy("chunk")).applyInArrow(tidy_pair(_remover(decoded)), kept)
    return cut.select(*[F.col("row")[c].alias(c) for c in keep], "n_bytes", "spans", "kept")
