"""Suffix arrays by induced sorting, and common prefixes in text order, as whole-array steps."""

from __future__ import annotations

import numpy as np

#: Alphabets beyond this are ordered by doubling: inducing goes bucket by bucket and pays where buckets are few.
WIDE = 4096


def _index(n: int) -> type:
    """Type of positions; half the room where it is enough."""
    return np.int32 if n < 1 << 30 else np.int64


def _later_types(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its right neighbour; ``s`` ends with its unique least symbol."""
    n = len(s)
    step = np.zeros(n, np.int8)
    step[:-1] = (s[1:] > s[:-1]).astype(np.int8) - (s[1:] < s[:-1])
    step[-1] = 1
    at = np.where(step != 0, np.arange(n, dtype=_index(n)), _index(n)(n))
    decides = np.minimum.accumulate(at[::-1])[::-1]  # equal symbols take the type of what ends their run
    return step[decides] > 0


def _induce(s: np.ndarray, small: np.ndarray, seeds: np.ndarray, sigma: int) -> np.ndarray:
    """Order of all suffixes from ``seeds``, the leftmost-smaller ones in order: larger ones left to right, smaller ones back."""
    n = len(s)
    counts = np.bincount(s, minlength=sigma)
    ends = np.cumsum(counts)
    heads, tails = ends - counts, ends.copy()
    order = np.full(n, -1, _index(n))
    symbol = s[seeds]
    seeds = seeds[np.argsort(symbol, kind="stable")]
    cut = np.r_[0, np.cumsum(np.bincount(symbol, minlength=sigma))]

    def scatter(found: np.ndarray, pointer: np.ndarray, sign: int) -> None:
        """Append each suffix to its symbol's bucket, in the order given."""
        symbols = s[found]
        rank = np.argsort(symbols, kind="stable")
        symbols = symbols[rank]
        edge = np.flatnonzero(np.r_[True, symbols[1:] != symbols[:-1]])
        sizes = np.diff(np.r_[edge, len(symbols)])
        within = np.arange(len(symbols)) - np.repeat(edge, sizes)
        if sign > 0:
            order[pointer[symbols] + within] = found[rank]
        else:
            order[pointer[symbols] - 1 - within] = found[rank]
        pointer[symbols[edge]] += sign * sizes

    used = np.flatnonzero(counts)
    starts = heads.copy()
    for c in used.tolist():
        done = starts[c]
        while done < heads[c]:  # runs of one symbol feed their own bucket
            front = order[done:heads[c]]
            done = heads[c]
            before = front[front > 0] - 1
            before = before[~small[before]]
            if len(before):
                scatter(before, heads, 1)
        front = seeds[cut[c]:cut[c + 1]]
        before = front[front > 0] - 1
        before = before[~small[before]]
        if len(before):
            scatter(before, heads, 1)
    order[0] = n - 1
    tails[0] -= 1
    for c in used[::-1].tolist():
        done = ends[c]
        while done > tails[c]:
            front = order[tails[c]:done][::-1]
            done = tails[c]
            before = front[front > 0] - 1
            before = before[small[before]]
            if len(before):
                scatter(before, tails, -1)
        front = order[starts[c]:heads[c]][::-1]
        before = front[front > 0] - 1
        before = before[small[before]]
        if len(before):
            scatter(before, tails, -1)
    order[0] = n - 1
    return order


def _names(s: np.ndarray, sorted_lms: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Rank of each leftmost-smaller substring in ``sorted_lms`` order; equal ones share a rank."""
    size = np.zeros(len(s), np.int64)
    size[lms[:-1]] = np.diff(lms) + 1
    size[lms[-1]] = 1
    a, b = sorted_lms[:-1], sorted_lms[1:]
    same = size[a] == size[b]
    live = np.flatnonzero(same)
    depth = 0
    while len(live):
        live = live[size[a[live]] > depth]
        equal = s[a[live] + depth] == s[b[live] + depth]
        same[live[~equal]] = False
        live = live[equal]
        depth += 1
    return np.r_[0, np.cumsum(~same)]


def _doubled(s: np.ndarray) -> np.ndarray:
    n, width, rank = len(s), 1, s.astype(np.int64)
    while True:
        key = rank * np.int64(n + 1)
        key[:n - width] += rank[width:] + 1
        order = np.argsort(key)
        ranked = np.r_[0, np.cumsum(key[order[1:]] != key[order[:-1]])]
        rank = np.empty(n, np.int64)
        rank[order] = ranked
        if ranked[-1] == n - 1:
            return order
        width = min(2 * width, n)


def _sort(s: np.ndarray, sigma: int) -> np.ndarray:
    """Suffix array of ``s``, whose last symbol is its unique least one."""
    n = len(s)
    if n < 3:
        return np.arange(n)[::-1].copy()
    if sigma > WIDE:
        return _doubled(s)
    small = _later_types(s)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    order = _induce(s, small, lms, sigma)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    by_substring = order[is_lms[order]]
    names = _names(s, by_substring, lms)
    if names[-1] < len(lms) - 1:
        place = np.empty(n, np.int64)
        place[by_substring] = names
        reduced = place[lms]
        by_suffix = lms[_sort(reduced, int(names[-1]) + 1)]
    else:
        by_suffix = by_substring
    return _induce(s, small, by_suffix, sigma)


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Positions of the suffixes of a sequence of non-negative integers in ascending order."""
    if not len(s):
        return np.zeros(0, np.int64)
    closed = np.zeros(len(s) + 1, np.uint16 if s.max() < 65_535 else np.int64)
    closed[:-1] = s.astype(np.int64) + 1
    return _sort(closed, int(closed.max()) + 1)[1:]


def permuted_lcp(data: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Common prefix of each suffix with the one before it in ``order``, up to ``most`` bytes, in text order.

    The predecessor of every position is looked up first; then all positions are compared eight bytes a step,
    those that still agree going on.
    """
    n = len(data)
    before = np.full(n, -1, _index(n))
    before[order[1:]] = order[:-1]
    room = -(-most // 8) * 8 + 8
    padded = np.zeros(n + room, np.uint8)
    padded[:n] = data
    eight = np.ndarray((n + room - 7,), "<u8", padded.tobytes(), 0, (1,))
    out = np.zeros(n, np.int16)
    live = np.flatnonzero(before >= 0).astype(_index(n))
    for depth in range(0, most, 8):
        differ = eight[live + depth] ^ eight[before[live] + depth]
        low = differ & (~differ + np.uint64(1))
        bytes_equal = np.where(differ == 0, 8, np.bitwise_count(low - np.uint64(1)) // 8)
        out[live] = depth + bytes_equal
        live = live[differ == 0]
        if not len(live):
            break
    left = n - np.maximum(np.arange(n, dtype=_index(n)), before)
    return np.minimum(np.minimum(out, left), most) * (before >= 0)
