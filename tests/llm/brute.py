"""Plain versions of the operators, and small tables with the awkward cases."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

LINE = "the quick brown fox jumps over the lazy dog while the other animals watch it from the hedge beside the river"
LONG = " ".join(f"word{i} and {i * 7 % 1013} more," for i in range(6000))

DOCUMENTS = [
    (1, LINE), (2, LINE), (3, f"A wholly other beginning. {LINE}"), (4, None), (5, ""), (6, "  \n "), (7, "short"), (8, "short"),
    (9, LONG), (10, LONG + " one more word"), (None, LINE), (11, "ÄÖÜ ß é \u0301 Ελληνικά ΟΔΟΣ 中文字 \U0001f600 don't it's 12345 <|endoftext|>"),
    (12, "a" * 200), (13, "a" * 300 + "b"), (14, f"{LINE}\n{LINE}\n{LINE}"), (14, f"{LINE}\n{LINE}\n{LINE}"), (-3, f"minus {LINE[:70]}"),
    (15, "é" * 60 + "x"), (16, "y" + "é" * 60), (17, "nul \x00 byte " * 12), (18, "nul \x00 byte " * 12 + "!"),
]


def documents(spark, rows=None):
    """With columns whose names operators might use themselves."""
    rows = DOCUMENTS if rows is None else rows
    return spark.createDataFrame([(i, t, "en", "s", 0, "x", 1, b"y", 2) for i, t in rows],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint, node string, row bigint, chunk binary, key int")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def jump_shard(key, shards):
    """The published algorithm on unsigned 64-bit integers."""
    key, b, j = key % 2**64, -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2147483648 / ((key >> 33) + 1)))
    return b


def repeats(rows, length=50):
    """(n_bytes, n_removed, n_spans, sha256 of what is left) by row."""
    first = {}
    rows = [(2**63 - 1 if i is None else i, (t or "").encode()) for i, t in rows]
    for i, b in sorted(rows):
        for p in range(len(b) - length + 1):
            first.setdefault(b[p:p + length], i)
    out = []
    for i, b in rows:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < i:
                gone[p:p + length] = b"\1" * length
        runs = sum(1 for p, g in enumerate(gone) if g and not (p and gone[p - 1]))
        out.append((i, (len(b), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest())))
    return out


def contamination(rows, items, size=10):
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1)) if w else ():
            windows[tuple(w[i:i + size])].add("" if item is None else str(item))
    sizes = {len(k) for k in windows}
    out = []
    for i, text in rows:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for p in range(len(w) - n + 1):
                if (got := windows.get(tuple(w[p:p + n]))) is not None:
                    hit.update(range(p, p + n))
                    found |= got
        out.append((i, len(w), len(hit), sorted(found)))
    return out


def classes(rows, linked):
    """Smallest id of each row's class, by texts; ``linked`` judges two texts."""
    texts = list(dict.fromkeys(t or "" for _, t in rows))
    up = {t: t for t in texts}

    def top(t):
        while up[t] != t:
            t = up[t]
        return t
    for n, a in enumerate(texts):
        for b in texts[:n]:
            if top(a) != top(b) and linked(a, b):
                up[top(a)] = top(b)
    least = {}
    for i, t in rows:
        if i is not None:
            least[top(t or "")] = min(i, least.get(top(t or ""), i))
    return [least.get(top(t or "")) for _, t in rows]
