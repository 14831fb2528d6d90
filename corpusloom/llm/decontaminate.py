"""Benchmark decontamination: prefix-filtered containment join over item-sized windows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.session import stage

from .common import parts_for, tidy
from .words import LOWER, UPPER, WORD, Lookup, of_strings, slices

WINDOW, SHINGLE = 10, 5
#: Windows met by one pass over the documents; more windows take more passes, so task tables stay of bounded size.
WINDOWS_PER_PASS = 200_000

HITS = "n_words bigint, runs array<struct<first:bigint,last:bigint>>, items array<string>"


def words_of(text: Column) -> Column:
    """Words in order; none for null."""
    return F.coalesce(F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(f"({WORD})"), F.lit(1)), F.array().cast("array<string>"))


def windows_of(benchmark: DataFrame, item: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """Distinct windows ``(words, items)``; an item of fewer words than ``size``, but not none, is one window.

    A null item id counts as the empty string. Rows with equal ids are one item with all their windows.
    """
    words = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), words_of(F.col(text)).alias("w")).filter(F.size("w") > 0)
    at = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    cut = words.select("item", F.explode(F.transform(at, lambda i: F.slice("w", i, size))).alias("words"))
    return cut.groupBy("words").agg(F.array_sort(F.collect_set("item")).alias("items"))


def shingles_of(windows: list[list[str]]) -> list[tuple[int, np.ndarray]]:
    """Width and hashes of each window's shingles; a window shorter than a shingle is one shingle."""
    out = []
    for words in windows:
        width = min(SHINGLE, len(words))
        out.append((width, of_strings([" ".join(words)]).rolled(width)[0]))
    return out


def _counter(widths: dict[int, np.ndarray]) -> Callable:
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {w: Lookup(h) for w, h in widths.items()}
        sums = {w: np.zeros(len(t.known), np.int64) for w, t in tables.items()}
        for _, words in slices(batches):
            for w, t in tables.items():
                sums[w] += np.bincount(t.find(*words.rolled(w))[1], minlength=len(t.known))
        for w, t in tables.items():
            held = np.flatnonzero(sums[w])
            yield pa.RecordBatch.from_arrays([pa.array([w] * len(held), pa.int32()), pa.array(t.known[held].view(np.int64)), pa.array(sums[w][held])],
                                             ["width", "hash", "n"])
    return count


def _joiner(windows: list[tuple[list[str], list[str]]], prefix: list[tuple[int, int, int]]) -> Callable:
    """``windows``: (words, items); ``prefix``: (width, hash, offset in words) of each window's rarest shingle."""
    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, lists = {}, {}
        for w in {p[0] for p in prefix}:
            tables[w] = Lookup(np.array([p[1] for p in prefix if p[0] == w], np.uint64))
            lists[w] = [[] for _ in tables[w].known]
            for i, p in enumerate(prefix):
                if p[0] == w:
                    lists[w][int(np.searchsorted(tables[w].known, np.uint64(p[1])))].append(i)
        spelled = [of_strings([" ".join(words)]).spelled(0, len(words)) for words, _ in windows]
        for rows, words in slices(batches):
            n_words = np.bincount(words.text, minlength=rows.num_rows)
            until = np.cumsum(n_words)
            change, items = np.zeros(len(words.hash) + 1, np.int64), {}
            for w, t in tables.items():
                for at, slot in zip(*(x.tolist() for x in t.find(*words.rolled(w))), strict=True):
                    text = int(words.text[at])
                    for i in lists[w][slot]:
                        start, size = at - prefix[i][2], len(windows[i][0])
                        # Length and position: the whole window has to lie in this text.
                        if start < until[text] - n_words[text] or start + size > until[text]:
                            continue
                        if words.spelled(start, size) == spelled[i]:
                            change[start] += 1
                            change[start + size] -= 1
                            items.setdefault(text, set()).update(windows[i][1])
            hit = np.cumsum(change)[:-1] > 0 if items else np.zeros(0, bool)
            out = []
            for i in range(rows.num_rows):
                runs = []
                if i in items:
                    own = np.r_[False, hit[until[i] - n_words[i]:until[i]], False].astype(np.int8)
                    edges = np.flatnonzero(np.diff(own))
                    runs = [{"first": a, "last": b} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]
                out.append((int(n_words[i]), runs, sorted(items.get(i, ()))))
            types = [pa.int64(), pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])), pa.list_(pa.string())]
            kept = [c for c in rows.schema.names if c != "text"]
            found = [pa.array(c, t) for c, t in zip(zip(*out), types, strict=True)]
            yield pa.RecordBatch.from_arrays([*(rows[c] for c in kept), *found], [*kept, "n_words", "runs", "items"])
    return join


def _one_pass(texts: DataFrame, windows: list[tuple[list[str], list[str]]]) -> DataFrame:
    """Hits of at most ``WINDOWS_PER_PASS`` windows. Shingles are ordered by how often the documents hold them; as all of a
    window's shingles must occur, its rarest one is the whole necessary prefix."""
    shingles = shingles_of([w for w, _ in windows])
    by_width = {w: np.unique(np.concatenate([h for x, h in shingles if x == w])) for w in {x for x, _ in shingles}}
    counted = (texts.mapInArrow(tidy(_counter(by_width)), "width int, hash bigint, n bigint").groupBy("width", "hash").agg(F.sum("n").alias("n")))
    often = {(r["width"], r["hash"]): r["n"] for r in counted.collect()}  # at most the shingles of one pass
    prefix = []
    for width, hashes in shingles:
        rarest = min(range(len(hashes)), key=lambda i: (often.get((width, int(hashes[i].view(np.int64))), 0), int(hashes[i])))
        prefix.append((width, int(hashes[rarest]), rarest))
    return texts.mapInArrow(tidy(_joiner(windows, prefix)), _hit_schema(texts))


def _hit_schema(texts: DataFrame) -> T.StructType:
    return T.StructType([f for f in texts.schema.fields if f.name != "text"] + T.StructType.fromDDL(HITS).fields)


def _bare(texts: DataFrame) -> DataFrame:
    """No hits at all: the result without a benchmark."""
    kinds = {f.name: f.dataType for f in T.StructType.fromDDL(HITS).fields}
    return texts.select(*[c for c in texts.columns if c != "text"], F.size(words_of(F.col("text"))).cast("bigint").alias("n_words"),
                        F.array().cast(kinds["runs"]).alias("runs"), F.array().cast(kinds["items"]).alias("items"))


def find_contamination(docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``(*keep, n_words, runs, items)`` for every row: hit word ranges ``[first, last)`` and the ids of items whose windows occur.

    The benchmark is cut into passes of a bounded number of windows, so what a task holds does not grow with it. A pass reads
    each document twice, once to count shingles and once to join; documents are never exchanged. With more passes than
    one their hits meet by row. Null texts have no words; an empty benchmark gives no hits; repeated rows are rows of their own.
    """
    windows = stage(windows_of(benchmark), "benchmark-windows")
    passes = parts_for(windows.count(), WINDOWS_PER_PASS)
    kept = [f"_keep{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(c).alias(k) for c, k in zip(keep, kept, strict=True)], F.col("text").cast("string").alias("text"),
                       *([F.monotonically_increasing_id().alias("row")] if passes > 1 else []))
    if passes > 1:
        rows = stage(rows, "numbered-documents")  # every pass has to see the same numbers
    found = None
    for n in range(passes):
        part = [(r["words"], r["items"]) for r in windows.filter(F.pmod(F.xxhash64("words"), F.lit(passes)) == n).collect()]
        one = _one_pass(rows, part) if part else _bare(rows)
        found = one if found is None else found.unionByName(one)
    if passes > 1:
        found = found.groupBy("row").agg(*[F.first(k).alias(k) for k in kept], F.max("n_words").alias("n_words"), F.flatten(F.collect_list("runs")).alias("runs"),
                                         F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")).withColumn("runs", _united(F.col("runs")))
    return found.select(*[F.col(k).alias(c) for c, k in zip(keep, kept, strict=True)], "n_words", "runs", "items")


def _united(runs: Column) -> Column:
    """Ranges in order, those that touch or overlap as one."""
    empty = F.array().cast("array<struct<first:bigint,last:bigint>>")

    def add(done: Column, run: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["first"].alias("first"), F.greatest(last["last"], run["last"]).alias("last"))))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["last"] >= run["first"]), joined).otherwise(F.concat(done, F.array(run)))
    return F.aggregate(F.array_sort(runs), empty, add)


def hit_words(runs: Column) -> Column:
    return F.aggregate(runs, F.lit(0).cast("bigint"), lambda n, r: n + r["last"] - r["first"])
