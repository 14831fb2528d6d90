"""Exact top-k inner product on a bit-sliced index."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import stage

from .common import parts_for

BLOCK_ROWS = 16_384
#: A block is copied to more tasks only if each has so many queries.
QUERIES_PER_UNIT = 64

INDEX_SCHEMA = "block int, attribute int, slice int, base bigint, bits binary"
HIT_SCHEMA = "query_id bigint, vec_id bigint, score bigint"


def quantise(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 256) -> DataFrame:
    """``(vec_id, x)`` with ``x = floor(scale * component)``; rows with a null id, a null vector, or a component
    that is null or not finite are left out. All others stay as they are; an ``x`` of more than 64 bits is an error."""
    inf = float("inf")
    usable = F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & F.forall(
        embedding, lambda x: F.coalesce(~F.isnan(x) & (x.cast("double") < inf) & (x.cast("double") > -inf), F.lit(False)))

    def floor(x: Column) -> Column:
        scaled = x.cast("double") * scale
        beyond = F.raise_error(F.concat(F.lit(f"top k: a component times {scale} is beyond 64 bits: "), x.cast("string"))).cast("bigint")
        return F.when(F.abs(scaled) < 2.0 ** 63, F.floor(scaled).cast("bigint")).otherwise(beyond)

    whole = F.transform(embedding, floor)
    return vectors.filter(usable).select(F.col(vec_id).cast("bigint").alias("vec_id"), whole.alias("x"))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of integer lists as one matrix; shorter rows are padded with 0."""
    lists = column.combine_chunks()
    sizes = np.asarray(lists.value_lengths())
    flat = np.asarray(lists.flatten())
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def _slices(table: pa.Table) -> pa.Table:
    """Index of one block: per attribute its least value and the bitmaps of what exceeds it, one row per bit.

    Attribute -1 holds the rows' ids, ascending; bit i of every bitmap belongs to the i-th id.
    """
    block = table["block"][0].as_py()
    ids = np.asarray(table["vec_id"])
    order = np.argsort(ids, kind="stable")
    values = _matrix(table["x"])[order]
    padded = -(-len(ids) // 64) * 64
    rows = [(block, -1, 0, len(ids), ids[order].astype("<i8").tobytes())]
    for a in range(values.shape[1]):
        base = int(values[:, a].min())
        above = (values[:, a] - base).astype(np.uint64)
        for s in range(max(1, int(above.max()).bit_length())):
            bits = np.zeros(padded, np.uint8)
            bits[:len(ids)] = (above >> np.uint64(s)) & np.uint64(1)
            rows.append((block, a, s, base, np.packbits(bits, bitorder="little").tobytes()))
    names = ["block", "attribute", "slice", "base", "bits"]
    types = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names=names)


def build_index(quantised: DataFrame, name: str = "bit-slices") -> tuple[DataFrame, int]:
    """Stage the index of all rows in blocks of about ``BLOCK_ROWS``; returns it and the number of blocks."""
    blocks = parts_for(quantised.count(), BLOCK_ROWS)
    keyed = quantised.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    return stage(keyed.groupBy("block").applyInArrow(_slices, INDEX_SCHEMA), name), blocks


def _add(bitmaps: list[list[np.ndarray]]) -> np.ndarray:
    """Sum of bitmaps given by weight 2**level: full adders over whole levels, carries go one level up."""
    planes, level = [], 0
    while level < len(bitmaps):
        x = np.concatenate(bitmaps[level]) if bitmaps[level] else None
        while x is not None and len(x) > 1:
            m = max(1, len(x) // 3)
            a, b = x[:m], x[m:2 * m]
            if len(x) >= 3:
                c = x[2 * m:3 * m]
                u = a ^ b
                carry = (a & b) | (u & c)
                x = np.concatenate([u ^ c, x[3 * m:]])
            else:
                carry, x = a & b, a ^ b
            if level + 1 == len(bitmaps):
                bitmaps.append([])
            bitmaps[level + 1].append(carry)
        planes.append(x)
        level += 1
    width = next((p.shape[1] for p in planes if p is not None), 0)
    return np.concatenate([p if p is not None else np.zeros((1, width), np.uint64) for p in planes])


def _members(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def _select(planes: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest sums among ``rows``, from the most significant slice downward.

    Sure rows collect in one bitmap, rows still tied on the slices read stay in another; rows tied on all slices are
    taken in order of their position, which is the order of their ids.
    """
    sure, tied, count = np.zeros_like(rows), rows, 0
    for plane in planes[::-1]:
        high = tied & plane
        n = int(np.bitwise_count(high).sum())
        if count + n > k:
            tied = high
        else:
            sure, count, tied = sure | high, count + n, tied & ~plane
            if count == k:
                return _members(sure)
    return np.concatenate([_members(sure), _members(tied)[:k - count]])


def _sums(held: np.ndarray) -> list[int]:
    """Numbers whose bits are the columns, from the least significant row on, whatever their size."""
    sums = [0] * held.shape[1]
    for at in range(0, len(held), 32):
        part = held[at:at + 32].astype(np.int64)
        some = (part << np.arange(len(part))[:, None]).sum(axis=0)
        sums = [total + (low << at) for total, low in zip(sums, some.tolist(), strict=True)]
    return sums


class Block:
    """One block of the index, ready to be asked."""

    def __init__(self, index: pa.Table) -> None:
        attribute, shift, base = (np.asarray(index[c]) for c in ("attribute", "slice", "base"))
        blobs = index["bits"].to_pylist()
        self.ids = np.frombuffer(blobs[int(np.flatnonzero(attribute == -1)[0])], "<i8")
        self.words = words = -(-len(self.ids) // 64)
        own = np.flatnonzero(attribute >= 0)
        bits = np.frombuffer(b"".join(blobs[i] for i in own), np.uint64).reshape(len(own), words)
        self.attribute, self.shift, base = attribute[own], shift[own].astype(np.int64), base[own]
        self.slices = np.concatenate([bits, ~bits])  # the complement serves negative query components
        self.every = np.packbits(np.r_[np.ones(len(self.ids), np.uint8), np.zeros(words * 64 - len(self.ids), np.uint8)], bitorder="little").view(np.uint64)
        first = self.shift == 0
        highest = np.zeros(self.attribute.max(initial=-1) + 1, np.int64)
        np.maximum.at(highest, self.attribute, self.shift)
        self.bases = np.zeros(len(highest), np.int64)
        self.bases[self.attribute[first]] = base[first]
        self.spans = [(1 << (h + 1)) - 1 for h in highest.tolist()]

    def top(self, query_id: int, q: np.ndarray, k: int) -> list[tuple[int, int, int]]:
        """The ``k`` highest of the block but the query's own rows."""
        attribute, shift, slices, ids = self.attribute, self.shift, self.slices, self.ids
        width = min(len(q), len(self.bases))
        q = np.concatenate([q[:width], np.zeros(len(self.bases) - width, np.int64)])
        # q*x = |q|*(x - base) + q*base, and for negative q the complement of x - base counts instead.
        fixed = sum(x * base + min(x, 0) * span for x, base, span in zip(q.tolist(), self.bases.tolist(), self.spans, strict=True))
        size, which = np.abs(q)[attribute], np.arange(len(attribute)) + (q < 0)[attribute] * len(attribute)
        depth = int(size.max(initial=0)).bit_length()
        rows, power = np.nonzero((size[:, None] >> np.arange(max(1, depth))[None, :]) & 1)
        weight = shift[rows] + power
        order = np.argsort(weight, kind="stable")
        cuts = np.searchsorted(weight[order], np.arange(weight.max(initial=-1) + 2))
        levels = [[slices[which[rows[order[a:b]]]]] if b > a else [] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        planes = _add(levels) if levels else np.zeros((1, self.words), np.uint64)
        rest = self.every
        lo, hi = np.searchsorted(ids, [query_id, query_id + 1])
        if hi > lo:
            mine = np.zeros(self.words * 64, np.uint8)
            mine[lo:hi] = 1
            rest = rest & ~np.packbits(mine, bitorder="little").view(np.uint64)
        at = _select(planes, rest, k)
        held = (planes[:, at // 64] >> (at % 64).astype(np.uint64)[None, :]) & np.uint64(1)
        scores = [above + fixed for above in _sums(held)]
        if any(not -(1 << 63) <= score < 1 << 63 for score in scores):
            raise ValueError(f"top k: a score of query {query_id} is beyond 64 bits")
        return list(zip([query_id] * len(at), ids[at].tolist(), scores, strict=True))


def _searcher(k: int) -> Callable:
    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by (block, lane), the block's slices before its queries: a task holds one block and asks as queries pass."""
        unit, held, block = None, [], None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            lanes, asks = np.asarray(table["block"], np.int64) << 32 | np.asarray(table["lane"], np.int64), table["vec_id"].is_valid().to_numpy()
            cuts = np.flatnonzero(np.r_[True, (lanes[1:] != lanes[:-1]) | (asks[1:] != asks[:-1])])
            got: list[tuple[int, int, int]] = []
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), table.num_rows], strict=True):
                if lanes[a] != unit:
                    unit, held, block = lanes[a], [], None
                part = table.slice(a, b - a)
                if not asks[a]:
                    held.append(part)
                    continue
                if block is None and held:
                    block, held = Block(pa.concat_tables(held).combine_chunks()), []
                if block is not None:
                    for query_id, q in zip(part["vec_id"].to_pylist(), _matrix(part["x"]), strict=True):
                        got.extend(block.top(query_id, q, k))
            columns = list(zip(*got)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])
    return search


def top_k(quantised: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's ``k`` highest integer inner products, ties to smaller ids.

    Both inputs have ``(vec_id, x)``; a row that carries the query's own id is no candidate, of repeated query ids the
    least vector asks. Vectors of unequal length are compared as if padded with zeros. With no rows the result is empty.
    Components have any size of 64 bits; a score beyond 64 bits among the ``k`` highest of a block is an error.

    The index is staged once in blocks. A stated query set meets every block: a block's slices go to one task, or to as many as
    are needed to keep all cores busy, and the queries pass by it there, so a task holds one block whatever the table's size, the index moves
    once where there are as many blocks as cores, and nothing is broadcast or pruned. A query's own top k of each block is all that
    reaches the final ranking.
    """
    index, blocks = build_index(quantised)
    asked = queries.groupBy("vec_id").agg(F.min("x").alias("x"))
    cores = quantised.sparkSession.sparkContext.defaultParallelism
    lanes = min(parts_for(asked.count(), QUERIES_PER_UNIT), parts_for(cores, blocks))
    every = F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane")
    left = index.select("block", every, *index.columns[1:])
    right = asked.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.pmod(F.xxhash64("vec_id"), F.lit(lanes)).cast("int").alias("lane"), "vec_id", "x")
    met = left.unionByName(right, allowMissingColumns=True).repartition("block", "lane").sortWithinPartitions("block", "lane", F.col("vec_id").asc_nulls_first())
    hits = met.mapInArrow(_searcher(k), HIT_SCHEMA)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
