"""Near duplicates: consistent weighted sampling over TF-IDF shingles, banded, verified by weighted Jaccard."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import stage

from .common import tidy
from .components import components
from .words import MIX, STEP, Lookup, Words, of_strings, slices

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 10, 3
#: A shingle in at least this share of all documents has its own weight; rarer ones share the weight of that share.
COMMON = 1 / 500
#: Pairs of a bucket whose signatures agree in a smaller share are not verified: at similarity 0.8 the share is below this
#: with probability 1e-4.
LIKELY = 0.5
BLOCK = 512


# --- shingle vectors -------------------------------------------------------------------------------------------------

def shingle_bags(words: Words, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes text by text (ascending within a text), their counts, and where each text's begin.

    A text of fewer words than a shingle, but not none, is one shingle of all its words.
    """
    n_words = np.bincount(words.text, minlength=texts)
    first = np.cumsum(n_words) - n_words
    hashes, _ = words.rolled(SHINGLE)
    kept, counts, sizes = [], [], np.zeros(texts, np.int64)
    for i, (a, n) in enumerate(zip(first.tolist(), n_words.tolist(), strict=True)):
        if n == 0:
            continue
        if n >= SHINGLE:
            own = np.sort(hashes[a:a + n - SHINGLE + 1])
        else:
            with np.errstate(over="ignore"):
                value = np.uint64(n)
                for h in words.hash[a:a + n]:
                    value = value * np.uint64(0x9E3779B97F4A7C15) + h
            own = np.array([value], np.uint64)
        edge = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        kept.append(own[edge])
        counts.append(np.diff(np.r_[edge, len(own)]))
        sizes[i] = len(edge)
    starts = np.cumsum(sizes) - sizes
    if not kept:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.r_[starts, 0]
    return np.concatenate(kept), np.concatenate(counts), np.r_[starts, sizes.sum()]


class Weights:
    """TF-IDF of shingles: sublinear counts times a damped idf.

    idf = L / (L + 1/2) with L = ln(1 + N / df). Damping keeps shingles of a large group of copies near full weight,
    while those in a tenth of the corpus or more clearly lose some.
    """

    def __init__(self, hashes: np.ndarray, df: np.ndarray, total: int, least: int) -> None:
        self.lookup = Lookup(hashes)
        self.idf = self._idf(df[np.argsort(hashes)], total)
        self.rare = self._idf(np.array([max(1, least)]), total)[0]

    @staticmethod
    def _idf(df: np.ndarray, total: int) -> np.ndarray:
        log = np.log1p(max(1, total) / df)
        return (log / (log + 0.5)).astype(np.float32)

    def of(self, hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        idf = np.full(len(hashes), self.rare, np.float32)
        at, slot = self.lookup.find(hashes, np.ones(len(hashes), bool))
        idf[at] = self.idf[slot]
        return idf * (1 + np.log(counts.astype(np.float32)))


# --- document frequencies of common shingles ---------------------------------------------------------------------------

SLICES = 64  # a histogram travels in so many parts


def _cells(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two cells of each shingle, in histograms of ``2 ** bits``."""
    shift = np.uint64(64 - bits)
    return (hashes * MIX) >> shift, (((hashes ^ (hashes >> np.uint64(32))) * STEP) ^ hashes) * MIX >> shift


def _bags(batches: Iterable[pa.RecordBatch], size: int = 1_000_000) -> Iterator[np.ndarray]:
    """Shingles of texts, each once a text, some texts at a time."""
    pending, n = [], 0
    for rows, words in slices(batches):
        pending.append(shingle_bags(words, rows.num_rows)[0])
        n += len(pending[-1])
        if n >= size:
            yield np.concatenate(pending)
            pending, n = [], 0
    if n:
        yield np.concatenate(pending)


def _histogram(bits: int) -> Callable:
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Two histograms of the task's shingles, of fixed size however many documents it has."""
        sums = np.zeros((2, 1 << bits), np.uint32)
        for own in _bags(batches):
            for held, cells in zip(sums, _cells(own, bits), strict=True):
                held += np.bincount(cells.astype(np.int64), minlength=1 << bits).astype(np.uint32)
        if sums.any():
            parts = [p.astype(np.uint8 if p.max() < 256 else np.uint16 if p.max() < 65_536 else np.uint32) for p in sums.reshape(2 * SLICES, -1)]
            yield pa.RecordBatch.from_arrays([pa.array(range(2 * SLICES), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], ["part", "counts"])
    return count


def _summed(bits: int, least: int) -> Callable:
    def total(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per part a bit for each cell that reaches ``least`` in the sum."""
        sums: dict[int, np.ndarray] = {}
        size = (1 << bits) // SLICES
        for batch in batches:
            for part, counts in zip(batch["part"].to_pylist(), batch["counts"], strict=True):
                data = counts.as_buffer()
                held = np.frombuffer(data, {1: np.uint8, 2: np.uint16, 4: np.uint32}[len(data) // size])
                sums[part] = sums.get(part, np.zeros(size, np.int64)) + held
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([np.packbits(s >= least).tobytes() for s in sums.values()], pa.binary())], ["part", "high"])
    return total


def _counter(high: np.ndarray, bits: int) -> Callable:
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Exact counts of the task's shingles with both cells high."""
        seen, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for own in _bags(batches):
            one, two = (row[cells.astype(np.int64)] for row, cells in zip(high, _cells(own, bits), strict=True))
            found, n = np.unique(own[one & two], return_counts=True)
            seen, place = np.unique(np.concatenate([seen, found]), return_inverse=True)
            counts = np.bincount(place, np.concatenate([counts, n]), len(seen)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(seen.view(np.int64)), pa.array(counts)], ["hash", "n"])
    return count


def fit_weights(texts: DataFrame, common: float = COMMON) -> Weights:
    """Weights from exact document frequencies over all rows.

    Frequencies sum to the number of shingles, so at most (shingles per document) / ``common`` shingles reach ``common``, at any
    corpus size: that table is collected and travels to the tasks. It is found in two passes. The first adds each shingle to
    two histograms, whose cells are many enough that an average one stays at an eighth of ``common``; tasks put out these and nothing else, so neither
    their memory nor their rows depend on how documents are dealt. A cell is never below the count of a shingle in it, so the second
    pass counts exactly those with both cells high, and misses none.
    """
    size = texts.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    total, least = size[0], max(2, int(np.ceil(common * size[0])))
    empty = Weights(np.zeros(0, np.uint64), np.zeros(0, np.int64), total, least)
    per_text = (size[1] or 0) / 6 / max(1, total)  # about six bytes a word
    bits = min(26, max(14, int(np.ceil(np.log2(max(1.0, 8 * per_text / common))))))
    parts = texts.mapInArrow(tidy(_histogram(bits)), "part int, counts binary").repartition("part")
    rows = parts.mapInArrow(tidy(_summed(bits, least)), "part int, high binary").collect()  # a bit for each cell
    if not rows:
        return empty
    high = np.zeros((2 * SLICES, (1 << bits) // SLICES), bool)
    for r in rows:
        high[r["part"]] = np.unpackbits(np.frombuffer(r["high"], np.uint8)).astype(bool)
    exact = texts.mapInArrow(tidy(_counter(high.reshape(2, -1), bits)), "hash bigint, n bigint").groupBy("hash").agg(F.sum("n").alias("n"))
    table = exact.filter(F.col("n") >= least).toArrow()
    return Weights(table["hash"].to_numpy().view(np.uint64), table["n"].to_numpy(), total, least) if table.num_rows else empty


# --- signatures --------------------------------------------------------------------------------------------------------

def _mixed(x: np.ndarray, odd: int, add: int) -> np.ndarray:
    y = x * np.uint64(odd) + np.uint64(add)
    y ^= y >> np.uint64(32)
    y *= np.uint64(0xD6E8FEB86659FD93)
    y ^= y >> np.uint64(29)
    return y


def samples(hashes: np.ndarray, weights: np.ndarray, starts: np.ndarray, count: int = BANDS * ROWS) -> np.ndarray:
    """Improved consistent weighted samples, one row of ``count`` per text with shingles.

    For element h of weight w: r, c ~ Gamma(2, 1) and b ~ U(0, 1) are functions of (h, k); t = floor(ln w / r + b);
    ln a = ln c - r (t - b + 1). The sample is the (h, t) of least a: two texts share it with the probability of
    their weighted Jaccard similarity.
    """
    log_w = np.log(weights)
    out = np.zeros((len(starts), count), np.uint32)
    for k in range(count):
        x = _mixed(hashes, 0x9E3779B97F4A7C15 + 2 * k * 0x632BE59BD9B4E019 & (1 << 64) - 1 | 1, 0xA0761D6478BD642F * (k + 1) & (1 << 64) - 1)
        y = _mixed(x, 0xE7037ED1A0B428DB, k)
        scale, half = np.float32(2.0 ** -21), np.float32(2.0 ** -22)

        def uniform(bits: np.ndarray, shift: int, scale: np.float32 = scale, half: np.float32 = half) -> np.ndarray:
            return ((bits >> np.uint64(shift)) & np.uint64(0x1FFFFF)).astype(np.float32) * scale + half

        r = -np.log(uniform(x, 0) * uniform(x, 21))
        b = uniform(x, 42)
        c = -np.log(uniform(y, 0) * uniform(y, 21))
        t = np.floor(log_w / r + b)
        log_a = np.log(c) - r * (t - b + np.float32(1))
        mark = (_mixed(hashes + t.astype(np.int64).view(np.uint64), 0x8CB92BA72F3D8DD7, k) >> np.uint64(32))
        # ln a lies well above -512, so adding that makes float bits sort as integers; the mark breaks ties.
        order = (np.maximum(log_a, np.float32(-500)) + np.float32(512)).view(np.uint32).astype(np.uint64)
        out[:, k] = (np.minimum.reduceat((order << np.uint64(32)) | mark, starts) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return out


def _signer(weights: Weights) -> Callable:
    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, words in slices(batches):
            hashes, counts, starts = shingle_bags(words, rows.num_rows)
            filled = np.flatnonzero(np.diff(starts) > 0)
            signed: list[bytes | None] = [None] * rows.num_rows
            bands: list[list[int]] = [[] for _ in range(rows.num_rows)]
            if len(filled):
                got = samples(hashes, weights.of(hashes, counts), starts[filled])
                keys = np.zeros((len(filled), BANDS), np.uint64)
                for band in range(BANDS):
                    key = np.full(len(filled), band + 1, np.uint64)
                    for column in got[:, band * ROWS:(band + 1) * ROWS].T:
                        key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64), 0xD6E8FEB86659FD93, band)
                    keys[:, band] = key
                for i, own, key in zip(filled.tolist(), got, keys.view(np.int64).tolist(), strict=True):
                    signed[i], bands[i] = own.tobytes(), key
            yield pa.RecordBatch.from_arrays([rows["node"], rows["doc_id"], pa.array(signed, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                                             ["node", "doc_id", "signature", "bands"])
    return sign


# --- verification ------------------------------------------------------------------------------------------------------

def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two (ascending distinct hashes, weights)."""
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    both = b[0][at] == a[0]
    shared = float(np.minimum(a[1][both], b[1][at[both]]).sum(dtype=np.float64))
    return shared / (float(a[1].sum(dtype=np.float64)) + float(b[1].sum(dtype=np.float64)) - shared)


def vector_of(text: str, weights: Weights) -> tuple[np.ndarray, np.ndarray]:
    hashes, counts, _ = shingle_bags(of_strings([text]), 1)
    return hashes, weights.of(hashes, counts)


def _verifier(weights: Weights, threshold: float) -> Callable:
    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple] = {}  # a hub's vector serves many rows

        def vector(node: str, text: pa.StringScalar) -> tuple:
            if node not in held:
                if len(held) >= 64:
                    held.clear()
                held[node] = vector_of(text.as_py() or "", weights)
            return held[node]

        for batch in batches:
            pairs = zip(batch["a"].to_pylist(), batch["b"].to_pylist(), batch["left"], batch["right"], strict=True)
            good = pa.array([weighted_jaccard(vector(a, left), vector(b, right)) >= threshold for a, b, left, right in pairs], pa.bool_())
            yield pa.RecordBatch.from_arrays([c.filter(good) for c in (batch["a"], batch["b"])], ["a", "b"])
    return verify


def agreement(left: Column, right: Column) -> Column:
    """Share of equal samples of two signatures (hex strings of eight digits a sample)."""
    n = BANDS * ROWS
    at = F.sequence(F.lit(0), F.lit(n - 1))
    same = F.filter(at, lambda i: F.substring(left, i * 8 + 1, F.lit(8)) == F.substring(right, i * 8 + 1, F.lit(8)))
    return F.size(same) / n


# --- candidates of buckets that hub links left in several components ----------------------------------------------------

def _by_part(work: Callable) -> Callable:
    """``work`` on each run of rows with equal ``part``; rows come sorted by it, runs may span batches."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None
        for batch in _with_end(batches):
            if batch is not None:
                new = pa.Table.from_batches([batch])
                kept = new if kept is None else pa.concat_tables([kept, new])
            if kept is None or not kept.num_rows:
                continue
            parts = kept["part"].to_numpy()
            cuts = np.flatnonzero(np.r_[True, parts[1:] != parts[:-1]])
            ends = np.r_[cuts[1:], len(parts)]
            whole = len(cuts) - (batch is not None)  # the last run may go on in the next batch
            out = [work(kept.slice(a, b - a)) for a, b in zip(cuts[:whole].tolist(), ends[:whole].tolist(), strict=True) if b - a > 1]
            out = [t for t in out if t.num_rows]
            if out:
                yield from pa.concat_tables(out).combine_chunks().to_batches()
            kept = kept.slice(int(cuts[-1])) if batch is not None else None
    return run


def _sides(part: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Signatures, component numbers, and the two sides that meet: two blocks, or one block with itself."""
    signs = np.frombuffer(b"".join(part["signature"].to_pylist()), np.uint32).reshape(part.num_rows, -1)
    labels = np.unique(part["label"].to_numpy(zero_copy_only=False).astype(str), return_inverse=True)[1]
    side = part["side"].to_numpy()
    return signs, labels, np.flatnonzero(side == 0), np.flatnonzero(side == 1) if (side == 1).any() else np.flatnonzero(side == 0)


def _hopeful(part: pa.Table) -> pa.Table:
    """The rows with a likely partner in another component."""
    signs, labels, one, two = _sides(part)
    kept = np.zeros(part.num_rows, bool)
    for i in one.tolist():
        likely = two[((signs[two] == signs[i]).mean(axis=1) >= LIKELY) & (labels[two] != labels[i])]
        kept[likely] = True
        kept[i] |= len(likely) > 0
    return part.filter(pa.array(kept))


def _linker(weights: Weights, threshold: float) -> Callable:
    def link(part: pa.Table) -> pa.Table:
        """Verified links of a part, as many as join its components; likely pairs of one component need no look."""
        signs, labels, one, two = _sides(part)
        vectors = [vector_of(t.as_py() or "", weights) for t in part["text"]]
        starts = np.cumsum([0, *(len(h) for h, _ in vectors)])
        known, place = np.unique(np.concatenate([h for h, _ in vectors]), return_inverse=True)
        weight = np.concatenate([w for _, w in vectors]).astype(np.float64)
        total = np.array([w.sum(dtype=np.float64) for _, w in vectors])
        dense, nodes, out = np.zeros(len(known)), part["node"].to_pylist(), []
        for i in one.tolist():
            others = two[((signs[two] == signs[i]).mean(axis=1) >= LIKELY) & (labels[two] != labels[i])]
            sizes = starts[others + 1] - starts[others]
            if not len(others) or not sizes.all():
                others, sizes = others[sizes > 0], sizes[sizes > 0]
                if not len(others):
                    continue
            own = slice(starts[i], starts[i + 1])
            dense[place[own]] = weight[own]
            first = np.cumsum(sizes) - sizes
            at = np.repeat(starts[others] - first, sizes) + np.arange(sizes.sum())
            shared = np.add.reduceat(np.minimum(dense[place[at]], weight[at]), first)
            dense[place[own]] = 0
            for j in others[shared >= threshold * (total[i] + total[others] - shared)].tolist():
                if labels[j] != labels[i]:
                    out.append((min(nodes[i], nodes[j]), max(nodes[i], nodes[j])))
                    labels[labels == labels[j]] = labels[i]
        return pa.table([pa.array(c, pa.string()) for c in (zip(*out) if out else ([], []))], names=["a", "b"])
    return link


def _with_end(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def unsettled_links(members: DataFrame, texts: DataFrame, weights: Weights, threshold: float) -> DataFrame:
    """Verified links ``(a, b)`` between components of ``members(bucket, node, label, signature)``.

    Buckets of one component are done. The rest is cut into blocks: a component of many members into blocks of its own, by
    node, and all small components together, by component; a block meets every other block of its bucket but those of the same
    component. A task holds two blocks whatever the bucket's size. Rows without a likely partner leave before texts are
    joined; pairs are found and verified where both texts are, and only links that join components come out, so no
    pair is ever a row.
    """
    of_label = members.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    small = F.when(F.col("n") < BLOCK, F.col("n"))
    of_bucket = of_label.groupBy("bucket").agg(F.count("*").alias("labels"), F.coalesce(F.sum(small), F.lit(0)).alias("small")).filter(F.col("labels") > 1)
    sized = of_label.join(of_bucket, "bucket").withColumn("own", F.col("n") >= BLOCK)
    cuts = F.ceil(F.when(F.col("own"), F.col("n")).otherwise(F.col("small")) / F.lit(BLOCK)).cast("int")
    sized = stage(sized.select("bucket", "label", F.when(F.col("own"), F.col("label")).otherwise("").alias("kind"), cuts.alias("cuts")), "bucket-sizes")
    number = F.pmod(F.when(F.col("kind") == "", F.xxhash64("label")).otherwise(F.xxhash64("node")), F.col("cuts")).cast("int")
    placed = members.join(sized, ["bucket", "label"]).withColumn("block", F.struct("kind", number.alias("number"))).select("bucket", "node", "label", "signature", "block")
    blocks = (sized.groupBy("bucket", "kind").agg(F.max("cuts").alias("cuts"))
              .select("bucket", F.explode(F.transform(F.sequence(F.lit(0), F.col("cuts") - 1), lambda i: F.struct(F.col("kind").alias("kind"), i.alias("number")))).alias("block")))
    meet = blocks.toDF("bucket", "first").join(blocks.toDF("bucket", "second"), "bucket").filter(
        (F.col("first") <= F.col("second")) & ((F.col("first.kind") == "") | (F.col("first.kind") != F.col("second.kind"))))
    part = F.xxhash64("bucket", "first", "second").alias("part")
    left = placed.withColumnRenamed("block", "first").join(meet, ["bucket", "first"]).select(part, F.lit(0).alias("side"), "node", "label", "signature")
    right = (placed.withColumnRenamed("block", "second").join(meet.filter(F.col("first") != F.col("second")), ["bucket", "second"])
             .select(part, F.lit(1).alias("side"), "node", "label", "signature"))
    fields = "part bigint, side int, node string, label string, signature binary"
    dealt = left.unionByName(right).repartition("part").sortWithinPartitions("part", "side", "node")
    hopeful = stage(dealt.mapInArrow(tidy(_by_part(_hopeful)), fields), "hopeful")
    with_texts = hopeful.join(texts, "node").select("part", "side", "node", "label", "signature", "text")
    met = with_texts.repartition("part").sortWithinPartitions("part", "side", "node")
    return met.mapInArrow(tidy(_by_part(_linker(weights, threshold))), "a string, b string").distinct()


def _id() -> Column:
    return F.coalesce("doc_id", F.lit(-(1 << 63)))


# --- the whole ---------------------------------------------------------------------------------------------------------

def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, node, class_id, class_node, copies, linked)`` for every row; nodes are digests of texts.

    ``class_id`` and ``class_node`` are the smallest doc_id of the row's class and its text: rows of equal text, and texts chained by verified links of at
    least ``threshold``. ``copies`` counts the rows of the same text, ``linked`` tells whether the text has a link to another.
    Texts are compared by runs of letters and digits, lower-cased; texts without any, empty and null ones match equal texts
    only (null counts as empty). Rows with a null id are classed too; a class without ids has the class id null. Repeated
    rows are copies; an empty table gives no rows; other columns are not read.

    Copies are reduced to one node each before any bucket is formed. Every node is held against two hubs, the nodes of
    its buckets that meet most others; likely pairs of a bucket that this leaves in different components are verified after it, block
    by block, so no likely pair goes unverified unless its texts are in one class already.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    weights = fit_weights(rows.select("text"))
    signed = stage(rows.withColumn("node", F.md5("text")).mapInArrow(tidy(_signer(weights)), "node string, doc_id bigint, signature binary, bands array<bigint>"), "signatures")
    nodes = stage(signed.groupBy("node").agg(F.count("*").alias("copies"), F.min(_id()).alias("one"), F.first("signature").alias("signature"), F.first("bands").alias("bands")), "nodes")
    spread = nodes.select("node", F.explode("bands").alias("bucket"))
    sizes = spread.groupBy("bucket").agg(F.count("*").alias("size")).filter(F.col("size") > 1)
    members = stage(spread.join(sizes, "bucket"), "members")
    met = members.groupBy("node").agg(F.sum("size").alias("met"))
    hubs = members.join(met, "node").groupBy("bucket").agg(F.min(F.struct(-F.col("met"), "node")).alias("hub"))
    # Of the hubs of its ten buckets a node is held against the two that meet most others.
    offered = members.join(hubs, "bucket").filter(F.col("node") != F.col("hub.node")).groupBy("node").agg(F.collect_set("hub").alias("hubs"))
    pairs = (offered.select("node", F.explode(F.slice(F.array_sort("hubs"), 1, 2)).alias("hub"))
             .select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b")).distinct())
    signs = nodes.select("node", F.hex("signature").alias("s"))
    likely = (pairs.join(signs.toDF("a", "sa"), "a").join(signs.toDF("b", "sb"), "b")
              .filter(agreement(F.col("sa"), F.col("sb")) >= LIKELY).select("a", "b"))
    # One row's text of each candidate node: joined by row and node, so copies of one text spread over tasks.
    wanted = members.select("node").distinct().join(nodes.select("node", "one"), "node")
    texts = stage(rows.select(F.md5("text").alias("node"), _id().alias("one"), "text").join(wanted, ["node", "one"], "left_semi")
                  .groupBy("node").agg(F.first("text").alias("text")), "texts")

    def verified(likely: DataFrame) -> DataFrame:
        with_texts = (likely.join(texts.toDF("a", "left"), "a").join(texts.toDF("b", "right"), "b").select("a", "b", "left", "right"))
        return with_texts.mapInArrow(tidy(_verifier(weights, threshold)), "a string, b string")

    links = stage(verified(likely), "links")
    labels = components(links)
    labelled = (members.select("bucket", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
                .join(nodes.select("node", "signature"), "node"))
    links = links.unionByName(stage(unsettled_links(labelled, texts, weights, threshold), "links"))
    labels = components(links)
    classed = signed.select("node", "doc_id").join(labels, "node", "left").withColumn("linked", F.col("label").isNotNull())
    classed = classed.withColumn("label", F.coalesce("label", "node"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "node"))  # rows without an id come last
    least = classed.groupBy("label").agg(first.alias("first")).select("label", F.col("first.doc_id").alias("class_id"), F.col("first.node").alias("class_node"))
    least = stage(least, "classes")  # so that the join below reads rows only, and Spark can split a large class
    return (classed.join(least, "label").join(nodes.select("node", "copies"), "node")
            .select(F.col("doc_id").alias(doc_id), "node", "class_id", "class_node", "copies", "linked"))
