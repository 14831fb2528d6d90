"""Merkle manifest of a dataset: each level of an aligned block is one hex string, hashed and cut by fixed-width substrings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.ranking import numbered
from corpusloom.session import stage

ARITY, DIGEST = 3, 64
#: Levels a block climbs, so a block has ARITY ** CLIMB nodes at most: about 47 kB of hex at its lowest level.
CLIMB = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _hash(value: Column) -> Column:
    """Digest as hex bytes; binary strings are cut by position without counting characters."""
    return F.sha2(value, 256).cast("binary")


def leaf_of(*values: Column) -> Column:
    """Digest of values in order: ``-`` for null, else byte count, colon, value."""
    texts = [v.cast("string") for v in values]
    return _hash(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def _parents(level: Column) -> Column:
    """The next level: each run of ARITY digests, the last run perhaps of fewer, becomes its digest."""
    run = ARITY * DIGEST
    runs = F.sequence(F.lit(0), F.ceil(F.octet_length(level) / F.lit(run)).cast("int") - 1)
    return F.array_join(F.transform(runs, lambda i: F.sha2(F.substring(level, i * run + 1, F.lit(run)), 256)), "").cast("binary")


def _blocks(nodes: DataFrame, *keep: str) -> DataFrame:
    """``(grp, block, n, members, levels)`` of ``nodes(grp, pos, n, node, *keep)``, n being the nodes of the whole group.

    A block of a group that goes beyond it climbs all CLIMB levels, also where one node is left; a block that is its whole group
    stops at one node. ``levels`` begins with the nodes themselves and ends with the one node the block is reduced to.
    """
    wide = ARITY ** CLIMB
    block = F.floor(F.col("pos") / wide)
    member = F.struct((F.col("pos") - block * wide).cast("int").alias("slot"), "node", *keep)
    gathered = (nodes.groupBy("grp", block.alias("block")).agg(F.array_sort(F.collect_list(member)).alias("members"), F.first("n").alias("n")))
    lowest = F.array_join(F.transform("members", lambda m: m["node"].cast("string")), "").cast("binary")

    def climb(levels: Column, _: Column) -> Column:
        top = F.element_at(levels, -1)
        return F.when((F.col("n") > wide) | (F.octet_length(top) > DIGEST), F.concat(levels, F.array(_parents(top)))).otherwise(levels)
    levels = F.aggregate(F.sequence(F.lit(1), F.lit(CLIMB)), F.array(F.col("lowest")), climb)
    return gathered.withColumn("lowest", lowest).select("grp", "block", "n", "members", levels.alias("levels"))


def _siblings(levels: Column, slot: Column) -> Column:
    """Per level climbed, the digests left and right of the node above ``slot`` within its run."""
    def at(level: Column, height: Column) -> Column:
        place = F.floor(slot / F.pow(F.lit(float(ARITY)), height)).cast("int")
        nth = place % ARITY
        return F.struct(F.substring(level, (place - nth) * DIGEST + 1, nth * DIGEST).alias("left"),
                        F.substring(level, (place + 1) * DIGEST + 1, (ARITY - 1 - nth) * DIGEST).alias("right"))
    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), at)


def _fold(node: Column, path: Column) -> Column:
    return F.aggregate(path, node, lambda known, s: _hash(F.concat(s["left"], known, s["right"])))


class Tree:
    """Trees of the groups of ``nodes(grp, pos, n, node, *keep)``: staged blocks height by height, the last with one block a group."""

    def __init__(self, nodes: DataFrame, *keep: str) -> None:
        self.heights: list[DataFrame] = []
        while True:
            blocks = stage(_blocks(nodes, *(keep if not self.heights else ())), "merkle-blocks")
            self.heights.append(blocks)
            if (blocks.agg(F.max("n")).first()[0] or 0) <= ARITY ** CLIMB:
                break
            nodes = blocks.select("grp", F.col("block").alias("pos"), F.ceil(F.col("n") / ARITY ** CLIMB).alias("n"), F.element_at("levels", -1).alias("node"))

    def roots(self) -> DataFrame:
        return self.heights[-1].select("grp", F.element_at("levels", -1).alias("root"))

    def members(self, above: DataFrame, *keep: str) -> DataFrame:
        """``(grp, pos, path, *keep, and the other columns of above)`` of every lowest node.

        ``above(grp, path, ...)`` is what lies over each group's root; blocks are joined with their own path before their members
        are laid out, so a node is copied once and no block string is copied to its members.
        """
        extra = [c for c in above.columns if c not in ("grp", "path")]
        paths = above.withColumn("block", F.lit(0).cast("bigint")).withColumnRenamed("path", "over")
        for height, blocks in reversed(list(enumerate(self.heights))):
            # the top has one block a group, so every node of it meets one path
            found = blocks.join(paths, ["grp", "block"])
            laid = F.transform("members", lambda m: F.struct(
                (F.col("block") * ARITY ** CLIMB + m["slot"]).alias("pos"), F.concat(_siblings(F.col("levels"), m["slot"]), F.col("over")).alias("path"),
                *[m[c].alias(c) for c in (("node", *keep) if not height else ())]))
            nodes = found.select("grp", *extra, F.explode_outer(laid).alias("m")).select("grp", *extra, "m.*").filter(F.col("pos").isNotNull())
            paths = nodes.withColumnRenamed("pos", "block").withColumnRenamed("path", "over")
        return nodes


EMPTY_PATH = "cast(array() as array<struct<left:binary,right:binary>>)"


def merkle_manifest(docs: DataFrame, tampered: Column | None = None, doc_id: str = "doc_id", source: str = "source",
                    fields: tuple[str, ...] = FIELDS, text: str = "text") -> DataFrame:
    """``(doc_id, leaf, subroot, root, path, folded_root)`` of every row.

    A row's leaf is the digest of its ``fields``; leaves of a source ascend by id (null ids first, equal ids by leaf) and are
    reduced by runs of three to its subroot, subroots in order of source (null first, bytewise) to the root. ``path`` lists, level by
    level, the digests left and right of the node; ``folded_root`` is recomputed along it from the leaf of the row with
    ``tampered`` in place of its text (as it is where that is null or not given). Repeated rows are leaves of their own; null and
    empty texts differ; other columns are not read; an empty table gives no rows.

    Ids are sorted by ranges and numbered from counts per range, so a source of any size spreads over tasks; what one task holds is a
    block of 729 nodes at any corpus size, and each height has a 729th of the rows of the one below.
    """
    of = [F.col(c) for c in fields]
    changed = F.when(tampered.isNotNull() & (tampered != F.col(text)), leaf_of(*[tampered if c == text else F.col(c) for c in fields])) if tampered is not None else F.lit(None).cast("binary")
    grp = F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit(""))
    leaves = stage(docs.select(F.col(doc_id).alias("id"), grp.alias("grp"), leaf_of(*of).alias("node"), changed.alias("other")), "leaves")
    placed = numbered(leaves, F.col("id").asc_nulls_first(), F.col("node"), by=("grp",), position="pos", total="n")
    tree = Tree(placed, "id", "other")
    subroots = tree.roots().toDF("source", "node")
    top = Tree(numbered(subroots.withColumn("grp", F.lit("")), F.col("source"), by=("grp",), position="pos", total="n"), "source")
    root = top.roots().select("grp", F.expr(EMPTY_PATH).alias("path"), "root")
    above = stage(top.members(root, "source").select(F.col("source").alias("grp"), "path", "root", F.col("node").alias("subroot")), "subroots")
    rows = tree.members(above, "id", "other")
    return rows.select(F.col("id").alias(doc_id), F.col("node").cast("string").alias("leaf"), F.col("subroot").cast("string").alias("subroot"),
                       F.col("root").cast("string").alias("root"), "path",
                       _fold(F.coalesce("other", "node"), F.col("path")).cast("string").alias("folded_root"))


def proof(path: Column) -> Column:
    """Digest of the siblings along a path, left to right, level by level."""
    return F.sha2(F.aggregate(path, F.lit("").cast("binary"), lambda known, s: F.concat(known, s["left"], s["right"])), 256)
