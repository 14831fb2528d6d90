"""Signature trees of corpora: digests by key prefix, so that versions are compared without reading what they share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.changes import corpus_signature

#: Hexadecimal digits of a key's hash that name its prefix: 16 ** WIDTH prefixes at most.
WIDTH = 2
TREE_DDL = "prefix STRING, digest STRING, n_keys BIGINT, path STRING"


def prefix_of(key: Column, width: int = WIDTH) -> Column:
    return F.substring(F.sha2(F.coalesce(key, F.lit("")), 256), 1, width)


def keys_of(records: DataFrame, key: str = "canonical", record_hash: str = "record_hash") -> DataFrame:
    """``(prefix, canonical, record_hash)`` of every record."""
    return records.select(prefix_of(F.col(key)).alias("prefix"), F.col(key).alias("canonical"), F.col(record_hash).alias("record_hash"))


def tree_of(keys: DataFrame) -> DataFrame:
    """``(prefix, digest, n_keys)``: equal multisets of (key, hash) below a prefix have equal digests.

    Digests are folded from pre-aggregated counts along the items' own hashes, so no task sees a prefix as a whole.
    """
    item = F.sha2(F.concat_ws("|", F.coalesce("canonical", F.lit("")), "record_hash"), 256)
    items = keys.select("prefix", item.alias("item"))
    return items.groupBy("prefix").agg(F.count(F.lit(1)).alias("n_keys")).join(
        corpus_signature(items, "prefix", record_hash="item").withColumnRenamed("corpus_signature", "digest"), "prefix").select("prefix", "digest", "n_keys")
