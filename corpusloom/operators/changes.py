"""Corpus signature, snapshot difference, versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import sha256_hex


def _digest(items: str) -> Column:
    """Hash of a group's strings in sorted order; no strings hash like the empty one."""
    return F.expr(sha256_hex(f"coalesce(listagg({items}, chr(10)) WITHIN GROUP (ORDER BY {items}), '')"))


def corpus_signature(hashed: DataFrame, *by: str, record_hash: str = "record_hash") -> DataFrame:
    """One signature per ``by`` group (or one in all): equal record multisets, equal signature.

    Equal hashes are counted first with map-side combining, so copies never pile
    up in one task. The distinct hashes are then folded along their hexadecimal
    prefix, 4 then 2 then 0 characters, so no task sees more than 1/65536 of them
    and the last steps see at most 256 rows per group.
    """
    keys = list(by)
    level = (hashed.groupBy(*keys, F.col(record_hash).alias("h")).agg(F.count(F.lit(1)).alias("n"))
             .select(*keys, F.substring("h", 1, 4).alias("p"), F.concat_ws(":", "h", F.col("n").cast("string")).alias("item")))
    for width in (2, 0):
        level = (level.groupBy(*keys, "p").agg(_digest("item").alias("d"))
                 .select(*keys, F.substring("p", 1, width).alias("p"), F.concat_ws(":", "p", "d").alias("item")))
    return level.groupBy(*keys).agg(_digest("item").alias("corpus_signature"))


def snapshot_diff(current: DataFrame, previous: DataFrame, key: str = "canonical",
                  record_hash: str = "record_hash") -> DataFrame:
    """``(key, status)`` with status added, removed, changed or same.

    Both sides are counted per (key, hash) and then compared per key; there is no
    join, so a key with many copies costs no more than its rows.
    """
    def side(df: DataFrame, cur: int) -> DataFrame:
        return df.select(F.col(key).alias(key), F.col(record_hash).alias("h"),
                         F.lit(cur).alias("cur"), F.lit(1 - cur).alias("prev"))

    counted = (side(current, 1).unionByName(side(previous, 0)).groupBy(key, "h")
               .agg(F.sum("cur").alias("cur"), F.sum("prev").alias("prev")))
    per_key = counted.groupBy(key).agg(
        F.sum("cur").alias("cur"), F.sum("prev").alias("prev"),
        F.bool_and(F.col("cur") == F.col("prev")).alias("equal"))
    return per_key.select(key, F.when(F.col("prev") == 0, "added").when(F.col("cur") == 0, "removed")
                          .when(F.col("equal"), "same").otherwise("changed").alias("status"))


def diff_counts(diff: DataFrame) -> DataFrame:
    return diff.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def latest_version(names: DataFrame, name: str = "name", pattern: str = r"^corpus_ver(\d+)\z") -> DataFrame:
    """Highest version number among the names that match, and its name; nulls when none does.

    A name that matches with a number beyond 64 bits is an error: left out, a lower version would pass for the latest.
    """
    version = F.expr("coalesce(try_cast(v as bigint), raise_error(concat('version number too large: ', path)))")
    found = names.select(F.col(name).alias("path"), F.regexp_extract(name, pattern, 1).alias("v")).where("v <> ''")
    numbered = found.select("path", version.alias("version"))
    return numbered.agg(F.max("version").alias("version"), F.max_by("path", "version").alias("path"))
