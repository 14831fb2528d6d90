"""Jump consistent hashing: shards for stable keys without a ring table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import stage

# Fixed values of the published generator: multiplier, and the powers of two it works with.
MULTIPLIER = "2862933555777941757BD"
WORD = "18446744073709551616BD"


def jump(key: Column, shards: int) -> Column:
    """Walk of a 64-bit key: ``(shard, next)``.

    ``shard`` is the key's place among ``shards`` shards; ``next`` is the shard count minus one at which
    it would move again, so a key moves on growth to ``n`` shards only if ``next < n``, and then into
    shard ``next``. The generator's unsigned 64-bit arithmetic is exact in decimals. A null key counts as 0.
    """
    unsigned = key.cast("decimal(20,0)")
    unsigned = F.coalesce(F.when(key < 0, unsigned + F.expr(WORD)).otherwise(unsigned), F.lit(0)).cast("decimal(20,0)")
    start = F.struct(unsigned.alias("key"), F.lit(-1).cast("bigint").alias("shard"), F.lit(0).cast("bigint").alias("next"))

    def step(walk: Column) -> Column:
        drawn = ((walk["key"] * F.expr(MULTIPLIER) + F.lit(1)) % F.expr(WORD)).cast("decimal(20,0)")
        high = F.floor(drawn / F.lit(1 << 33).cast("decimal(20,0)")).cast("double")
        ahead = F.floor((walk["next"] + 1).cast("double") * (F.lit(2147483648.0) / (high + 1.0))).cast("bigint")
        return F.struct(drawn.alias("key"), walk["next"].alias("shard"), ahead.alias("next"))

    # Each step moves ahead by one shard at least; about log(shards) steps are taken, the rest return at once.
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start,
                         lambda walk, _: F.when(walk["next"] < shards, step(walk)).otherwise(walk))
    return F.struct(walked["shard"].alias("shard"), walked["next"].alias("next"))


def shard_rows(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, size, text_crc32, shard, slot, grown_shard)`` of every row.

    Size is the text's UTF-8 bytes plus 16 (null text: 16, checksum 0). ``slot`` numbers a shard's rows from 0
    in key order; ``grown_shard`` is the shard after one more is appended. Repeated rows have a slot each; of a text only size and
    checksum count, however long it is; an empty table gives no rows; columns beside key and text are not read.

    A shard may hold any share of the rows, so no task numbers a whole shard: rows are cut into key ranges,
    each range is numbered on its own, and counts per (range, shard) give the offsets. Rows that agree in key,
    size and checksum are spread by a salt, so a repeated row can't fill one range.
    """
    walk = jump(F.col("key").cast("bigint"), shards)
    rows = (docs.select(F.col(key).alias("key"), (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("bigint").alias("size"),
                        F.coalesce(F.crc32(text), F.lit(0)).alias("text_crc32"),
                        (F.monotonically_increasing_id() % 1024).alias("salt"))
            .withColumn("walk", walk)
            .select("key", "size", "text_crc32", "salt", F.col("walk.shard").cast("int").alias("shard"),
                    F.when(F.col("walk.next") == shards, shards).otherwise(F.col("walk.shard")).cast("int").alias("grown_shard")))
    order = ["key", "size", "text_crc32", "salt"]
    ranged = stage(rows.repartitionByRange("shard", *order).withColumn("range", F.spark_partition_id()), "shard-ranges")
    before = (ranged.groupBy("shard", "range").count()
              .select("shard", "range", (F.sum("count").over(Window.partitionBy("shard").orderBy("range")) - F.col("count")).alias("before")))
    within = F.row_number().over(Window.partitionBy("shard", "range").orderBy(*order))
    return (ranged.withColumn("within", within).join(before, ["shard", "range"])
            .select(F.col("key").alias(key), "size", "text_crc32", "shard",
                    (F.col("before") + F.col("within") - 1).cast("bigint").alias("slot"), "grown_shard"))
