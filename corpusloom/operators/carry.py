"""Carry the latest marker forward along an ordered key, safe for keys of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import stage


def carry_forward(rows: DataFrame, key: str, order: str, marker: Column, name: str) -> DataFrame:
    """Add ``name``: the last non-null ``marker`` at or before each row of its key.

    The plain window over a key would put a hot key into one task. Rows are dealt by ranges of (key, order) instead,
    whatever the density of ``order``: the window runs inside a range, and one summary row per (range, key) takes part in
    the carry between ranges. Null keys are a key of their own.
    """
    staged = stage(rows.withColumn("_marker", marker).repartitionByRange(key, order)
                   .withColumn("_range", F.spark_partition_id()), "carry")
    inside = Window.partitionBy("_range", key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = staged.withColumn("_local", F.last("_marker", ignorenulls=True).over(inside))
    before = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    marked = F.when(F.col("_marker").isNotNull(), F.col(order))
    carried = (staged.groupBy(F.col(key).alias("_key"), F.col("_range").alias("_part")).agg(F.max_by(F.col("_marker"), marked).alias("_end"))
               .select("_key", "_part", F.last("_end", ignorenulls=True).over(before).alias("_carried")))
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_range") == F.col("_part"))
    return (local.join(carried, same, "left")
            .withColumn(name, F.coalesce("_local", "_carried"))
            .drop("_range", "_marker", "_local", "_key", "_part", "_carried"))
