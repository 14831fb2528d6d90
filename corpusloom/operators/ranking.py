"""Positions in a global order, without a task that sees all rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import stage

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number within the partition below


def in_places(df: DataFrame, *order: Column, name: str = "place") -> DataFrame:
    """Stage the rows sorted by ``order`` over ranges, with a number that ascends in that order.

    Ranges are the parts of a number above 33 bits, and numbers within a range have no gaps. Rows equal in ``order`` keep one arbitrary
    order among themselves and may fall into different ranges, so no key is too frequent for a task.
    """
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    ranged = tied.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    return stage(ranged.withColumn(name, F.monotonically_increasing_id()), "ordered")


def numbered(df: DataFrame, *order: Column, by: tuple[str, ...] = (), position: str = "position",
             total: str | None = None) -> DataFrame:
    """Add the 0-based ``position`` of every row in ``order`` (nulls where the order puts them), counted per ``by`` group,
    and with ``total`` the size of its group.

    The position is a row's place within its range plus the rows of the group in earlier ranges, so a group of any size
    spreads over ranges and the only table that meets in one place has a row for each range and group.
    """
    keys = [F.col(c).asc_nulls_first() for c in by] + list(order)
    placed = in_places(df, *keys, name="_place")
    counted = (placed.groupBy(F.shiftright("_place", _ROW_BITS).alias("_range"), *[F.col(c).alias(f"_of_{c}") for c in by])
               .agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n")))
    group = [f"_of_{c}" for c in by]
    if by:
        earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        ranges = counted.withColumns({"_before": F.coalesce(F.sum("_n").over(earlier), F.lit(0)),
                                      "_total": F.sum("_n").over(Window.partitionBy(*group))})
    else:
        rows, seen = sorted(counted.collect(), key=lambda r: r["_range"]), 0  # one row per range
        known, every = [], sum(r["_n"] for r in rows)
        for r in rows:
            known.append((r["_range"], r["_first"], seen, every))
            seen += r["_n"]
        ranges = df.sparkSession.createDataFrame(known, "_range bigint, _first bigint, _before bigint, _total bigint")
    ranges = ranges.select("_range", *group, "_first", "_before", "_total")
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by],
                  F.shiftright(placed["_place"], _ROW_BITS) == F.col("_range"))
    found = placed.join(ranges, same)
    columns = [F.col(c) for c in df.columns] + [(F.col("_place") - F.col("_first") + F.col("_before")).alias(position)]
    return found.select(*columns, *([F.col("_total").alias(total)] if total else []))
