"""Registry of this subpackage's queries, and small helpers its operators share."""

from __future__ import annotations

import ctypes
import gc
import math
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register ``fn`` under its own name, with the SQL that checks it if there is any."""
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        QUERIES[fn.__name__] = run
        if sql:
            ORACLES[fn.__name__] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts_for(amount: int, per_part: int) -> int:
    """Number of parts of about ``per_part`` that ``amount`` needs; one at least."""
    return max(1, math.ceil((amount or 0) / per_part))


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of a text column over all rows: one aggregated scan, one number."""
    return docs.agg(F.sum(F.octet_length(column))).first()[0] or 0


def give_back() -> None:
    """Return freed memory to the system: worker processes are used again, and would keep the most that any stage has taken."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # not every C library has it


def tidy(work: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``work`` on the batches of a task, giving its memory back at the end, that of objects which refer to each other too."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            gc.collect()  # else they stay beside those of the next task
            give_back()
    return run


def tidy_table(work: Callable[[pa.Table], pa.Table]) -> Callable:
    """``work`` on a group, likewise."""
    def run(table: pa.Table) -> pa.Table:
        out = work(table)
        give_back()
        return out
    return run


def tidy_pair(work: Callable[[pa.Table, pa.Table], pa.Table]) -> Callable:
    """``work`` on two groups that meet, likewise."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = work(left, right)
        give_back()
        return out
    return run
