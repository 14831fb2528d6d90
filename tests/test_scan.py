"""Tables that feed the page parser: tasks of bounded size, whatever the files' splits hold."""

import math

import pytest
from pyspark.sql import functions as F

from corpusloom.catalog import queries


@pytest.fixture
def small_tasks(monkeypatch):
    monkeypatch.setattr(queries, "SPLIT_ROWS", 400, raising=False)
    monkeypatch.setattr(queries, "TASK_ROWS", 100, raising=False)


def orders(spark, folder, rows, files=1):
    """Orders with repeated keys and nulls, in files of one row group each."""
    day = F.to_timestamp(F.lit("1996-01-02"))
    (spark.range(0, rows, 1, files).select(
        F.when(F.col("id") % 50 != 0, F.col("id") % 1999).alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"),
        F.when(F.col("id") % 11 != 0, "O").alias("o_orderstatus"), day.alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"))
     .write.parquet(f"{folder}/orders.parquet"))
    return str(folder)


def task_rows(df):
    return [r[0] for r in df.groupBy(F.spark_partition_id()).count().select("count").collect()]


@pytest.mark.parametrize("files", [1, 16])
def test_tasks_do_not_grow_with_the_table(spark, tmp_path, small_tasks, files):
    longest = []
    for rows in (5_000, 20_000):
        read = queries.scan(spark, orders(spark, tmp_path / str(rows), rows, files), "orders")
        held = task_rows(read)
        assert sum(held) == rows and len(held) >= math.ceil(rows / 400)
        longest.append(max(held))
    assert max(longest) <= 400


def test_small_splits_stay_as_they_are(spark, tmp_path):
    folder = orders(spark, tmp_path, 4_000, 16)
    read = queries.scan(spark, folder, "orders")
    assert read.rdd.getNumPartitions() == queries.table(spark, folder, "orders").rdd.getNumPartitions()


def test_dealing_keeps_all_rows(spark, tmp_path, small_tasks):
    folder = orders(spark, tmp_path, 3_000)
    read, plain = queries.scan(spark, folder, "orders"), queries.table(spark, folder, "orders")
    assert read.exceptAll(plain).isEmpty() and plain.exceptAll(read).isEmpty()


def test_an_empty_table_has_no_rows(spark, tmp_path):
    assert queries.scan(spark, orders(spark, tmp_path, 0), "orders").count() == 0


@pytest.mark.parametrize("name", ["head_meta", "table_cells", "page_dates"])
def test_queries_over_orders_parse_in_bounded_tasks(spark, tmp_path, small_tasks, name):
    read = queries.QUERIES[name](spark, orders(spark, tmp_path, 20_000))
    assert read.rdd.getNumPartitions() >= 200
