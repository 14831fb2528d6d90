import re

import pytest
from pyspark.sql import functions as F

from corpusloom.sources.fetched import FETCHED, FetchStore, fetched_pages


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def results(spark):
    """Repeated fetches, one URL with a third of them, failures, null bodies and URLs."""
    rows = [(f"https://a/{i % 50}", f"https://a/{i % 50}?x", 200 if i % 7 else 404, f"<p>{i}</p>" if i % 5 else None) for i in range(200)]
    rows += [("https://hot/", "https://hot/", 200, f"<p>{i % 3}</p>") for i in range(100)] + [(None, None, 200, "x")]
    return spark.createDataFrame(rows, FETCHED)


def frontier(spark):
    return spark.createDataFrame([("https://a/1",), ("https://a/1",), ("https://hot/",), ("https://never/",), ("https://a/49",)], "url string")


def pages_plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def exchanged(plan):
    """Columns that go through the exchanges of a formatted plan."""
    return [m[1] for m in re.finditer(r"\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", plan)]


def rows_of(df):
    return sorted(map(tuple, df.select("requested_url", "final_url", "status", "html").collect()), key=repr)


def test_store_gives_what_a_join_gives(spark, tmp_path, no_broadcast):
    store = FetchStore.create(results(spark), str(tmp_path / "store"), buckets=8)
    want = rows_of(fetched_pages(results(spark), frontier(spark)))
    assert rows_of(store.pages(frontier(spark))) == want
    again = FetchStore.open(spark, str(tmp_path / "store"))
    assert (again.buckets, again.parts) == (8, 4)
    assert rows_of(again.pages(frontier(spark))) == want
    assert again.results().count() == 301
    assert again.pages(frontier(spark).limit(0)).count() == 0


def test_no_exchange_carries_pages(spark, tmp_path, no_broadcast):
    store = FetchStore.create(results(spark), str(tmp_path / "store"), buckets=8)
    plain = exchanged(pages_plan(fetched_pages(results(spark), frontier(spark))))
    assert any("html" in columns for columns in plain)  # the test sees what it looks for
    plan = pages_plan(store.pages(frontier(spark)))
    found = exchanged(plan)
    assert found and not any("html" in columns for columns in found)
    assert not re.search(r"\) Sort\nInput \[\d+\]: \[[^\]]*html", plan)  # nor are they sorted
    assert "Bucketed: true" in plan


def test_a_hot_url_spreads_over_buckets(spark, tmp_path):
    FetchStore.create(results(spark), str(tmp_path / "store"), buckets=16, parts=4)
    files = spark.read.parquet(str(tmp_path / "store/results")).where("requested_url = 'https://hot/'").select(F.input_file_name()).distinct()
    assert files.count() >= 3
