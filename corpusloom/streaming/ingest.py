"""The harvest as a stream: page work has no state across rows, so batch operators apply unchanged; URLs seen and counts are state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.operators.records import harvest_results
from corpusloom.rules import DEFAULTS, Rules
from corpusloom.session import configure
from corpusloom.sources.fetched import FETCHED


def fetched_stream(spark: SparkSession, path: str, timed: bool = False) -> DataFrame:
    """Fetch results arriving as Parquet files in a folder; ``timed`` ones have ``fetched_at`` too."""
    return configure(spark).readStream.schema(FETCHED + ", fetched_at TIMESTAMP" * timed).parquet(path)


def fetched_once(fetched: DataFrame, fetched_at: str = "fetched_at", late: str = "1 day") -> DataFrame:
    """The stream with each URL once: of fetches less than ``late`` apart by ``fetched_at`` the first to arrive counts.

    The URLs seen are state, kept by URL and dropped once the watermark has passed them; pages themselves are not kept.
    """
    return fetched.withWatermark(fetched_at, late).dropDuplicatesWithinWatermark(["requested_url"])


def metrics_stream(fetched: DataFrame, out: str, checkpoint: str, site_origin: str | None = None, rules: Rules = DEFAULTS) -> StreamingQuery:
    """Running counts of results by outcome and page type: ``out`` holds the changed counts of every batch, ``latest_metrics`` the current ones.

    The state is a row per outcome and type. A batch that is run again after a crash writes over its own folder.
    """
    results = harvest_results(fetched, site_origin=site_origin, rules=rules)
    counts = results.groupBy("ok", "status", "page_type").agg(F.count(F.lit(1)).alias("n"))

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{out}/number={number}")
    return (counts.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .outputMode("update").trigger(availableNow=True).start())


def latest_metrics(spark: SparkSession, out: str) -> DataFrame:
    """``(ok, status, page_type, n)`` as of the last batch."""
    rows = spark.read.parquet(out)
    return rows.groupBy("ok", "status", "page_type").agg(F.max_by("n", "batch").alias("n"))


def harvest_stream(fetched: DataFrame, out: str, checkpoint: str, site_host: str | None = None,
                   site_origin: str | None = None, rules: Rules = DEFAULTS) -> StreamingQuery:
    """Append harvest results to ``out`` for all files now present, exactly once."""
    results = harvest_results(fetched, site_host, site_origin, rules=rules)
    return (results.writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(availableNow=True).start())
