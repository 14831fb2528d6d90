"""Fetched pages: the table the engine starts from."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FETCHED = "requested_url STRING, final_url STRING, status INT, html STRING"


def read_fetched(spark: SparkSession, path: str, format: str = "parquet", partitions: int | None = None) -> DataFrame:
    """Fetch results stored as Parquet or JSON lines.

    ``partitions`` deals the pages anew, for input in fewer splits than there are cores; by default nothing is exchanged.
    """
    fetched = spark.read.format(format).schema(FETCHED).load(path)
    return fetched.repartition(partitions) if partitions else fetched


def from_pages(pages: DataFrame) -> DataFrame:
    """A crawl table ``(page_id, url, html)`` as fetch results that all succeeded."""
    return pages.select("page_id", F.col("url").alias("requested_url"), F.col("url").alias("final_url"),
                        F.lit(200).alias("status"), "html")


def fetched_pages(fetched: DataFrame, frontier: DataFrame | None = None) -> DataFrame:
    """Fetch results, or the frontier with its results; a URL without one has status 0 and no body."""
    if frontier is None:
        return fetched.withColumn("html", F.coalesce("html", F.lit("")))
    urls = frontier.select(F.col("url").alias("requested_url")).distinct()
    # Two joins whose large side is the left one: a URL fetched a great many times is then a
    # skewed partition adaptive execution can split. The other side has one row per URL.
    found = fetched.join(urls, "requested_url", "left_semi")
    missing = urls.join(fetched.select("requested_url").distinct(), "requested_url", "left_anti")
    return _completed(found, missing)


def _completed(found: DataFrame, missing: DataFrame) -> DataFrame:
    return (found.unionByName(missing, allowMissingColumns=True)
            .withColumns({"final_url": F.coalesce("final_url", "requested_url"),
                          "status": F.coalesce("status", F.lit(0)),
                          "html": F.coalesce("html", F.lit(""))}))


@dataclass(frozen=True)
class FetchStore:
    """Fetch results laid out by URL once, so that looking up a frontier moves no page.

    Results lie in ``buckets`` buckets by (URL, part); the fetches of one URL are dealt to ``parts`` parts, so a URL fetched a great many times
    spreads over as many buckets. A frontier of URLs is dealt alike, and each bucket is read and held against its URLs where it is.
    """

    spark: SparkSession
    path: str
    buckets: int
    parts: int

    @classmethod
    def create(cls, fetched: DataFrame, path: str, buckets: int = 200, parts: int = 4) -> FetchStore:
        """Write fetch results; this is the one time that they are exchanged."""
        part = F.pmod(F.monotonically_increasing_id(), F.lit(parts)).cast("int")
        dealt = fetched.withColumn("_part", part).repartition(buckets, "requested_url", "_part")
        spark, name = fetched.sparkSession, f"fetched_{uuid.uuid4().hex}"
        (dealt.write.bucketBy(buckets, "requested_url", "_part").option("path", f"{path}/results").format("parquet").saveAsTable(name))
        spark.sql(f"DROP TABLE {name}")  # the files stay, as the table's place was given
        layout = spark.createDataFrame([(buckets, parts, dealt.schema.json())], "buckets int, parts int, fields string")
        layout.coalesce(1).write.json(f"{path}/layout")
        return cls(spark, path, buckets, parts)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> FetchStore:
        layout = spark.read.schema("buckets int, parts int").json(f"{path}/layout").first()
        return cls(spark, path, layout["buckets"], layout["parts"])

    def _bucketed(self) -> DataFrame:
        schema = spark_schema(self.spark.read.json(f"{self.path}/layout").first()["fields"])
        name = f"fetched_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (requested_url, _part) INTO {self.buckets} BUCKETS LOCATION '{self.path}/results'")
        return self.spark.table(name)

    def results(self) -> DataFrame:
        return self._bucketed().drop("_part")

    def pages(self, frontier: DataFrame) -> DataFrame:
        """As ``fetched_pages``: the frontier with its results, a URL without one with status 0 and no body."""
        stored = self._bucketed()
        urls = frontier.select(F.col("url").alias("requested_url")).distinct()
        everywhere = urls.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(self.parts - 1))))
        # A hash of the URLs of a bucket needs no order, so the pages are not sorted either.
        found = stored.join(everywhere.hint("shuffle_hash"), ["requested_url", "_part"], "left_semi").drop("_part")
        missing = urls.join(stored.select("requested_url").distinct(), "requested_url", "left_anti")
        return _completed(found, missing)


def spark_schema(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))


def is_harvestable() -> Column:
    return (F.col("status") == 200) & (F.coalesce(F.col("html"), F.lit("")) != "")
