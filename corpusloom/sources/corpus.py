"""Corpora, summaries and manifests written by earlier runs."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.schema import LAYOUT_DDL, MANIFEST_DDL, RECORD_DDL, SUMMARY_DDL


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Records of a JSON-lines corpus, plain or gzip; blank lines are skipped."""
    return spark.read.schema(RECORD_DDL).json(path)


def read_positions(spark: SparkSession, path: str) -> DataFrame:
    """Records of a corpus that ``write_jsonl`` wrote, with their ``position`` in the export.

    A file holds the lines from its number times the lines per file on; within a file lines are counted in the order in which they are
    read, so what meets in one place is a file.
    """
    per_file = spark.read.schema(LAYOUT_DDL).json(f"{path}/_layout").first()["per_file"]
    lines = spark.read.schema(RECORD_DDL).json(path).select(
        "*", F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("bigint").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row"))
    nth = F.row_number().over(Window.partitionBy("_file").orderBy("_block", "_row")) - 1
    return lines.withColumn("position", F.col("_file") * per_file + nth).drop("_file", "_block", "_row")


def _or_empty(spark: SparkSession, schema: str, load) -> DataFrame:
    try:
        return load()
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def previous_signature(spark: SparkSession, summary_path: str) -> DataFrame:
    """The signature in a harvest summary: one row, or none when missing or unreadable."""
    summary = _or_empty(spark, SUMMARY_DDL, lambda: spark.read.schema(SUMMARY_DDL)
                        .option("multiLine", "true").json(summary_path))
    return (summary.select(F.col("change_detection.corpus_signature").alias("corpus_signature"))
            .where("corpus_signature is not null"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all versions; each version is one file, named by its number."""
    return _or_empty(spark, MANIFEST_DDL, lambda: spark.read.schema(MANIFEST_DDL).json(path))
