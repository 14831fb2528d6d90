"""JSON-lines corpora and the error log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.canonical import canonical_json, sorted_fields
from corpusloom.operators.changes import corpus_signature
from corpusloom.operators.ranking import numbered
from corpusloom.operators.records import RECORD, sort_key
from corpusloom.schema import LAYOUT_DDL
from corpusloom.session import stage

#: Size of a corpus file before compression; one compressed file is read by one task.
FILE_BYTES = 256 << 20
# Corpus names by page type.
CORPUS_OF_TYPE = {"Product": "products", "Article": "articles", "WebPage": "pages", "CollectionPage": "collections"}


def json_lines(records: DataFrame) -> DataFrame:
    """Records with keys sorted, as they are written."""
    fields = sorted(records.schema.fields, key=lambda f: f.name)
    return records.select(*[sorted_fields(F.col(f.name), f.dataType).alias(f.name) for f in fields])


def in_export_order(records: DataFrame, *by: str) -> DataFrame:
    """Records sorted for export, by ``by`` columns first; a row number breaks ties, so copies spread over tasks too."""
    return records.withColumn("_row", F.monotonically_increasing_id()).orderBy(*by, *sort_key(), "_row").drop("_row")


def _write_json(df: DataFrame, path: str, compression: str, *partition: str) -> None:
    (df.write.mode("errorifexists").option("ignoreNullFields", "false").option("compression", compression)
     .partitionBy(*partition).json(path))


def write_jsonl(records: DataFrame, path: str, compression: str = "gzip", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write one record per line and return ``(n_records, corpus_signature)`` of the content.

    Lines lie in export order over files of about ``file_bytes`` each before compression, so that a compressed corpus is read by as many tasks as
    it has files. All files but the last have the same number of lines; ``_layout``, which readers skip, tells it, and so gives every line
    its position (``sources.corpus.read_positions``). Lines are rendered once, hashed and written.
    """
    spark, kind = records.sparkSession, T.StructType([records.schema[name] for name in RECORD])
    keys = [f"_k{i}" for i in range(len(sort_key()))]
    lines = records.select(canonical_json(F.struct(*RECORD), kind).alias("value"), *[k.alias(n) for k, n in zip(sort_key(), keys, strict=True)])
    placed = stage(numbered(lines, *map(F.col, keys)).select("value", "position"), "jsonl")
    total = placed.agg(F.count(F.lit(1)), F.sum(F.octet_length("value"))).first()
    per_file = max(1, file_bytes * total[0] // max(1, total[1] or 0))
    files = max(1, -(-total[0] // per_file))
    dealt = placed.repartitionById(files, F.floor(F.col("position") / per_file).cast("int")).sortWithinPartitions("position")
    dealt.select("value").write.mode("errorifexists").option("compression", compression).text(path)
    spark.createDataFrame([(per_file, files, total[0])], LAYOUT_DDL).coalesce(1).write.json(f"{path}/_layout")
    return corpus_stats(placed.select(F.sha2("value", 256).alias("record_hash")))


def corpus_stats(hashed: DataFrame, *by: str) -> DataFrame:
    """Row count and content signature, per ``by`` group or in all."""
    signature = corpus_signature(hashed, *by)
    if not by:
        total = hashed.agg(F.count(F.lit(1)).alias("n_records"))
        return total.withColumn("corpus_signature", signature.scalar())
    return hashed.groupBy(*by).agg(F.count(F.lit(1)).alias("n_records")).join(signature, list(by))


def write_corpora(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """All typed corpora in one pass, one folder per page type; together they are the full corpus."""
    # sorted as the partitioned writer needs it, so that the writer does not sort once more
    typed = in_export_order(records.withColumn("corpus", corpus_name()), "corpus")
    _write_json(json_lines(typed.select(*RECORD, "corpus")), path, compression, "corpus")


def corpus_name() -> Column:
    kind, name = F.col("document_identifier.page_type"), F.lit(None).cast("string")
    for page_type, corpus in CORPUS_OF_TYPE.items():
        name = F.when(kind == page_type, corpus).otherwise(name)
    return name


def harvest_errors(results: DataFrame) -> DataFrame:
    """One tab-separated line per failed fetch."""
    return results.where(~F.col("ok")).select(F.concat_ws(
        "\t", "url", F.concat(F.lit("status="), F.col("status").cast("string")),
        F.concat(F.lit("final="), F.col("final_url")), F.coalesce("error", F.lit(""))).alias("value"))


def line_stats(lines: DataFrame) -> DataFrame:
    """``(n_records, corpus_signature)`` of the rows of a flat file."""
    return corpus_stats(lines.select(F.sha2(F.to_json(F.struct(*lines.columns), {"ignoreNullFields": "false"}), 256).alias("record_hash")))


def write_errors(results: DataFrame, path: str) -> None:
    harvest_errors(results).write.mode("errorifexists").text(path)
