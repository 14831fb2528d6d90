"""Training-corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.decontaminate import find_contamination
from corpusloom.llm.neardup import near_duplicates
from corpusloom.llm.packing import pack_documents
from corpusloom.llm.queries import tokenizer_file
from corpusloom.llm.repeats import remove_repeats
from corpusloom.llm.toxicity import score_documents
from corpusloom.session import configure, stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below one half. Null and empty texts have no clause and stay; repeated rows stay or go alike."""
    scored = score_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), keep=COLUMNS)
    return scored.filter("predicted = 0").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: that with the smallest id (rows without an id last), once if repeated.

    Null and empty texts are one class, as are other texts without words that are equal.
    """
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    chosen = near_duplicates(docs).select(F.coalesce("class_id", F.lit(-(1 << 63))).alias("_id"), F.col("class_node").alias("_node")).distinct()
    keyed = docs.select(*COLUMNS, key.alias("_id"), F.md5(F.coalesce("text", F.lit(""))).alias("_node"))
    return keyed.join(chosen, ["_id", "_node"], "left_semi").dropDuplicates(["_id", "_node"]).select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document of smaller id has too; a text that such passages make up wholly goes.

    A text that keeps all its bytes stays as it is, null or empty too; parts of characters at a cut go; a null id counts as the largest.
    """
    cut = remove_repeats(docs, keep=COLUMNS, decoded=True)
    changed = F.size("spans") > 0
    return (cut.filter(~changed | (F.trim("kept") != ""))
            .select("doc_id", F.when(changed, F.col("kept")).otherwise(F.col("text")).alias("text"), "lang", "source",
                    F.when(changed, F.length("kept").cast("bigint")).otherwise(F.col("n_chars")).alias("n_chars")))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item; null and empty texts have none and stay."""
    found = find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=COLUMNS)
    return found.filter(F.size("runs") == 0).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents' pieces in training sequences; a null or empty text is the end id alone."""
    return pack_documents(docs, tokenizer_file(), special_as_text=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("suffix_repeats", cut_repeats),
    ("decontamination", drop_contaminated), ("packing", pack_sequences)]

# Scores, sampled signatures and byte-level repeats have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is staged in the shared folder."""
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
