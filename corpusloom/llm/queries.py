"""Registered queries: each applies its operator with production parameters to the whole table."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles
from .archives import page_archive
from .bpe import encode_documents
from .chat import format_chats, masked_text, parse
from .common import ORACLES, QUERIES, query, table  # noqa: F401  the registries are read from here
from .decontaminate import find_contamination, hit_words
from .merkle import merkle_manifest, proof
from .neardup import near_duplicates
from .packing import pack_documents
from .repair import Repair, damage
from .repeats import remove_repeats
from .sharding import shard_rows
from .topk import quantise, top_k
from .toxicity import score_documents
from .urlfilter import judge_urls


def tokenizer_file() -> str:
    """Vocabulary of the packing query; on a cluster every executor has the file at the same path."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query()
def op1_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


@query(oracles.CHAT)
def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    tricky = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], "conv_id bigint, turn bigint, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    chats = format_chats(turns).withColumn("turns", parse(F.col("formatted")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = masked_text(F.col("formatted"), F.col("loss_mask"))
    return (chats.withColumn("loss", loss)
            .select("conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                    F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                    F.length("formatted").cast("bigint").alias("formatted_chars")))


@query()
def op3_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_rows(table(spark, sf_dir, "documents"), shards=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query()
def op4_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["length"])
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_file(), special_as_text=False)


@query(oracles.WARC)
def op6_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_archive(table(spark, sf_dir, "pages"))


@query()
def op7_url_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
    return judge_urls(table(spark, sf_dir, "pages"), rules)


@query()
def op8_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "copies", "linked")


@query(oracles.CONTAMINATION)
def op9_prefix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = hit_words(F.col("runs"))
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


@query(oracles.TOP_K)
def op10_bit_sliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantise(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5)


@query(oracles.REPAIR)
def op11_checkpointed_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = Repair(damage(turns)).summary().withColumnRenamed("conv_id", "_id")
    whole = turns.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("_id")), "left").drop("_id")
    counts = [c for c in whole.columns if c not in ("conv_id", "audit", "repaired_sha256")]
    return whole.fillna(0, counts).fillna({"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()})


@query(oracles.MERKLE)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n")))
    rows = merkle_manifest(table(spark, sf_dir, "documents"), tampered)
    return rows.select("doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"), "folded_root",
                       (F.col("folded_root") == F.col("root")).alias("verified"))


@query()
def op13_speculative_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = encode_documents(table(spark, sf_dir, "documents"), tokenizer_file(), decoded=True)
    return rows.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
