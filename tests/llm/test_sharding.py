import zlib
from collections import Counter

from brute import DOCUMENTS, documents, jump_shard
from pyspark.sql import functions as F

from corpusloom.llm.queries import op3_jump_shards
from corpusloom.llm.sharding import jump, shard_rows


def test_jump_is_the_published_function(spark):
    keys = [0, 1, -1, 2**63 - 1, -2**63, 17, 10**12, None, *range(100, 140)]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    for shards in (1, 2, 40, 41, 1000):
        got = [r[0] for r in df.select(jump(F.col("k"), shards)["shard"]).collect()]
        assert got == [jump_shard(k or 0, shards) for k in keys]


def test_growth_moves_rows_only_into_the_new_shard(spark, sf_dir):
    rows = op3_jump_shards(spark, sf_dir).collect()
    assert all(r.shard == jump_shard(r.doc_id, 40) and r.grown_shard == jump_shard(r.doc_id, 41) for r in rows)
    assert {r.grown_shard for r in rows if r.grown_shard != r.shard} == {40}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) and r.size == len(texts[r.doc_id].encode()) + 16 for r in rows)
    assert len(rows) == len(texts)


def test_slots_are_gapless_for_awkward_rows(spark):
    rows = shard_rows(documents(spark, DOCUMENTS + [(7, "short")] * 40).repartition(5), 3).collect()
    assert len(rows) == len(DOCUMENTS) + 40
    for shard, n in Counter(r.shard for r in rows).items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))
    null = next(r for r in rows if r.doc_id == 4)
    assert (null["size"], null.text_crc32) == (16, 0)
    assert shard_rows(documents(spark, []), 3).count() == 0
