"""The operators of this package on their whole tables, with production parameters."""

import public_tokenizers
from pyspark.sql import functions as F

from claimrisk.llm import (
    anchor_tree,
    bpe_cuts,
    bsi_topk,
    lang_crf,
    license_scan,
    multi_index,
    packing,
    quality,
    sharding,
    simhash,
    threshold_clusters,
    token_rollup,
    toxicity,
)

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def embeddings(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def op1_simhash(spark, sf_dir):
    return simhash.near_duplicates(documents(spark, sf_dir), shingle=4, distance=4)


def op2_license_scan(spark, sf_dir):
    return license_scan.summary(license_scan.scan(documents(spark, sf_dir)))


def op3_topk(spark, sf_dir):
    return bsi_topk.top_k_of_table(embeddings(spark, sf_dir), every=50, k=5)


def op4_language_id(spark, sf_dir):
    return lang_crf.language_id(documents(spark, sf_dir))


def op5_toxicity(spark, sf_dir):
    return toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op6_quality_rules(spark, sf_dir):
    return quality.judge(documents(spark, sf_dir))


def op7_token_counts(spark, sf_dir):
    return token_rollup.rollup_of_table(documents(spark, sf_dir), BYTE_BPE, "byte_bpe_50k")


def op8_packing(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir), BYTE_BPE)


def op9_sharding(spark, sf_dir):
    return sharding.place(documents(spark, sf_dir).select("doc_id"), sharding.shard_names())


def op10_bpe(spark, sf_dir):
    coded = bpe_cuts.encode(documents(spark, sf_dir), WORD_BPE)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op11_threshold_clusters(spark, sf_dir):
    return threshold_clusters.cluster(embeddings(spark, sf_dir))


def op12_multi_index(spark, sf_dir):
    return multi_index.search(embeddings(spark, sf_dir), every=50, k=5)


def hard_negative_labels(rows):
    """The labels of the mining task: those of rows whose id is divisible by 7 are moved on by one, modulo ten."""
    label = F.col("label").cast("long")
    return rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))


def op13_hard_negatives(spark, sf_dir):
    return anchor_tree.mine(hard_negative_labels(embeddings(spark, sf_dir)))


QUERIES = {f.__name__: f for f in (
    op1_simhash, op2_license_scan, op3_topk, op4_language_id, op5_toxicity, op6_quality_rules,
    op7_token_counts, op8_packing, op9_sharding, op10_bpe, op11_threshold_clusters,
    op12_multi_index, op13_hard_negatives)}

# Nearest neighbours over the whole table, vectors kept as lists; the other operators have no SQL form.
TOPK_SQL = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.r AS q_r, q.vec_id AS query_id, c.r, c.vec_id,
         coalesce(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])), 0)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.r <> c.r)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY q_r ORDER BY score DESC, vec_id, r)::INTEGER AS rank FROM s)
WHERE rank <= 5"""

ORACLES = {"op3_topk": TOPK_SQL, "op9_sharding": sharding.oracle_sql(),
           "op11_threshold_clusters": threshold_clusters.oracle_sql(), "op13_hard_negatives": anchor_tree.ORACLE_SQL}
