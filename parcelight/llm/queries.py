"""The queries of the corpus operators: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, divergence, interaction, langid, minhash, mixing, passages, quality, sharding, simhash, suffix, unigram
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.group(table(spark, sf_dir, "documents"))


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out(F.col("doc_id"), 4, 2))
    model = langid.learn(docs.where("not held_out").select("text", "lang"))
    return langid.classify(docs.select("doc_id", "held_out", "text"), model).drop("text")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", langid.held_out(F.col("doc_id"), 5, 0).alias("held_out"))
    marked = table(spark, sf_dir, "labels").select("doc_id", "quality")
    known = docs.where("not held_out").select("doc_id", F.xxhash64("text").alias("by")).join(marked, "doc_id")
    model = quality.learn(known, docs=docs)
    return quality.score(docs, model)


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.fingerprint_edits(table(spark, sf_dir, "documents"))


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 50 = 0"))


def op6_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), path or vocabulary("word_bpe_49k.json"))


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.dedup(table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_token_counts(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    return unigram.token_counts(table(spark, sf_dir, "documents"), unigram.model_pieces(path or vocabulary("piece_bpe_32k.model")))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.dedup(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interaction.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Query]:
    return {"op1_simhash": op1_simhash, "op2_langid": op2_langid, "op3_quality": op3_quality, "op4_fingerprints": op4_fingerprints, "op5_nearest": op5_nearest, "op6_bpe": op6_bpe, "op7_substrings": op7_substrings, "op8_sharding": op8_sharding, "op9_mixing": op9_mixing, "op10_token_counts": op10_token_counts} | {"op11_divergence": op11_divergence, "op12_passages": op12_passages, "op13_filter_audit": op13_filter_audit}


def oracle_sql() -> dict[str, str]:
    return {"op11_divergence": divergence.SQL, "op12_passages": passages.SQL, "op13_filter_audit": interaction.SQL}
