"""From raw documents to token ids: language, near duplicates, repeated passages, mixing, encoding.

Each stage works on all that the one before kept. Rows are told apart by id and text, so null or repeated ids do no
harm; rows that are equal in both are drawn one by one by the mixing stage and count as one document before it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelight.llm import bpe, langid, mixing, simhash, suffix
from parcelight.llm.common import checkpoint_folder, cut, dropped, small, table
from parcelight.llm.queries import vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def matched(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
    """Rows of a joined to those of b with the same doc_id (null matches null) and text_hash."""
    b = b.withColumnsRenamed({"doc_id": "b_id", "text_hash": "b_hash"})
    out = a.join(b, a["doc_id"].eqNullSafe(F.col("b_id")) & (F.col("text_hash") == F.col("b_hash")), how)
    return out if how in ("left_anti", "left_semi") else out.drop("b_id", "b_hash")


def hashed(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS, F.xxhash64("text").alias("text_hash"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told apart clearly; those without letters or with a narrow margin go."""
    model = langid.learn(docs.select("text", "lang"))
    return langid.classify(docs.select(COLUMNS), model).where(~F.col("rejected")).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near duplicates."""
    found = cut(simhash.near_duplicates(docs))
    kept = matched(hashed(docs), small(cut(found.where(~F.col("kept")).select("doc_id", "text_hash"))), "left_anti")
    if not found.where("kept and copies > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", "text_hash"])
    return kept.select(COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without what also starts earlier; one of which only white space is left goes."""
    found = suffix.dedup(docs, texts_too=True).where("n_removed > 0")
    changed = found.select("doc_id", "text_hash", "kept_text").dropDuplicates(["doc_id", "text_hash"])
    left = matched(hashed(docs), changed, "left").withColumn("text", F.coalesce("kept_text", "text"))
    emptied = F.col("kept_text").isNotNull() & ~F.col("kept_text").rlike(r"\S")
    length: Column = F.when(F.col("kept_text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))
    return left.where(~emptied).withColumn("n_chars", length).select(COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of its source takes it."""
    drawn = mixing.mix(docs).select("doc_id", "text_hash", "copies")
    rows = hashed(docs)
    if not drawn.groupBy("doc_id", "text_hash").count().where("count > 1").isEmpty():
        twin = Window.partitionBy("doc_id", "text_hash")
        rows = rows.withColumn("text_hash", F.xxhash64("text_hash", F.row_number().over(twin.orderBy("source"))))
        drawn = drawn.withColumn("text_hash", F.xxhash64("text_hash", F.row_number().over(twin.orderBy("copies"))))
    taken = matched(rows, drawn.where("copies > 0"), "inner")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and digests of each text's tokens."""
    return bpe.encode(docs, vocabulary("word_bpe_49k.json"), keep=True, decoded_too=False)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages), ("mixture", mixture), ("tokens", tokens)]

#: Compression, fingerprints with connected components, and the cube method have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written to the checkpoint folder and read by the next, after which
    it is deleted."""
    checkpoint_folder(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            dropped(spark, f"{folder}/{k - 1}")
    return docs
