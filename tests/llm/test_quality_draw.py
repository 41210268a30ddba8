"""The texts that the quality model learns from are drawn before they are joined with labels."""

from pyspark.sql import functions as F

from parcelight.llm import quality


def test_draw_by_hash_gives_the_same_model(spark):
    texts = [f"w{k % 7} good text {k % 50}" for k in range(300)] + [None, ""]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    marked = spark.createDataFrame([(k, k % 2) for k in range(0, 302, 3)] + [(3, 0), (5, None)], "doc_id long, quality int")
    known = docs.select("doc_id", F.xxhash64("text").alias("by")).join(marked, "doc_id")
    for sample in (20, 5000):
        assert quality.learn(known, sample, docs) == quality.learn(docs.join(marked, "doc_id"), sample)
