"""Connected components of an edge table, by alternating large-star and small-star steps, and tables written in between."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def checkpoint_folder(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir; only where none is set (tests, a local session) a temporary one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="checkpoint-"))
    return sc.getCheckpointDir()


#: Bytes of files of which joins send nothing to all executors: packed columns and lists are many times as large in memory.
LARGE = 1 << 20


def stored(df: DataFrame) -> tuple[DataFrame, str]:
    """df written as Parquet to the checkpoint folder and read again, and its path. What a loop makes in each round goes
    here: sizes are estimated from files, while a checkpoint carries on the estimate of its plan, and joins of a table
    with itself would multiply it in every round. Large ones are joined by sorting, not through the driver."""
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/round-{uuid.uuid4().hex}"
    df.write.parquet(path)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    size = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(at).getLength()
    out = spark.read.parquet(path)
    return out.hint("merge") if size > LARGE else out, path


def dropped(spark: SparkSession, path: str) -> None:
    """Delete what ``stored`` has written and nobody reads any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of edges (a, b, both long, a null in neither): root is the smallest node reachable.

    Each step keeps at most as many edges as before and is written to the checkpoint folder as Parquet, where the step
    before is deleted. A step groups nothing into one place: minima come from partial aggregates, and the joins on them
    can be split where a node is hot. The loop ends when every node points at a root that points nowhere, after a number
    of steps logarithmic in the longest path.
    """
    links, path = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large, between = stored(large.distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        before, (links, path) = path, stored(small.where("u <> v").distinct())
        for old in (before, between):
            dropped(edges.sparkSession, old)
        # a star forest: each node has one parent, and no parent has a parent
        twice = links.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("u")
        chained = links.select(F.col("v").alias("u")).join(links.select("u"), "u", "left_semi")
        if twice.unionByName(chained).isEmpty():
            break
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
