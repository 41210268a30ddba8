"""Sharding by longest-processing-time scheduling.

Rows with equal texts form a group that must stay together. Groups go, largest first, to the least-loaded shard of a
heap. Only a bounded list is scheduled: every group above 1/256 of a shard on its own (at most 256 x shards of them),
all smaller groups in hashed bins (``bins`` of them), so the heap sees the same few thousand entries at any corpus size.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import numbered

#: A group is scheduled on its own if it is larger than this part of a shard's share.
BIG = 256


def longest_first(sizes: list[tuple[int, int]], shards: int) -> dict[int, int]:
    """Shard of each (item, size): by falling size, ties by item, to the shard with the least load, ties to the lower."""
    loads = [(0, s) for s in range(shards)]
    out = {}
    for item, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        load, shard = heapq.heappop(loads)
        out[item] = shard
        heapq.heappush(loads, (load + size, shard))
    return out


def shard(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", bins: int = 4096, cell: int = 1000) -> DataFrame:
    """Put every row of docs into a shard and number the rows of each shard without gaps.

    Returns doc_id, size, text_crc32, law, shard, slot, grown_shard; one row for each input row. size is the text's
    UTF-8 bytes plus 1. The law is `bytes`: shards get nearly equal sums of size, as far as groups of equal texts, which
    are never split, allow. A null text counts as the empty text (size 1, CRC 0) and stays with the empty texts. Null
    ids and repeated rows are rows like others. An empty table gives no rows. Other columns of docs are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = numbered(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("key"),
        )
    )
    groups = base.groupBy("key").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).withColumn("bin", F.pmod(F.xxhash64("key"), F.lit(bins)).cast("int"))
    total = base.agg(F.sum("size")).first()[0] or 0
    big = F.col("size") * F.lit(BIG * shards) > F.lit(total)
    large = groups.filter(big).select("key", "size", "n").collect()  # sizes sum to total, so under BIG * shards rows
    small = groups.filter(~big).groupBy("bin").agg(F.sum("size").alias("size"), F.sum("n").alias("n")).collect()  # at most bins rows
    sized = [(r["bin"], r["size"], r["n"]) for r in small]
    named = [(bins + i, r["key"], r["size"], r["n"]) for i, r in enumerate(sorted(large, key=lambda r: bytes(r["key"])))]
    sized += [(i, size, n) for i, _, size, n in named]
    to = longest_first([(i, size) for i, size, _ in sized], shards)
    keys = spark.createDataFrame([(bytes(key), i) for i, key, _, _ in named], T.StructType([T.StructField("key", T.BinaryType()), T.StructField("own", T.IntegerType())]))
    items = spark.createDataFrame([(i, to[i], -(-n // cell)) for i, _, n in sized], "item int, shard int, cells int")
    placed = (
        base.join(F.broadcast(keys), "key", "left")
        .withColumn("item", F.coalesce("own", F.pmod(F.xxhash64("key"), F.lit(bins)).cast("int")))
        .join(F.broadcast(items), "item")
        .withColumn("cell", F.pmod(F.xxhash64("doc_id", "text_crc32", "nth", F.lit(7)), F.col("cells").cast("long")).cast("int"))
        .select("doc_id", "size", "text_crc32", "nth", "shard", "item", "cell")
    )
    counts = placed.groupBy("shard", "item", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("item", "cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("item", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("item", "cell").orderBy(F.col("doc_id").asc_nulls_last(), "text_crc32", "nth")
    return (
        placed.join(offsets, ["item", "cell"])
        .withColumn("slot", F.col("offset") + F.row_number().over(within) - F.lit(1))
        .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    )
