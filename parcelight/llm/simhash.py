"""SimHash near-duplicates through deletion-variant signatures.

Fingerprints that differ in at most ``bits`` bits are cut into so few segments that in one of them they differ by at
most one bit. Each segment is indexed once for each of its bits with that bit as a wildcard, so such a pair meets in an
equality join on (segment, wildcard, remaining bits) and is then verified on all 64 bits. Large groups of near copies
come together before that, on whole segments, so that the variants need to compare only what is not linked yet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import jaccard
from .common import cut, in_parts, lean, small, texts
from .components import components
from .meeting import BLOCK, CELL, connected_near, dealt
from .shingles import majority, shingle_hashes


def fingerprints(docs: DataFrame, size: int, seed: int = 42) -> DataFrame:
    """docs (doc_id, text) with the text replaced by its SimHash fingerprint fp, a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            found = np.array([majority(shingle_hashes(t, size, seed)) for t in texts(batch)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return docs.mapInArrow(lean(run), "doc_id long, fp long")


def segments(bits: int) -> list[tuple[int, int]]:
    """(first bit, length) of each segment: bits // number is 1 at most."""
    m = bits // 2 + 1
    ends = [round(64 * (i + 1) / m) for i in range(m)]
    return [(a, b - a) for a, b in zip([0, *ends], ends, strict=False)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def variants(bits: int) -> list[tuple[int, int, int, int]]:
    """(number, mask of the kept bits, mask of the segment, its first bit) of each one-wildcard variant."""
    out = []
    for a, n in segments(bits):
        whole = ((1 << n) - 1) << a
        out += [(len(out) + j, signed(whole & ~(1 << (a + j))), signed(whole), a + j) for j in range(n)]
    return out


def links(nodes: DataFrame, bits: int, block: int = BLOCK, dense: int = 8, pivots: int = 32) -> DataFrame:
    """node, root for the nodes (distinct 64-bit fingerprints) of the components whose links are ``bits`` bits at most.

    First the nodes that share a whole segment with more than ``dense`` in all are linked among themselves, in blocks of
    ``block``; some ``pivots`` of a segment's nodes are in all of its blocks, so that large groups come together. Then the
    wildcard variants are indexed, and only nodes of different roots compared. Keys of more than about 2 * ``block`` nodes
    are dealt into cells, see ``meeting.dealt``. What comes out of a task is not pairs but stars of roots.
    """
    per, cuts = variants(bits), segments(bits)
    whole = F.array(*[F.struct(F.lit(i).alias("cut"), F.col("node").bitwiseAND(F.lit(signed(((1 << n) - 1) << a))).alias("part")) for i, (a, n) in enumerate(cuts)])
    parts = nodes.select("node", F.explode(whole).alias("k")).select("node", "k.cut", "k.part")
    crowded = cut(parts.groupBy("cut", "part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > dense))
    labels = None
    if not crowded.isEmpty():
        blocks = F.ceil(F.col("n") / block).cast("int")
        mine = F.array(F.pmod(F.xxhash64("node", F.lit(3)), blocks).cast("int"))
        pivot = F.pmod(F.xxhash64("node", F.lit(4)), F.ceil(F.col("n") / pivots)) == 0
        here = parts.join(small(crowded), ["cut", "part"]).select("cut", "part", "node", F.col("node").alias("root"), F.explode(F.when((blocks > 1) & pivot, F.sequence(F.lit(0), blocks - 1)).otherwise(mine)).alias("i"))
        labels = cut(components(connected_near(here, ("cut", "part", "i"), bits)))
    masks = F.array(*[F.lit(m) for _, m, _, _ in per])
    numbers = F.sequence(F.lit(0), F.lit(len(per) - 1))
    rooted = nodes.withColumn("root", F.col("node")) if labels is None else nodes.join(small(labels), "node", "left").withColumn("root", F.coalesce("root", "node"))

    def key(at: Column, fp: Column) -> Column:
        return F.xxhash64(at, fp.bitwiseAND(F.element_at(masks, at + 1)))

    index = rooted.select("node", "root", F.explode(numbers).alias("at")).select(key(F.col("at"), F.col("node")).alias("key"), "node", "root")
    huge = crowded.where(F.col("n") > block)
    edges = None
    if not huge.isEmpty():
        first = F.element_at(F.array(*[F.lit(sum(n for _, n in cuts[:i])) for i in range(len(cuts))]), F.col("cut") + 1)
        length = F.element_at(F.array(*[F.lit(n) for _, n in cuts]), F.col("cut") + 1)
        keys = huge.select("part", F.explode(F.sequence(first, first + length - 1)).alias("at")).select(key(F.col("at"), F.col("part")).alias("key")).distinct()
        keys = small(cut(keys))
        edges = connected_near(dealt(index.join(keys, "key", "left_semi"), block), CELL, bits)
        index = index.join(keys, "key", "left_anti")
    rest = connected_near(index, ("key",), bits)
    roots = cut(components(rest if edges is None else edges.unionByName(rest)))
    if labels is None:
        return roots
    joined = labels.join(roots.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return joined.unionByName(roots.join(labels.select("node"), "node", "left_anti"))


def group(docs: DataFrame, bits: int = 4, size: int = 4, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for each row of docs.

    Rows whose fingerprints differ in at most ``bits`` bits are linked; component_id is the smallest doc_id reachable.
    A null or wordless text has fingerprint zero and is linked like any other. A null doc_id is a row like others but is
    never the smallest unless all of a component's are null. Repeated rows each give a row. An empty table gives no rows,
    and other columns of docs are ignored. Very long texts are read whole.
    """
    rows = cut(fingerprints(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), size, seed))
    least = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = links(least.select(F.col("fp").alias("node")), bits)
    named = least.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    component = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = named.join(component, "root").select("fp", "component_id")
    return rows.join(by_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_duplicates(docs: DataFrame, similarity: float = 0.8, size: int = 5, bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, copies, kept for each distinct (id, text) of docs: kept marks one of each group, the smallest.

    Texts are linked if the Jaccard similarity of their sets of ``size``-word shingles is ``similarity`` or more, which is
    decided on the sets; groups are the connected components. SimHash comes first: fingerprints (of the sets) that
    ``links`` connects within ``bits`` bits and whose sets prove alike form groups. Then ``jaccard.groups`` compares what
    differs in more bits across these groups, and misses none; so ``bits`` changes the work but not the groups. Ties,
    nulls and empty texts as in ``group``; the smallest is by doc_id (nulls last), then by text hash.
    """
    corpus = jaccard.Corpus(docs, similarity, size, id_col, text_col)
    fps = cut(corpus.rows.groupBy("fp").agg(F.min("node").alias("least")))
    same = corpus.rows.select("fp", "node").distinct().join(fps, "fp").where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b"))
    ends = [fps.select(F.col("fp").alias(x), F.col("least").alias(y)) for x, y in (("node", "a"), ("root", "b"))]
    close = links(fps.select(F.col("fp").alias("node")), bits).where("node <> root").join(ends[0], "node").join(ends[1], "root").select("a", "b")
    roots = jaccard.groups(corpus, corpus.verified(same.unionByName(close)))
    rows = corpus.rows.groupBy("doc_id", "text_hash", "node").agg(F.count(F.lit(1)).alias("copies"))
    rows = cut(rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")
    best = rows.groupBy("root").agg(F.min(order).alias("best"))
    return rows.join(best, "root").select("doc_id", "text_hash", "copies", (order == F.col("best")).alias("kept"))
