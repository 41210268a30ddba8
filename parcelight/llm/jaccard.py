"""Groups of texts by the Jaccard similarity of their sets of word shingles: every pair that reaches it, and no other.

Sets that are alike share one of the first shingles of each, in an order that is the same for all and leaves common
shingles to the end (prefix filtering). So sets that meet in such a shingle are compared, unless their sizes, the places
of the shingle or a parity sketch show that they cannot be alike, and the similarity is decided on the sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.components import components, stored
from .common import cut, frames, in_parts, lean, ranges, small, texts, unsigned_fraction
from .meeting import CELL, ROWS, dealt, numbered, pairs
from .shingles import majority, shingle_hashes

#: Texts sampled and shingles kept for the order; the part of the sample that makes a shingle hot; rows of a shingle
#: compared without sketches at most.
SAMPLE, COMMON, HOT, DENSE = 10_000, 100_000, 0.01, 32
#: Rows with lists of keys read at a time.
LISTED = 8_000
#: Pairs of two roots that a cell gives in each round; the last one gives all that are left.
MOST = (1, 8, None)
_EPS = 1e-9


def sketch(h: np.ndarray) -> np.ndarray:
    """Parities of the numbers of elements in classes, a power of two of them, about as many as elements and 256 at least.
    Two sets differ in at least as many elements as their sketches differ in bits; one of twice the size is folded first:
    its halves are put together by exclusive or."""
    bits = max(256, 1 << (len(h) - 1).bit_length()) if len(h) else 256
    mixed = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    classes = ((mixed >> np.uint64(32)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(classes, minlength=bits) & 1).view(np.int64)


def folded(column: pa.ChunkedArray) -> np.ndarray:
    """Sketches folded to 256 bits each."""
    lists = column.combine_chunks()
    words, size = lists.flatten().to_numpy().view(np.uint64), np.diff(lists.offsets.to_numpy())
    quads = np.bitwise_xor.reduceat(words.reshape(-1, 4), (np.cumsum(size) - size) // 4, axis=0)
    return quads


def alike_bits(similarity: float, total: Column | np.ndarray) -> Column | np.ndarray:
    """In how many elements sets of total elements together may differ."""
    return (1 - similarity) / (1 + similarity) * total + _EPS


def common_shingles(base: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several texts of a sample of about SAMPLE hold, the most common last, COMMON of them at most; and
    those that the part HOT holds, of which there are few for the same reason: a text has few that are common.

    They only set the order in which prefixes are taken and the way in which a shingle's rows are counted: any choice
    finds the same pairs, this one meets fewer others."""
    n = base.count()

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            for t in texts(batch):
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(shingle_hashes(t, size)).view(np.int64))], ["key"])

    drawn = base.where(unsigned_fraction(F.col("text_hash"), F.lit(7)) < min(1.0, SAMPLE / max(n, 1))).dropDuplicates(["text_hash"]).select("text")
    found = drawn.mapInArrow(lean(sets), "key long").groupBy("key").count().where("count > 2").orderBy(F.desc("count"), "key").limit(COMMON).collect()
    return np.array([r["key"] for r in reversed(found)], np.int64), np.array([r["key"] for r in found if r["count"] > HOT * SAMPLE], np.int64)


class Corpus:
    """The shingle sets of docs. rows has doc_id, text_hash, node (the set's hash) and fp (SimHash of the set) for each
    row; sets (node, n, quad, prefix) for each distinct set, n elements, with its sketch folded to 256 bits and its first
    shingles that are not to miss."""

    def __init__(self, docs: DataFrame, similarity: float, size: int, id_col: str, text_col: str) -> None:
        self.similarity, self.size = similarity, size
        self.base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).cast("string").alias("text"))
        known, self.hot = common_shingles(self.base, size)
        by = np.argsort(known)
        shared = docs.sparkSession.sparkContext.broadcast((known[by], by))  # COMMON entries at most

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, rank = shared.value
            for batch in in_parts(batches):
                out: list[tuple] = []
                for t in texts(batch):
                    h = np.unique(shingle_hashes(t, size))
                    k = len(h) - math.ceil(similarity * len(h) - _EPS) + 1 if len(h) else 0
                    first = h.view(np.int64)
                    if len(known) and len(first):
                        at = np.minimum(np.searchsorted(known, first), len(known) - 1)
                        first = first[np.lexsort((first, np.where(known[at] == first, rank[at], -1)))]
                    out.append((xxhash.xxh3_64_intdigest(h.tobytes()), majority(h), len(h), sketch(h), first[:k]))
                if out:
                    node, fp, n, bits, first = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(np.array(x, np.uint64).view(np.int64)) for x in (node, fp)), pa.array(n, pa.int32()), pa.array(bits, pa.list_(pa.int64())), pa.array(first, pa.list_(pa.int64()))], ["doc_id", "text_hash", "node", "fp", "n", "sketch", "prefix"])

        self.rows, _ = stored(self.base.mapInArrow(lean(run), "doc_id long, text_hash long, node long, fp long, n int, sketch array<long>, prefix array<long>"))
        quad = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda k: F.aggregate(F.filter("sketch", lambda _, i: i % 4 == k), F.lit(0).cast("long"), lambda x, y: x.bitwiseXOR(y)))
        sets = self.rows.select("node", "n", quad.alias("quad"), "prefix")
        copied = small(cut(self.rows.groupBy("node").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1").select("node")))
        self.sets = sets.join(copied, "node", "left_anti").unionByName(sets.join(copied, "node", "left_semi").dropDuplicates(["node"]))

    def verified(self, candidates: DataFrame) -> DataFrame:
        """Those of the candidates (a, b) whose sets are alike. Only these texts are read again."""
        candidates = cut(candidates.distinct())
        wanted = candidates.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        one = self.rows.join(wanted, "node", "left_semi").groupBy("node").agg(F.min(F.struct("doc_id", "text_hash")).alias("row"))
        one = small(cut(one.select(F.col("row.doc_id").alias("its_id"), F.col("row.text_hash").alias("its_hash"))))
        size = self.size

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in in_parts(batches):
                sets = [np.unique(shingle_hashes(t, size)) for t in texts(batch)]
                node = np.array([xxhash.xxh3_64_intdigest(h.tobytes()) for h in sets], np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), pa.array([h.view(np.int64) for h in sets], pa.list_(pa.int64()))], ["node", "shingles"])

        picked = self.base.join(one, (F.col("text_hash") == F.col("its_hash")) & F.col("doc_id").eqNullSafe(F.col("its_id")), "left_semi")
        sets = picked.select("text").mapInArrow(lean(run), "node long, shingles array<long>").dropDuplicates(["node"])
        side = lambda x: sets.select(F.col("node").alias(x), F.col("shingles").alias(f"set_{x}"))
        shared = F.size(F.array_intersect("set_a", "set_b"))
        alike = shared >= F.lit(self.similarity) * (F.size("set_a") + F.size("set_b") - shared) - _EPS
        return cut(candidates.join(side("a"), "a").join(side("b"), "b").where(alike).select("a", "b"))


def rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """rows with the root of each node, which is the node itself where roots has none."""
    return rows.drop("root").join(small(roots), "node", "left").withColumn("root", F.coalesce("root", "node"))


class Lists:
    """Lists of keys in the order of all prefixes, as sorted numbers that tell rows and keys apart."""

    def __init__(self, column: pa.ChunkedArray) -> None:
        lists = column.combine_chunks()
        self.size = np.diff(lists.offsets.to_numpy())
        self.start = np.cumsum(self.size) - self.size
        self.keys, code = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        self.code = code
        self.flat = np.sort(np.repeat(np.arange(len(self.size)), self.size) * len(self.keys) + code)

    def first_common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The first key that rows i and j share, for pairs that share one."""
        pair = np.repeat(np.arange(len(i)), self.size[i])
        place = ranges(self.start[i], self.size[i])
        wanted = j[pair] * len(self.keys) + self.code[place]
        at = np.minimum(np.searchsorted(self.flat, wanted), len(self.flat) - 1)
        hit = self.flat[at] == wanted
        first = np.full(len(i), len(self.code))
        np.minimum.at(first, pair[hit], place[hit])
        return self.keys[self.code[first]]


def nearest(group: np.ndarray, p: np.ndarray, q: np.ndarray, score: np.ndarray, most: int) -> np.ndarray:
    """Places of the pairs of roots p and q in a group that have the least scores, so many of each two roots."""
    low, high = np.minimum(p, q), np.maximum(p, q)
    order = np.lexsort((score, high, low, group))
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([v[order[1:]] != v[order[:-1]] for v in (group, low, high)])
    place = np.arange(len(order))
    return order[place - np.maximum.accumulate(np.where(new, place, 0)) < most]


def met(index: DataFrame, key: tuple[str, ...], similarity: float, most: int | None = None) -> DataFrame:
    """a, b: nodes of rows (node, root, n, pos, sketch and maybe keys) in one group of the key that have different roots
    and may be alike; with most only so many of each two roots in a group, those whose sketches differ least. A group has
    a bounded number of rows. With keys, all that a node has in the order of its prefix, a pair is made only under the first
    one that both have.

    Under the first key that two sets share nothing before it is common, so what comes from there on must do for the
    similarity; under other keys the pair is not wanted."""
    listed = "keys" in index.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in frames(batches, LISTED if listed else ROWS, key):
            node, root, n, pos = (t[c].to_numpy().astype(np.int64) for c in ("node", "root", "n", "pos"))
            bits, keys = folded(t["sketch"]), Lists(t["keys"]) if listed else None
            own, group = t["key"].to_numpy(), numbered(t, key)
            for i, j in pairs(group):
                need = np.ceil(similarity / (1 + similarity) * (n[i] + n[j]) - _EPS)
                ok = (root[i] != root[j]) & (np.minimum(n[i] - pos[i], n[j] - pos[j]) >= need)
                i, j = i[ok], j[ok]
                differ = np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1)
                ok = differ <= alike_bits(similarity, n[i] + n[j])
                i, j, differ = i[ok], j[ok], differ[ok]
                if listed:
                    mine = np.zeros(len(i), bool)
                    for k in range(0, len(i), 1 << 14):
                        some = slice(k, k + (1 << 14))
                        mine[some] = keys.first_common(i[some], j[some]) == own[i[some]]
                    i, j, differ = i[mine], j[mine], differ[mine]
                if most is not None:
                    some = nearest(group[i], root[i], root[j], differ / np.maximum(n[i] + n[j], 1), most)
                    i, j = i[some], j[some]
                if len(i):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(node[i], node[j])), pa.array(np.maximum(node[i], node[j]))], ["a", "b"])

    return index.repartition(*key).sortWithinPartitions(*key).mapInArrow(lean(run), "a long, b long")


def unlike(index: DataFrame) -> DataFrame:
    """key, total, of the keys (of rows key, root) under which there are several roots."""
    keys = index.groupBy("key").agg(F.count(F.lit(1)).alias("total"), F.min("root").alias("p"), F.max("root").alias("q"))
    return keys.where("p < q").select("key", "total")


def several(index: DataFrame, hot: np.ndarray) -> DataFrame:
    """index (key, root and others) with the number of a key's rows as total, without keys all of whose rows have one root.

    A window over the key takes one shuffle. The keys known to be hot are counted by partial aggregates and joined, so
    that no task gets all rows of one."""
    whole = Window.partitionBy("key")
    counted = lambda df: df.withColumns({"total": F.count(F.lit(1)).over(whole), "p": F.min("root").over(whole), "q": F.max("root").over(whole)}).where("p < q").drop("p", "q")
    if not len(hot):
        return counted(index)
    keys = F.broadcast(index.sparkSession.createDataFrame([(int(k),) for k in hot], "key long"))  # COMMON at most
    out = index.join(keys, "key", "left_semi")
    return counted(index.join(keys, "key", "left_anti")).unionByName(out.join(unlike(out), "key"))


def groups(corpus: Corpus, edges: DataFrame, pivots: int = 3, dense: int = DENSE) -> DataFrame:
    """node, root of all nodes with a link, those of edges (a, b: some that are alike) among them.

    First each node is compared with one pivot of each shingle that it shares (with ``pivots`` of those that more than
    ``dense`` nodes share). That brings groups together and makes no more pairs than rows; fewer, as all shingles prefer
    the same pivots. Then nodes of different groups that still share a shingle are compared, with sketches and in cells of
    a bounded size where there are many. In a crowd of near copies most of what could be compared is of the same few
    groups, so the nearest pairs of each two groups come first (MOST), and all that are still apart only at the end.
    """
    similarity = corpus.similarity
    roots = cut(components(edges))
    mixed, _ = stored(several(rooted(corpus.sets.select("node", "n", F.posexplode("prefix").alias("pos", "key")), roots), corpus.hot))
    crowded, sparse = mixed.where(F.col("total") > dense), mixed.where(F.col("total") <= dense)
    some = not crowded.isEmpty()
    may = lambda p: (F.col("root") != F.col(f"{p}.root")) & (F.least("n", f"{p}.n") >= F.lit(similarity) * F.greatest("n", f"{p}.n") - _EPS)
    pair = lambda p: [F.least("node", f"{p}.node").alias("a"), F.greatest("node", f"{p}.node").alias("b")]
    pivot = lambda s: F.min(F.struct(F.xxhash64("node", F.lit(s)).alias("by"), "node", "root", "n"))
    tried = sparse.withColumn("p", pivot(0).over(Window.partitionBy("key"))).where(may("p")).select(*pair("p"))
    if some:
        chosen = crowded.groupBy("key").agg(*[pivot(s).alias(f"p{s}") for s in range(pivots)]).select("key", F.explode(F.array(*[f"p{s}" for s in range(pivots)])).alias("p"))
        tried = tried.unionByName(crowded.join(chosen, "key").where(may("p")).select(*pair("p")))
    done = cut(tried.distinct())  # pairs that are linked or proved unlike, and need not be looked at again
    edges = edges.unionByName(corpus.verified(possible(done, corpus)))
    roots = cut(components(edges))
    sketches = corpus.sets.select("node", F.col("quad").alias("sketch"))
    sparse = cut(apart(sparse, roots).join(sketches, "node"))
    if some:
        again = cut(apart(crowded, roots))
        keys = again.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("pos", "key")))["key"].alias("keys"))  # of a prefix at most
        crowded = cut(again.join(keys, "node").join(sketches, "node"))
    for most in MOST:
        found = met(sparse, ("key",), similarity, most)
        if some:
            found = found.unionByName(met(dealt(crowded), CELL, similarity, most))
        found = cut(found.distinct())
        if found.isEmpty():
            break
        found = cut(found.join(done, ["a", "b"], "left_anti"))
        done = done.unionByName(found)
        more = corpus.verified(possible(found, corpus))
        if more.isEmpty():
            continue
        edges = edges.unionByName(more)
        roots = cut(components(edges))
        if most is not None:
            sparse = cut(apart(sparse, roots))
            crowded = cut(apart(crowded, roots)) if some else crowded
    return roots


def apart(index: DataFrame, roots: DataFrame) -> DataFrame:
    """index with the present roots, without keys all of whose rows have one root. Two nodes of different roots keep all
    keys that they share."""
    rows = rooted(index, roots)
    return rows.join(unlike(rows).select("key"), "key", "left_semi")


def possible(candidates: DataFrame, corpus: Corpus) -> DataFrame:
    """Those of the candidates (a, b) that their sketches do not rule out; one is less than twice as large as the other."""
    candidates = cut(candidates.distinct())
    wanted = candidates.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    some = cut(corpus.rows.select("node", "n", "sketch").join(wanted, "node", "left_semi").dropDuplicates(["node"]))
    side = lambda x: some.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))
    least = F.least(F.size("s_a"), F.size("s_b"))
    fold = lambda c: F.when(F.size(c) == least, F.col(c)).otherwise(F.zip_with(F.slice(c, 1, least), F.slice(c, least + 1, least), lambda x, y: x.bitwiseXOR(y)))
    differ = F.aggregate(F.zip_with(fold("s_a"), fold("s_b"), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
    return candidates.join(side("a"), "a").join(side("b"), "b").where(differ <= alike_bits(corpus.similarity, F.col("n_a") + F.col("n_b"))).select("a", "b")
