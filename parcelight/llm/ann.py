"""Approximate nearest neighbours by an adaptive dimension scan over an inverted-list index.

Vectors are scaled to length 1, rotated by one random rotation and assigned to the nearest of a few centroids. A query
scans the lists of its nearest centroids. Within a list the rotated dimensions are read in blocks of columns: after a
random rotation the distance over the first d of D dimensions, times D / d, estimates the whole one, and a candidate is
abandoned as soon as a hypothesis test on that estimate says that it lies beyond the k-th nearest found so far. What
survives is ranked by the cosine of the original vectors in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, unsigned_fraction

#: Columns read at a time, and the width of the hypothesis test: a larger one abandons less and finds more.
COLUMNS, WIDTH = 16, 2.5
#: Vectors and queries that meet in one group at most.
BLOCK, QUERIES = 2000, 500


def rotation(dims: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(5).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def scaled(x: np.ndarray) -> np.ndarray:
    """The rows times a power of two each, so that squares of very large or small components neither overflow nor vanish;
    cosines stay as they are."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def centroids(x: np.ndarray, lists: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means of the rows of x, which have length 1."""
    c = x[np.random.default_rng(6).choice(len(x), min(lists, len(x)), replace=False)]
    for _ in range(rounds):
        near = (x @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        size = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        c = np.where(size > 1e-12, sums / np.maximum(size, 1e-12), c)
    return c


def scan(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, bound: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """(query, candidate, cosine) for up to k nearest of each query among the vectors x that the tests let through."""
    turn = rotation(x.shape[1])
    x, q = scaled(x), scaled(q)
    xr, qr = unit(x) @ turn, unit(q) @ turn
    dims, out = x.shape[1], []
    norm = np.sqrt((x * x).sum(axis=1))
    for i, own in enumerate(query_ids.tolist()):
        live = np.flatnonzero(ids != own)
        limit = 2 - 2 * bound[i] + 1e-9  # squared distance of the k-th nearest so far
        part = np.zeros(len(live))
        for d in range(0, dims, COLUMNS):
            part += ((xr[live, d : d + COLUMNS] - qr[i, d : d + COLUMNS]) ** 2).sum(axis=1)
            seen = min(d + COLUMNS, dims)
            stay = part * (dims / seen) <= limit * (1 + WIDTH / np.sqrt(seen)) ** 2 if seen < dims else part <= limit + 1e-9
            live, part = live[stay], part[stay]
            if not len(live):
                break
        if len(live) > 4 * k:
            live = live[np.argpartition(part, 4 * k)[: 4 * k]] if not _tied(part, k) else live
        if len(live):
            cosine = (x[live] * q[i]).sum(axis=1) / (norm[live] * np.sqrt((q[i] * q[i]).sum()))
            best = np.lexsort((ids[live], -cosine))[:k]
            out += [(own, int(ids[live[j]]), float(cosine[j])) for j in best]
    return out


def _tied(part: np.ndarray, k: int) -> bool:
    """Whether so many distances are equal to the k-th, but for rounding, that all must be ranked by cosine and id."""
    kth = np.partition(part, k - 1)[k - 1]
    return int((part <= kth + 1e-7).sum()) > 4 * k


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, lists: int = 64, probe: float = 0.85, sample: int = 10_000, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row of queries its k nearest rows of vectors, itself (by id) left out.

    score is the cosine in double precision; ties go to the smaller id. Both tables have the same columns. Vectors that
    are null, of another length than most, zero, or hold a null, NaN or infinite component take no part. An id that comes
    repeatedly counts once, with the least of its vectors. The centroids are fitted on about ``sample`` vectors drawn by hash; every vector is indexed.
    A query scans the part ``probe`` of the lists. Of vectors that are exactly equal only the k + 1 with the smallest ids
    are indexed, as ties go to them and no more can be among k nearest. An empty table gives no rows.
    """
    valid = lambda c: F.col(c).isNotNull() & F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))) & F.exists(c, lambda v: v != 0)
    clean = lambda df: df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(F.col("id").isNotNull() & valid("v"))
    rows = clean(vectors)
    sizes = sorted(rows.groupBy(F.size("v").alias("size")).count().collect(), key=lambda r: (-r["count"], r["size"]))
    if not sizes:
        return rows.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    dims, n = sizes[0]["size"], sizes[0]["count"]
    rows = rows.where(F.size("v") == dims)
    same = Window.partitionBy("v").orderBy("id")
    kept = rows.groupBy("id").agg(F.min("v").alias("v")).withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= k + 1).drop("nth")
    drawn = rows.where(unsigned_fraction(F.col("id"), F.lit(8)) < min(1.0, sample / n)).groupBy("id").agg(F.min("v").alias("v")).collect()  # about sample ids
    few = max(1, min(lists, round(n**0.5)))
    fitted = sorted(drawn, key=lambda r: (r["id"], r["v"])) or rows.orderBy("id").limit(1).collect()
    centers = centroids(unit(np.array([r["v"] for r in fitted], np.float64)), few)
    probes = max(1, int(np.ceil(probe * len(centers))))
    shared = vectors.sparkSession.sparkContext.broadcast(centers)  # lists x dimensions

    def placed(take: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    x = np.array(batch.column(1).flatten()).reshape(-1, dims)
                    near = np.argsort(-(unit(x) @ shared.value.T), axis=1, kind="stable")[:, :take].astype(np.int32)
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(near), pa.list_(pa.int32()))], ["id", "v", "near"])

        return run

    schema = "id long, v array<double>, near array<int>"
    index = cut(kept.mapInArrow(placed(1), schema).select("id", "v", F.col("near")[0].alias("list")))
    asked = cut(clean(queries).where(F.size("v") == dims).groupBy("id").agg(F.min("v").alias("v")).mapInArrow(placed(probes), schema))
    in_list = {r["list"]: r["count"] for r in index.groupBy("list").count().collect()}  # a row for each list

    def found(asks: DataFrame) -> DataFrame:
        """asks: id, v, list, bound."""
        wanted = {r["list"]: r["count"] for r in asks.groupBy("list").count().collect()}
        cells = [(c, -(-in_list[c] // BLOCK), -(-m // QUERIES)) for c, m in wanted.items() if c in in_list]
        if not cells:
            return asks.select(F.col("id").alias("query_id"), F.col("id").alias("vec_id"), F.col("bound").alias("score")).limit(0)
        cell = F.broadcast(vectors.sparkSession.createDataFrame(cells, "list int, rows int, asks int"))  # a row for each list
        part = lambda c: F.pmod(F.xxhash64("id", F.lit(9)), F.col(c).cast("long")).cast("int")
        every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
        left = index.join(cell, "list").withColumn("i", part("rows")).withColumn("j", every("asks")).select("list", "i", "j", "id", "v")
        right = asks.join(cell, "list").withColumn("j", part("asks")).withColumn("i", every("rows")).select("list", "i", "j", "id", "v", "bound")

        def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            hits = scan(a["id"].to_numpy(), np.stack(a["v"]), b["id"].to_numpy(), np.stack(b["v"]), b["bound"].to_numpy(), k) if len(a) and len(b) else []
            return pd.DataFrame(hits, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

        return left.groupBy("list", "i", "j").cogroup(right.groupBy("list", "i", "j")).applyInPandas(meet, "query_id long, vec_id long, score double")

    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    top = lambda df: df.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    # the nearest list first: its k-th cosine bounds what the others need to find
    first = cut(top(found(asked.select("id", "v", F.col("near")[0].alias("list"), F.lit(-1.0).alias("bound")))))
    bounds = first.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("bound"))
    others = asked.join(bounds, "id", "left").select("id", "v", F.coalesce("bound", F.lit(-1.0)).alias("bound"), F.explode(F.slice("near", 2, max(1, len(centers)))).alias("list"))
    hits = cut(top(first.drop("rank").unionByName(found(others))))
    # a query whose lists hold fewer than k candidates goes through all lists
    full = hits.groupBy(F.col("query_id").alias("id")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k).select("id")
    short = cut(asked.join(full, "id", "left_anti").select("id", "v"))
    if probes < len(centers) and not short.isEmpty():
        every = F.explode(F.sequence(F.lit(0), F.lit(len(centers) - 1))).alias("list")
        whole = top(found(short.select("id", "v", F.lit(-1.0).alias("bound"), every)))
        hits = hits.join(full, hits["query_id"] == full["id"], "left_semi").unionByName(whole)
    return hits.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
