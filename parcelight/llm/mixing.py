"""Mixing sources to target weights by the cube method.

Every document of a source has the same rate r = target / source size. It is taken floor(r) times, and once more with
the fractional rest as inclusion probability. The cube method makes these choices: probabilities move at random along
directions that keep both the words and the number of documents expected from a source, until all but two are 0 or 1.
Blocks of a bounded number of documents are moved on their own; what stays undecided in them meets in new blocks, round
by round, until one block per source is left. There the larger half of the documents moves first; its last two are
rounded (the landing), what that adds or takes is made up for by the smaller ones, and so on down to the smallest.
"""

from __future__ import annotations

import random
from functools import reduce
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, cut, numbered

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: No source and no document is taken more often than this.
MOST = 3
EPS = 1e-9
#: The sources' targets are sent to all executors if there are no more sources than this.
FEW = 20_000


def words(text_col: str) -> F.Column:
    return F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """source, source_size, n, target for the rows (source, size) of sized.

    Shares follow the weights; a source stops at most times its size and the rest is shared again. Sources whose limit
    per weight is lowest stop first, so running sums over that order give the final level in one pass.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    by = Window.orderBy("ratio", "rank")
    all_ = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    prior = by.rowsBetween(Window.unboundedPreceding, -1)
    rest = by.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
        .withColumn("rank", F.row_number().over(order))
        .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
        .withColumn("limit", F.col("source_size") * F.lit(float(most)))
        .withColumn("ratio", F.col("limit") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(all_))
        .withColumn("level", (F.col("total") - F.coalesce(F.sum("limit").over(prior), F.lit(0.0))) / F.sum("weight").over(rest))
        .withColumn("stopped", F.col("ratio") <= F.col("level"))
        .withColumn("final", F.first(F.when(~F.col("stopped"), F.col("level")), ignorenulls=True).over(all_))
        .withColumn("target", F.when(F.col("stopped"), F.col("limit")).otherwise(F.col("final") * F.col("weight")))
        .select("source", "rank", "source_size", "n", "target")
    )


def flight(p: np.ndarray, size: np.ndarray, rng: random.Random) -> np.ndarray:
    """Move the probabilities p, keeping sum(p) and sum(p * size), until at most two lie strictly between 0 and 1."""
    p, x = p.tolist(), size.tolist()
    live: list[int] = []
    for k in range(len(p)):
        if not EPS < p[k] < 1 - EPS:
            p[k] = float(round(p[k]))
            continue
        live.append(k)
        while len(live) == 3:
            a, b, c = live
            u = (x[c] - x[b], x[a] - x[c], x[b] - x[a])  # orthogonal to (1, 1, 1) and to the sizes
            if not any(u):
                u = (1, -1, 0)
            up = down = float("inf")
            for i, v in zip(live, u, strict=True):
                if v > 0:
                    up, down = min(up, (1 - p[i]) / v), min(down, p[i] / v)
                elif v < 0:
                    up, down = min(up, p[i] / -v), min(down, (1 - p[i]) / -v)
            step = up if rng.random() * (up + down) < down else -down
            for i, v in zip(live, u, strict=True):
                p[i] += step * v
                if p[i] < EPS:
                    p[i] = 0.0
                elif p[i] > 1 - EPS:
                    p[i] = 1.0
            live = [i for i in live if 0.0 < p[i] < 1.0]
    return np.array(p)


def landing(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Round the few open probabilities so that the words, then the documents, come nearest to what is expected."""
    out, open_ = p.copy(), np.flatnonzero((p > 0) & (p < 1))
    if len(open_):
        x, q = size[open_], p[open_]
        out[open_] = min(product((0.0, 1.0), repeat=len(open_)), key=lambda s: (round(abs(float(np.dot(np.array(s) - q, x))), 6), round(abs(float(sum(s) - q.sum())), 6), s))
    return out


def settle(p: np.ndarray, size: np.ndarray, rng: random.Random) -> np.ndarray:
    """Decide all: flight and landing over the larger half by size, then the same for the rest.

    The words that a landing gains or loses are first taken from the probabilities of the documents still to come, so
    that what is left over at the end is the rounding of the smallest.
    """
    out = p.copy()
    todo = np.flatnonzero((p > EPS) & (p < 1 - EPS))
    out[p <= EPS], out[p >= 1 - EPS] = 0.0, 1.0
    todo = todo[np.argsort(-size[todo], kind="stable")]
    owed = 0.0
    while len(todo):
        now, todo = np.split(todo, [-(-len(todo) // 2)])
        x = size[now].astype(np.float64)
        for _ in range(8):  # at most a few rounds, as probabilities that reach 0 or 1 can't move further
            room = np.where(owed > 0, 1 - out[now], out[now]) * x
            if abs(owed) < EPS or room.sum() < EPS:
                break
            move = np.clip(owed / room.sum(), -1, 1) * room
            out[now] = np.clip(out[now] + np.divide(move, x, out=np.zeros_like(x), where=x > 0), 0, 1)
            owed -= float(move.sum())
        before = float(np.dot(out[now], x))
        out[now] = landing(flight(out[now], size[now], rng), size[now])
        owed += before - float(np.dot(out[now], x))
    return out


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, most: float = MOST, block: int = 2000, seed: int = 9) -> DataFrame:
    """How often the mix takes each row of docs.

    Returns doc_id, text_hash, source, size, source_size, target, copies, taken (copies x size); one row for each input
    row. A null text has size 0. A null source is a source of its own, the last. Documents without words are drawn like
    others and take no words. Repeated rows are drawn one by one, and spread over
    the blocks like others. Choices depend on the ids, the texts and the seed
    alone, so reruns agree. An empty table gives no rows. Other columns of docs are ignored.
    """
    sized = numbered(docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(source_col).cast("string").alias("source"), words(text_col).alias("size")))
    goal = cut(targets(sized, weights, most))
    if goal.count() <= FEW:
        goal = F.broadcast(goal)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    one = F.xxhash64("doc_id", "text_hash", F.lit(seed))
    pick = F.when(F.col("nth") == 0, one).otherwise(F.xxhash64(one, "nth"))  # copies leave other rows' picks as they are
    drawn = (
        sized.join(goal, sized["source"].eqNullSafe(goal["source"]))
        .drop(goal["source"])
        .withColumn("rate", rate)
        .withColumn("whole", F.floor(F.col("rate") + F.lit(EPS)))
        .withColumn("p", F.greatest(F.col("rate") - F.col("whole"), F.lit(0.0)))
        .select("doc_id", "text_hash", "source", "size", "source_size", "target", "whole", "rank", "n", "p", pick.alias("pick"))
    )
    schema = "doc_id long, text_hash long, source string, size long, source_size long, target double, whole long, rank int, p double, pick long, block long, blocks long"

    def moved(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "pick", "doc_id"], ascending=[False, True, True], kind="stable").reset_index(drop=True)  # the smallest stay open longest
        rank, b, blocks = (int(pdf[c].iloc[0]) for c in ("rank", "block", "blocks"))
        size = pdf["size"].to_numpy(np.int64)
        p, rng = pdf["p"].to_numpy(np.float64), random.Random(f"{seed} {rank} {blocks} {b} {len(pdf)}")
        if blocks == 1:
            pdf["p"] = settle(p, size, rng)
        elif b > 0:  # block 0 waits for the last round, where its small documents even out what the large ones leave
            pdf["p"] = flight(p, size, rng)
        return pdf

    names = [x.split()[0] for x in schema.split(", ")]
    blocks = lambda n: F.when(n <= 4 * block, F.lit(1)).otherwise(F.ceil(n / block)).cast("long")
    done, open_ = [], drawn.withColumn("blocks", blocks(F.col("n")))
    while True:
        dealt = open_.withColumn("block", F.pmod(F.col("pick"), F.col("blocks"))).select(names)
        state = cut(dealt.groupBy("rank", "block").applyInPandas(moved, schema))
        decided = F.col("p").isin(0.0, 1.0)
        done.append(state.filter(decided))
        left = state.filter(~decided).drop("block", "blocks").withColumn("pick", F.xxhash64("pick", F.lit(seed)))
        if left.isEmpty():
            break
        open_ = left.join(left.groupBy("rank").agg(blocks(F.count(F.lit(1))).alias("blocks")), "rank")
    out = reduce(DataFrame.unionByName, done)
    copies = (F.col("whole") + F.col("p")).cast("long")
    return out.select("doc_id", "text_hash", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
