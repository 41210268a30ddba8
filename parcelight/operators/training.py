"""Training elements: chunks joined with their normalisation, in a shuffled order, and reductions of activations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NORMALIZERS = ("to_meanstd", "to_medianstd", "to_perc99")


def elements(chunks: DataFrame, metadata: DataFrame, folds: list[int] | None = None, n_bands: int = 4) -> DataFrame:
    """Chunk rows with norm_perc99 and norm_meanstd_{mean, median, std} as arrays of the bands.

    Rows meet on chunk and chunk_pos, never by their order; with folds only those of the folds.
    """
    wanted = metadata if folds is None else metadata.where(F.col("fold").isin(folds))
    arrays = [F.array(*[F.col(f"{n}_b{i}") for i in range(n_bands)]).alias(n) for n in ("norm_perc99", "norm_meanstd_mean", "norm_meanstd_median", "norm_meanstd_std")]
    return chunks.join(wanted.select("chunk", "chunk_pos", *arrays), ["chunk", "chunk_pos"])


def normalised(features: Column, how: str) -> Column:
    """A pixel's bands (an array) normalised by the element's arrays."""
    if how not in NORMALIZERS:
        raise ValueError(f"{how} is none of {NORMALIZERS}")
    if how == "to_perc99":
        return F.zip_with(features, "norm_perc99", lambda x, p: x / p)
    centred = F.zip_with(features, "norm_meanstd_mean" if how == "to_meanstd" else "norm_meanstd_median", lambda x, m: x - m)
    return F.zip_with(centred, "norm_meanstd_std", lambda x, s: x / s)


def draw(keys: list[Column], seed: int, epoch: int) -> Column:
    """A number that orders rows by chance: another one in each epoch, the same in every run."""
    return F.md5(F.concat_ws("|", *[F.coalesce(k.cast("string"), F.lit("")) for k in keys], F.lit(str(seed)), F.lit(str(epoch))))


def shuffled(rows: DataFrame, keys: list[str], seed: int = 0, epoch: int = 0) -> DataFrame:
    """Rows in a random order, sorted by ranges over all partitions. keys tell rows apart: the order follows from them, the
    seed and the epoch, not from how rows come in, so a task that is run again gives the same."""
    return rows.withColumn("_draw", draw([F.col(k) for k in keys], seed, epoch)).orderBy("_draw", *keys).drop("_draw")


def interleaved(rows: DataFrame, chunk: str, pos: str, cycle: int, block: int, seed: int = 0, epoch: int = 0) -> DataFrame:
    """Rows with stage, turn, lane: in the order of these and pos, block rows of each of about cycle chunks alternate, as a
    reader of several files at a time sees them. Which chunks come together, and when, is drawn anew in each epoch.

    Chunks are dealt to stages by their draw, so no list of all chunks is put in order; a stage has about cycle of them.
    """
    chunks = rows.select(F.col(chunk).alias("_chunk")).distinct()
    stages = max(1, -(-chunks.count() // cycle))
    drawn = chunks.withColumn("_draw", draw([F.col("_chunk")], seed, epoch))
    drawn = drawn.withColumn("stage", (F.conv(F.substr("_draw", F.lit(1), F.lit(8)), 16, 10).cast("long") % stages).cast("int"))
    drawn = drawn.withColumn("lane", F.row_number().over(Window.partitionBy("stage").orderBy("_draw", "_chunk")) - 1)
    placed = rows.join(drawn.drop("_draw"), F.col(chunk).eqNullSafe(F.col("_chunk"))).drop("_chunk")
    return placed.withColumn("turn", F.floor(F.col(pos) / block).cast("int"))


def batches(rows: DataFrame, size: int) -> Iterator[list]:
    """Lists of rows for a trainer, fetched partition by partition; the last may be shorter."""
    held = []
    for row in rows.toLocalIterator(prefetchPartitions=True):
        held.append(row)
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


def clusters(activations: DataFrame, features: str, k: int, seed: int = 42) -> DataFrame:
    """Activations (arrays) with their k-means cluster."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    made = activations.withColumn("_vector", array_to_vector(F.col(features).cast("array<double>")))
    model = KMeans(k=k, seed=seed, featuresCol="_vector", predictionCol="cluster").fit(made)
    return model.transform(made).drop("_vector")


def saliency(gradients: np.ndarray) -> np.ndarray:
    """Greatest absolute gradient over the channels, stretched to [0, 1]."""
    x = np.abs(gradients).max(axis=-1)
    return (x - x.min()) / max(float(x.max() - x.min()), 1e-16)


def class_activation(outputs: np.ndarray, gradients: np.ndarray, eps: float = 1e-16) -> np.ndarray:
    """Channels weighted by their mean gradient, negative parts dropped, stretched to [0, 1]."""
    x = np.maximum((outputs * gradients.mean(axis=(0, 1))).sum(axis=-1), 0)
    return (x - x.min()) / (x.max() - x.min() + eps)
