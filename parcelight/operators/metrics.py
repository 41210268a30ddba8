"""Segmentation metrics from confusion counts, and averaging of models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def safe(a: Column, b: Column) -> Column:
    return a / F.nullif(b, F.lit(0))


def segmentation(pixels: DataFrame, keys: list[str], truth: str = "y", predicted: str = "p") -> DataFrame:
    """Accuracy, mean intersection over union, Matthews correlation and Tanimoto loss of binary classes."""
    y, p = F.col(truth), F.col(predicted)
    counted = pixels.groupBy(*keys).agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 0) & (p == 1)).alias("fp"), F.count_if((y == 1) & (p == 0)).alias("fn")
    )
    tp, tn, fp, fn = (F.col(c).cast("double") for c in ("tp", "tn", "fp", "fn"))
    tanimoto = lambda t, a, b: safe(t, t + a + b)  # noqa: E731  for 0/1 values: products over squares less products
    return counted.select(
        *keys,
        "tp", "tn", "fp", "fn",
        safe(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        ((tanimoto(tp, fp, fn) + tanimoto(tn, fp, fn)) / 2).alias("mean_iou"),
        safe(tp * tn - fp * fn, F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))).alias("mcc"),
        (1 - (tanimoto(tp, fp, fn) + tanimoto(tn, fp, fn)) / 2).alias("tanimoto_loss"),
    )


def soft_tanimoto(pixels: DataFrame, keys: list[str], truth: str = "y", probability: str = "p") -> DataFrame:
    """keys, tanimoto, loss of probabilities against 0/1 truth: products over squares less products, the mean of both
    classes. Rows with a null in either go; null where a class has nothing to divide by."""
    y, p = F.col(truth).cast("double"), F.col(probability).cast("double")
    some = pixels.where(y.isNotNull() & p.isNotNull())

    def shared(a: Column, b: Column) -> Column:
        product = F.sum(a * b)
        return safe(product, F.sum(a * a) + F.sum(b * b) - product)

    out = some.groupBy(*keys).agg(((shared(y, p) + shared(1 - y, 1 - p)) / 2).alias("tanimoto"))
    return out.withColumn("loss", 1 - F.col("tanimoto"))


def average_weights(models: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """The mean over models of each weight."""
    return models.groupBy(*keys).agg(F.avg(weight).alias("weight"), F.count(F.lit(1)).alias("models"))


def status_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def progress(log: DataFrame, done: str = "PROCESSED", failed: str = "FAILED") -> DataFrame:
    """Finished, failed and all items."""
    s = F.col("status")
    return log.agg(F.count_if(s == done).alias("finished"), F.count_if(s == failed).alias("failed"), F.count(F.lit(1)).alias("total"))
