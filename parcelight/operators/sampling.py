"""Patchlet windows, chunks and folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hashed(*cols: Column, digits: int = 8) -> Column:
    """A non-negative integer from the MD5 of the columns as text: the same number in any engine."""
    return F.conv(F.substr(F.md5(F.concat_ws("|", *[c.cast("string") for c in cols])), F.lit(1), F.lit(digits)), 16, 10).cast("bigint")


def candidate_windows(images: DataFrame, key: str, height: int, width: int, size: int, buffer: int = 0) -> DataFrame:
    """All windows of a tile that keep the buffer: top row in [buffer, height - size - buffer)."""
    span = lambda n: F.sequence(F.lit(buffer), F.lit(n - size - buffer - 1))
    return images.select(key, F.explode(span(height)).alias("row"), "height", "width").select(key, "row", F.explode(span(width)).alias("col")) if "height" in images.columns else images.select(key).distinct().withColumn("row", F.explode(span(height))).withColumn("col", F.explode(span(width)))


def window_ratios(pixels: DataFrame, key: str, value: Column, size: int) -> DataFrame:
    """Share of pixels with value in each size x size window, by running sums along columns, then along rows.

    Two window sums instead of a join of every window with its pixels. Pixels must cover whole rows and columns.
    """
    across = Window.partitionBy(key, "row").orderBy("col").rowsBetween(0, size - 1)
    down = Window.partitionBy(key, "col").orderBy("row").rowsBetween(0, size - 1)
    return (
        pixels.select(key, "row", "col", value.cast("long").alias("hit"))
        .withColumn("line", F.sum("hit").over(across))
        .withColumn("hits", F.sum("line").over(down))
        .select(key, "row", "col", (F.col("hits") / F.lit(float(size * size))).alias("ratio"))
    )


def sample_windows(ratios: DataFrame, key: str, num_samples: int, fraction: float, positive: bool = True, seed: int = 0) -> DataFrame:
    """Up to num_samples accepted windows for each tile, in a hashed order: patchlet {tile}_{i}, row, col, ratio.

    Positive sampling takes windows with at least the fraction of valid pixels, negative ones with at most that.
    """
    ok = F.col("ratio") >= fraction if positive else F.col("ratio") <= fraction
    order = Window.partitionBy(key).orderBy(hashed(F.col(key), F.col("row"), F.col("col"), F.lit(seed)), "row", "col")
    picked = ratios.where(ok).withColumn("i", F.row_number().over(order) - 1).where(F.col("i") < num_samples)
    return picked.select(key, "i", F.concat_ws("_", F.col(key).cast("string"), F.col("i").cast("string")).alias("patchlet"), "row", "col", "ratio")


def patchlet_bbox(windows: DataFrame, min_x: Column, max_y: Column, size: int, resolution: float = 10.0) -> DataFrame:
    """Windows with the map coordinates of their corners."""
    left, top = min_x + F.col("col") * resolution, max_y - F.col("row") * resolution
    return windows.withColumns({"bbox_min_x": left, "bbox_min_y": top - size * resolution, "bbox_max_x": left + size * resolution, "bbox_max_y": top})


def slice_windows(pixels: DataFrame, windows: DataFrame, key: str, size: int) -> DataFrame:
    """Pixels of each window, with coordinates from its corner: patchlet, row, col and what else pixels have.

    The join is on tile and on aligned blocks of the window's size, of which a window touches at most four.
    """
    block = lambda c: F.floor(F.col(c) / size)
    touched = F.array_distinct(F.flatten(F.array(*[F.array(F.struct(F.floor((F.col("row") + F.lit(a)) / size).alias("br"), F.floor((F.col("col") + F.lit(b)) / size).alias("bc"))) for a in (0, size - 1) for b in (0, size - 1)])))
    w = windows.select(key, "patchlet", F.col("row").alias("r0"), F.col("col").alias("c0"), F.explode(touched).alias("b")).select(key, "patchlet", "r0", "c0", "b.br", "b.bc")
    inside = F.col("row").between(F.col("r0"), F.col("r0") + size - 1) & F.col("col").between(F.col("c0"), F.col("c0") + size - 1)
    joined = pixels.withColumns({"br": block("row"), "bc": block("col")}).join(w, [key, "br", "bc"]).where(inside)
    return joined.withColumns({"row": F.col("row") - F.col("r0"), "col": F.col("col") - F.col("c0")}).drop("br", "bc", "r0", "c0")


def assign_chunks(rows: DataFrame, group: str, order: list[str], chunk_size: int) -> DataFrame:
    """chunk and chunk_pos within each group: chunk_size rows to a chunk, in a fixed order."""
    n = F.row_number().over(Window.partitionBy(group).orderBy(*order)) - 1
    return rows.withColumn("n", n).withColumns({"chunk": F.floor(F.col("n") / chunk_size), "chunk_pos": F.col("n") % chunk_size}).drop("n")


def fold(key: Column, n_folds: int, seed: int = 0) -> Column:
    """A fold from 1 to n_folds for each key: all rows of a tile share it, without a table of tiles."""
    return (hashed(key, F.lit(seed)) % n_folds + 1).cast("int")


def fold_plan(n_folds: int, seed: int = 0) -> list[dict]:
    """For each fold as test: the validation fold, drawn from the others, and the rest to train on."""
    import hashlib

    out = []
    for test in range(1, n_folds + 1):
        others = [f for f in range(1, n_folds + 1) if f != test]
        pick = int(hashlib.md5(f"{test}|{seed}".encode()).hexdigest()[:8], 16) % len(others)
        out.append({"test": test, "val": others[pick], "train": [f for f in others if f != others[pick]]})
    return out


def fold_sizes(rows: DataFrame, fold_: Column, n_folds: int, seed: int = 0) -> DataFrame:
    """test, val, train of the plan, with the rows that each of them has: n_test, n_val, n_train (0 where there are none)."""
    counts = rows.groupBy(fold_.alias("fold")).agg(F.count(F.lit(1)).alias("n"))
    role = lambda p: F.when(F.col("fold") == p["test"], "n_test").when(F.col("fold") == p["val"], "n_val").otherwise("n_train")
    plan = fold_plan(n_folds, seed)
    roles = F.array(*[F.struct(F.lit(p["test"]).alias("test"), F.lit(p["val"]).alias("val"), F.lit(",".join(map(str, p["train"]))).alias("train"), role(p).alias("role")) for p in plan])
    out = counts.withColumn("p", F.explode(roles)).select("p.*", "n")
    of = lambda name: F.coalesce(F.sum(F.when(F.col("role") == name, F.col("n"))), F.lit(0).cast("long")).alias(name)
    return out.groupBy("test", "val", "train").agg(of("n_test"), of("n_val"), of("n_train"))
