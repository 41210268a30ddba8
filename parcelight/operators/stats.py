"""Band statistics of images, monthly normalisation factors, and normalisation by them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STATS = ("mean", "median", "perc_1", "perc_5", "perc_95", "perc_99", "std", "min", "max")


def band_stats(pixels: DataFrame, keys: list[str], bands: list[str], stats: tuple[str, ...] = STATS) -> DataFrame:
    """One row for each image (keys), one column {stat}_b{i} for each statistic and band; std is of the population."""
    out = []
    for i, b in enumerate(bands):
        # one pass over a band's sorted values serves all of its percentiles
        ranks = F.percentile(b, F.array(*[F.lit(q) for q in (0.5, 0.01, 0.05, 0.95, 0.99)]))
        made = {"mean": F.avg(b), "median": ranks[0], "perc_1": ranks[1], "perc_5": ranks[2], "perc_95": ranks[3], "perc_99": ranks[4], "std": F.stddev_pop(b), "min": F.min(b), "max": F.max(b)}
        out += [made[s].alias(f"{s}_b{i}") for s in stats]
    return pixels.groupBy(*keys).agg(*out)


def month_period(ts: str) -> Column:
    return F.date_trunc("month", F.col(ts).cast("timestamp_ntz")).cast("timestamp_ntz")


def monthly_factors(stats: DataFrame, ts: str = "ts", n_bands: int = 4) -> DataFrame:
    """month, norm_perc99_b{i}, norm_meanstd_{mean,median,std}_b{i}: means over the month's images, and count."""
    means = [F.avg(f"{a}_b{i}").alias(f"{b}_b{i}") for a, b in (("perc_99", "norm_perc99"), ("mean", "norm_meanstd_mean"), ("median", "norm_meanstd_median"), ("std", "norm_meanstd_std")) for i in range(n_bands)]
    return stats.groupBy(month_period(ts).alias("month")).agg(*means, F.count(F.lit(1)).alias("n_images"))


def monthly_spread(stats: DataFrame, ts: str = "ts", n_bands: int = 4) -> DataFrame:
    """month and the sample standard deviation and mean of each image mean."""
    return stats.groupBy(month_period(ts).alias("month")).agg(*[f(f"mean_b{i}").alias(f"mean_b{i}_{n}") for i in range(n_bands) for n, f in (("std", F.stddev_samp), ("mean", F.avg))])


def with_factors(metadata: DataFrame, stats: DataFrame, factors: DataFrame, keys: list[str], ts: str = "ts") -> DataFrame:
    """Metadata rows with their image's statistics and their month's factors; rows without statistics go."""
    return metadata.join(stats, keys, "inner").withColumn("month", month_period(ts)).join(factors, "month", "left")


def calendar_factors(factors: DataFrame, columns: list[str]) -> DataFrame:
    """Factors for each month of the year: those of the first period with that month."""
    first = F.min_by(F.struct(*columns), "month")
    return factors.groupBy(F.month("month").alias("month_of_year")).agg(F.min("month").alias("period"), first.alias("f")).select("month_of_year", "period", "f.*")


def max_by_period(metadata: DataFrame, columns: list[str], ts: str = "ts") -> DataFrame:
    """The greatest value of each column in each month; NaN counts as missing."""
    return metadata.groupBy(month_period(ts).alias("month")).agg(*[F.max(F.nanvl(F.col(c), F.lit(None))).alias(c) for c in columns])


def for_scenes(scenes: DataFrame, calendar: DataFrame, ts: str = "ts") -> DataFrame:
    """Scenes with the factors of their month of the year; missing factors are an error of the row, not a lost row."""
    out = scenes.withColumn("month_of_year", F.month(ts)).join(F.broadcast(calendar), "month_of_year", "left")  # 12 rows
    return out.withColumn("missing", F.col("period").isNull())


def zscore(df: DataFrame, bands: list[str], subtract: str = "mean") -> DataFrame:
    """Bands less the month's mean (or median), divided by its deviation."""
    return df.withColumns({f"n{i}": (F.col(b) - F.col(f"norm_meanstd_{subtract}_b{i}")) / F.col(f"norm_meanstd_std_b{i}") for i, b in enumerate(bands)})


def percentile_scale(df: DataFrame, bands: list[str]) -> DataFrame:
    """Bands divided by the month's 99th percentile."""
    return df.withColumns({f"n{i}": F.col(b) / F.col(f"norm_perc99_b{i}") for i, b in enumerate(bands)})


def month_window_mean(stats: DataFrame, column: str, ts: str = "ts") -> DataFrame:
    """Each row with its month's mean of a column. Months are few and long, so their means are aggregated in parts and joined
    back; a window would put all rows of a month into one task."""
    month = month_period(ts)
    means = stats.groupBy(month.alias("_month")).agg(F.avg(column).alias(f"{column}_month"))
    return stats.join(means, month.eqNullSafe(F.col("_month"))).drop("_month")
