"""Queries over observations and metadata: statistics, normalisation, scenes, folds, chunks, names, status."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names
from ..operators import metrics, raster, sampling, scenes, stats, training
from ..sources import fixtures as fx
from .registry import query

BANDS = ["b0", "b1", "b2", "b3"]
KEYS = ["patchlet", "ts"]
_Q = {"perc_1": 0.01, "perc_5": 0.05, "perc_95": 0.95, "perc_99": 0.99}


def _stat(s: str, i: int) -> str:
    b = f"b{i}"
    if s in _Q:
        return f"quantile_cont({b}, {_Q[s]})"
    return {"mean": f"avg({b})", "median": f"quantile_cont({b}, 0.5)", "std": f"stddev_pop({b})", "min": f"min({b})", "max": f"max({b})"}[s]


def rounded(df: DataFrame, keep: list[str], digits: int = 6) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.select(*[F.round(c, digits).alias(c) if kinds[c] in ("double", "float") and c not in keep else F.col(c) for c in df.columns])


IMAGES = fx.OBS + ", images as (select patchlet, ts, " + ", ".join(f"{_stat(s, i)} as {s}_b{i}" for i in range(4) for s in stats.STATS) + " from obs group by all)"
FACTORS = (
    IMAGES
    + ", factors as (select date_trunc('month', ts)::timestamp as month, "
    + ", ".join(f"avg({a}_b{i}) as {b}_b{i}" for a, b in (("perc_99", "norm_perc99"), ("mean", "norm_meanstd_mean"), ("median", "norm_meanstd_median"), ("std", "norm_meanstd_std")) for i in range(4))
    + ", count(*) as n_images from images group by 1)"
)


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.band_stats(fx.obs(spark, sf_dir), KEYS, BANDS)


def factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.monthly_factors(stats.band_stats(fx.obs(spark, sf_dir), KEYS, BANDS, ("mean", "median", "perc_99", "std")))


@query(f"with {IMAGES} select patchlet, ts, " + ", ".join(f"round({s}_b{i}, 6) as {s}_b{i}" for i in range(4) for s in stats.STATS) + " from images")
def patchlet_band_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(images(spark, sf_dir), [])


_N = [f"{b}_b{i}" for b in ("norm_perc99", "norm_meanstd_mean", "norm_meanstd_median", "norm_meanstd_std") for i in range(4)]


@query(f"with {FACTORS} select month, " + ", ".join(f"round({c}, 6) as {c}" for c in _N) + ", n_images from factors")
def monthly_norm_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(factors(spark, sf_dir), [])


@query(f"with {IMAGES} select date_trunc('month', ts)::timestamp as month, " + ", ".join(f"stddev_samp(mean_b{i})::float::double as mean_b{i}_std, avg(mean_b{i})::float::double as mean_b{i}_mean" for i in range(4)) + " from images group by 1")
def monthly_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Given in single precision: means of hundredths often end in an exact half of a decimal digit, never of a binary one."""
    out = stats.monthly_spread(images(spark, sf_dir))
    return out.select("month", *[F.col(c).cast("float").cast("double").alias(c) for c in out.columns if c != "month"])


_META = "meta as (select distinct eopatch, patchlet, ts from obs)"


@query(f"with {FACTORS}, {_META} select meta.eopatch, patchlet, ts, round(mean_b0, 6) as mean_b0, round(std_b3, 6) as std_b3, round(norm_perc99_b1, 6) as norm_perc99_b1, round(norm_meanstd_median_b2, 6) as norm_meanstd_median_b2 from meta join images using (patchlet, ts) join factors on month = date_trunc('month', ts)")
def norm_join_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = fx.obs(spark, sf_dir).select("eopatch", "patchlet", "ts").distinct()
    im = images(spark, sf_dir)
    out = stats.with_factors(meta, im, stats.monthly_factors(im), KEYS)
    return rounded(out.select("eopatch", "patchlet", "ts", "mean_b0", "std_b3", "norm_perc99_b1", "norm_meanstd_median_b2"), [])


_CAL = "calendar as (select month(month)::int as month_of_year, min(month) as period, arg_min(norm_meanstd_mean_b0, month) as mean_b0, arg_min(norm_meanstd_std_b0, month) as std_b0 from factors group by 1)"


@query(f"with {FACTORS}, {_CAL} select o_orderkey as scene, o_orderdate as ts, period, round(mean_b0, 6) as mean_b0, round(std_b0, 6) as std_b0, period is null as missing from orders left join calendar on month_of_year = month(o_orderdate)")
def predict_month_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = factors(spark, sf_dir).withColumnsRenamed({"norm_meanstd_mean_b0": "mean_b0", "norm_meanstd_std_b0": "std_b0"})
    scenes_ = fx.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("scene"), F.col("o_orderdate").alias("ts"))
    out = stats.for_scenes(scenes_, stats.calendar_factors(f, ["mean_b0", "std_b0"]))
    return rounded(out.select("scene", "ts", "period", "mean_b0", "std_b0", "missing"), [])


@query(f"with {IMAGES} select date_trunc('month', ts)::timestamp as month, round(max(perc_99_b1), 6) as perc_99_b1, round(max(std_b0), 6) as std_b0 from images group by 1")
def max_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(stats.max_by_period(images(spark, sf_dir), ["perc_99_b1", "std_b0"]), [])


@query(f"with {IMAGES} select patchlet, ts, round(mean_b0, 6) as mean_b0, round(avg(mean_b0) over (partition by date_trunc('month', ts)), 6) as mean_b0_month from images")
def month_window_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    im = stats.band_stats(fx.obs(spark, sf_dir), KEYS, BANDS, ("mean",))
    return rounded(stats.month_window_mean(im, "mean_b0").select("patchlet", "ts", "mean_b0", "mean_b0_month"), [])


def _normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    pixels = fx.obs(spark, sf_dir).withColumn("month", stats.month_period("ts"))
    return pixels.join(factors(spark, sf_dir), "month")


def _norm_sql(expr: str) -> str:
    return f"with {FACTORS} select o, l, " + ", ".join(f"round({expr.format(i=i)}, 5) as n{i}" for i in range(4)) + " from obs join factors on month = date_trunc('month', ts)"


@query(_norm_sql("(b{i} - norm_meanstd_mean_b{i}) / norm_meanstd_std_b{i}"))
def zscore_meanstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(stats.zscore(_normalised(spark, sf_dir), BANDS).select("o", "l", "n0", "n1", "n2", "n3"), [], 5)


@query(_norm_sql("(b{i} - norm_meanstd_median_b{i}) / norm_meanstd_std_b{i}"))
def zscore_medianstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(stats.zscore(_normalised(spark, sf_dir), BANDS, "median").select("o", "l", "n0", "n1", "n2", "n3"), [], 5)


@query(_norm_sql("b{i} / norm_perc99_b{i}"))
def perc99_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(stats.percentile_scale(_normalised(spark, sf_dir), BANDS).select("o", "l", "n0", "n1", "n2", "n3"), [], 5)


def _clear_sql(n: str) -> str:
    return f"with {fx.OBS} select patchlet, ts, count(*) filter (cloudy) as cloudy_px, count(*) filter (not valid) as invalid_px, round(count(*) filter (cloudy) / {n}, 6) as ratio from obs group by 1, 2 having count(*) filter (cloudy) / {n} < 0.3 and count(*) filter (not valid) = 0"


@query(_clear_sql("count(*)"))
def clear_scene_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scenes.clear_scenes(fx.obs(spark, sf_dir), KEYS, 0.3), [])


@query(_clear_sql("16"))
def clear_scene_filter_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scenes.clear_scenes(fx.obs(spark, sf_dir), KEYS, 0.3, 16), [])


_FRACTIONS = fx.OBS + ", fractions as (select eopatch, ts, avg(cloudy::int) as cloud_fraction, avg(valid::int) as valid_fraction from obs group by 1, 2)"


@query(f"with {_FRACTIONS} select eopatch, ts, round(cloud_fraction, 6) as cloud_fraction, round(valid_fraction, 6) as valid_fraction from fractions")
def scene_cloud_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scenes.scene_fractions(fx.obs(spark, sf_dir), ["eopatch", "ts"]), [])


@query(f"with {fx.OBS}, f as (select patchlet, ts, avg(cloudy::int) as cloud_fraction, avg(valid::int) as valid_fraction from obs group by 1, 2) select patchlet, ts, round(cloud_fraction, 6) as cloud_fraction, round(valid_fraction, 6) as valid_fraction from f where ts::date >= date '1996-01-01' and ts::date < date '1998-01-01' and cloud_fraction < 0.5 and valid_fraction = 1.0")
def usable_scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scenes.usable_scenes(scenes.scene_fractions(fx.obs(spark, sf_dir), KEYS), "1996-01-01", "1998-01-01", 0.5), [])


@query(f"with {fx.TS} select tile, event_id, round(v / 255.0, 6) as probability from ts_series where ts::date >= date '2024-01-10' and ts::date < date '2024-01-20'")
def cloud_probability(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = fx.ts_series(spark, sf_dir).where(scenes.in_interval(F.col("ts"), "2024-01-10", "2024-01-20"))
    return s.select("tile", "event_id", F.round(scenes.cloud_probability(F.col("v")), 6).alias("probability"))


@query(f"with {fx.TS} select tile, round(coalesce(quantile_cont(v, 0.5), 0), 6) as merged, count(v) as n from ts_series where ts::date >= date '2024-01-05' and ts::date < date '2024-01-25' group by 1")
def temporal_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = fx.ts_series(spark, sf_dir).where(scenes.in_interval(F.col("ts"), "2024-01-05", "2024-01-25"))
    return rounded(scenes.temporal_percentile(s, ["tile"], "v"), [])


@query(f"with {fx.OBS}, o2 as (select eopatch, o % 64 as px, case when not cloudy and valid then b1 end as v from obs) select eopatch, px, round(coalesce(quantile_cont(v, 0.9), 0), 6) as merged, count(v) as n from o2 group by 1, 2")
def masked_temporal_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    pixels = fx.obs(spark, sf_dir).withColumn("px", F.col("o") % 64)
    return rounded(scenes.masked_temporal_percentile(pixels, ["eopatch", "px"], "b1", 90), [])


def _h(x: str) -> str:
    return f"concat('0x', substr(md5({x}), 1, 8))::bigint"


_FOLD = f"({_h('patchlet::varchar || chr(124) || 7')} % 3 + 1)::int"


@query(f"with {fx.OBS} select distinct patchlet, {_FOLD} as fold from obs")
def fold_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.obs(spark, sf_dir).select("patchlet").distinct().withColumn("fold", sampling.fold(F.col("patchlet"), 3, 7))


@query(f"with {fx.OBS} select {_FOLD} as fold, count(*) as n, count(distinct patchlet) as patchlets from obs group by 1")
def fold_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.obs(spark, sf_dir).groupBy(sampling.fold(F.col("patchlet"), 3, 7).alias("fold")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("patchlet").alias("patchlets"))


_FIVE = f"({_h('patchlet::varchar || chr(124) || 7')} % 5 + 1)::int"


@query(f"""with {fx.OBS}, f as (select {_FIVE} as fold, count(*) as n from obs group by 1), t as (select range::int as test from range(1, 6)), o as (select test, list_filter([1, 2, 3, 4, 5], lambda x: x <> test) as others from t),
  v as (select test, others, others[({_h('test::varchar || chr(124) || 0')} % 4)::int + 1] as val from o)
  select test, val::int as val, array_to_string(list_filter(others, lambda x: x <> val), ',') as train, coalesce(sum(n) filter (where fold = test), 0)::bigint as n_test, coalesce(sum(n) filter (where fold = val), 0)::bigint as n_val, coalesce(sum(n) filter (where fold <> test and fold <> val), 0)::bigint as n_train from v, f group by all""")
def loo_fold_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each fold left out in turn, with the pixels that test, validate and train."""
    return sampling.fold_sizes(fx.obs(spark, sf_dir), sampling.fold(F.col("patchlet"), 5, 7), 5)


@query(f"""with {fx.OBS}, m as (select distinct eopatch, patchlet, ts from obs), n as (select *, row_number() over (partition by eopatch order by patchlet, ts) - 1 as n from m)
  select eopatch, patchlet, ts, n // 10 as chunk, n % 10 as chunk_pos from n""")
def chunk_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = fx.obs(spark, sf_dir).select("eopatch", "patchlet", "ts").distinct()
    out = sampling.assign_chunks(meta, "eopatch", ["patchlet", "ts"], 10)
    return out.withColumn("chunk_pos", F.col("chunk_pos").cast("long"))


@query(f"with {fx.MGRS} select key, name, ((case when upper(substr(name, 3, 1)) >= 'N' then 32600 else 32700 end) + substr(name, 1, 2)::int)::int as epsg from mgrs")
def mgrs_to_epsg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.mgrs(spark, sf_dir).withColumn("epsg", names.mgrs_to_epsg(F.col("name")))


@query("""with p as (select p_partkey as id, 's3/patchlets/eop_' || (p_partkey % 50) || '_' || p_partkey as path from part)
  select id, regexp_extract(path, '([^/]*)$', 1) as patchlet, regexp_replace(regexp_extract(path, '([^/]*)$', 1), '_[^_]*$', '') as eopatch,
  regexp_extract(path, '(\\d+)\\D*$', 1)::int as number, regexp_extract(path, '([^/]*)$', 1) || '-32634.tiff' as tiff, regexp_extract(path, '([^/]*)$', 1) like 'eop_1%' as chosen from p""")
def patchlet_name_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    p = fx.table(spark, sf_dir, "part").select(key.alias("id"), F.concat(F.lit("s3/patchlets/eop_"), (key % 50).cast("string"), F.lit("_"), key.cast("string")).alias("path"))
    name = names.basename(F.col("path"))
    return p.select("id", name.alias("patchlet"), names.eopatch_of(name).alias("eopatch"), names.trailing_number(F.col("path")).alias("number"), names.tiff_name(name, F.lit(32634)).alias("tiff"), name.startswith("eop_1").alias("chosen"))


@query("""with d as (select n_nationkey as tile, '2024-01-' || lpad((n_nationkey + 1)::varchar, 2, '0') || 'T10:00:00' as a, '2024-02-' || lpad((n_nationkey + 1)::varchar, 2, '0') || 'T11:30:00' as b from nation)
  select tile, 0 as t_idx, a::timestamp as ts from d union all select tile, 1, b::timestamp from d""")
def userdata_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.readers import userdata_dates

    key = F.col("n_nationkey")
    day = F.lpad((key + 1).cast("string"), 2, "0")
    inner = F.to_json(F.array(F.concat(F.lit("2024-01-"), day, F.lit("T10:00:00")), F.concat(F.lit("2024-02-"), day, F.lit("T11:30:00"))))
    raw = fx.table(spark, sf_dir, "nation").select(key.alias("tile"), F.to_json(F.struct(inner.alias("dates"))).alias("json"))
    return userdata_dates(raw, "json").select("tile", F.posexplode("dates").alias("t_idx", "ts"))


@query(f"with {fx.STATUS} select status, count(*) as n from status_log group by 1")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.status_counts(fx.status_log(spark, sf_dir))


@query(f"with {fx.STATUS} select count(*) filter (status = 'PROCESSED') as finished, count(*) filter (status = 'FAILED') as failed, count(*) as total from status_log")
def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.progress(fx.status_log(spark, sf_dir))


@query(f"with {fx.STATUS} select name from status_log where status = 'FAILED'")
def failed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.status_log(spark, sf_dir).where("status = 'FAILED'").select("name")


@query(f"""with {fx.LABELS} select px, 1 - p as not_p, p, (y = 0)::int as hot0, (y = 1)::int as hot1, (y = 2)::int as hot2,
  case when p = 1 then -2.0 else y::double end as filled, case when px = 10 then -1 else px end as replaced, round(((px - 3) / 7.0), 6) as scaled,
  case when y >= 1 - y then (case when y > 1 - y then 1 else 0 end) else 0 end as argmax from labels_pred""")
def encodings(spark: SparkSession, sf_dir: str) -> DataFrame:
    y, p, px = F.col("y"), F.col("p"), F.col("px")
    pair, hot = raster.one_minus(p), raster.one_hot(y, 3)
    broken = F.when(p == 1, F.lit(float("nan"))).otherwise(y.cast("double"))
    return fx.labels_pred(spark, sf_dir).select(
        "px",
        pair[0].alias("not_p"),
        raster.positive_class(pair).alias("p"),
        hot[0].alias("hot0"), hot[1].alias("hot1"), hot[2].alias("hot2"),
        raster.fill_nan(broken).alias("filled"),
        raster.replace_value(px, 10, -1).cast("long").alias("replaced"),
        F.round(raster.normalize(px, 7.0, 3.0), 6).alias("scaled"),
        raster.argmax(F.array(1 - y, y)).cast("int").alias("argmax"),
    )


@query(f"""with {fx.LABELS}, c as (select img, count(*) filter (y = 1 and p = 1) as tp, count(*) filter (y = 0 and p = 0) as tn, count(*) filter (y = 0 and p = 1) as fp, count(*) filter (y = 1 and p = 0) as fn from labels_pred group by 1)
  select img, tp, tn, fp, fn, round((tp + tn) / (tp + tn + fp + fn), 6) as accuracy, round((tp / nullif(tp + fp + fn, 0) + tn / nullif(tn + fp + fn, 0)) / 2, 6) as mean_iou,
  round((tp * tn - fp * fn) / nullif(sqrt((tp + fp)::double * (tp + fn) * (tn + fp) * (tn + fn)), 0), 6) as mcc,
  round(1 - (tp / nullif(tp + fp + fn, 0) + tn / nullif(tn + fp + fn, 0)) / 2, 6) as tanimoto_loss from c""")
def seg_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.segmentation(fx.labels_pred(spark, sf_dir), ["img"]), [])


@query("select l_linenumber as layer, l_partkey % 97 as idx, round(avg(l_discount), 6) as weight, count(*) as models from lineitem group by 1, 2")
def model_weight_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = fx.table(spark, sf_dir, "lineitem").select(F.col("l_linenumber").alias("layer"), (F.col("l_partkey") % 97).alias("idx"), "l_discount")
    return rounded(metrics.average_weights(w, ["layer", "idx"], "l_discount"), [])


@query(f"with {fx.TS} select event_id, tile, json_extract(props, '$.k')::int as k, month(ts)::int as month_of_year, ts::date as day from ts_series")
def event_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.ts_series(spark, sf_dir).select("event_id", "tile", F.from_json("props", "k int")["k"].alias("k"), F.month("ts").alias("month_of_year"), F.to_date("ts").alias("day"))


@query(f"""with {fx.OBS}, {fx.MGRS}, i as (select distinct ts as interval_start from obs), u as (select distinct case when upper(substr(name, 3, 1)) >= 'N' then 32600 else 32700 end + substr(name, 1, 2)::int as utm from mgrs) select interval_start, utm::int as utm from i, u""")
def interval_utm_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job for each month that has images and each zone that has tiles."""
    zones = fx.mgrs(spark, sf_dir).select(names.mgrs_to_epsg(F.col("name"))).distinct().collect()  # some 120 at most
    months = fx.obs(spark, sf_dir).select(F.col("ts").alias("interval_start")).distinct()
    return months.withColumn("utm", F.explode(F.array(*[F.lit(z[0]) for z in zones])))


@query(f"""with {FACTORS}, m as (select distinct eopatch, patchlet, ts from obs), n as (select *, row_number() over (partition by eopatch order by patchlet, ts) - 1 as n from m),
  k as (select eopatch, patchlet, ts, n // 10 as chunk, n % 10 as chunk_pos from n where {_FOLD} in (1, 2))
  select patchlet, ts, chunk, chunk_pos, round((mean_b0 - norm_meanstd_mean_b0) / norm_meanstd_std_b0, 5) as z0, round(mean_b1 / norm_perc99_b1, 5) as q1
  from k join images using (patchlet, ts) join factors on month = date_trunc('month', ts)""")
def training_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    im = images(spark, sf_dir)
    meta = fx.obs(spark, sf_dir).select("eopatch", "patchlet", "ts").distinct()
    placed = sampling.assign_chunks(meta, "eopatch", ["patchlet", "ts"], 10).withColumn("fold", sampling.fold(F.col("patchlet"), 3, 7))
    name = F.concat_ws("-", F.col("eopatch").cast("string"), F.col("chunk").cast("string"))
    info = stats.with_factors(placed, im, stats.monthly_factors(im), KEYS).withColumns({"number": F.col("chunk"), "chunk": name})
    chunks = placed.join(im, KEYS).select("patchlet", "ts", name.alias("chunk"), "chunk_pos", F.col("chunk").alias("number"), F.array("mean_b0", "mean_b1", "mean_b2", "mean_b3").alias("x"))
    made = training.elements(chunks, info, [1, 2])
    out = made.select("patchlet", "ts", F.col("number").alias("chunk"), F.col("chunk_pos").cast("long").alias("chunk_pos"), training.normalised(F.col("x"), "to_meanstd")[0].alias("z0"), training.normalised(F.col("x"), "to_perc99")[1].alias("q1"))
    return rounded(out, [], 5)


_DRAW = "md5(chunk || '|5|2')"


@query(f"""with {fx.OBS}, m as (select distinct eopatch, patchlet, ts from obs), n as (select *, row_number() over (partition by eopatch order by patchlet, ts) - 1 as n from m), k as (select patchlet, ts, eopatch || '-' || (n // 10) as chunk, n % 10 as pos from n),
  c as (select chunk, {_DRAW} as d, (select ceil(count(distinct chunk) / 8)::bigint from k) as stages from (select distinct chunk from k)), p as (select chunk, d, (concat('0x', substr(d, 1, 8))::bigint % stages)::int as stage from c),
  l as (select chunk, stage, (row_number() over (partition by stage order by d, chunk) - 1)::int as lane from p) select patchlet, ts, chunk, pos, stage, (pos // 4)::int as turn, lane from k join l using (chunk)""")
def interleaved_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The third epoch's order of elements: four rows each of some eight chunks in turn."""
    meta = fx.obs(spark, sf_dir).select("eopatch", "patchlet", "ts").distinct()
    placed = sampling.assign_chunks(meta, "eopatch", ["patchlet", "ts"], 10)
    rows = placed.select("patchlet", "ts", F.concat_ws("-", F.col("eopatch").cast("string"), F.col("chunk").cast("string")).alias("chunk"), F.col("chunk_pos").cast("long").alias("pos"))
    return training.interleaved(rows, "chunk", "pos", 8, 4, seed=5, epoch=2).select("patchlet", "ts", "chunk", "pos", "stage", "turn", "lane")


@query(f"with {fx.OBS}, s as (select patchlet % 10 as img, valid::int as y, b2 * 10 as p from obs), t as (select img, sum(y * p) as a, sum(y * y) + sum(p * p) - sum(y * p) as b, sum((1 - y) * (1 - p)) as c, sum((1 - y) * (1 - y)) + sum((1 - p) * (1 - p)) - sum((1 - y) * (1 - p)) as d from s group by 1) select img, round((a / b + c / d) / 2, 6) as tanimoto, round(1 - (a / b + c / d) / 2, 6) as loss from t")
def soft_tanimoto(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities from 0 to 1 against the validity of pixels."""
    pixels = fx.obs(spark, sf_dir).select((F.col("patchlet") % 10).alias("img"), F.col("valid").cast("int").alias("y"), (F.col("b2") * 10).alias("p"))
    return rounded(metrics.soft_tanimoto(pixels, ["img"]), [])
