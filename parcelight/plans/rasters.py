"""Queries over images and mosaics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import kernels
from ..operators import focal, mosaic, raster, sampling
from ..sources import fixtures as fx
from .registry import query
from .tabular import _h, rounded

DISK2 = "disk as (select i, j from range(-2, 3) a(i), range(-2, 3) b(j) where i * i + j * j <= 4)"


@query(f"with {fx.IMG8} select img, row, col, round(greatest(least(1 + v - (case when v > 0 then 0.5 else 0.25 end), 2.0), 0.0), 6) as combined from img8")
def combine_extent_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    edge = F.when(F.col("v") > 0, 0.5).otherwise(0.25)
    return fx.img8(spark, sf_dir).select("img", "row", "col", F.round(raster.combine_extent_boundary(F.col("v"), edge), 6).alias("combined"))


@query(f"with {fx.IMG8} select img, row, col, round((v - min(v) over w) / nullif(max(v) over w - min(v) over w, 0), 6) as scaled from img8 window w as (partition by img)")
def minmax_rescale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(raster.rescale(fx.img8(spark, sf_dir), "img", "v").select("img", "row", "col", "scaled"), [])


@query(f"with {fx.IMG8}, g as (select a.i::int as row, b.j::int as col from range(14) a(i), range(14) b(j)) select img, g.row, g.col, v from g join img8 on img8.row = greatest(0, least(7, g.row - 3)) and img8.col = greatest(0, least(7, g.col - 3))")
def pad_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.pad_edge(fx.img8(spark, sf_dir), "img", 8, 8, 3)


@query(f"with {fx.IMG8} select img, row - 2 as row, col - 2 as col, v from img8 where row between 2 and 5 and col between 2 and 5")
def crop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.crop(fx.img8(spark, sf_dir), 8, 8, 2)


@query(f"with {fx.IMG8} select img, row, 7 - col as col, v from img8")
def flip_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.flip_left_right(fx.img8(spark, sf_dir), 8)


@query(f"with {fx.IMG8} select img, 7 - row as row, col, v from img8")
def flip_ud(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.flip_up_down(fx.img8(spark, sf_dir), 8)


@query(f"with {fx.IMG8} select img, 7 - col as row, row as col, v from img8")
def rot90(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.rot90(fx.img8(spark, sf_dir), 8, 1)


@query(f"with {fx.IMG8} select img, row, col, round(v + 0.1, 6) as bright, round((v - avg(v) over (partition by img)) * 1.1 + avg(v) over (partition by img), 6) as contrasted from img8")
def brightness_contrast(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = raster.contrast(fx.img8(spark, sf_dir), "img", "v", 1.1)
    return rounded(out.select("img", "row", "col", raster.brightness(F.col("v"), 0.1).alias("bright"), "contrasted"), [])


def _d(name: str) -> str:
    return f"{_h(f'img::varchar || chr(124) || {name!r} || chr(124) || 0')} / 4294967296.0"


@query(f"""with {fx.IMG8}, a as (select img, row, v, v as label, case when {_d('lr')} < 0.5 then 7 - col else col end as col from img8),
  b as (select img, case when {_d('ud')} < 0.5 then 7 - row else row end as row, col, v, label, floor({_d('turn')} * 4)::int as k from a),
  c as (select img, case k when 1 then 7 - col when 2 then 7 - row when 3 then col else row end as row, case k when 1 then row when 2 then 7 - col when 3 then 7 - row else col end as col,
    v + ({_d('light')} * 2 - 1) * 0.1 as v, label, {_d('contrast')} * (1.1 - 0.9) + 0.9 as f from b)
  select img, row, col, label, round((v - avg(v) over (partition by img)) * f + avg(v) over (partition by img), 6) as v from c""")
def augmentation_consistent(spark: SparkSession, sf_dir: str) -> DataFrame:
    pixels = fx.img8(spark, sf_dir).withColumn("label", F.col("v"))
    out = raster.augment(pixels, "img", ["v"], 8)
    return rounded(out.select("img", "row", "col", "label", "v"), ["label"])


@query(f"with {fx.IMG8}, {DISK2} select a.img, a.row, a.col, round(avg(b.v), 6) as mean from img8 a, disk, img8 b where b.img = a.img and b.row = a.row + i and b.col = a.col + j group by all")
def disk_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(focal.disk_mean(fx.img8(spark, sf_dir), "img", "v", 2, 8, 8), [])


@query(f"with {fx.IMG8}, {DISK2} select a.img, a.row, a.col, max(b.v) as dilated from img8 a, disk, img8 b where b.img = a.img and b.row = a.row + i and b.col = a.col + j group by all")
def disk_dilation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return focal.disk_max(fx.img8(spark, sf_dir), "img", "v", 2, 8, 8)


@query(f"with {fx.EXT8}, {DISK2} select a.img, a.row, a.col, (max(b.extent) > 0 and a.extent = 0)::int as boundary from ext8 a, disk, ext8 b where b.img = a.img and b.row = a.row + i and b.col = a.col + j group by a.img, a.row, a.col, a.extent")
def boundary_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return focal.boundary(fx.ext8(spark, sf_dir), "img", "extent", 2, 8, 8)


def _tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("img"), F.lit(8).alias("h"), F.lit(8).alias("w"), F.transform("embedding", lambda v: (v > 0).cast("double")).alias("px"))


_DIST = "dist as (select a.img, a.row, a.col, case when a.extent = 0 then 0.0 else sqrt(min((a.row - b.row) ** 2 + (a.col - b.col) ** 2)) end as distance from ext8 a join ext8 b on a.img = b.img and b.extent = 0 group by a.img, a.row, a.col, a.extent)"


@query(f"with {fx.EXT8}, {_DIST} select img, row, col, round(distance, 6) as distance from dist")
def distance_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(raster.to_pixels(focal.distance_transform(_tiles(spark, sf_dir), ["img"]), ["img"], "distance"), [])


_PARTS = """px as (select img, row * 8 + col as p, row, col from ext8 where extent = 1),
  edge as (select a.img, a.p as p, b.p as q from px a join px b on a.img = b.img and abs(a.row - b.row) <= 1 and abs(a.col - b.col) <= 1),
  reach as (select img, p, q from edge union select r.img, r.p, e.q from reach r join edge e on e.img = r.img and e.p = r.q),
  part as (select img, p, min(q) + 1 as component from reach group by 1, 2)"""


@query(f"with recursive {fx.EXT8}, {_PARTS} select e.img, e.row, e.col, coalesce(component, 0)::double as component from ext8 e left join part on part.img = e.img and part.p = e.row * 8 + e.col")
def connected_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.to_pixels(focal.connected_components(_tiles(spark, sf_dir), ["img"]), ["img"], "component")


@query(f"""with recursive {fx.EXT8}, {_DIST}, {_PARTS}, j as (select d.img, d.row, d.col, distance, component from dist d left join part on part.img = d.img and part.p = d.row * 8 + d.col)
  select img, row, col, round(case when component is null then 0 else distance / max(distance) over (partition by img, component) end, 5) as normalised from j""")
def normalised_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiles = _tiles(spark, sf_dir)
    d = raster.to_pixels(focal.distance_transform(tiles, ["img"]), ["img"], "distance")
    c = raster.to_pixels(focal.connected_components(tiles, ["img"]), ["img"], "component")
    out = focal.normalise_by_component(d.join(c, ["img", "row", "col"]), "img", "component", "distance")
    return out.select("img", "row", "col", F.round(F.col("normalised").cast("double"), 5).alias("normalised"))


def _grown(t: str, n: int, out: str) -> str:
    """SQL that doubles the n x n images of t (img, row, col, v) by cubic convolution and stretches them to [0, 1]."""
    return f"""{out}_t as (select o::int as o, k::int as k, abs((o + 0.5) / 2 - 0.5 - k) as t from range({2 * n}) a(o), range({n}) b(k)),
      {out}_n as (select o, k, case when t <= 1 then 1.5 * t ** 3 - 2.5 * t ** 2 + 1 else -0.5 * t ** 3 + 2.5 * t ** 2 - 4 * t + 2 end as w from {out}_t where t < 2),
      {out}_w as (select o, k, w / sum(w) over (partition by o) as w from {out}_n),
      {out}_r as (select img, o as row, col, sum(v * w) as v from {t} join {out}_w on k = row group by all), {out}_c as (select img, row, o as col, sum(v * w) as v from {out}_r join {out}_w on k = col group by all),
      {out} as (select img, row, col, (v - min(v) over (partition by img)) / (max(v) over (partition by img) - min(v) over (partition by img)) as v from {out}_c)"""


def _near(t: str, n: int, radius: int, made: str, out: str) -> str:
    """SQL with made, an aggregate over the disk of a radius, for each pixel of n x n images."""
    return f"""{out} as (select img, (row + i)::int as row, (col + j)::int as col, {made} as v from {t} join (select i, j from range(-{radius}, {radius + 1}) a(i), range(-{radius}, {radius + 1}) b(j) where i * i + j * j <= {radius * radius}) on true
      where row + i between 0 and {n - 1} and col + j between 0 and {n - 1} group by 1, 2, 3)"""


def _smooth(t: str, n: int, radius: int, out: str) -> str:
    return _near(t, n, radius, "avg(v)", f"{out}_m") + f", {out} as (select img, row, col, (v - min(v) over (partition by img)) / (max(v) over (partition by img) - min(v) over (partition by img)) as v from {out}_m)"


@query(f"with {fx.IMG8}, {_grown('img8', 8, 'up')} select img, row, col, round(v, 6) as v from up")
def bicubic_upscale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(raster.to_pixels(focal.on_tiles(_values(spark, sf_dir), ["img"], lambda x: kernels.upscale(x, 2)), ["img"]), [])


@query(
    f"with {fx.IMG8}, e as (select img, row, col, (v > 0)::int as v from img8), {_near('e', 8, 1, 'max(v)', 'd')}, c as (select i.img, i.row, i.col, least(2, greatest(0, 1 + i.v - (d.v > 0 and e.v = 0)::int)) as v from img8 i join e using (img, row, col) join d using (img, row, col)), "
    f"{_grown('c', 8, 'a')}, {_smooth('a', 16, 2, 'b')}, {_grown('b', 16, 'f')}, {_smooth('f', 32, 4, 'g')} select img, row, col, round(v, 6) as v from g"
)
def combine_upsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = focal.on_tiles(_values(spark, sf_dir), ["img"], lambda x: kernels.combine_upsample(x, kernels.boundary((x > 0).astype(float), 1).astype(float)))
    return rounded(raster.to_pixels(made, ["img"]), [])


def _values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The images as tiles."""
    return fx.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("img"), F.lit(8).alias("h"), F.lit(8).alias("w"), F.transform("embedding", lambda v: v.cast("double")).alias("px"))


@query()
def contour_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rings around positive ground, with their area."""
    from ..operators.vectorise import contour_rings

    t = fx.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("img"), F.lit(8).alias("h"), F.lit(8).alias("w"), F.transform("embedding", lambda v: v.cast("double")).alias("px"))
    return contour_rings(t, ["img"], 0.0)


@query(f"with {fx.IMG8}, {_near('img8', 8, 2, 'avg(v)', 'm')}, t as (select img, row, col, (v > 0)::int as v from m), {_near('t', 8, 1, 'max(v)', 'd')} select img, row, col, (v > 0)::int::double as cloud from d")
def cloud_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fx.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("img"), F.lit(8).alias("h"), F.lit(8).alias("w"), F.transform("embedding", lambda v: v.cast("double")).alias("px"))
    return raster.to_pixels(focal.on_tiles(t, ["img"], lambda x: kernels.cloud_mask(x, 4, 0.0, 3)), ["img"], "cloud")


def _weight_sql(top: str) -> str:
    return f"""with {fx.IMG8}, w as (select *, (case when col < 2 then col when col >= 6 then 7 - col else 1 end) * (case when row < 4 then {top} when row >= 4 then (7 - row) / 3 else 1 end) as weight from img8)
      select img, row, col, round(weight, 6) as weight, round(v * weight, 6) as weighted from w"""


def _weighted(spark: SparkSession, sf_dir: str, drift: bool) -> DataFrame:
    weight = mosaic.edge_weight(F.col("row"), F.col("col"), 8, 8, (1, 2), drift)
    return rounded(fx.img8(spark, sf_dir).withColumn("weight", weight).select("img", "row", "col", "weight", (F.col("v") * F.col("weight")).alias("weighted")), [])


@query(_weight_sql("row / 3"))
def edge_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images with the weights of their pixels: ramps of 2 columns and 4 rows."""
    return _weighted(spark, sf_dir, False)


@query(_weight_sql("((row * 8 + col) // 4) / 7"))
def edge_weights_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weighted(spark, sf_dir, True)


def _mosaic(spark: SparkSession, sf_dir: str) -> DataFrame:
    img = F.col("img")
    pixels = fx.img8(spark, sf_dir).withColumn("w", mosaic.edge_weight(F.col("row"), F.col("col"), 8, 8, (1, 1)))
    placed = mosaic.place(pixels.withColumn("zone", img % 25), F.floor(img / 25) % 5, F.floor(img / 125) % 4, 6)
    return mosaic.overlap_average(placed, ["zone", "g_row", "g_col"], "v", "w")


@query(f"""with {fx.IMG8}, placed as (select img % 25 as zone, ((img // 25) % 5) * 6 + row as g_row, ((img // 125) % 4) * 6 + col as g_col, v,
  (case when col < 2 then col / 1.0 when col >= 6 then (7 - col) / 1.0 else 1.0 end)::double * (case when row < 2 then row / 1.0 when row >= 6 then (7 - row) / 1.0 else 1.0 end)::double as w from img8)
  select zone, g_row, g_col, round(case when count(v) > 1 and sum(w) > 0 then sum(v * w) / sum(w) else avg(v) end, 6) as value, count(v) as n from placed group by 1, 2, 3""")
def overlap_weighted_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_mosaic(spark, sf_dir), [])


@query(f"""with {fx.IMG8}, placed as (select img % 25 as zone, ((img // 25) % 5) * 6 + row as g_row, ((img // 125) % 4) * 6 + col as g_col, v,
  (case when col < 2 then col / 1.0 when col >= 6 then (7 - col) / 1.0 else 1.0 end)::double * (case when row < 2 then row / 1.0 when row >= 6 then (7 - row) / 1.0 else 1.0 end)::double as w from img8),
  m as (select zone, g_row, g_col, case when count(v) > 1 and sum(w) > 0 then sum(v * w) / sum(w) else avg(v) end as value from placed group by 1, 2, 3)
  select zone, g_row - 4 as row, g_col - 3 as col, round(value, 6) as value from m where g_row between 4 and 13 and g_col between 3 and 12""")
def window_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(mosaic.read_window(_mosaic(spark, sf_dir), 4, 3, 10).select("zone", "row", "col", "value"), [])


def _ratio_sql(select: str, where: str) -> str:
    return f"""with {fx.EXT8}, wr as (select img, unnest(range(row - 3, row + 1))::int as row, col, extent from ext8), wc as (select img, row, unnest(range(col - 3, col + 1))::int as col, extent from wr),
      r as (select img, row, col, sum(extent) / 16.0 as ratio from wc where row between 0 and 4 and col between 0 and 4 group by 1, 2, 3) {select} {where}"""


def _ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    ext = fx.ext8(spark, sf_dir)
    return sampling.window_ratios(ext, "img", F.col("extent") > 0, 4).where("row <= 4 and col <= 4")


@query(_ratio_sql("select img, row, col, round(ratio, 6) as ratio from r", ""))
def window_valid_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_ratios(spark, sf_dir), [])


def _sample_sql(test: str) -> str:
    order = _h("img::varchar || chr(124) || row || chr(124) || col || chr(124) || 42")
    return _ratio_sql(f", n as (select *, row_number() over (partition by img order by {order}, row, col) - 1 as i from r where {test})", "select img, i::int as i, img || '_' || i as patchlet, row, col, round(ratio, 6) as ratio from n where i < 3")


@query(_sample_sql("ratio >= 0.5"))
def patchlet_windows_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(sampling.sample_windows(_ratios(spark, sf_dir), "img", 3, 0.5, True, 42), [])


@query(_sample_sql("ratio <= 0.4"))
def patchlet_windows_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(sampling.sample_windows(_ratios(spark, sf_dir), "img", 3, 0.4, False, 42), [])


@query(
    _sample_sql("ratio >= 0.5").replace("select img, i::int as i,", ", s as materialized (select img, i::int as i,")
    + "), o as materialized (select patchlet, img, row as r0, col as c0, unnest(range(16))::int as k from s) select o.patchlet, o.k // 4 as row, o.k % 4 as col, e.extent from o join ext8 e on e.img = o.img and e.row = o.r0 + o.k // 4 and e.col = o.c0 + o.k % 4"
)
def patchlet_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = sampling.sample_windows(_ratios(spark, sf_dir), "img", 3, 0.5, True, 42)
    return sampling.slice_windows(fx.ext8(spark, sf_dir), windows, "img", 4).select("patchlet", "row", "col", "extent")


@query("select p_partkey as id, p_size::int as row, (p_partkey % 40)::int as col, 300000.0 + 10 * (p_partkey % 40) as bbox_min_x, 6200000.0 - 10 * p_size - 2560 as bbox_min_y, 300000.0 + 10 * (p_partkey % 40) + 2560 as bbox_max_x, 6200000.0 - 10 * p_size as bbox_max_y from part")
def patchlet_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = fx.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").alias("row"), (F.col("p_partkey") % 40).cast("int").alias("col"))
    return sampling.patchlet_bbox(w, F.lit(300000.0), F.lit(6200000.0), 256)


@query("""with r as (select s_suppkey as id, (900 + s_suppkey % 9 * 250)::int as h, (s_suppkey % 7 * 333)::int as w from supplier), t as (select *, unnest(range(0, h, 490))::int as row from r), c as (select *, unnest(range(0, greatest(1, w), 490))::int as col from t)
  select id, row, col from c where col <= greatest(0, w - 10)""")
def chunk_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunks of rasters of many sizes."""
    k = F.col("s_suppkey")
    rasters = fx.table(spark, sf_dir, "supplier").select(k.alias("id"), (900 + k % 9 * 250).cast("int").alias("h"), (k % 7 * 333).cast("int").alias("w"))
    return mosaic.chunks(rasters, 500, 10).select("id", "row", "col")


@query(f"with {fx.IMG8} select img, row, col, v from img8 union all select img, row, col, v * 2 + 1 from img8")
def tiff_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images of two bands as TIFF files in a column, and their pixels again."""
    from ..sources import tiff

    doubled = F.transform("px", lambda v: v * 2 + 1)
    rasters = _values(spark, sf_dir).select(F.col("img").cast("string").alias("name"), "h", "w", F.array("px", doubled).alias("bands"))
    out = tiff.decoded(tiff.files_of(rasters, "f8"))
    pixels = raster.to_pixels(out.select(F.col("file").cast("long").alias("img"), "band", "h", "w", "px"), ["img", "band"])
    return pixels.select("img", "row", "col", "v")


@query(
    f"with {fx.IMG8}, e as (select img, row, col, (v > 0)::int as v from img8), {_near('e', 8, 1, 'max(v)', 'd')}, c as (select i.img, i.row, i.col, least(2, greatest(0, 1 + i.v - (d.v > 0 and e.v = 0)::int)) as v from img8 i join e using (img, row, col) join d using (img, row, col)), "
    f"{_grown('c', 8, 'a')}, {_smooth('a', 16, 2, 'b')}, {_grown('b', 16, 'f')}, {_smooth('f', 32, 4, 'g')} select img, row, col, round(v, 6) as v from g"
)
def combine_upsample_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As combine_upsample, in blocks that are put together again."""
    t = _values(spark, sf_dir).withColumn("e", F.col("px")).repartition(4 * spark.sparkContext.defaultParallelism)
    edge = focal.on_tiles(t, ["img", "e"], lambda x: kernels.boundary((x > 0).astype(float), 1).astype(float), "b")
    made = focal.upsampled(edge, ["img"], 3)
    out = raster.to_pixels(made, ["img", "top", "left"])
    return rounded(out.select("img", (F.col("top") + F.col("row")).alias("row"), (F.col("left") + F.col("col")).alias("col"), "v"), [])
