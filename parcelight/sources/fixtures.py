"""Virtual rasters and polygons over the driver's tables: each as a DataFrame and as the SQL that defines the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels with four bands, a cloud flag and a validity flag; an image is a (patchlet, month)."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") % 10).alias("eopatch"),
        F.col("l_suppkey").alias("patchlet"),
        F.date_trunc("month", "l_shipdate").cast("timestamp_ntz").alias("ts"),
        F.col("l_orderkey").alias("o"),
        F.col("l_linenumber").alias("l"),
        F.col("l_quantity").alias("b0"),
        F.col("l_extendedprice").alias("b1"),
        F.col("l_discount").alias("b2"),
        F.col("l_tax").alias("b3"),
        (F.col("l_returnflag") == "R").alias("cloudy"),
        (F.col("l_linestatus") == "F").alias("valid"),
    )


OBS = """obs as (select l_suppkey % 10 as eopatch, l_suppkey as patchlet, date_trunc('month', l_shipdate)::timestamp as ts,
  l_orderkey as o, l_linenumber as l, l_quantity as b0, l_extendedprice as b1, l_discount as b2, l_tax as b3,
  l_returnflag = 'R' as cloudy, l_linestatus = 'F' as valid from lineitem)"""


def img8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8 x 8 images with one value for each pixel."""
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("img"), F.posexplode("embedding").alias("pos", "e")).select(
        "img", F.floor(F.col("pos") / 8).cast("int").alias("row"), (F.col("pos") % 8).cast("int").alias("col"), F.col("e").cast("double").alias("v")
    )


IMG8 = """img8 as (select vec_id as img, (p // 8)::int as row, (p % 8)::int as col, embedding[p + 1]::double as v
  from embeddings, range(64) as r(p))"""


def ext8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary extents of the images."""
    return img8(spark, sf_dir).select("img", "row", "col", (F.col("v") > 0).cast("int").alias("extent"))


EXT8 = IMG8 + ", ext8 as (select img, row, col, (v > 0)::int as extent from img8)"


def ts_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of a few tiles over time, with a cloud flag."""
    return table(spark, sf_dir, "events").select((F.col("user_id") % 16).alias("tile"), "ts", F.col("value").alias("v"), (F.col("event_type") == "error").alias("cloudy"), "props", "event_id")


TS = "ts_series as (select user_id % 16 as tile, ts, value as v, event_type = 'error' as cloudy, props, event_id from events)"


def rects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Axis-parallel rectangles in two zones, at hashed places."""
    h = F.md5(F.col("p_partkey").cast("string"))
    at = lambda a: (F.conv(F.substr(h, F.lit(a), F.lit(8)), 16, 10).cast("bigint") % 500).cast("int")
    base = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), (F.col("p_partkey") % 2).cast("int").alias("zone"), at(1).alias("x0"), at(9).alias("y0"), "p_size")
    return base.select("id", "zone", "x0", "y0", (F.col("x0") + F.col("p_size") % 7 + 1).alias("x1"), (F.col("y0") + F.col("p_size") % 5 + 1).alias("y1"))


RECTS = """rects0 as (select p_partkey as id, (p_partkey % 2)::int as zone, (concat('0x', substr(md5(p_partkey::varchar), 1, 8))::bigint % 500)::int as x0,
  (concat('0x', substr(md5(p_partkey::varchar), 9, 8))::bigint % 500)::int as y0, p_size from part),
  rects as (select id, zone, x0, y0, (x0 + p_size % 7 + 1)::int as x1, (y0 + p_size % 5 + 1)::int as y1 from rects0)"""


def ells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concave polygons: the rectangles without the quarter beyond (mx, my); thin ones stay rectangles."""
    middle = lambda a, b: F.floor((F.col(a) + F.col(b) + 1) / 2).cast("int")
    at = lambda x, y: F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    made = rects(spark, sf_dir).withColumns({"mx": middle("x0", "x1"), "my": middle("y0", "y1")})
    whole = F.array(at("x0", "y0"), at("x1", "y0"), at("x1", "y1"), at("x0", "y1"))
    bent = F.array(at("x0", "y0"), at("x1", "y0"), at("x1", "my"), at("mx", "my"), at("mx", "y1"), at("x0", "y1"))
    return made.withColumn("rings", F.array(F.when((F.col("mx") < F.col("x1")) & (F.col("my") < F.col("y1")), bent).otherwise(whole)))


ELLS = """ells as (select *, ((x0 + x1 + 1) // 2)::int as mx, ((y0 + y1 + 1) // 2)::int as my from rects),
  ones as (select id, zone, mx, my, x1, y1, unnest(range(x0, x1)) as gx, y0 from ells),
  cells as (select id, zone, gx, gy from (select id, zone, mx, my, gx, unnest(range(y0, y1)) as gy from ones) where not (gx >= mx and gy >= my)),
  arms as (select id, zone, x0, y0, case when mx < x1 and my < y1 then my else y1 end as y1, x1 from ells union all select id, zone, x0, y0, y1, mx from ells where mx < x1 and my < y1)"""


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sheet of polygons without gaps, 40 in a row: squares of 10 whose sides have a middle point that is off the straight
    line by -3 to 3. Neighbours share their sides."""
    i, j = F.col("p_partkey") % 40, F.floor(F.col("p_partkey") / 40)
    off = lambda kind, i, j: (F.conv(F.substr(F.md5(F.concat_ws(",", F.lit(kind), i.cast("string"), j.cast("string"))), F.lit(1), F.lit(8)), 16, 10).cast("bigint") % 7 - 3).cast("int")
    base = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), i.alias("i"), j.alias("j"), off("h", i, j).alias("low"), off("h", i, j + 1).alias("high"), off("v", i, j).alias("left"), off("v", i + 1, j).alias("right"))
    x, y = F.col("i") * 10, F.col("j") * 10
    at = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    ring = F.array(at(x, y), at(x + 5, y + F.col("low")), at(x + 10, y), at(x + 10 + F.col("right"), y + 5), at(x + 10, y + 10), at(x + 5, y + 10 + F.col("high")), at(x, y + 10), at(x + F.col("left"), y + 5))
    made = base.withColumn("rings", F.array(ring))
    return made.withColumns({"x0": x - 3, "y0": y - 3, "x1": x + 13, "y1": y + 13})


CELLS = "cells0 as (select p_partkey as id, p_partkey % 40 as i, p_partkey // 40 as j from part), cells as (select *, " + ", ".join(f"(concat('0x', substr(md5('{k},' || {i} || ',' || {j}), 1, 8))::bigint % 7 - 3)::int as \"{n}\"" for n, k, i, j in (("low", "h", "i", "j"), ("high", "h", "i", "(j + 1)"), ("left", "v", "i", "j"), ("right", "v", "(i + 1)", "j"))) + " from cells0)"


def mgrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tile names in the grid's style."""
    key = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(key.alias("key"), F.concat(F.lpad((key + 1).cast("string"), 2, "0"), F.when(key % 2 == 1, "M").otherwise("U"), F.lit("FG")).alias("name"))


MGRS = "mgrs as (select n_nationkey as key, lpad((n_nationkey + 1)::varchar, 2, '0') || case when n_nationkey % 2 = 1 then 'M' else 'U' end || 'FG' as name from nation)"


def status_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A status for each processed item."""
    s = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("name"), F.when(s == "F", "FAILED").when(s == "O", "PROCESSED").otherwise("PENDING").alias("status"))


STATUS = "status_log as (select o_orderkey as name, case o_orderstatus when 'F' then 'FAILED' when 'O' then 'PROCESSED' else 'PENDING' end as status from orders)"


def labels_pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference and predicted classes, as pixels of ten images."""
    return table(spark, sf_dir, "labels").select((F.col("doc_id") % 10).cast("int").alias("img"), F.col("doc_id").alias("px"), F.col("quality").alias("y"), F.col("toxic").alias("p"))


LABELS = "labels_pred as (select (doc_id % 10)::int as img, doc_id as px, quality as y, toxic as p from labels)"


def numbered(df: DataFrame, keys: list[str], order: list[str], name: str = "px") -> DataFrame:
    """df with a running number from 0 within keys."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)
