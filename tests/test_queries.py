"""Every query with SQL against DuckDB on the smallest tables."""

import importlib

import duckdb
import pandas as pd
import pytest

from parcelight.plans import registry

for _name in ("tabular", "rasters", "vectors"):
    importlib.import_module(f"parcelight.plans.{_name}")

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def ordered(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for k in df.columns:
        if df[k].dtype.kind == "M":
            df[k] = df[k].astype("datetime64[us]").astype(str)
        elif df[k].dtype == object:
            df[k] = df[k].astype(str)
        elif df[k].dtype.kind in "biu":
            df[k] = df[k].astype("float64")
    return df.sort_values(list(df.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_same_rows_as_sql(spark, duck, name):
    mine = ordered(registry.QUERIES[name](spark, SF).toPandas())
    pd.testing.assert_frame_equal(mine, ordered(duck.sql(registry.ORACLE[name]).df()), check_dtype=False, rtol=1e-9, atol=1e-9)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 83
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["bicubic_upscale", "contour_polygons", "cloud_masks", "reproject_tm"])
def test_rows(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0


def test_overlap_tiles_of_every_rectangle(spark, duck):
    out = registry.QUERIES["zone_overlap_all_tiles"](spark, SF)
    assert out.select("id").distinct().count() == out.count() == duck.sql("select count(*) as n from part").df()["n"][0]
