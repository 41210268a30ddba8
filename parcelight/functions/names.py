"""Names of tiles, patchlets and files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mgrs_to_epsg(name: Column) -> Column:
    """EPSG code of a tile name's UTM zone: 326xx from band N on, 327xx before."""
    return (F.when(F.upper(F.substr(name, F.lit(3), F.lit(1))) >= "N", 32600).otherwise(32700) + F.substr(name, F.lit(1), F.lit(2)).cast("int")).cast("int")


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def eopatch_of(patchlet: Column) -> Column:
    """A patchlet's tile: its name without what follows the last underscore."""
    return F.regexp_replace(patchlet, "_[^_]*$", "")


def trailing_number(name: Column) -> Column:
    return F.regexp_extract(name, r"(\d+)\D*$", 1).cast("int")


def tiff_name(tile: Column, epsg: Column) -> Column:
    return F.concat(tile, F.lit("-"), epsg.cast("string"), F.lit(".tiff"))
