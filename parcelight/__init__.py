"""Spark-native parcel delineation: raster, vector and tabular operators as DataFrame transformations."""
