"""The spatial join against all pairs, where boxes are dense, huge, or points."""

import random

import pytest
from pyspark.sql import functions as F

from parcelight.operators import components, spatial

BOX = "id long, x0 double, y0 double, x1 double, y1 double"


def boxes(rnd, n, size, spread):
    out = []
    for i in range(n):
        x, y, s = rnd.uniform(-spread, spread), rnd.uniform(-spread, spread), rnd.choice(size)
        out.append((i, x, y, x + rnd.uniform(0, s), y + rnd.uniform(0, s)))
    return out


@pytest.mark.parametrize("cell", [0.37, 5.0, 1e4])
def test_pairs_do_not_depend_on_the_unit(spark, cell):
    rnd = random.Random(int(cell))
    left = boxes(rnd, 300, [0.01, 1, 1, 30], 40) + [(1000, -1e6, -1e6, 1e6, 1e6), (1001, 3.0, 3.0, 3.0, 3.0), (1002, 8.0, 0.0, 16.0, 8.0), (1003, None, 0.0, 1.0, 1.0)]
    right = boxes(rnd, 300, [0.001, 2, 9], 40) + [(2000, -50.0, 0.0, 50.0, 0.0), (2001, 3.0, 3.0, 3.0, 3.0), (2002, 16.0, 8.0, 20.0, 9.0)]
    out = spatial.box_join(spark.createDataFrame(left, BOX), spark.createDataFrame(right, BOX), cell).select("l.id", F.col("r.id").alias("other")).collect()
    want = {(a[0], b[0]) for a in left for b in right if a[1] is not None and a[1] <= b[3] and b[1] <= a[3] and a[2] <= b[4] and b[2] <= a[4]}
    assert len(out) == len(want) and {tuple(r) for r in out} == want


def test_dense_places_and_huge_boxes(spark):
    """20,000 small boxes in one unit and one box over everything: rows grow with the boxes, and no cell holds many."""
    rnd = random.Random(1)
    small = [(i, x, y, x + 0.004, y + 0.004) for i in range(20_000) for x, y in [(rnd.random(), rnd.random())]]
    left, huge = spark.createDataFrame(small, BOX), spark.createDataFrame([(0, -1e7, -1e7, 1e7, 1e7), *small[:100]], BOX)
    rows = spatial.cells(left, 1.0, [24, -7])
    assert rows.count() < 5.2 * 20_000  # a grid of units would hold all in one cell
    assert rows.where("grid < 0").groupBy("grid", "cx", "cy").count().agg(F.max("count")).first()[0] < 50
    assert spatial.cells(huge, 1.0, [-7]).where("x1 = 1e7").count() <= 4
    pairs = spatial.box_join(left, huge, 1.0)
    assert pairs.where("r.x1 = 1e7").count() == 20_000
    assert spatial.box_join(left, huge.where("false"), 1.0).count() == 0


def test_large_layers_are_not_broadcast(spark, monkeypatch):
    """A file's size says little of the shapes made of its rows: joins of many go without the driver, by the same pairs."""
    at = F.col("id").cast("double")
    layer = spark.range(300).select("id", at.alias("x0"), at.alias("y0"), (at + 1).alias("x1"), (at + 1).alias("y1"))
    pairs = lambda: spatial.box_join(layer, layer, 1.0).select("l.id", F.col("r.id").alias("other"))
    few = pairs()
    monkeypatch.setattr(spatial, "FEW", 299)
    many = pairs()
    assert "BroadcastHashJoin" in few._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in many._jdf.queryExecution().executedPlan().toString()
    assert sorted(few.collect()) == sorted(many.collect()) and many.count() == 3 * 300 - 2


def test_large_stored_tables_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(components, "LARGE", 100)
    table, _ = components.stored(spark.range(1000))
    joined = table.join(spark.range(1000), "id")
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString() and joined.count() == 1000
