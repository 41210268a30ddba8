import numpy as np
from pyspark.sql import functions as F

from parcelight.operators import training


def test_batches_and_order(spark):
    rows = training.shuffled(spark.range(25), ["id"], 3)
    got = list(training.batches(rows, 10))
    assert [len(b) for b in got] == [10, 10, 5] and sorted(r["id"] for b in got for r in b) == list(range(25))


def test_clusters(spark):
    x = spark.range(20).select("id", F.array((F.col("id") % 2) * 10.0, F.col("id") / 100).alias("x"))
    out = training.clusters(x, "x", 2).collect()
    assert len({(r["id"] % 2, r["cluster"]) for r in out}) == 2


def test_reductions():
    g = np.zeros((2, 2, 3))
    g[0, 1, 2] = -4.0
    assert training.saliency(g).tolist() == [[0.0, 1.0], [0.0, 0.0]]
    out = np.arange(12.0).reshape(2, 2, 3)
    assert training.class_activation(out, np.ones((2, 2, 3))).max() <= 1.0
