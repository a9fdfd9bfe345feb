"""Same answers under 1 and 16 partitions with shuffled input (determinism under recomputation)."""

import numpy as np
from pyspark.sql import functions as F

from tablelearn.operators import epochs, metrics, profile, split, validate


def _frames(spark):
    rng = np.random.default_rng(11)
    rows = [(int(i), int(rng.integers(0, 7)), float(rng.normal()), int(rng.integers(0, 5)), int(rng.integers(0, 5)))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, label int, v double, y int, p int")
    one = df.coalesce(1)
    many = df.orderBy(F.rand(5)).repartition(16)
    return one, many


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_operators_partition_invariant(spark):
    one, many = _frames(spark)
    for f in (lambda d: split.holdout(d, "k", 0.3, 9),
              lambda d: split.stratified(d.select("k", "label"), "k", "label", 0.2, 0.1, 9),
              lambda d: split.kfold(d.select("k"), "k", 4, 9),
              lambda d: split.stratified_kfold(d.select("k", "label"), "k", "label", 3, 9),
              lambda d: metrics.confusion(d, "y", "p", list(range(5))),
              lambda d: validate.check(d, [("unique", ["label"]), ("between", "v", -1.0, 1.0)])):
        assert _rows(f(one)) == _rows(f(many))
    q1 = profile.exact_quantiles(one, ["v"], [0.1, 0.5, 0.9])
    q2 = profile.exact_quantiles(many, ["v"], [0.1, 0.5, 0.9])
    assert q1 == q2


def test_history_folds_partition_invariant(spark):
    one, many = _frames(spark)

    def hist(d):
        return d.select(F.col("label").alias("run"), F.col("k").alias("epoch"), "v")
    a = _rows(epochs.early_stop(hist(one), "run", "epoch", "v", patience=3))
    b = _rows(epochs.early_stop(hist(many), "run", "epoch", "v", patience=3))
    assert a == b
