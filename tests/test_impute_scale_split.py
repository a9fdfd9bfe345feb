import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tablelearn.functions.exprs import order_hash
from tablelearn.operators import impute, scale, split
from tablelearn.plans import price


def test_median_imputation_and_engineered_features(house):
    med = impute.fit_median(house, ["TotalBsmtSF"]).first()
    assert med["TotalBsmtSF"] == 850.0
    x = impute.apply_median(house, med.asDict())
    x = x.withColumn("TotalSF", F.col("GrLivArea") + F.col("TotalBsmtSF")) \
         .withColumn("TotalBath", F.col("FullBath") + 0.5 * F.col("HalfBath")) \
         .withColumn("HouseAge", F.greatest(F.lit(2026) - F.col("YearBuilt"), F.lit(0)))
    r = {row["Id"]: row for row in x.collect()}
    assert r[3]["TotalSF"] == 2050.0 and r[1]["TotalBath"] == 2.0 and all(v["HouseAge"] >= 0 for v in r.values())


def test_transform_reuses_learned_median(spark, house):
    med = impute.fit_median(house, ["TotalBsmtSF"])
    new = spark.createDataFrame([(9, None)], "Id long, TotalBsmtSF double")
    assert impute.apply_median(new, med).first()["TotalBsmtSF"] == 850.0


def test_sanitize_inf_and_residual_modes(spark):
    df = spark.createDataFrame([(1, float("inf")), (2, 1.0), (3, 3.0), (4, -float("inf"))], "id long, v double")
    s = impute.sanitize_inf(df, ["v"])
    assert s.where("v is null").count() == 2
    learned = {"v": 100.0}
    a = {r["id"]: r["v"] for r in impute.residual_fill(s, ["v"], learned, "learned").collect()}
    b = {r["id"]: r["v"] for r in impute.residual_fill(s, ["v"], learned, "current").collect()}
    assert a[1] == 100.0 and b[1] == 2.0


def test_iqr_filter_inclusive_and_drops_missing(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 100]] + [(None,)], "v double")
    kept = [r["v"] for r in impute.iqr_filter(df, "v", 1.5).collect()]
    assert sorted(kept) == [1.0, 2.0, 3.0, 4.0]


def test_scaler_population_std_and_constant_column(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 2.0, 5.0), (3, 3.0, 5.0), (4, 4.0, 5.0)], "id long, a double, c double")
    st = scale.fit_scaler(df, ["a", "c"])
    out = scale.apply_scaler(df, st, ["a", "c"])
    m = out.agg(F.avg("a").alias("m"), F.stddev_pop("a").alias("s"), F.max(F.abs("c")).alias("c")).first()
    assert abs(m["m"]) < 1e-12 and abs(m["s"] - 1) < 1e-12 and m["c"] == 0.0
    new = spark.createDataFrame([(9, 10.0, 7.0)], "id long, a double, c double")
    r = scale.apply_scaler(new, st, ["a", "c"]).first()
    assert r["c"] == 2.0  # x − mean with scale 1 on a zero-variance column
    assert math.isclose(r["a"], (10.0 - 2.5) / math.sqrt(1.25))


def _window_holdout(df, key, frac, seed):
    n = df.count()
    k = math.ceil(n * frac)
    w = Window.orderBy(order_hash(key, seed), key)
    return {r[key]: ("test" if r["rn"] <= k else "train")
            for r in df.withColumn("rn", F.row_number().over(w)).collect()}


@pytest.mark.parametrize("parts,digits,seed", [(1, 4, 42), (4, 1, 7), (16, 2, 42)])
def test_holdout_equals_full_window(spark, parts, digits, seed):
    df = spark.range(0, 2345).withColumnRenamed("id", "k").repartition(parts)
    got = {r["k"]: r["split"] for r in split.holdout(df, "k", 0.2, seed, digits=digits).collect()}
    assert got == _window_holdout(df, "k", 0.2, seed)
    assert sum(v == "test" for v in got.values()) == math.ceil(2345 * 0.2)


def test_stratified_three_way_sizes(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(500)], "k long, label int")
    s = split.stratified(df, "k", "label", 0.2, 0.1, 42, digits=1)
    c = {r["split"]: r["n"] for r in s.groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert c == {"train": 350, "val": 50, "test": 100}
    per = {(r["split"], r["label"]): r["n"] for r in s.groupBy("split", "label").agg(F.count("*").alias("n")).collect()}
    assert per[("test", 0)] == per[("test", 1)] == 50


def test_stratified_matches_per_label_window_many_strata(spark):
    rows = [(i, i % 80) for i in range(4000)]
    df = spark.createDataFrame(rows, "k long, label int")
    got = {r["k"]: r["split"] for r in split.stratified(df, "k", "label", 0.25, 0.0, 3, digits=2).collect()}
    counts = {}
    for _, lab in rows:
        counts[lab] = counts.get(lab, 0) + 1
    quotas = split.largest_remainder(counts, math.ceil(4000 * 0.25))
    w = Window.partitionBy("label").orderBy(order_hash("k", 3), "k")
    ranked = df.withColumn("rn", F.row_number().over(w)).collect()
    want = {r["k"]: "test" if r["rn"] <= quotas[r["label"]] else "train" for r in ranked}
    assert got == want


def test_kfold_sizes_and_stratified_folds(spark):
    df = spark.range(0, 103).withColumnRenamed("id", "k")
    sizes = sorted((r["fold"], r["n"]) for r in split.kfold(df, "k", 5).groupBy("fold").agg(F.count("*").alias("n")).collect())
    assert [n for _, n in sizes] == [21, 21, 21, 20, 20]
    lab = df.withColumn("label", (F.col("k") % 3).cast("int"))
    sf = split.stratified_kfold(lab, "k", "label", 3)
    c = sf.groupBy("label", "fold").count().collect()
    assert max(r["count"] for r in c) - min(r["count"] for r in c) <= 1


def test_partition_disjoint_and_complete(spark):
    df = spark.range(0, 999).withColumnRenamed("id", "k")
    h = split.holdout(df, "k", 0.3)
    r = split.check_partition({"a": h.where("split='train'"), "b": h.where("split='test'")}, "k").first()
    assert (r["n_rows"], r["n_keys"], r["n_overlap"]) == (999, 999, 0)


def test_price_workflow_runs(spark):
    from tests.conftest import SF001
    rows = price.run(spark, SF001).collect()
    assert {r["split"] for r in rows} == {"train", "test"}


def test_split_is_the_same_for_any_bucket_width(spark):
    df = spark.range(0, 2000).withColumnRenamed("id", "k").withColumn("label", (F.col("k") % 3).cast("int"))
    want = {r["k"]: r["split"] for r in split.stratified(df, "k", "label", 0.2, 0.1, 1, digits=4).collect()}
    for digits in (1, 2):
        got = {r["k"]: r["split"] for r in split.stratified(df, "k", "label", 0.2, 0.1, 1, digits=digits).collect()}
        assert got == want


@pytest.mark.parametrize("many", [False, True])
def test_null_labels_and_groups_keep_their_rows(spark, many):
    label = F.when(F.col("k") % 10 != 0, (F.col("k") % (150 if many else 3)).cast("string"))
    df = spark.range(0, 1500).withColumnRenamed("id", "k").withColumn("label", label)
    got = split.stratified(df, "k", "label", 0.2, 0.1, 1).collect()
    assert len(got) == 1500
    none = [r["split"] for r in got if r["label"] is None]
    assert len(none) == 150 and none.count("test") == 30 and none.count("val") in (14, 15, 16)
    folds = split.stratified_kfold(df, "k", "label", 3).collect()
    assert len(folds) == 1500 and sorted([r["fold"] for r in folds if r["label"] is None].count(f) for f in range(3)) == [50, 50, 50]
    parts = split.split_by_group(df, "label", 0.2).collect()
    assert len(parts) == 1500 and len({r["split"] for r in parts if r["label"] is None}) == 1


def test_many_strata_in_one_pass(spark):
    df = spark.range(0, 3000).withColumnRenamed("id", "k").withColumn("label", (F.col("k") % 1500).cast("int"))
    got = split.stratified(df, "k", "label", 0.5).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in got} == {"test": 1500, "train": 1500}


def test_price_fit_scope_all_and_segments_raw(spark):
    from tablelearn.plans import segments
    from tests.conftest import SF001
    rows = price.run(spark, SF001, fit_scope="all").collect()
    assert {r["split"] for r in rows} == {"train", "test"}
    out = segments.run(spark, SF001, k=3, restarts=2, scale_features=False)
    assert out["labels"].count() == spark.read.parquet(f"{SF001}/customer.parquet").count()
