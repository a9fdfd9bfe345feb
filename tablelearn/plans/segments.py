"""Customer-segmentation workflow on ``customer_feats`` (the reference's project C).

validate → population-std scaling → k-means (k=5, restarts, canonical ids) → assignment →
silhouette (squared distance, O(n·k)), Davies–Bouldin, inertia, cluster profiles.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelearn.operators import cluster, metrics, profile, scale, validate
from tablelearn.plans.views import customer_feats

FEATURES = ["acctbal", "spend", "n_orders"]
RULES = [("columns", ["id", "segment", *FEATURES]), ("non_empty",), ("unique", ["id"]),
         *[("not_null", c) for c in FEATURES], ("min_rows", 5)]


def run(spark: SparkSession, sf_dir: str, k: int = 5, restarts: int = 10, seed: int = 42,
        scale_features: bool = True) -> dict[str, DataFrame]:
    """``scale_features=False`` clusters the raw values (the reference's off switch)."""
    cf = customer_feats(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)
    validate.require(cf, RULES)
    st = scale.fit_scaler(cf, FEATURES).first().asDict() if scale_features else None
    pts = scale.scaled_points(cf, FEATURES, st, "x").persist(StorageLevel.MEMORY_AND_DISK)  # raw and scaled side by side
    cents, cost = cluster.fit_kmeans_batched(pts, "x", "id", k=k, restarts=restarts, seed=seed)
    labelled = cluster.assign(pts, "x", cents).persist(StorageLevel.MEMORY_AND_DISK)
    quality = (metrics.silhouette_sq(labelled, "x", "cluster", len(FEATURES))
               .crossJoin(metrics.davies_bouldin(labelled, "x", "cluster", len(FEATURES)))
               .withColumn("inertia", F.lit(cost)))
    cf.unpersist()
    return {"labels": labelled.select("id", "cluster"), "quality": quality,
            "profiles": profile.group_profile(labelled, "cluster", FEATURES, "segment"),
            "state": segment_state(spark, st, cents)}


STATE = "mean array<double>, std array<double>, centres array<array<double>>"


def segment_state(spark: SparkSession, st: dict | None, centres) -> DataFrame:
    """One saveable row: the scaler and the centres (k rows of features)."""
    mean = [float(st[f"mean_{c}"]) if st else 0.0 for c in FEATURES]
    std = [float(st[f"std_{c}"] or 1.0) if st else 1.0 for c in FEATURES]
    return spark.createDataFrame([(mean, std, [list(map(float, c)) for c in centres])], STATE)


def assign_new(customers: DataFrame, state: DataFrame) -> DataFrame:
    """Clusters of new customers by a saved state (``segment_state`` written and read)."""
    s = state.first()
    st = {f"{n}_{c}": v for n, vs in (("mean", s["mean"]), ("std", s["std"])) for c, v in zip(FEATURES, vs)}
    return cluster.assign(scale.scaled_points(customers, FEATURES, st, "x"), "x", [list(c) for c in s["centres"]]).select("id", "cluster")
