"""Registered queries: one per operator of SURVEY §2, each (spark, sf_dir) -> DataFrame.

Every query reads the supplied tables (through the base views) in full.  Computed
doubles are rounded in the report layer (``_r``) exactly as the oracle SQL rounds them.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from tablelearn.functions.exprs import round_doubles
from tablelearn.operators import impute, metrics, profile, regress, scale, split, validate
from tablelearn.plans import price
from tablelearn.plans.views import customer_feats, doc_feats, emb, order_feats, scored
from tablelearn.session import prepare

QUERIES: dict = {}


def q(fn):
    def run(spark, sf):
        prepare(spark)
        return fn(spark, sf)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


def _r(df, places=6, **over):
    return round_doubles(df, places, over)


# ---------------------------------------------------------------- validation (V)
@q
def validate_orders(spark, sf):
    return validate.check(order_feats(spark, sf), price.ORDER_RULES)


CUSTOMER_RULES = [
    ("columns", ["id", "segment", "acctbal", "n_orders", "spend", "avg_order"]),
    ("non_empty",),
    ("unique", ["id"]),
    ("not_null", "acctbal"),
    ("not_null", "n_orders"),
    ("non_negative", "acctbal"),
    ("non_negative", "n_orders"),
    ("non_negative", "spend"),
]


@q
def validate_customers(spark, sf):
    return validate.check(customer_feats(spark, sf), CUSTOMER_RULES)


@q
def duplicate_keys(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    return validate.check(li, [("unique", ["l_orderkey", "l_linenumber"])])


@q
def null_counts(spark, sf):
    return profile.null_counts(order_feats(spark, sf))


@q
def aligned_keys(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderkey").alias("k"))
    li = spark.read.parquet(f"{sf}/lineitem.parquet").select(F.col("l_orderkey").alias("k"))
    return validate.aligned_keys(o, li, "k")


@q
def precondition_counts(spark, sf):
    cf = customer_feats(spark, sf)
    of = order_feats(spark, sf)
    a = validate.check(cf, [("min_rows", 5)]).select(F.lit("rows_ge_k").alias("check_name"), "violations")
    b = cf.agg(F.count_distinct("segment").alias("v")).select(
        F.lit("clusters_ge_2").alias("check_name"), F.greatest(F.lit(2) - F.col("v"), F.lit(0)).cast("bigint").alias("violations"))
    c = validate.check(of, [("min_rows", 5)]).select(F.lit("rows_ge_folds").alias("check_name"), "violations")
    return a.unionByName(b).unionByName(c)


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@q
def range_checks(spark, sf):
    return validate.check(customer_feats(spark, sf), [
        ("between", "acctbal", -999.99, 9999.99), ("between", "n_orders", 0, 25), ("one_of", "segment", SEGMENTS)])


# ---------------------------------------------------------------- profiling (A)
@q
def median_cols(spark, sf):
    return _r(profile.median_cols(order_feats(spark, sf), ["target", "n_lines", "qty", "gross"]), 4)


@q
def quartiles(spark, sf):
    return _r(profile.quartiles(order_feats(spark, sf), ["target", "qty"]), 4)


@q
def col_moments(spark, sf):
    return _r(profile.col_moments(customer_feats(spark, sf), ["acctbal", "spend", "n_orders", "avg_order"]), 4)


@q
def describe_exact(spark, sf):
    return _r(profile.describe_exact(customer_feats(spark, sf), ["acctbal", "n_orders"]), 4)


@q
def value_counts(spark, sf):
    return _r(profile.value_counts(order_feats(spark, sf), "status"))


@q
def corr_matrix(spark, sf):
    return _r(profile.corr_matrix(customer_feats(spark, sf), ["acctbal", "spend", "n_orders", "avg_order"]))


@q
def hist20(spark, sf):
    return _r(profile.histogram(customer_feats(spark, sf), "acctbal", 20), 4)


@q
def shape_counts(spark, sf):
    return profile.shape_counts(order_feats(spark, sf), "cust")


# ---------------------------------------------------------------- impute / scale (I, P7)
@q
def impute_median(spark, sf):
    of = order_feats(spark, sf)
    med = impute.fit_median(of, ["gross", "qty"])
    return _r(impute.apply_median(of, med).select("id", "gross", "qty"), 4)


def _holdout_orders(spark, sf):
    return split.holdout(order_feats(spark, sf), "id", 0.2, 42).persist(StorageLevel.MEMORY_AND_DISK)


@q
def impute_apply_holdout(spark, sf):
    h = _holdout_orders(spark, sf)
    med = impute.fit_median(h.where("split = 'train'"), ["gross"])
    return _r(impute.apply_median(h.where("split = 'test'"), med).select("id", "gross"), 4)


def _ratio(df):
    return df.withColumn("ratio", F.when(F.col("n_lines") <= 1, F.lit(float("inf")))
                         .otherwise(F.col("target") / F.col("n_lines")))


@q
def sanitize_inf(spark, sf):
    return _r(impute.sanitize_inf(_ratio(order_feats(spark, sf)), ["ratio"]).select("id", "ratio"))


@q
def residual_fill(spark, sf):
    h = _ratio(_holdout_orders(spark, sf))
    h = impute.sanitize_inf(h, ["ratio"])
    learned = impute.fit_median(h.where("split = 'train'"), ["ratio"])
    test = h.where("split = 'test'")
    a = impute.residual_fill(test, ["ratio"], learned, mode="learned").select("id", F.col("ratio").alias("filled_learned"))
    b = impute.residual_fill(test, ["ratio"], None, mode="current").select("id", F.col("ratio").alias("filled_current"))
    return _r(a.join(b, "id"))


@q
def iqr_filter(spark, sf):
    of = order_feats(spark, sf)
    e = price.engineer(impute.apply_median(of, impute.fit_median(of, ["gross"])))
    return _r(impute.iqr_filter(e, "total", 0.5).select("id", "total"), 4)


@q
def semi_align(spark, sf):
    of = order_feats(spark, sf)
    e = price.engineer(impute.apply_median(of, impute.fit_median(of, ["gross"])))
    kept = impute.iqr_filter(e, "total", 0.5)
    y = of.select("id", "target")
    from tablelearn.operators import align
    return align.semi_align(y, kept, "id")


@q
def anti_removed(spark, sf):
    of = order_feats(spark, sf)
    e = price.engineer(impute.apply_median(of, impute.fit_median(of, ["gross"])))
    kept = impute.iqr_filter(e, "total", 0.5)
    return impute.removed_rows(of.select("id", "target"), kept.select("id"), "id")


SCALE_COLS = ["acctbal", "spend", "n_orders"]


@q
def standard_scale(spark, sf):
    cf = customer_feats(spark, sf)
    return _r(scale.apply_scaler(cf, scale.fit_scaler(cf, SCALE_COLS), SCALE_COLS).select("id", *SCALE_COLS))


@q
def scale_apply_holdout(spark, sf):
    h = split.holdout(customer_feats(spark, sf), "id", 0.2, 42)
    st = scale.fit_scaler(h.where("split = 'train'"), SCALE_COLS)
    return _r(scale.apply_scaler(h.where("split = 'test'"), st, SCALE_COLS).select("id", *SCALE_COLS))


@q
def engineered_features(spark, sf):
    of = order_feats(spark, sf)
    e = price.engineer(impute.apply_median(of, impute.fit_median(of, ["gross"])))
    return _r(e.select("id", "total", "weighted", "age"), 4)


# ---------------------------------------------------------------- splits (T)
@q
def split_holdout(spark, sf):
    return split.holdout(order_feats(spark, sf).select("id"), "id", 0.2, 42)


@q
def split_stratified3(spark, sf):
    return split.stratified(emb(spark, sf).select("vec_id", "label"), "vec_id", "label", 0.2, 0.1, 42)


@q
def split_stratified2(spark, sf):
    return split.stratified(doc_feats(spark, sf).select("doc_id", "label"), "doc_id", "label", 0.2, 0.0, 42)


@q
def kfold_assign(spark, sf):
    return split.kfold(order_feats(spark, sf).select("id"), "id", 5, 42)


@q
def stratified_folds(spark, sf):
    return split.stratified_kfold(emb(spark, sf).select("vec_id", "label"), "vec_id", "label", 3, 42)


@q
def stratified_folds_nulls(spark, sf):
    """Folds over labels of which one is missing: null is a stratum and keeps its rows."""
    e = emb(spark, sf).select("vec_id", F.expr("nullif(label, 3)").alias("label"))
    return split.stratified_kfold(e, "vec_id", "label", 3, 42)


@q
def split_by_group_nulls(spark, sf):
    """Holdout by group where some rows have no group: they stay together."""
    d = spark.read.parquet(table_path(sf, "documents")).select("doc_id", F.expr("nullif(source, 'src0')").alias("source"))
    return split.split_by_group(d, "source", 0.2, 42)


@q
def split_disjoint(spark, sf):
    h = split.holdout(order_feats(spark, sf).select("id"), "id", 0.2, 42)
    return split.check_partition({"train": h.where("split = 'train'"), "test": h.where("split = 'test'")}, "id")


# ---------------------------------------------------------------- regression + metrics (L1, L2, M1-M5)
def _simple_fit_predictions(spark, sf):
    of = order_feats(spark, sf)
    c = regress.ols_simple(of, "qty", "target").first()
    return of.select("id", "status", F.col("target").alias("y"),
                     (F.lit(c["intercept"]) + F.lit(c["slope"]) * F.col("qty")).alias("yhat"))


@q
def regression_metrics(spark, sf):
    return _r(metrics.regression(_simple_fit_predictions(spark, sf), "y", "yhat"), 6, rmse=4, mae=4)


@q
def regression_metrics_by(spark, sf):
    return _r(metrics.regression(_simple_fit_predictions(spark, sf), "y", "yhat", group="status"), 6, rmse=4, mae=4)


@q
def ols_simple(spark, sf):
    return _r(regress.ols_simple(customer_feats(spark, sf), "n_orders", "spend"), 4, r2=6)


@q
def ols_two_feature(spark, sf):
    return _r(regress.ols_two(order_feats(spark, sf), "qty", "n_lines", "target"), 4)


@q
def cv_rmse(spark, sf):
    f = split.kfold(order_feats(spark, sf), "id", 5, 42)
    return _r(regress.cv_rmse_simple(f, "qty", "target", "fold", 5), 4)


@q
def ols_fit(spark, sf):
    """OLS of the regression workflow on its four raw features: holdout predictions."""
    parts = split.holdout(order_feats(spark, sf), "id", 0.2, 42)
    tr, te, _ = price.prepare(parts.where("split = 'train'"), parts.where("split = 'test'"))
    model = regress.fit_ols(tr, price.RAW, "target")
    return _r(model.transform(te).select("id", "target", "prediction"), 2)


@q
def ols_coefficients(spark, sf):
    """Intercept and coefficients of the OLS on the raw features of all orders with a gross value."""
    return _r(regress.ols_coefficients(order_feats(spark, sf), price.RAW, "target"), 3)


@q
def cv_rmse_full(spark, sf):
    """K-fold CV of the full design: the RMSE of every fold, from the second moments of one pass."""
    f = split.kfold(order_feats(spark, sf), "id", 5, 42).where("gross IS NOT NULL")
    return _r(regress.cross_validate(f, price.RAW, "target", "fold"), 2)


def _doc_pred(spark, sf):
    return doc_feats(spark, sf).withColumn("pred", F.when(F.col("letters") > 0.78, 1).otherwise(0))


@q
def binary_metrics(spark, sf):
    return _r(metrics.binary(_doc_pred(spark, sf), "label", "pred"))


CLASSES10 = list(range(10))


@q
def classification_report(spark, sf):
    return _r(metrics.report(scored(spark, sf), "y_true", "y_pred", CLASSES10))


@q
def macro_weighted_f1(spark, sf):
    rep = metrics.report(scored(spark, sf), "y_true", "y_pred", CLASSES10)
    w = rep.where(F.col("label").isin("accuracy", "macro avg", "weighted avg"))
    return _r(w.agg(F.max(F.when(F.col("label") == "accuracy", F.col("f1"))).alias("accuracy"),
                    F.max(F.when(F.col("label") == "macro avg", F.col("f1"))).alias("macro_f1"),
                    F.max(F.when(F.col("label") == "weighted avg", F.col("f1"))).alias("weighted_f1")))


@q
def confusion_matrix(spark, sf):
    return metrics.confusion(scored(spark, sf), "y_true", "y_pred", CLASSES10)


# ---------------------------------------------------------------- clustering
from tablelearn.operators import align, cluster, epochs, silhouettes  # noqa: E402
from tablelearn.operators import score as scoring  # noqa: E402


def seg_points(spark, sf):
    """Customer segmentation points: raw features plus the scaled vector ``x``."""
    cf = customer_feats(spark, sf)
    sc = scale.apply_scaler(cf, scale.fit_scaler(cf, SCALE_COLS), SCALE_COLS)
    sc = sc.select("id", *[F.col(c).alias(f"z_{c}") for c in SCALE_COLS])
    return cluster.assemble(cf.join(sc, "id"), [f"z_{c}" for c in SCALE_COLS], "x").persist(StorageLevel.MEMORY_AND_DISK)


def _seeded(spark, sf):
    pts = seg_points(spark, sf)
    return pts, cluster.hash_seeds(pts, "id", "x", 5, 42)


@q
def assign_centroid(spark, sf):
    pts, seeds = _seeded(spark, sf)
    return cluster.assign(pts, "x", seeds).select("id", "cluster")


@q
def kmeans_fixed_init(spark, sf):
    pts, seeds = _seeded(spark, sf)
    cents = cluster.lloyd(pts, "x", seeds, 2)
    return cluster.assign(pts, "x", cents).select("id", "cluster")


@q
def kmeans_inertia(spark, sf):
    pts, seeds = _seeded(spark, sf)
    return _r(metrics.inertia(pts, "x", seeds))


def _kmeans(spark, sf):
    pts = seg_points(spark, sf)
    cents, cost = cluster.fit_kmeans_batched(pts, "x", "id", k=5, restarts=10, tol=0.0, seed=42)
    return pts, cents, cost


@q
def kmeans_fit(spark, sf):
    """k-means, 10 restarts batched into one pass per iteration: size and centre of every cluster, inertia."""
    pts, cents, cost = _kmeans(spark, sf)
    sizes = cluster.assign(pts, "x", cents).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    rows = [(int(c), [round(float(v), 6) for v in x], round(float(cost), 6)) for c, x in enumerate(cents)]
    return sizes.join(F.broadcast(spark.createDataFrame(rows, "cluster int, center array<double>, inertia double")), "cluster")


@q
def kmeans_relations(spark, sf):
    """Rows assigned, clusters in use, and within plus between sum of squares (the total, if centres
    are means and inertia is right)."""
    pts, cents, cost = _kmeans(spark, sf)
    a = cluster.assign(pts, "x", cents).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("cluster").alias("n_clusters"))
    return _r(a.withColumn("total_ss", F.lit(cost + cluster.between(pts, "x", cents))), 3)


def _elbow(spark, sf):
    return cluster.elbow(seg_points(spark, sf), "x", "id", range(2, 11), restarts=10, tol=0.0)


@q
def elbow_curve(spark, sf):
    """Inertia for k = 2..10."""
    return _r(_elbow(spark, sf).select("k", "inertia", "between"))


@q
def elbow_relations(spark, sf):
    """Inertia for k = 2..10 falls, and with the between sum of squares is always the total."""
    e = _elbow(spark, sf)
    rows = sorted(e.collect())
    falls = all(a["inertia"] >= b["inertia"] for a, b in zip(rows, rows[1:]))
    return _r(e.select("k", (F.col("inertia") + F.col("between")).alias("total_ss"), F.lit(falls).alias("non_increasing")), 3)


def _assigned(spark, sf):
    pts, seeds = _seeded(spark, sf)
    return cluster.assign(pts, "x", seeds)


@q
def cluster_profiles(spark, sf):
    a = _assigned(spark, sf)
    p = profile.group_profile(a, "cluster", SCALE_COLS, "segment", places=None)
    p = p.select("cluster", "size", "pct", *[f"mean_{c}" for c in SCALE_COLS],
                 F.explode("segment_pct").alias("segment", "segment_pct"))
    return _r(p, 6, mean_spend=4, mean_acctbal=4)


@q
def cluster_sizes(spark, sf):
    return _assigned(spark, sf).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


@q
def profile_pivot(spark, sf):
    return _r(profile.profile_pivot(_assigned(spark, sf), "cluster", "segment", SEGMENTS, places=None))


@q
def silhouette(spark, sf):
    """Silhouette with Euclidean distance: exact within the cost limit, else from reference rows with a standard error."""
    return _r(silhouettes.silhouette(_assigned(spark, sf), "x", "cluster"))


@q
def silhouette_sq(spark, sf):
    return _r(metrics.silhouette_sq(_assigned(spark, sf), "x", "cluster", 3))


@q
def davies_bouldin(spark, sf):
    return _r(metrics.davies_bouldin(_assigned(spark, sf), "x", "cluster", 3))


# ---------------------------------------------------------------- lookup (J3) and history folds
# Event-type weights of the lookup stand-in ("signup" and "error" are left
# out on purpose; "default" is the fallback entry).
EVENT_WEIGHTS = [("click", 1), ("purchase", 10), ("view", 2), ("default", 0)]


def _event_dim(spark):
    return spark.createDataFrame(EVENT_WEIGHTS, "event_type string, weight int")


@q
def lookup_default(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "event_type")
    return align.lookup_default(ev, _event_dim(spark), "event_type", "weight")


@q
def lookup_missing(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "event_type")
    return align.missing_keys(ev, _event_dim(spark), "event_type")


def _history(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet").select("user_id", "ts", "event_id", "value")
    return epochs.with_epoch_index(ev, "user_id", ["ts", "event_id"])


@q
def early_stop(spark, sf):
    return _r(epochs.early_stop(_history(spark, sf), "user_id", "epoch", "value", patience=4, min_delta=1e-5))


@q
def lr_plateau(spark, sf):
    return epochs.lr_plateau(_history(spark, sf), "user_id", "epoch", "value", lr=0.001, factor=0.5, patience=2)


@q
def best_checkpoint(spark, sf):
    return _r(epochs.best_checkpoint(_history(spark, sf), "user_id", "epoch", "value"))


# ---------------------------------------------------------------- scoring
@q
def score_regression(spark, sf):
    h = _holdout_orders(spark, sf)
    c = regress.ols_two(h.where("split = 'train'"), "qty", "n_lines", "target").first()
    te = h.where("split = 'test'")
    pred = F.lit(c["b0"]) + F.lit(c["b1"]) * F.col("qty") + F.lit(c["b2"]) * F.col("n_lines")
    return _r(te.select("id", pred.alias("prediction")), 4)


def _emb_proba(spark, sf):
    e = emb(spark, sf)
    from tablelearn.plans.views import label_centroids
    cents = label_centroids(e, "label", "embedding", 64)
    classes = [c for c, _ in cents]
    return scoring.softmax_distance(e, "embedding", [v for _, v in cents]), classes


@q
def log_loss(spark, sf):
    p, classes = _emb_proba(spark, sf)
    return _r(metrics.log_loss(p, "label", "probability", classes))


@q
def top1_confidence(spark, sf):
    p, classes = _emb_proba(spark, sf)
    return _r(scoring.top1(p, "probability", classes).select("vec_id", "top_class", "confidence"))


@q
def proba_map(spark, sf):
    p, classes = _emb_proba(spark, sf)
    m = scoring.proba_map(p, "probability", classes)
    return _r(m.select("vec_id", F.explode("proba_map").alias("class", "prob")))


# The reference's food classes in configured order and their kcal per 100 g,
# with the "default" entry used for unknown classes.
FOOD_CLASSES = ["apple_pie", "caesar_salad", "cheesecake", "chicken_curry", "french_fries",
                "hamburger", "pizza", "ramen", "sushi", "waffles"]
FOOD_KCAL = [("apple_pie", 237), ("caesar_salad", 190), ("cheesecake", 321), ("chicken_curry", 165),
             ("french_fries", 312), ("hamburger", 295), ("pizza", 266), ("ramen", 436), ("sushi", 150),
             ("waffles", 291), ("default", 250)]


@q
def predictions_with_lookup(spark, sf):
    dim = spark.createDataFrame(FOOD_KCAL, "class string, kcal int")
    t = scoring.predictions_table(scored(spark, sf), "y_true", "y_pred", FOOD_CLASSES, dim, "class", "kcal")
    return t.select("vec_id", "true_class", "predicted_class", F.col("true_value").alias("true_kcal"),
                    F.col("predicted_value").alias("predicted_kcal"), "correct")


# ---------------------------------------------------------------- image jobs on 8×8 stand-ins
import numpy as np  # noqa: E402

from tablelearn.operators import images  # noqa: E402
from tablelearn.plans.views import emb_images  # noqa: E402


def _rgb(spark, sf):
    """Three channels from one 8×8 grey image: R = px, G = px mirrored, B = 255 − px."""
    e = emb_images(spark, sf)
    rgb = F.flatten(F.zip_with("pixels", F.reverse("pixels"), lambda r, g: F.array(r, g, 255 - r)))
    return e.withColumn("rgb", rgb)


def _long(df, key, arr, idx="i", val="v"):
    return df.select(key, F.posexplode(arr).alias(idx, val))


@q
def resize_half(spark, sf):
    r = images.resize_column(emb_images(spark, sf), "vec_id", "pixels", 8, 8, 4, 4)
    x = _long(r, "vec_id", "resized")
    return _r(x.select("vec_id", (F.col("i") / 4).cast("int").alias("y"), (F.col("i") % 4).cast("int").alias("x"), "v"))


@q
def grayscale(spark, sf):
    g = images.gray_column(_rgb(spark, sf), "vec_id", "rgb", images.GRAY_SKIMAGE)
    return _r(_long(g, "vec_id", "gray", "pos", "gray"))


@q
def pixel_normalize(spark, sf):
    e = emb_images(spark, sf).withColumn("norm", images.normalize_pixels("pixels"))
    return _r(_long(e, "vec_id", "norm", "pos", "v"))


def _hog(spark, sf):
    return images.hog_column(emb_images(spark, sf), "vec_id", "pixels", 8, 8, cell=4, block=2)


@q
def hog_cells(spark, sf):
    x = _long(_hog(spark, sf), "vec_id", "cells")
    return _r(x.select("vec_id", (F.col("i") / 18).cast("int").alias("cy"), ((F.col("i") / 9).cast("int") % 2).alias("cx"),
                       (F.col("i") % 9).cast("int").alias("bin"), F.col("v").alias("value")))


@q
def hog_blocks(spark, sf):
    return _r(_long(_hog(spark, sf), "vec_id", "blocks"))


def _hist(spark, sf, mode):
    x = _long(images.hist_column(_rgb(spark, sf), "vec_id", "rgb", 16, mode), "vec_id", "hist")
    return _r(x.select("vec_id", (F.col("i") / 16).cast("int").alias("channel"), (F.col("i") % 16).cast("int").alias("bin"),
                       F.col("v").alias("value")))


@q
def color_hist_density(spark, sf):
    return _hist(spark, sf, "density")


@q
def color_hist_joint(spark, sf):
    return _hist(spark, sf, "joint")


@q
def concat_vector(spark, sf):
    """HOG blocks of the grey image ++ per-channel density histogram of the RGB stand-in."""
    def fn(s):
        x = np.stack([np.asarray(v, dtype=np.float64).reshape(8, 8, 3) for v in s])
        _, blocks = images.hog_batch(x[..., 0], 9, 4, 2)
        return {"features": np.concatenate([blocks, images.color_hist_batch(x, 16, "density")], axis=1)}
    f = images.map_arrays(_rgb(spark, sf), "vec_id", "rgb", fn, "vec_id bigint, features array<double>")
    return _r(_long(f, "vec_id", "features"))


@q
def augment_rows(spark, sf):
    """Two deterministic rotated/shifted copies per image: their parameters and pixel sums."""
    a = images.augment(emb_images(spark, sf), "vec_id", "pixels", 8, 8, copies=2, seed=42)
    px = F.aggregate("pixels", F.lit(0.0), lambda s, v: s + v).cast("long").alias("checksum")
    return _r(a.select("vec_id", "copy", "angle", "shift_y", "shift_x", px))


# ---------------------------------------------------------------- sources and sinks
from pyspark.sql import types as T  # noqa: E402

from tablelearn.functions import project  # noqa: E402
from tablelearn.session import shared_dir  # noqa: E402
from tablelearn.sources import bundle, sinks  # noqa: E402
from tablelearn.sources import images as imgsrc  # noqa: E402
from tablelearn.sources.tables import read_csv, read_or_default as _read_or_default, table_path  # noqa: E402

CUSTOMER_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType())])


@q
def csv_roundtrip(spark, sf):
    """customer → CSV sink (shared folder) → CSV source with an explicit schema → aggregate."""
    path = shared_dir(spark, "csv_roundtrip")
    sinks.write_table(spark.read.parquet(table_path(sf, "customer")), path, fmt="csv")
    c = read_csv(spark, path, CUSTOMER_SCHEMA)
    return _r(c.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.sum("c_acctbal").alias("sum_acctbal"),
                                             F.min("c_custkey").alias("min_key"), F.max("c_custkey").alias("max_key")), 4)


@q
def read_or_default(spark, sf):
    """All sources present → real files; one missing → the caller's substitute."""
    def reader(paths):
        return spark.read.parquet(*paths)
    a, oa = _read_or_default(spark, [table_path(sf, "customer")], reader, spark.read.parquet(table_path(sf, "nation")))
    b, ob = _read_or_default(spark, [table_path(sf, "customer"), table_path(sf, "no_such_table")], reader,
                             spark.read.parquet(table_path(sf, "nation")))
    return (a.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("all_present").alias("case_name"),
                                                              F.lit(oa).alias("origin"), "n_rows")
            .unionByName(b.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit("one_missing").alias("case_name"), F.lit(ob).alias("origin"), "n_rows")))


# The two prefixes of the name-labelled stand-in, in label order.
NAME_CLASSES = ["economy", "small"]


@q
def label_from_name(spark, sf):
    """Label from a file-name prefix ('<type>.<key>.jpg'); unknown prefixes skipped."""
    p = spark.read.parquet(table_path(sf, "part")).select(
        "p_partkey", F.concat(F.col("p_type"), F.lit("."), F.col("p_partkey").cast("string"), F.lit(".jpg")).alias("path"))
    kept, _ = imgsrc.label_by_prefix(p, "path", NAME_CLASSES)
    return kept.select("p_partkey", "class_name", "label")


# Class folders kept by the tree-index stand-in, in label order.
TREE_CLASSES = ["en", "fr", "de"]


@q
def index_tree(spark, sf):
    """'<source>/<lang>/<doc>.<ext>' paths; image extensions only (case-insensitive)."""
    d = spark.read.parquet(table_path(sf, "documents")).select("doc_id", "source", "lang")
    ext = (F.when(F.col("doc_id") % 7 == 0, F.lit(".txt")).when(F.col("doc_id") % 2 == 0, F.lit(".PNG"))
           .otherwise(F.lit(".jpg")))
    p = d.select("doc_id", F.concat_ws("/", F.lit("root"), "source", "lang", F.concat(F.col("doc_id").cast("string"), ext))
                 .alias("path"))
    return imgsrc.index_tree(p, "path", TREE_CLASSES).select("doc_id", "subject", "class_name", "label")


@q
def drop_invalid(spark, sf):
    """Unusable rows (null or blank text) are skipped and counted per language."""
    d = spark.read.parquet(table_path(sf, "documents")).select("lang", "text")
    ok = F.col("text").isNotNull() & (F.trim(F.col("text")) != "")
    return d.groupBy("lang").agg(*imgsrc.valid_counts(ok))


@q
def metrics_json(spark, sf):
    """Binary-metric counts → JSON report sink → read back."""
    m = metrics.binary(_doc_pred(spark, sf), "label", "pred").select("tp", "fp", "fn", "tn", "n")
    path = shared_dir(spark, "metrics_json")
    sinks.write_report(sinks.report_json(m.withColumn("metric_set", F.lit("binary")), "metric_set"), path)
    return spark.read.schema("metric_set string, json string").json(path)


@q
def run_summary(spark, sf):
    """Deterministic columns of the run summary row, appended to a runs table and read back."""
    h = split.holdout(order_feats(spark, sf).select("id"), "id", 0.2, 42)
    row = h.agg(F.count_if(F.col("split") == "train").cast("bigint").alias("n_train"),
                F.count_if(F.col("split") == "test").cast("bigint").alias("n_test")).select(
        "n_train", "n_test", F.lit(len(price.FEATURES)).alias("n_features"),
        F.lit(",".join(price.FEATURES)).alias("features"))
    return sinks.append_run(spark, shared_dir(spark, "runs"), row)


@q
def model_roundtrip(spark, sf):
    """Save the scoring bundle (medians, scaler, features, model), load it, score unprepared rows."""
    parts = split.holdout(order_feats(spark, sf), "id", 0.2, 42)
    model = price.fit_scoring(parts.where("split = 'train'"), price.RAW)
    path = shared_dir(spark, "bundle")
    bundle.save_bundle(spark, model, path, price.RAW)
    loaded, _, _, _ = bundle.load_bundle(spark, path)
    return _r(loaded.transform(parts.where("split = 'test'")).select("id", "prediction"), 2)


@q
def assign_new_customers(spark, sf):
    """Fit scaler and centres on one part, save and load them, assign the customers of the other."""
    from tablelearn.plans import segments
    parts = split.holdout(customer_feats(spark, sf), "id", 0.2, 42)
    tr = parts.where("split = 'train'")
    st = scale.fit_scaler(tr, segments.FEATURES).first().asDict()
    seeds = cluster.hash_seeds(scale.scaled_points(tr, segments.FEATURES, st, "x"), "id", "x", 5, 42)
    path = shared_dir(spark, "segment_state")
    segments.segment_state(spark, st, seeds).write.parquet(path)
    return segments.assign_new(parts.where("split = 'test'"), spark.read.parquet(path))


# ---------------------------------------------------------------- projections
@q
def select_features(spark, sf):
    return _r(project.select_features(customer_feats(spark, sf), ["acctbal", "spend", "n_orders"], keep=["id"]), 4)


@q
def column_order(spark, sf):
    return _r(project.order_columns(order_feats(spark, sf), ["qty", "gross", "n_lines"]), 4)


@q
def label_encode(spark, sf):
    c = project.encode_labels(customer_feats(spark, sf).select("id", "segment"), "segment", SEGMENTS, "label")
    return project.decode_labels(c, "label", SEGMENTS, "decoded")


@q
def filter_eq(spark, sf):
    return _r(customer_feats(spark, sf).where(F.col("segment") == "BUILDING").select("id", "acctbal"), 4)


@q
def limit_preview(spark, sf):
    """First 10 rows by key (the limit is the feature; the order is total)."""
    return _r(order_feats(spark, sf).orderBy("id").limit(10).select("id", "target"), 4)


@q
def math_scalars(spark, sf):
    of = order_feats(spark, sf)
    return _r(of.select("id", F.abs(F.col("target") - 150000).alias("dev"), F.sqrt("qty").alias("root_qty"),
                        F.least(F.greatest(F.col("qty"), F.lit(50.0)), F.lit(150.0)).alias("clipped"),
                        F.round(F.col("qty") / 4, 1).alias("rounded")), 4, root_qty=6)


@q
def run_id_format(spark, sf):
    ev = spark.read.parquet(table_path(sf, "events")).select("event_id", "ts")
    return ev.select("event_id", F.date_format("ts", "yyyyMMdd'T'HHmmss'Z'").alias("run_id"),
                     F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("iso"))


# ---------------------------------------------------------------- classifiers
from pyspark.ml.functions import array_to_vector, vector_to_array  # noqa: E402

from tablelearn.operators import calibrate, classify  # noqa: E402

DOC_FEATURES = ["n", "letters", "digits", "spaces"]


def _doc_vectors(spark, sf):
    d = doc_feats(spark, sf)
    sc = scale.apply_scaler(d, scale.fit_scaler(d, DOC_FEATURES), DOC_FEATURES)
    return sc.select("doc_id", "label", array_to_vector(F.array(*[F.col(c).cast("double") for c in DOC_FEATURES]))
                     .alias("features"))


def _rff_fixed(d: int, n_components: int = 8, gamma: float = 0.5):
    """A fixed, formula-defined projection for the oracle check of the RFF map."""
    w = [[float(np.sin(1.0 + i * d + j)) * float(np.sqrt(2.0 * gamma)) for j in range(d)] for i in range(n_components)]
    b = [float((i * 0.7548776662466927) % 1.0 * 2.0 * np.pi) for i in range(n_components)]
    return np.array(w), np.array(b)


@q
def rff_map(spark, sf):
    pts = seg_points(spark, sf)
    w, b = _rff_fixed(3)
    z = pts.select("id", classify.rff_column(F.col("x"), w, b).alias("z"))
    return _r(_long(z, "id", "z"))


@q
def platt_apply(spark, sf):
    d = doc_feats(spark, sf)
    return _r(d.select("doc_id", classify.platt_apply(F.col("letters") - F.lit(0.78), -4.0, 0.1).alias("p")))


def _doc_split(spark, sf):
    s = split.stratified(_doc_vectors(spark, sf), "doc_id", "label", 0.2, 0.0, 42).persist(StorageLevel.MEMORY_AND_DISK)
    return s.where("split = 'train'"), s.where("split = 'test'")


def _fit_rows(model, train, test, k, label="label"):
    """Per part and true label: rows, predictions that are a class, and whether the accuracy on the
    training part, recomputed from the predictions, reaches the share of its largest class."""
    pred = model.transform(train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test"))))
    per = pred.groupBy("part", label).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("prediction").between(0, k - 1)).cast("long").alias("n_in_domain"),
        F.count_if(F.col("prediction") == F.col(label)).alias("hit"))
    tot = per.where("part = 'train'").agg((F.sum("hit") >= F.max("n_rows")).alias("beats_majority"))
    return per.crossJoin(F.broadcast(tot)).select("part", label, "n_rows", "n_in_domain", "beats_majority")


def _predictions(model, train, test, key, label="label"):
    """Part, key, label and prediction of every row of both parts."""
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return model.transform(both).select("part", key, label, F.col("prediction").cast("int").alias("prediction"))


@q
def svm_rbf(spark, sf):
    """RBF machine (C=5, gamma=scale) on random Fourier features: the prediction of every row."""
    tr, te = _doc_split(spark, sf)
    return _predictions(classify.fit_classifier(tr, "features", "label", "svm_rbf", 2, C=5.0, n_components=2000), tr, te, "doc_id")


@q
def svm_landmarks(spark, sf):
    """The same machine on the Nyström map of 300 landmarks."""
    tr, te = _doc_split(spark, sf)
    m = classify.fit_classifier(tr, "features", "label", "svm_rbf", 2, C=5.0, kernel_map="landmarks", n_components=300)
    return _predictions(m, tr, te, "doc_id")


@q
def svm_probability(spark, sf):
    """P(label = 1) from a decision value, every fifth of the rows with a sigmoid fitted on the others."""
    d = doc_feats(spark, sf).select("doc_id", "label", (F.col("letters") - F.lit(0.78)).alias("f"), (F.col("doc_id") % 5).cast("int").alias("fold"))
    return _r(calibrate.cross_fitted(d, "f", "label", "fold", 5).select("doc_id", "probability"), 5)


@q
def svm_class_probabilities(spark, sf):
    """Machines for all pairs of ten classes with sigmoids from left-out folds, coupled: probabilities of every test row."""
    tr, te = _emb_split(spark, sf)
    f = split.stratified_kfold(tr, "vec_id", "label", 3, 42)
    m = classify.svm_probabilities(f, "features", "label", "fold", 10, n_components=300)
    return m.transform(te).select("vec_id", "label", F.col("prediction").cast("int").alias("prediction"), vector_to_array("probability").alias("probability"))


@q
def score_binary(spark, sf):
    """Binary scoring job for unlabelled rows: every id with its label."""
    tr, te = _doc_split(spark, sf)
    m = classify.fit_classifier(tr, "features", "label", "svm_rbf", 2, C=5.0, n_components=2000)
    return m.transform(te.drop("label")).select(F.col("doc_id").alias("id"), F.col("prediction").cast("int").alias("label"))


@q
def grid_search(spark, sf):
    """The full C × gamma grid, 3 stratified folds: accuracy of every cell over the left-out rows."""
    tr, _ = _doc_split(spark, sf)
    f = split.stratified_kfold(tr, "doc_id", "label", 3, 42)
    rows, _ = classify.grid_search(f, "features", "label", "fold")
    return spark.createDataFrame(rows, "gamma string, C double, accuracy double, n_rows long")


def _emb_split(spark, sf):
    e = emb(spark, sf).select("vec_id", "label", array_to_vector("embedding").alias("features"))
    s = split.stratified(e, "vec_id", "label", 0.2, 0.0, 42).persist(StorageLevel.MEMORY_AND_DISK)
    return s.where("split = 'train'"), s.where("split = 'test'")


@q
def random_forest(spark, sf):
    tr, te = _emb_split(spark, sf)
    return _predictions(classify.fit_classifier(tr, "features", "label", "forest", 10), tr, te, "vec_id")


@q
def mlp_fit(spark, sf):
    tr, te = _emb_split(spark, sf)
    return _predictions(classify.fit_classifier(tr, "features", "label", "mlp", 10), tr, te, "vec_id")


def _every_backend(spark, sf, judged):
    tr, te = _emb_split(spark, sf)
    out = None
    for backend in classify.BACKENDS:
        m = classify.fit_classifier(tr, "features", "label", backend, 10)
        a = judged(m, tr, te).withColumn("backend", F.lit(backend))
        out = a if out is None else out.unionByName(a)
    return out


@q
def compare_backends(spark, sf):
    """Accuracy of every backend on one split, by part."""
    def accuracy(m, tr, te):
        p = _predictions(m, tr, te, "vec_id")
        return p.groupBy("part").agg(F.count(F.lit(1)).alias("n_rows"), F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy"))
    return _every_backend(spark, sf, accuracy)


@q
def backend_relations(spark, sf):
    """Every backend on one split, judged per part and label."""
    return _every_backend(spark, sf, lambda m, tr, te: _fit_rows(m, tr, te, 10))


@q
def epoch_training(spark, sf):
    """Minibatch training in rounds with a validation history: losses and accuracies of every round."""
    e = emb(spark, sf).select("vec_id", "label", array_to_vector("embedding").alias("features"))
    s = split.stratified(e, "vec_id", "label", 0.15, 0.15, 42).persist(StorageLevel.MEMORY_AND_DISK)
    hist, _ = classify.epoch_training(s.where("split = 'train'"), s.where("split = 'val'"), "features", "label", 10,
                                      hidden=(32,), rounds=8, iters_per_round=5)
    s.unpersist()
    return spark.createDataFrame(hist, "epoch int, train_loss double, train_acc double, val_loss double, val_acc double")


# ---------------------------------------------------------------- group-aware split, stream scoring
@q
def split_by_group(spark, sf):
    """Holdout that keeps every source (subject) whole."""
    d = spark.read.parquet(table_path(sf, "documents")).select("doc_id", "source")
    return split.split_by_group(d, "source", 0.2, 42)


@q
def stream_score(spark, sf):
    """Orders arrive as a stream, are joined to the static per-order line aggregate and scored
    with the closed-form model fitted on the batch train split; parquet sink, read back."""
    from tablelearn.streaming import scoring

    h = _holdout_orders(spark, sf)
    c = regress.ols_two(h.where("split = 'train'"), "qty", "n_lines", "target").first()
    lines = (spark.read.parquet(table_path(sf, "lineitem")).groupBy("l_orderkey")
             .agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q")))
    o = scoring.stream_table(spark, sf, "orders").select("o_orderkey")
    j = o.join(lines, o.o_orderkey == lines.l_orderkey, "left")
    qty = F.coalesce(F.col("q"), F.lit(0.0))
    n_lines = F.coalesce(F.col("n"), F.lit(0)).cast("double")
    pred = F.lit(c["b0"]) + F.lit(c["b1"]) * qty + F.lit(c["b2"]) * n_lines
    _, sink = scoring.run_to_sink(j.select(F.col("o_orderkey").alias("id"), pred.alias("prediction")))
    return _r(spark.read.parquet(sink), 4)


@q
def cv_rmse_summary(spark, sf):
    """K-fold CV of OLS: mean and population std of the fold RMSEs."""
    f = split.kfold(order_feats(spark, sf), "id", 5, 42)
    return _r(regress.cv_summary(regress.cv_rmse_simple(f, "qty", "target", "fold", 5)), 4)


@q
def platt_fit(spark, sf):
    """Sigmoid calibration of a decision value: its two numbers."""
    d = doc_feats(spark, sf).withColumn("f", F.col("letters") - F.lit(0.78))
    return _r(spark.createDataFrame([classify.platt_fit(d, "f", "label")], "a double, b double"), 3)


@q
def platt_relations(spark, sf):
    """Sigmoid calibration of a decision value f: at the optimum the sums of p and of f·p equal
    those of the label and of f times the label."""
    d = doc_feats(spark, sf).withColumn("f", F.col("letters") - F.lit(0.78))
    a, b = classify.platt_fit(d, "f", "label")
    p = d.withColumn("p", classify.platt_apply(F.col("f"), a, b))
    return _r(p.agg(F.count(F.lit(1)).alias("n_rows"), F.avg("p").alias("mean_p"), F.avg(F.col("f") * F.col("p")).alias("mean_fp")), 4)
