"""Model metrics as distributed aggregations over (key, y_true, y_pred[, probability]).

Only class-sized tables (k² pair counts) are ever combined after the aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelearn.errors import ModelError
from tablelearn.functions.exprs import col_of, vec_sqdist, matrix_literal


def regression(df: DataFrame, y: str, p: str, group: str | None = None) -> DataFrame:
    """RMSE, MAE, R², MAPE (%), n — per group when given.  y = 0 makes MAPE infinite; evaluating
    an empty prediction set is an error."""
    e = col_of(p).cast("double") - col_of(y).cast("double")
    yy = col_of(y).cast("double")
    ape = F.when(yy == 0, F.lit(float("inf"))).otherwise(F.abs(e) / F.abs(yy))
    sst = F.var_pop(yy) * F.count(F.lit(1))
    aggs = [F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
            F.when(sst == 0, F.lit(float("nan"))).otherwise(1 - F.sum(e * e) / sst).alias("r2"),
            (F.avg(ape) * 100).alias("mape"), F.count(F.lit(1)).alias("n")]
    if group:
        return df.groupBy(col_of(group)).agg(*aggs)
    empty = F.raise_error(F.lit("cannot evaluate an empty prediction set")).cast("bigint")
    return df.agg(*aggs).withColumn("n", F.when(F.col("n") == 0, empty).otherwise(F.col("n")))


def binary(df: DataFrame, y: str, p: str, positive=1) -> DataFrame:
    """accuracy, precision, recall, F1 for the positive class, the 2×2 counts and n (0 on 0/0)."""
    t, q = col_of(y) == F.lit(positive), col_of(p) == F.lit(positive)
    c = df.agg(F.count_if(t & q).alias("tp"), F.count_if(~t & q).alias("fp"),
               F.count_if(t & ~q).alias("fn"), F.count_if(~t & ~q).alias("tn"))

    def div(a, b):
        return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b)
    prec = div(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = div(F.col("tp"), F.col("tp") + F.col("fn"))
    n = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    return c.select(
        div(F.col("tp") + F.col("tn"), n).alias("accuracy"), prec.alias("precision"), rec.alias("recall"),
        F.when(prec + rec == 0, F.lit(0.0)).otherwise(2 * prec * rec / (prec + rec)).alias("f1"),
        "tp", "fp", "fn", "tn", n.alias("n"))


def pair_counts(df: DataFrame, y: str, p: str) -> DataFrame:
    """(y_true, y_pred, n): k² rows at most, partial counts map-side."""
    return df.groupBy(col_of(y).alias("t"), col_of(p).alias("q")).agg(F.count(F.lit(1)).alias("n"))


def _classes_df(spark, classes, dtype: str):
    return spark.createDataFrame([(c,) for c in classes], f"c {dtype}")


def report(df: DataFrame, y: str, p: str, classes) -> DataFrame:
    """Per-class precision/recall/F1/support over the full class list, plus accuracy,
    macro and weighted averages (zero division → 0).  Long form: (label, precision, recall, f1, support)."""
    spark = df.sparkSession
    dtype = df.schema[y].dataType.simpleString()
    pc = pair_counts(df, y, p)
    cls = _classes_df(spark, classes, dtype)
    tp = pc.where("t = q").select(F.col("t").alias("c"), F.col("n").alias("tp"))
    sup = pc.groupBy(F.col("t").alias("c")).agg(F.sum("n").alias("support"))
    pred = pc.groupBy(F.col("q").alias("c")).agg(F.sum("n").alias("npred"))
    j = (cls.join(tp, "c", "left").join(sup, "c", "left").join(pred, "c", "left")
         .select("c", *[F.coalesce(F.col(x), F.lit(0)).cast("bigint").alias(x) for x in ("tp", "support", "npred")]))
    prec = F.when(F.col("npred") == 0, 0.0).otherwise(F.col("tp") / F.col("npred"))
    rec = F.when(F.col("support") == 0, 0.0).otherwise(F.col("tp") / F.col("support"))
    per = j.select(F.col("c").cast("string").alias("label"), prec.alias("precision"), rec.alias("recall"),
                   "support", "tp")
    per = per.withColumn("f1", F.when(F.col("precision") + F.col("recall") == 0, 0.0)
                         .otherwise(2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))))
    tot = per.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"),
                  F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                  F.sum(F.col("precision") * F.col("support")).alias("wp"),
                  F.sum(F.col("recall") * F.col("support")).alias("wr"),
                  F.sum(F.col("f1") * F.col("support")).alias("wf"))
    summary = tot.selectExpr(
        "stack(3, 'accuracy', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CASE WHEN n = 0 THEN 0.0 ELSE tp / n END, n,"
        " 'macro avg', mp, mr, mf, n,"
        f" 'weighted avg', CASE WHEN n = 0 THEN 0.0 ELSE wp / n END, CASE WHEN n = 0 THEN 0.0 ELSE wr / n END,"
        f" CASE WHEN n = 0 THEN 0.0 ELSE wf / n END, n) as (label, precision, recall, f1, support)")
    return per.select("label", "precision", "recall", "f1", "support").unionByName(
        summary.select("label", "precision", "recall", "f1", F.col("support").cast("bigint")))


def confusion(df: DataFrame, y: str, p: str, classes) -> DataFrame:
    """k×k confusion matrix in long form including zero cells: (y_true, y_pred, n)."""
    spark = df.sparkSession
    dtype = df.schema[y].dataType.simpleString()
    grid = spark.createDataFrame([(a, b) for a in classes for b in classes], f"t {dtype}, q {dtype}")
    pc = pair_counts(df, y, p)
    return (grid.join(pc, ["t", "q"], "left")
            .select(F.col("t").alias("y_true"), F.col("q").alias("y_pred"),
                    F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def log_loss(df: DataFrame, y: str, proba: str, classes, group: str | None = None, eps: float = 1e-15) -> DataFrame:
    """Mean cross-entropy of the true class and accuracy of the arg-max (first max wins)."""
    idx = F.array_position(F.array(*[F.lit(c) for c in classes]), col_of(y)).cast("int")
    pt = F.element_at(col_of(proba), idx)
    top = F.element_at(F.array(*[F.lit(c) for c in classes]),
                       F.array_position(col_of(proba), F.array_max(col_of(proba))).cast("int"))
    aggs = [F.avg(-F.log(F.greatest(pt, F.lit(eps)))).alias("loss"),
            F.avg((top == col_of(y)).cast("double")).alias("accuracy"), F.count(F.lit(1)).alias("n")]
    return df.groupBy(col_of(group)).agg(*aggs) if group else df.agg(*aggs)


def inertia(df: DataFrame, vec: str, centroids) -> DataFrame:
    """Within-cluster sum of squares: Σ min_j ‖x − c_j‖² (centroids are a k×d literal)."""
    mat = matrix_literal(centroids)
    d = F.array_min(F.transform(mat, lambda c: vec_sqdist(F.col(vec), c)))
    return df.agg(F.sum(d).alias("inertia"), F.count(F.lit(1)).alias("n"))


def _cluster_moments(df: DataFrame, vec: str, cluster: str, dim: int, max_clusters: int = 1000) -> list[dict]:
    """Per cluster: n, S = Σx (d values), Q = Σ‖x‖²; k rows to the driver (checked)."""
    from tablelearn.functions.exprs import grouped_vector_sums

    sums = grouped_vector_sums(df, cluster, vec, dim, max_clusters)
    q = {r["cl"]: float(r["q"]) for r in df.groupBy(col_of(cluster).alias("cl")).agg(
        F.sum(F.aggregate(F.col(vec), F.lit(0.0), lambda a, v: a + v * v)).alias("q")).collect()}
    return [{"cl": c, "n": n, "q": q[c], "s": s_} for c, (n, s_) in sums.items()]


def silhouette_sq(df: DataFrame, vec: str, cluster: str, dim: int, max_clusters: int = 1000) -> DataFrame:
    """Exact silhouette with *squared* Euclidean distance in O(n·k) (Spark's evaluator's definition).

    Mean squared distance from x to cluster C = ‖x‖² + Q_C/n_C − 2·x·S_C/n_C with
    S_C = Σx, Q_C = Σ‖x‖²; the own cluster excludes x itself: ×n_C/(n_C−1).
    Singleton clusters score 0.  Per-cluster moments are k rows (bounded, literal).
    """
    rows = _cluster_moments(df, vec, cluster, dim, max_clusters)
    if len(rows) < 2:
        raise ModelError("silhouette needs at least 2 clusters")
    cl = [r["cl"] for r in rows]
    ns = [float(r["n"]) for r in rows]
    qs = [float(r["q"]) for r in rows]
    ss = [list(map(float, r["s"])) for r in rows]
    x = F.col(vec)
    xx = F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v)
    structs = []
    for c, n, q, s in zip(cl, ns, qs, ss):
        dot = F.aggregate(F.zip_with(x, F.array(*[F.lit(v) for v in s]), lambda a, b: a * b), F.lit(0.0),
                          lambda a, v: a + v)
        mean_d = xx + F.lit(q / n) - 2 * dot / F.lit(n)
        structs.append((c, n, mean_d))
    own_n = F.element_at(F.create_map(*[z for c, n, _ in structs for z in (F.lit(c), F.lit(n))]), col_of(cluster))
    own = None
    other = None
    for c, n, md in structs:
        own = (F.when(col_of(cluster) == F.lit(c), md * F.lit(n) / F.lit(max(n - 1, 1.0))) if own is None
               else own.when(col_of(cluster) == F.lit(c), md * F.lit(n) / F.lit(max(n - 1, 1.0))))
        cand = F.when(col_of(cluster) == F.lit(c), F.lit(float("inf"))).otherwise(md)
        other = cand if other is None else F.least(other, cand)
    a, b = own.otherwise(F.lit(None)), other
    sil = F.when(own_n <= 1, F.lit(0.0)).otherwise(
        F.when(F.greatest(a, b) == 0, F.lit(0.0)).otherwise((b - a) / F.greatest(a, b)))
    return df.agg(F.avg(sil).alias("silhouette"), F.count(F.lit(1)).alias("n"))


def davies_bouldin(df: DataFrame, vec: str, cluster: str, dim: int, max_clusters: int = 1000) -> DataFrame:
    """Davies–Bouldin index: pass 1 centroids (k rows), pass 2 mean distance to own centroid,
    then max over the k×k centroid pairs (small table, literals) and the mean."""
    spark = df.sparkSession
    cm = _cluster_moments(df, vec, cluster, dim, max_clusters)
    cents = {r["cl"]: [float(v) / r["n"] for v in r["s"]] for r in cm}
    keys = sorted(cents)
    cmap = F.create_map(*[z for c in keys for z in (F.lit(c), F.array(*[F.lit(v) for v in cents[c]]))])
    dist = F.sqrt(vec_sqdist(F.col(vec), F.element_at(cmap, col_of(cluster))))
    s = df.groupBy(col_of(cluster).alias("cl")).agg(F.avg(dist).alias("s")).collect()
    sd = {r["cl"]: r["s"] for r in s}
    rows = []
    for i in keys:
        best = 0.0
        for j in keys:
            if i == j:
                continue
            dij = sum((a - b) ** 2 for a, b in zip(cents[i], cents[j])) ** 0.5
            r = (sd[i] + sd[j]) / dij if dij > 0 else float("inf")
            best = max(best, r)
        rows.append((i, best))
    return spark.createDataFrame(rows, "cl long, r double").agg(F.avg("r").alias("davies_bouldin"),
                                                               F.count(F.lit(1)).alias("k"))
