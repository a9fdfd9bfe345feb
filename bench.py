"""Benchmark: headline workflows and operator queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line.  One run of the price workflow warms the JVM; then every job is
executed fully (noop sink, no collect) $BENCH_REPS times and the median is reported.  The
total is that of the four workflows, the forest (project F: 200 trees, depth 20) included.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tablelearn.session import get_spark  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "4")
REPS = int(os.environ.get("BENCH_REPS", "3"))


def _sink(df):
    df.write.format("noop").mode("overwrite").save()


def pipeline_price(spark, sf):
    from tablelearn.plans import price
    _sink(price.run(spark, sf))


def pipeline_segments(spark, sf):
    from tablelearn.plans import segments
    out = segments.run(spark, sf)
    for df in (out["labels"], out["quality"], out["profiles"]):
        _sink(df)


def pipeline_images(spark, sf):
    """Project D configuration: HOG + histogram, RBF SVC (C=5, gamma=scale) via RFF."""
    from tablelearn.plans import image_classes
    out = image_classes.run(spark, sf, backend="svm_rbf", test=0.2, val=0.1, C=5.0)
    for df in out.values():
        _sink(df)


def pipeline_images_forest(spark, sf):
    """Project F configuration: HOG + histogram, random forest 200 trees, depth 20."""
    from tablelearn.plans import image_classes
    out = image_classes.run(spark, sf, backend="forest")
    for df in out.values():
        _sink(df)


def _query(name):
    def run(spark, sf):
        from tablelearn.plans.queries import QUERIES
        _sink(QUERIES[name](spark, sf))
    return run


HEADLINE = {
    "pipeline_price": pipeline_price,
    "pipeline_segments": pipeline_segments,
    "pipeline_images": pipeline_images,
    "pipeline_images_forest": pipeline_images_forest,
}
OPERATORS = ["split_holdout", "split_stratified3", "kfold_assign", "median_cols", "describe_exact", "validate_orders",
             "duplicate_keys", "corr_matrix", "standard_scale", "regression_metrics_by", "classification_report",
             "confusion_matrix", "kmeans_fixed_init", "silhouette_sq", "davies_bouldin", "hog_blocks",
             "color_hist_density", "early_stop", "lr_plateau", "lookup_default", "predictions_with_lookup",
             "grid_search", "mlp_fit", "cv_rmse_full", "silhouette"]


def main():
    only = [a for a in sys.argv[1:]]
    spark = get_spark(f"local[{CPUS}]", shuffle_partitions=int(CPUS) * 2,
                      extra={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    jobs = {**HEADLINE, **{n: _query(n) for n in OPERATORS}}
    if only:
        jobs = {k: v for k, v in jobs.items() if k in only}
    times = {}
    pipeline_price(spark, SF_DIR)  # JVM / JIT / Python-worker warm-up
    for name, fn in jobs.items():
        runs = []
        for _ in range(REPS):
            spark.catalog.clearCache()  # no reuse of a previous repetition's persisted data
            t0 = time.perf_counter()
            fn(spark, SF_DIR)
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_pipelines_total_sec",
                      "value": round(sum(times[k] for k in HEADLINE if k in times), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
