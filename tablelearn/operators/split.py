"""Exact, deterministic splits by hashed order, without a global window.

Contract: rows of a stratum are ordered by ``md5('<seed>:<key>')`` then key (the key
must be unique); the first quota rows go to the first part, and so on.

Scale method: a histogram of the leading hex digits of the hash per stratum (map-side
partial counts) stays a DataFrame; a window over the buckets of a stratum gives each bucket
its offset.  The driver sees one count per stratum and, for every cut position, the one row
that holds it: only the rows of those boundary buckets are ranked (a window partitioned by
stratum and bucket).  The split itself is then a projection comparing each row's (hash, key)
with the cut rows: no shuffle of the data, same answer as a full window.  Null is a
stratum, or a group, like any other value.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablelearn.errors import SizeBoundError
from tablelearn.functions.exprs import col_of, hash_bucket, order_hash

#: Strata whose counts the driver may hold; more are refused.
MAX_STRATA = 100_000
LITERAL_STRATA = 64


def _prep(df: DataFrame, key: str, seed, strata, digits: int) -> DataFrame:
    h = order_hash(key, seed)
    d = df.withColumn("_h", h).withColumn("_b", hash_bucket(F.col("_h"), digits))
    if strata:
        d = d.withColumn("_s", col_of(strata))
    else:
        d = d.withColumn("_s", F.lit(0))
    return d


def bucket_histogram(d: DataFrame) -> DataFrame:
    """(_hs, _hb, n, before): rows of each stratum's buckets and in the buckets before."""
    w = Window.partitionBy("_hs").orderBy("_hb").rowsBetween(Window.unboundedPreceding, -1)
    return (d.groupBy(F.col("_s").alias("_hs"), F.col("_b").alias("_hb")).agg(F.count(F.lit(1)).alias("n"))
            .withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0))))


def stratum_counts(hist: DataFrame) -> dict:
    rows = hist.groupBy("_hs").agg(F.sum("n").alias("n")).limit(MAX_STRATA + 1).collect()
    if len(rows) > MAX_STRATA:
        raise SizeBoundError(f"more than {MAX_STRATA} strata")
    return {r["_hs"]: r["n"] for r in rows}


def cut_rows(d: DataFrame, key: str, hist: DataFrame, counts: dict, cuts: dict) -> dict:
    """For each stratum and cut c (rows ranked ≤ c fall before it) return the c-th row's
    (hash, key), or "all"/"none" when the cut lies outside the stratum."""
    need, res = [], {}
    for s, cs in cuts.items():
        for c in cs:
            if c <= 0:
                res[(s, c)] = "all"
            elif c >= counts.get(s, 0):
                res[(s, c)] = "none"
            else:
                need.append((s, c))
    if need:
        stype = d.schema["_s"].dataType.simpleString()
        want = d.sparkSession.createDataFrame(sorted(set(need), key=str), f"_ws {stype}, _c long")
        want = (hist.join(F.broadcast(want), F.col("_ws").eqNullSafe(F.col("_hs"))
                          & (F.col("before") < F.col("_c")) & (F.col("_c") <= F.col("before") + F.col("n")))
                .select("_ws", "_hb", "_c", (F.col("_c") - F.col("before")).cast("int").alias("_wp")))
        w = Window.partitionBy("_s", "_b").orderBy("_h", key)
        here = F.col("_s").eqNullSafe(F.col("_ws")) & (F.col("_b") == F.col("_hb"))
        ranked = (d.join(F.broadcast(want.select("_ws", "_hb").distinct()), here, "left_semi")
                  .select("_s", "_b", "_h", col_of(key).alias("_k"), F.row_number().over(w).alias("_p")))
        got = ranked.join(F.broadcast(want), here & (F.col("_p") == F.col("_wp"))).select("_s", "_c", "_h", "_k").collect()
        for r in got:
            res[(r["_s"], r["_c"])] = (r["_h"], r["_k"])
    return res


def _after(th, key: str) -> Column:
    if th == "all":
        return F.lit(1)
    if th == "none":
        return F.lit(0)
    h, k = th
    return F.when((F.col("_h") > F.lit(h)) | ((F.col("_h") == F.lit(h)) & (col_of(key) > F.lit(k))), 1).otherwise(0)


def part_index(d: DataFrame, key: str, cuts: dict, th: dict) -> DataFrame:
    """Add ``_part`` = number of the stratum's cut rows strictly before this row."""
    strata = list(cuts)
    if len(strata) <= LITERAL_STRATA:
        expr = None
        for s in strata:
            e = sum((_after(th[(s, c)], key) for c in cuts[s]), F.lit(0))
            here = F.col("_s").eqNullSafe(F.lit(s))
            expr = F.when(here, e) if expr is None else expr.when(here, e)
        return d.withColumn("_part", expr.otherwise(F.lit(0)) if expr is not None else F.lit(0))
    # many strata: a broadcast table with one row per stratum (size checked ≤ MAX_STRATA)
    spark = d.sparkSession
    rows = []
    for s in strata:
        ts = []
        for c in cuts[s]:
            t = th[(s, c)]
            ts.append(("", None, 1) if t == "all" else ("", None, 2) if t == "none" else (t[0], str(t[1]), 0))
        rows.append((s, ts))
    stype = d.schema["_s"].dataType.simpleString()
    tab = spark.createDataFrame(rows, f"_ts {stype}, _t array<struct<h:string,k:string,mode:int>>")
    kk = col_of(key).cast("string") if d.schema[key].dataType.simpleString() == "string" else col_of(key)
    j = d.join(F.broadcast(tab), F.col("_s").eqNullSafe(F.col("_ts")), "left")
    cnt = F.size(F.filter("_t", lambda t: (t["mode"] == 1) | ((t["mode"] == 0) & (
        (F.col("_h") > t["h"]) | ((F.col("_h") == t["h"]) & (kk > t["k"].cast(d.schema[key].dataType)))))))
    return j.withColumn("_part", cnt).drop("_t", "_ts")


def split_by_cuts(df: DataFrame, key: str, seed, strata, cuts_fn, digits: int = 4) -> DataFrame:
    """Generic driver: ``cuts_fn(counts) -> {stratum: [cut positions]}`` from per-stratum sizes."""
    d = _prep(df, key, seed, strata, digits)
    hist = bucket_histogram(d).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counts = stratum_counts(hist)
        cuts = cuts_fn(counts)
        th = cut_rows(d, key, hist, counts, cuts)
    finally:
        hist.unpersist()
    return part_index(d, key, cuts, th)


def largest_remainder(counts: dict, quota: int) -> dict:
    """Allocate ``quota`` over strata proportionally: floors, then the largest remainders
    (ties to the smaller stratum value, null last).  Integer arithmetic only."""
    total = sum(counts.values())
    if total == 0:
        return {s: 0 for s in counts}
    base = {s: (n * quota) // total for s, n in counts.items()}
    rem = {s: (n * quota) % total for s, n in counts.items()}
    left = quota - sum(base.values())
    for s in sorted(counts, key=lambda s: (-rem[s], s is None, s if s is not None else 0))[:left]:
        base[s] += 1
    return base


def holdout(df: DataFrame, key: str, test_frac: float = 0.2, seed=42, digits: int = 4) -> DataFrame:
    """Random holdout: test = ceil(n·frac) rows of the hash order.  Adds ``split`` ∈ {train, test}."""
    def cuts(counts):
        n = counts.get(0, 0)
        return {0: [int(math.ceil(n * float(test_frac)))]}
    d = split_by_cuts(df, key, seed, None, cuts, digits)
    return d.withColumn("split", F.when(F.col("_part") == 0, "test").otherwise("train")).drop("_h", "_b", "_s", "_part")


def stratified(df: DataFrame, key: str, label: str, test_frac: float, val_frac: float = 0.0,
               seed=42, digits: int = 4) -> DataFrame:
    """Stratified test / val / train.  Test quotas first (ceil(N·test), largest remainder over
    labels), then val = ceil(N_rest·val/(1−test)) over the remaining counts."""
    def cuts(counts):
        n = sum(counts.values())
        n_test = int(math.ceil(n * float(test_frac)))
        t = largest_remainder(counts, n_test)
        out = {s: [t[s]] for s in counts}
        if val_frac:
            rest = {s: counts[s] - t[s] for s in counts}
            n_val = int(math.ceil((n - n_test) * (float(val_frac) / (1.0 - float(test_frac)))))
            v = largest_remainder(rest, n_val)
            out = {s: [t[s], t[s] + v[s]] for s in counts}
        return out
    d = split_by_cuts(df, key, seed, label, cuts, digits)
    names = F.when(F.col("_part") == 0, "test").when(F.col("_part") == 1, "val" if val_frac else "train").otherwise("train")
    return d.withColumn("split", names).drop("_h", "_b", "_s", "_part")


def kfold(df: DataFrame, key: str, k: int = 5, seed=42, digits: int = 4) -> DataFrame:
    """Shuffled K-fold: fold sizes differ by ≤1, the first n mod k folds are larger.  Adds ``fold``."""
    def cuts(counts):
        n = counts.get(0, 0)
        q, r = divmod(n, k)
        sizes = [q + 1 if i < r else q for i in range(k)]
        acc, out = 0, []
        for s in sizes[:-1]:
            acc += s
            out.append(acc)
        return {0: out}
    d = split_by_cuts(df, key, seed, None, cuts, digits)
    return d.withColumn("fold", F.col("_part").cast("int")).drop("_h", "_b", "_s", "_part")


def exact_rank(df: DataFrame, key: str, seed=42, strata: str | None = None, digits: int = 4) -> DataFrame:
    """0-based rank of every row within its stratum in hash order, without a stratum-wide window:
    bucket offsets (joined) + row_number inside (stratum, bucket)."""
    d = _prep(df, key, seed, strata, digits)
    offs = bucket_histogram(d).select("_hs", "_hb", "before")
    w = Window.partitionBy("_s", "_b").orderBy("_h", key)
    r = (d.withColumn("_n", F.row_number().over(w))
         .join(offs, F.col("_s").eqNullSafe(F.col("_hs")) & (F.col("_b") == F.col("_hb")))
         .withColumn("_rank", F.col("before") + F.col("_n") - 1))
    return r.drop("_h", "_b", "_s", "_n", "_hs", "_hb", "before")


def stratified_kfold(df: DataFrame, key: str, label: str, k: int = 3, seed=42, digits: int = 4) -> DataFrame:
    """Stratified folds: rank within label (hash order) modulo k.  Adds ``fold``."""
    r = exact_rank(df, key, seed, label, digits)
    return r.withColumn("fold", (F.col("_rank") % k).cast("int")).drop("_rank")


def check_partition(parts: dict, key: str) -> DataFrame:
    """Disjoint and complete?  (n_rows, n_keys, n_overlap) over the union of the parts."""
    u = None
    for name, p in parts.items():
        x = p.select(col_of(key).alias("k"), F.lit(name).alias("part"))
        u = x if u is None else u.unionByName(x)
    per = u.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.sum("n").cast("bigint").alias("n_rows"), F.count(F.lit(1)).alias("n_keys"),
                   F.count_if(F.col("n") > 1).cast("bigint").alias("n_overlap"))


def split_by_group(df: DataFrame, group: str, test_frac: float = 0.2, seed=42, digits: int = 4) -> DataFrame:
    """Group-aware holdout: whole groups go to one part.  Groups are taken in hash order
    while the rows before them number fewer than ceil(n·frac).  Adds ``split``.

    Group sizes are pre-aggregated (one row per group); their weighted prefix sums use
    bucket offsets (16^digits at most) plus a window inside each bucket, never a global window.
    Spark broadcasts the group → split table where its measured size allows.
    """
    g = df.groupBy(col_of(group).alias("_g")).agg(F.count(F.lit(1)).alias("_w"))
    g = g.withColumn("_h", order_hash("_g", seed)).withColumn("_b", hash_bucket(F.col("_h"), digits))
    sums = g.groupBy("_b").agg(F.sum("_w").alias("s")).collect()
    total = sum(r["s"] for r in sums)
    quota = int(math.ceil(total * float(test_frac)))
    offs, acc = [], 0
    for r in sorted(sums, key=lambda r: r["_b"]):
        offs.append((r["_b"], acc))
        acc += r["s"]
    off = df.sparkSession.createDataFrame(offs, "_b int, _off long")
    w = Window.partitionBy("_b").orderBy("_h", "_g").rowsBetween(Window.unboundedPreceding, -1)
    gs = (g.join(F.broadcast(off), "_b")
          .withColumn("_before", F.col("_off") + F.coalesce(F.sum("_w").over(w), F.lit(0)))
          .select(F.col("_g"), F.when(F.col("_before") < quota, "test").otherwise("train").alias("split")))
    return df.join(gs, col_of(group).eqNullSafe(F.col("_g"))).drop("_g")
