"""Profiling aggregates: exact quantiles, moments, describe, counts, correlation, histograms,
group profiles.  Every output is a small long-form DataFrame.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablelearn.functions.exprs import col_of, is_missing, nan_to_null

MAX_BRACKET = 2_000_000


def _positions(n: int, p: float) -> tuple[int, int, float]:
    pos = (n - 1) * p
    lo = int(math.floor(pos))
    return lo, min(lo + 1, n - 1) if pos > lo else lo, pos - lo


def costly(df: DataFrame) -> bool:
    """Whether reading ``df`` again means joining or aggregating again, and nothing under it is cached."""
    plan = df._jdf.queryExecution().withCachedData().toString()
    return "InMemoryRelation" not in plan and ("Join" in plan or "Aggregate" in plan)


def exact_quantiles(df: DataFrame, cols, probs, accuracy: int = 10000, max_bracket: int = MAX_BRACKET) -> dict:
    """Exact linear-interpolated quantiles of several columns, without one giant buffer.

    Each wanted order statistic k (0-based) is held in a value bracket [lo, hi] with a
    known count ``below`` of values < lo.  Round 0: approximate quantiles at p ± 3/accuracy
    (job 1).  Each round: count below/inside every bracket (one job); brackets still wider
    than ``max_bracket`` rows are narrowed by approximate quantiles of the values inside
    them (one job; each narrowing shrinks a bracket ~accuracy/6 times, until only ties are
    left).  One last job ranks the values of all brackets on the executors.  So the number of
    scans does not depend on the number of columns and probabilities.  A
    bracket that misses its statistic is widened to [min, max], so the answer is always
    exact.  ``probs`` may differ by column ({col: probs}).  Returns {col: {p: value or None}}.
    A joined or aggregated input is kept for the scans (its columns only).
    """
    cols = list(cols)
    x = df.select(*[nan_to_null(df, c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    keep = costly(x)
    x = x.persist(StorageLevel.MEMORY_AND_DISK) if keep else x
    try:
        return _bracketed(x, cols, {c: list(probs[c] if isinstance(probs, dict) else probs) for c in cols}, accuracy, max_bracket)
    finally:
        if keep:
            x.unpersist()


def _bracketed(x: DataFrame, cols: list, asked: dict, accuracy: int, max_bracket: int) -> dict:
    d = 3.0 / accuracy

    def clip(v):
        return max(0.0, min(1.0, v))
    aggs = []
    for i in range(len(cols)):
        c = F.col(f"c{i}")
        edges = sorted({clip(p + s) for p in asked[cols[i]] for s in (-d, d)})
        aggs += [F.count(c).alias(f"n{i}"), F.min(c).alias(f"mn{i}"), F.max(c).alias(f"mx{i}"),
                 F.percentile_approx(c, edges, accuracy).alias(f"q{i}")]
    r1 = x.agg(*aggs).first()
    st = {}  # (i, p) -> dict(k1, k2, frac, lo, hi)
    for i in range(len(cols)):
        n = r1[f"n{i}"]
        if not n:
            continue
        edges = sorted({clip(p + s) for p in asked[cols[i]] for s in (-d, d)})
        q = dict(zip(edges, r1[f"q{i}"]))
        for p in asked[cols[i]]:
            k1, k2, frac = _positions(n, p)
            lo = q[clip(p - d)] if p - d > 0 else r1[f"mn{i}"]
            hi = q[clip(p + d)] if p + d < 1 else r1[f"mx{i}"]
            st[(i, p)] = {"k1": k1, "k2": k2, "frac": frac, "lo": lo, "hi": hi}
    out = {c: {p: None for p in asked[c]} for c in cols}
    if not st:
        return out
    keys = list(st)
    for _ in range(64):
        cnt = []
        for j, key in enumerate(keys):
            c, b = F.col(f"c{key[0]}"), st[key]
            cnt += [F.count_if(c < F.lit(b["lo"])).alias(f"b{j}"),
                    F.count_if(c.between(F.lit(b["lo"]), F.lit(b["hi"]))).alias(f"w{j}"),
                    F.count_if(c == F.lit(b["lo"])).alias(f"el{j}"), F.count_if(c == F.lit(b["hi"])).alias(f"eh{j}")]
        r2 = x.agg(*cnt).first()
        wide = []
        for j, key in enumerate(keys):
            b = st[key]
            if "value" in b:
                continue
            b["below"], b["inside"] = r2[f"b{j}"], r2[f"w{j}"]
            if not (b["below"] <= b["k1"] and b["below"] + b["inside"] > b["k2"]):
                i = key[0]
                b["lo"], b["hi"] = r1[f"mn{i}"], r1[f"mx{i}"]  # missed: widen, then narrow again
                b["below"], b["inside"] = 0, r1[f"n{i}"]
                wide.append(key)
                continue
            lo_end = b["below"] + r2[f"el{j}"]            # ranks [below, lo_end) hold the value lo
            hi_start = b["below"] + b["inside"] - r2[f"eh{j}"]  # ranks [hi_start, ...) hold hi
            v1 = b["lo"] if b["k1"] < lo_end else b["hi"] if b["k1"] >= hi_start else None
            v2 = b["lo"] if b["k2"] < lo_end else b["hi"] if b["k2"] >= hi_start else None
            if v1 is not None and v2 is not None:  # both statistics sit on tied end values
                b["value"] = v1 + (v2 - v1) * b["frac"] if b["k2"] != b["k1"] else v1
            elif b["inside"] > max_bracket:
                wide.append(key)
        if not wide:
            break
        nar = []
        for j, key in enumerate(wide):
            b = st[key]
            c = F.col(f"c{key[0]}")
            inb = F.when(c.between(F.lit(b["lo"]), F.lit(b["hi"])), c)
            rel_lo = (b["k1"] - b["below"]) / max(b["inside"] - 1, 1)
            rel_hi = (b["k2"] - b["below"]) / max(b["inside"] - 1, 1)
            nar.append(F.percentile_approx(inb, [clip(rel_lo - d), clip(rel_hi + d)], accuracy).alias(f"a{j}"))
        r3 = x.agg(*nar).first()
        progress = False
        for j, key in enumerate(wide):
            b = st[key]
            lo, hi = r3[f"a{j}"]
            rel_lo = (b["k1"] - b["below"]) / max(b["inside"] - 1, 1)
            rel_hi = (b["k2"] - b["below"]) / max(b["inside"] - 1, 1)
            new_lo = lo if rel_lo - d > 0 else b["lo"]
            new_hi = hi if rel_hi + d < 1 else b["hi"]
            progress |= (new_lo, new_hi) != (b["lo"], b["hi"])
            b["lo"], b["hi"] = new_lo, new_hi
        if not progress:
            break
    # one scan tags the values of all brackets; ties are counted map-side, each bracket is ranked by
    # the executors, and at most two values a bracket reach the driver
    open_ = [j for j, key in enumerate(keys) if "value" not in st[key]]
    picked = {}
    if open_:
        hit = [F.when(F.col(f"c{keys[j][0]}").between(F.lit(st[keys[j]]["lo"]), F.lit(st[keys[j]]["hi"])),
                      F.struct(F.lit(j).alias("j"), F.col(f"c{keys[j][0]}").alias("v"))) for j in open_]
        g = (x.select(F.explode(F.array_compact(F.array(*hit))).alias("s"))
             .groupBy(F.col("s.j").alias("j"), F.col("s.v").alias("v")).agg(F.count(F.lit(1)).alias("n")))
        g = g.withColumn("upto", F.sum("n").over(Window.partitionBy("j").orderBy("v")))
        want = {k: F.element_at(F.create_map(*[F.lit(z) for j in open_ for z in (j, st[keys[j]][k] - st[keys[j]]["below"])]), F.col("j"))
                for k in ("k1", "k2")}
        held = {k: (F.col("upto") > w) & (F.col("upto") - F.col("n") <= w) for k, w in want.items()}
        for r in g.where(held["k1"] | held["k2"]).select("j", "v", held["k1"].alias("k1"), held["k2"].alias("k2")).collect():
            picked.update({(r["j"], k): r["v"] for k in ("k1", "k2") if r[k]})
    for j, key in enumerate(keys):
        b = st[key]
        if "value" not in b:
            v1, v2 = picked[j, "k1"], picked[j, "k2"]
            b["value"] = v1 + (v2 - v1) * b["frac"] if b["k2"] != b["k1"] else v1
        out[cols[key[0]]][key[1]] = b["value"]
    return out


def median_cols(df: DataFrame, cols) -> DataFrame:
    """Exact median per column (missing ignored, even count → mean of middle two): (column, median)."""
    q = exact_quantiles(df, cols, [0.5])
    return df.sparkSession.createDataFrame([(c, q[c][0.5]) for c in cols], "column string, median double")


def quartiles(df: DataFrame, cols, probs=(0.25, 0.75)) -> DataFrame:
    q = exact_quantiles(df, cols, probs)
    rows = [(c, float(p), q[c][p]) for c in cols for p in probs]
    return df.sparkSession.createDataFrame(rows, "column string, p double, value double")


def col_moments(df: DataFrame, cols) -> DataFrame:
    """Mean and population std per column (one aggregation): (column, mean, std)."""
    aggs = []
    for i, c in enumerate(cols):
        v = nan_to_null(df, c).cast("double")
        aggs += [F.avg(v).alias(f"m{i}"), F.stddev_pop(v).alias(f"s{i}")]
    stack = ", ".join(f"'{c}', m{i}, s{i}" for i, c in enumerate(cols))
    return df.agg(*aggs).selectExpr(f"stack({len(cols)}, {stack}) as (column, mean, std)")


def describe_exact(df: DataFrame, cols) -> DataFrame:
    """count, mean, sample std, min, 25/50/75 % (exact), max, as (column, stat, value)."""
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    aggs = []
    for i, c in enumerate(cols):
        v = nan_to_null(df, c).cast("double")
        aggs += [F.count(v).cast("double").alias(f"n{i}"), F.avg(v).alias(f"m{i}"), F.stddev_samp(v).alias(f"s{i}"),
                 F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}")]
    parts = []
    for i, c in enumerate(cols):
        parts += [f"'{c}', 'count', n{i}", f"'{c}', 'mean', m{i}", f"'{c}', 'std', s{i}", f"'{c}', 'min', lo{i}",
                  f"'{c}', 'max', hi{i}"]
        for p, name in ((0.25, "25%"), (0.5, "50%"), (0.75, "75%")):
            val = q[c][p]
            parts.append(f"'{c}', '{name}', cast({'NULL' if val is None else repr(float(val))} as double)")
    return df.agg(*aggs).selectExpr(f"stack({len(parts)}, {', '.join(parts)}) as (column, stat, value)")


def null_counts(df: DataFrame, cols=None) -> DataFrame:
    """dtype and missing (null or NaN) count per column, one aggregation: (column, dtype, nulls)."""
    cols = cols or df.columns
    dt = dict(df.dtypes)
    row = df.agg(*[F.count_if(is_missing(df, c)).cast("bigint").alias(f"n{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', '{dt[c]}', n{i}" for i, c in enumerate(cols))
    return row.selectExpr(f"stack({len(cols)}, {stack}) as (column, dtype, nulls)")


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Counts and shares of each non-null value: (value, n, share)."""
    c = col_of(col)
    g = df.where(c.isNotNull()).groupBy(c.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = F.broadcast(g.agg(F.sum("n").alias("_total")))  # one row
    return g.crossJoin(total).select("value", "n", (F.col("n") / F.col("_total").cast("double")).alias("share"))


def corr_matrix(df: DataFrame, cols) -> DataFrame:
    """Pearson r for every ordered pair, one aggregation over the unordered ones: (x, y, r)."""
    cols = list(cols)
    half = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    aggs = [F.corr(nan_to_null(df, cols[i]).cast("double"), nan_to_null(df, cols[j]).cast("double")).alias(f"r{i}_{j}")
            for i, j in half]
    stack = ", ".join(f"'{a}', '{b}', r{min(i, j)}_{max(i, j)}" for i, a in enumerate(cols) for j, b in enumerate(cols))
    return df.agg(*aggs).selectExpr(f"stack({len(cols) ** 2}, {stack}) as (x, y, r)")


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """Equal-width bins over [min, max], last bin closed; empty bins kept: (bin, lo, hi, n, mean)."""
    v = nan_to_null(df, col).cast("double")
    r = df.agg(F.min(v).alias("mn"), F.max(v).alias("mx"), F.avg(v).alias("mean")).first()
    mn, mx, mean = r["mn"], r["mx"], r["mean"]
    spark = df.sparkSession
    if mn is None:
        return spark.createDataFrame([], "bin int, lo double, hi double, n bigint, mean double")
    w = (mx - mn) / bins if mx > mn else 1.0
    b = F.least(F.floor((v - F.lit(mn)) / F.lit(w)), F.lit(bins - 1)).cast("int")
    counts = df.where(v.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edges = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (edges.join(F.broadcast(counts), "bin", "left")
            .select("bin", (F.lit(mn) + F.col("bin") * F.lit(w)).alias("lo"),
                    (F.lit(mn) + (F.col("bin") + 1) * F.lit(w)).alias("hi"),
                    F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), F.lit(mean).alias("mean")))


def group_profile(df: DataFrame, group: str, features, segment: str | None = None,
                  places: tuple | None = (1, 2)) -> DataFrame:
    """Per-group size, % of total (1 dp), feature means (2 dp) and segment shares map.

    One groupBy for sizes and means; segment shares from a (group, segment) count
    folded into a map per group.  The total is a one-row aggregate (no window).
    """
    def rnd(c, i):
        return F.round(c, places[i]) if places else c
    aggs = [F.count(F.lit(1)).alias("size")] + [rnd(F.avg(col_of(f)), 1).alias(f"mean_{f}") for f in features]
    g = df.groupBy(col_of(group).alias(group)).agg(*aggs)
    total = F.broadcast(g.agg(F.sum("size").alias("_total")))  # one row
    g = g.crossJoin(total).withColumn("pct", rnd(F.col("size") / F.col("_total").cast("double") * 100, 0)).drop("_total")
    if segment and segment in df.columns:
        seg = (df.groupBy(col_of(group).alias(group), col_of(segment).alias("seg")).agg(F.count(F.lit(1)).alias("c"))
               .join(g.select(group, "size"), group)
               .groupBy(group).agg(F.map_from_entries(F.array_sort(F.collect_list(
                   F.struct("seg", rnd(F.col("c") / F.col("size") * 100, 0))))).alias("segment_pct")))
        g = g.join(seg, group)
    return g


def profile_pivot(df: DataFrame, group: str, segment: str, values, places: int | None = 1) -> DataFrame:
    """One row per group, one column per fixed segment value holding its % share (1 dp)."""
    p = df.groupBy(col_of(group).alias(group)).pivot(segment, list(values)).count()
    size = df.groupBy(col_of(group).alias(group)).agg(F.count(F.lit(1)).alias("size"))
    j = p.join(size, group)
    def rnd(c):
        return F.round(c, places) if places is not None else c
    return j.select(group, *[rnd(F.coalesce(col_of(v), F.lit(0)) / F.col("size") * 100).alias(f"pct_{v}")
                             for v in values])


def shape_counts(df: DataFrame, distinct_col: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_cols"),
                  F.count_distinct(col_of(distinct_col)).alias("n_distinct"))
