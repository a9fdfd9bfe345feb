"""DuckDB twins of the registered queries (independent formulations: plain windows,
cross joins and pairwise forms where Spark uses the scalable method)."""

from __future__ import annotations

ORACLE: dict = {}

OF = """of AS (
  SELECT o.o_orderkey AS id, o.o_custkey AS cust, o.o_orderstatus AS status, o.o_totalprice AS target,
         CAST(COALESCE(l.n, 0) AS DOUBLE) AS n_lines, COALESCE(l.q, CAST(0 AS DOUBLE)) AS qty,
         CASE WHEN o.o_orderkey % 50 = 0 THEN NULL ELSE COALESCE(l.g, CAST(0 AS DOUBLE)) END AS gross,
         CAST(EXTRACT(YEAR FROM o.o_orderdate) AS INT) AS yr
  FROM orders o LEFT JOIN (SELECT l_orderkey, COUNT(*) AS n, SUM(l_quantity) AS q, SUM(l_extendedprice) AS g
                           FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey)"""

CF = """cf AS (
  SELECT c.c_custkey AS id, c.c_mktsegment AS segment, c.c_acctbal AS acctbal,
         CAST(COUNT(o.o_orderkey) AS DOUBLE) AS n_orders, COALESCE(SUM(o.o_totalprice), CAST(0 AS DOUBLE)) AS spend,
         COALESCE(AVG(o.o_totalprice), CAST(0 AS DOUBLE)) AS avg_order
  FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey
  GROUP BY c.c_custkey, c.c_mktsegment, c.c_acctbal)"""

EMB = """emb AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS embedding, label FROM embeddings)"""

EMB_LONG = """emb_long AS (SELECT vec_id, label, generate_subscripts(embedding, 1) - 1 AS pos,
                              CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)"""

DOC = """doc AS (
  SELECT d.doc_id, l.quality AS label, CAST(LENGTH(d.text) AS INT) AS n,
         LENGTH(regexp_replace(d.text, '[^A-Za-z]', '', 'g')) / CAST(LENGTH(d.text) AS DOUBLE) AS letters,
         LENGTH(regexp_replace(d.text, '[^0-9]', '', 'g')) / CAST(LENGTH(d.text) AS DOUBLE) AS digits,
         LENGTH(regexp_replace(d.text, '[^ ]', '', 'g')) / CAST(LENGTH(d.text) AS DOUBLE) AS spaces
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id WHERE LENGTH(d.text) > 0)"""

SCORED = EMB_LONG + """,
scored AS (
  SELECT vec_id, label AS y_true, c AS y_pred FROM (
    SELECT vec_id, label, c, row_number() OVER (PARTITION BY vec_id ORDER BY d, c) AS r FROM (
      SELECT e.vec_id, e.label, m.label AS c, SUM((e.v - m.v) * (e.v - m.v)) AS d
      FROM emb_long e JOIN (SELECT label, pos, AVG(v) AS v FROM emb_long GROUP BY label, pos) m ON m.pos = e.pos
      GROUP BY e.vec_id, e.label, m.label) a) b WHERE r = 1)"""


def H(key):
    return f"md5('42:' || CAST({key} AS VARCHAR))"


HOLDOUT_OF = OF + f""",
ho AS (SELECT of.*, CASE WHEN row_number() OVER (ORDER BY {H('id')}, id)
                         <= CAST(ceil(count(*) OVER () * CAST(0.2 AS DOUBLE)) AS BIGINT)
                    THEN 'test' ELSE 'train' END AS split FROM of)"""

KFOLD_OF = OF + f""",
kf AS (SELECT *, CAST(CASE WHEN r < (n % 5) * (n // 5 + 1) THEN r // (n // 5 + 1)
                         ELSE (n % 5) + (r - (n % 5) * (n // 5 + 1)) // (n // 5) END AS INT) AS fold
       FROM (SELECT of.*, row_number() OVER (ORDER BY {H('id')}, id) - 1 AS r, count(*) OVER () AS n FROM of))"""


def rule_rows(rows):
    return "\nUNION ALL ".join(rows)


# ---------------------------------------------------------------- validation
ORACLE["validate_orders"] = f"""WITH {OF}
SELECT CAST(0 AS INT) AS seq, 'columns' AS rule, '*' AS "column", CAST(0 AS BIGINT) AS violations
UNION ALL SELECT 1, 'non_empty', '*', CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT) FROM of
UNION ALL SELECT 2, 'positive', 'target', CAST(count(*) FILTER (WHERE target <= 0) AS BIGINT) FROM of
UNION ALL SELECT 3, 'not_null', 'target', CAST(count(*) FILTER (WHERE target IS NULL OR isnan(target)) AS BIGINT) FROM of
UNION ALL SELECT 4, 'non_negative', 'n_lines', CAST(count(*) FILTER (WHERE n_lines < 0) AS BIGINT) FROM of
UNION ALL SELECT 5, 'non_negative', 'qty', CAST(count(*) FILTER (WHERE qty < 0) AS BIGINT) FROM of"""

ORACLE["validate_customers"] = f"""WITH {CF}
SELECT CAST(0 AS INT) AS seq, 'columns' AS rule, '*' AS "column", CAST(0 AS BIGINT) AS violations
UNION ALL SELECT 1, 'non_empty', '*', CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT) FROM cf
UNION ALL SELECT 2, 'unique', 'id', CAST(count(*) - count(DISTINCT id) AS BIGINT) FROM cf
UNION ALL SELECT 3, 'not_null', 'acctbal', CAST(count(*) FILTER (WHERE acctbal IS NULL OR isnan(acctbal)) AS BIGINT) FROM cf
UNION ALL SELECT 4, 'not_null', 'n_orders', CAST(count(*) FILTER (WHERE n_orders IS NULL OR isnan(n_orders)) AS BIGINT) FROM cf
UNION ALL SELECT 5, 'non_negative', 'acctbal', CAST(count(*) FILTER (WHERE acctbal < 0) AS BIGINT) FROM cf
UNION ALL SELECT 6, 'non_negative', 'n_orders', CAST(count(*) FILTER (WHERE n_orders < 0) AS BIGINT) FROM cf
UNION ALL SELECT 7, 'non_negative', 'spend', CAST(count(*) FILTER (WHERE spend < 0) AS BIGINT) FROM cf"""

ORACLE["duplicate_keys"] = """SELECT CAST(0 AS INT) AS seq, 'unique' AS rule, 'l_orderkey,l_linenumber' AS "column",
  CAST((SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))
       AS BIGINT) AS violations"""

ORACLE["null_counts"] = f"""WITH {OF}
SELECT 'id' AS "column", 'bigint' AS dtype, CAST(count(*) FILTER (WHERE id IS NULL) AS BIGINT) AS nulls FROM of
UNION ALL SELECT 'cust', 'bigint', CAST(count(*) FILTER (WHERE cust IS NULL) AS BIGINT) FROM of
UNION ALL SELECT 'status', 'string', CAST(count(*) FILTER (WHERE status IS NULL) AS BIGINT) FROM of
UNION ALL SELECT 'target', 'double', CAST(count(*) FILTER (WHERE target IS NULL OR isnan(target)) AS BIGINT) FROM of
UNION ALL SELECT 'n_lines', 'double', CAST(count(*) FILTER (WHERE n_lines IS NULL OR isnan(n_lines)) AS BIGINT) FROM of
UNION ALL SELECT 'qty', 'double', CAST(count(*) FILTER (WHERE qty IS NULL OR isnan(qty)) AS BIGINT) FROM of
UNION ALL SELECT 'gross', 'double', CAST(count(*) FILTER (WHERE gross IS NULL OR isnan(gross)) AS BIGINT) FROM of
UNION ALL SELECT 'yr', 'int', CAST(count(*) FILTER (WHERE yr IS NULL) AS BIGINT) FROM of"""

ORACLE["aligned_keys"] = """WITH l AS (SELECT o_orderkey AS k, count(*) AS nl FROM orders GROUP BY 1),
r AS (SELECT l_orderkey AS k, count(*) AS nr FROM lineitem GROUP BY 1),
j AS (SELECT l.nl, r.nr FROM l FULL OUTER JOIN r ON l.k = r.k)
SELECT CAST(COALESCE(SUM(CASE WHEN nr IS NULL THEN nl END), 0) AS BIGINT) AS only_left,
       CAST(COALESCE(SUM(CASE WHEN nl IS NULL THEN nr END), 0) AS BIGINT) AS only_right,
       CAST(COALESCE(SUM(CASE WHEN nl IS NOT NULL AND nr IS NOT NULL THEN nl END), 0) AS BIGINT) AS matched FROM j"""

ORACLE["precondition_counts"] = f"""WITH {OF}, {CF}
SELECT 'rows_ge_k' AS check_name, CAST(GREATEST(5 - count(*), 0) AS BIGINT) AS violations FROM cf
UNION ALL SELECT 'clusters_ge_2', CAST(GREATEST(2 - count(DISTINCT segment), 0) AS BIGINT) FROM cf
UNION ALL SELECT 'rows_ge_folds', CAST(GREATEST(5 - count(*), 0) AS BIGINT) FROM of"""

ORACLE["range_checks"] = f"""WITH {CF}
SELECT CAST(0 AS INT) AS seq, 'between' AS rule, 'acctbal' AS "column",
  CAST(count(*) FILTER (WHERE acctbal IS NOT NULL AND NOT (acctbal BETWEEN -999.99 AND 9999.99)) AS BIGINT) AS violations FROM cf
UNION ALL SELECT 1, 'between', 'n_orders', CAST(count(*) FILTER (WHERE n_orders IS NOT NULL AND NOT (n_orders BETWEEN 0 AND 25)) AS BIGINT) FROM cf
UNION ALL SELECT 2, 'one_of', 'segment', CAST(count(*) FILTER (WHERE segment IS NULL OR segment NOT IN
  ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')) AS BIGINT) FROM cf"""

# ---------------------------------------------------------------- profiling
ORACLE["median_cols"] = f"""WITH {OF}
SELECT 'target' AS "column", ROUND(median(target), 4) AS median FROM of
UNION ALL SELECT 'n_lines', ROUND(median(n_lines), 4) FROM of
UNION ALL SELECT 'qty', ROUND(median(qty), 4) FROM of
UNION ALL SELECT 'gross', ROUND(median(gross), 4) FROM of"""

ORACLE["quartiles"] = f"""WITH {OF}
SELECT 'target' AS "column", CAST(0.25 AS DOUBLE) AS p, ROUND(quantile_cont(target, 0.25), 4) AS value FROM of
UNION ALL SELECT 'target', CAST(0.75 AS DOUBLE), ROUND(quantile_cont(target, 0.75), 4) FROM of
UNION ALL SELECT 'qty', CAST(0.25 AS DOUBLE), ROUND(quantile_cont(qty, 0.25), 4) FROM of
UNION ALL SELECT 'qty', CAST(0.75 AS DOUBLE), ROUND(quantile_cont(qty, 0.75), 4) FROM of"""

ORACLE["col_moments"] = f"""WITH {CF}
SELECT 'acctbal' AS "column", ROUND(avg(acctbal), 4) AS mean, ROUND(stddev_pop(acctbal), 4) AS std FROM cf
UNION ALL SELECT 'spend', ROUND(avg(spend), 4), ROUND(stddev_pop(spend), 4) FROM cf
UNION ALL SELECT 'n_orders', ROUND(avg(n_orders), 4), ROUND(stddev_pop(n_orders), 4) FROM cf
UNION ALL SELECT 'avg_order', ROUND(avg(avg_order), 4), ROUND(stddev_pop(avg_order), 4) FROM cf"""


def _describe(col):
    return f"""SELECT '{col}' AS "column", 'count' AS stat, ROUND(CAST(count({col}) AS DOUBLE), 4) AS value FROM cf
UNION ALL SELECT '{col}', 'mean', ROUND(avg({col}), 4) FROM cf
UNION ALL SELECT '{col}', 'std', ROUND(stddev_samp({col}), 4) FROM cf
UNION ALL SELECT '{col}', 'min', ROUND(min({col}), 4) FROM cf
UNION ALL SELECT '{col}', 'max', ROUND(max({col}), 4) FROM cf
UNION ALL SELECT '{col}', '25%', ROUND(quantile_cont({col}, 0.25), 4) FROM cf
UNION ALL SELECT '{col}', '50%', ROUND(quantile_cont({col}, 0.5), 4) FROM cf
UNION ALL SELECT '{col}', '75%', ROUND(quantile_cont({col}, 0.75), 4) FROM cf"""


ORACLE["describe_exact"] = f"WITH {CF}\n" + _describe("acctbal") + "\nUNION ALL " + _describe("n_orders")

ORACLE["value_counts"] = f"""WITH {OF}
SELECT status AS value, count(*) AS n, ROUND(count(*) / CAST(SUM(count(*)) OVER () AS DOUBLE), 6) AS share
FROM of WHERE status IS NOT NULL GROUP BY status"""

_CM = ["acctbal", "spend", "n_orders", "avg_order"]
ORACLE["corr_matrix"] = f"WITH {CF}\n" + "\nUNION ALL ".join(
    f"SELECT '{a}' AS x, '{b}' AS y, ROUND(corr({a}, {b}), 6) AS r FROM cf" for a in _CM for b in _CM)

ORACLE["hist20"] = f"""WITH {CF},
mm AS (SELECT min(acctbal) AS mn, max(acctbal) AS mx, avg(acctbal) AS mean, (max(acctbal) - min(acctbal)) / 20 AS w FROM cf),
b AS (SELECT CAST(LEAST(floor((acctbal - mn) / w), 19) AS INT) AS bin FROM cf, mm WHERE acctbal IS NOT NULL),
c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin),
bins AS (SELECT CAST(range AS INT) AS bin FROM range(20))
SELECT bins.bin, ROUND(mn + bins.bin * w, 4) AS lo, ROUND(mn + (bins.bin + 1) * w, 4) AS hi,
       CAST(COALESCE(c.n, 0) AS BIGINT) AS n, ROUND(mean, 4) AS mean
FROM bins LEFT JOIN c ON c.bin = bins.bin, mm"""

ORACLE["shape_counts"] = f"""WITH {OF}
SELECT count(*) AS n_rows, CAST(8 AS INT) AS n_cols, count(DISTINCT cust) AS n_distinct FROM of"""

# ---------------------------------------------------------------- impute / scale
ORACLE["impute_median"] = f"""WITH {OF}, m AS (SELECT median(gross) AS mg, median(qty) AS mq FROM of)
SELECT id, ROUND(COALESCE(gross, mg), 4) AS gross, ROUND(COALESCE(qty, mq), 4) AS qty FROM of, m"""

ORACLE["impute_apply_holdout"] = f"""WITH {HOLDOUT_OF}, m AS (SELECT median(gross) AS mg FROM ho WHERE split = 'train')
SELECT id, ROUND(COALESCE(gross, mg), 4) AS gross FROM ho, m WHERE split = 'test'"""

RATIO = "CASE WHEN n_lines <= 1 THEN CAST('inf' AS DOUBLE) ELSE target / n_lines END"
ORACLE["sanitize_inf"] = f"""WITH {OF}
SELECT id, ROUND(CASE WHEN isinf(r) THEN NULL ELSE r END, 6) AS ratio FROM (SELECT id, {RATIO} AS r FROM of)"""

ORACLE["residual_fill"] = f"""WITH {HOLDOUT_OF},
s AS (SELECT id, split, CASE WHEN isinf({RATIO}) THEN NULL ELSE {RATIO} END AS ratio FROM ho),
ml AS (SELECT median(ratio) AS m FROM s WHERE split = 'train'),
mc AS (SELECT median(ratio) AS m FROM s WHERE split = 'test')
SELECT id, ROUND(COALESCE(ratio, ml.m), 6) AS filled_learned, ROUND(COALESCE(ratio, mc.m), 6) AS filled_current
FROM s, ml, mc WHERE split = 'test'"""

ENG = f"""{OF}, mg AS (SELECT median(gross) AS m FROM of),
eng AS (SELECT id, target, COALESCE(gross, mg.m) + qty AS total, n_lines + CAST(0.5 AS DOUBLE) * qty AS weighted,
               CAST(GREATEST(2026 - yr, 0) AS DOUBLE) AS age FROM of, mg),
qq AS (SELECT quantile_cont(total, 0.25) AS q1, quantile_cont(total, 0.75) AS q3 FROM eng),
kept AS (SELECT eng.* FROM eng, qq WHERE total BETWEEN q1 - 0.5 * (q3 - q1) AND q3 + 0.5 * (q3 - q1))"""

ORACLE["engineered_features"] = f"""WITH {ENG}
SELECT id, ROUND(total, 4) AS total, ROUND(weighted, 4) AS weighted, ROUND(age, 4) AS age FROM eng"""
ORACLE["iqr_filter"] = f"WITH {ENG}\nSELECT id, ROUND(total, 4) AS total FROM kept"
ORACLE["semi_align"] = f"WITH {ENG}\nSELECT id, target FROM of WHERE id IN (SELECT id FROM kept)"
ORACLE["anti_removed"] = f"WITH {ENG}\nSELECT id, target FROM of WHERE id NOT IN (SELECT id FROM kept)"

_SC = ["acctbal", "spend", "n_orders"]


def _scaled(src, fit_where="TRUE", out_where="TRUE"):
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _SC)
    cols = ", ".join(f"ROUND(({c} - m_{c}) / CASE WHEN s_{c} = 0 OR s_{c} IS NULL THEN 1 ELSE s_{c} END, 6) AS {c}"
                     for c in _SC)
    return f"st AS (SELECT {stats} FROM {src} WHERE {fit_where})\nSELECT id, {cols} FROM {src}, st WHERE {out_where}"


ORACLE["standard_scale"] = f"WITH {CF},\n" + _scaled("cf")
ORACLE["scale_apply_holdout"] = f"""WITH {CF},
ch AS (SELECT cf.*, CASE WHEN row_number() OVER (ORDER BY {H('id')}, id)
                         <= CAST(ceil(count(*) OVER () * CAST(0.2 AS DOUBLE)) AS BIGINT)
                    THEN 'test' ELSE 'train' END AS split FROM cf),
""" + _scaled("ch", "split = 'train'", "split = 'test'")

# ---------------------------------------------------------------- splits
ORACLE["split_holdout"] = f"WITH {HOLDOUT_OF}\nSELECT id, split FROM ho"
ORACLE["kfold_assign"] = f"WITH {KFOLD_OF}\nSELECT id, fold FROM kf"
ORACLE["split_disjoint"] = f"""WITH {HOLDOUT_OF}, per AS (SELECT id, count(*) AS n FROM ho GROUP BY id)
SELECT CAST(SUM(n) AS BIGINT) AS n_rows, count(*) AS n_keys, CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS n_overlap FROM per"""


def _lr(src, quota_expr, cnt="n"):
    """Largest-remainder allocation of a total quota over labels (integer arithmetic)."""
    return f"""SELECT label, {cnt} AS n, base + CASE WHEN row_number() OVER (ORDER BY rem DESC, label)
                                             <= quota - SUM(base) OVER () THEN 1 ELSE 0 END AS q
  FROM (SELECT label, {cnt}, quota, ({cnt} * quota) // tot AS base, ({cnt} * quota) % tot AS rem
        FROM (SELECT label, {cnt}, CAST(SUM({cnt}) OVER () AS BIGINT) AS tot, {quota_expr} AS quota FROM {src}))"""


def _stratified(src_cte, key, test, val):
    head = f"""WITH {src_cte},
rk AS (SELECT {key}, label, row_number() OVER (PARTITION BY label ORDER BY {H(key)}, {key}) AS r FROM src),
cnt AS (SELECT label, count(*) AS n FROM src GROUP BY label),
tq AS ({_lr('cnt', f'CAST(ceil(CAST(SUM(n) OVER () AS BIGINT) * CAST({test} AS DOUBLE)) AS BIGINT)')})"""
    if not val:
        return head + f"""
SELECT rk.{key}, rk.label, CASE WHEN r <= tq.q THEN 'test' ELSE 'train' END AS split FROM rk JOIN tq USING (label)"""
    return head + f""",
rest AS (SELECT label, n - q AS m, (SELECT SUM(q) FROM tq) AS nt FROM tq),
vq AS ({_lr('rest', f'CAST(ceil((CAST(SUM(m) OVER () AS BIGINT)) * (CAST({val} AS DOUBLE) / (1.0 - CAST({test} AS DOUBLE)))) AS BIGINT)', 'm')})
SELECT rk.{key}, rk.label, CASE WHEN r <= tq.q THEN 'test' WHEN r <= tq.q + vq.q THEN 'val' ELSE 'train' END AS split
FROM rk JOIN tq USING (label) JOIN vq USING (label)"""


ORACLE["split_stratified3"] = _stratified(f"{EMB}, src AS (SELECT vec_id, label FROM emb)", "vec_id", 0.2, 0.1)
ORACLE["split_stratified2"] = _stratified(f"{DOC}, src AS (SELECT doc_id, label FROM doc)", "doc_id", 0.2, 0.0)
ORACLE["stratified_folds"] = f"""WITH {EMB}
SELECT vec_id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY {H('vec_id')}, vec_id) - 1) % 3 AS INT) AS fold
FROM emb"""

ORACLE["stratified_folds_nulls"] = f"""WITH {EMB}
SELECT vec_id, nullif(label, 3) AS label,
       CAST((row_number() OVER (PARTITION BY nullif(label, 3) ORDER BY {H('vec_id')}, vec_id) - 1) % 3 AS INT) AS fold
FROM emb"""

ORACLE["split_by_group_nulls"] = """WITH d AS (SELECT doc_id, nullif(source, 'src0') AS source FROM documents),
g AS (SELECT source, count(*) AS w, md5('42' || coalesce(':' || source, '')) AS h FROM d GROUP BY source),
c AS (SELECT source, COALESCE(SUM(w) OVER (ORDER BY h, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
             CAST(ceil(SUM(w) OVER () * CAST(0.2 AS DOUBLE)) AS BIGINT) AS quota FROM g)
SELECT d.doc_id, d.source, CASE WHEN c.before < c.quota THEN 'test' ELSE 'train' END AS split
FROM d JOIN c ON c.source IS NOT DISTINCT FROM d.source"""

# ---------------------------------------------------------------- regression + metrics
SIMPLE_PRED = f"""{OF},
c AS (SELECT covar_pop(qty, target) / var_pop(qty) AS b,
             avg(target) - covar_pop(qty, target) / var_pop(qty) * avg(qty) AS a FROM of),
p AS (SELECT id, status, target AS y, a + b * qty AS yhat FROM of, c)"""

REG = """ROUND(sqrt(avg((yhat - y) * (yhat - y))), 4) AS rmse, ROUND(avg(abs(yhat - y)), 4) AS mae,
  ROUND(CASE WHEN var_pop(y) * count(*) = 0 THEN CAST('nan' AS DOUBLE)
             ELSE 1 - sum((yhat - y) * (yhat - y)) / (var_pop(y) * count(*)) END, 6) AS r2,
  ROUND(avg(CASE WHEN y = 0 THEN CAST('inf' AS DOUBLE) ELSE abs(yhat - y) / abs(y) END) * 100, 6) AS mape,
  count(*) AS n"""

ORACLE["regression_metrics"] = f"WITH {SIMPLE_PRED}\nSELECT {REG} FROM p"
ORACLE["regression_metrics_by"] = f"WITH {SIMPLE_PRED}\nSELECT status, {REG} FROM p GROUP BY status"

ORACLE["ols_simple"] = f"""WITH {CF}
SELECT ROUND(covar_pop(n_orders, spend) / var_pop(n_orders), 4) AS slope,
       ROUND(avg(spend) - covar_pop(n_orders, spend) / var_pop(n_orders) * avg(n_orders), 4) AS intercept,
       ROUND(pow(corr(n_orders, spend), 2), 6) AS r2, count(*) AS n FROM cf"""

ORACLE["ols_two_feature"] = f"""WITH {OF},
s AS (SELECT var_pop(qty) AS s11, var_pop(n_lines) AS s22, covar_pop(qty, n_lines) AS s12,
             covar_pop(qty, target) AS s1y, covar_pop(n_lines, target) AS s2y,
             avg(qty) AS m1, avg(n_lines) AS m2, avg(target) AS my, count(*) AS n FROM of),
b AS (SELECT (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1,
             (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2, m1, m2, my, n FROM s)
SELECT ROUND(b1, 4) AS b1, ROUND(b2, 4) AS b2, ROUND(my - b1 * m1 - b2 * m2, 4) AS b0, n FROM b"""

ORACLE["cv_rmse"] = f"""WITH {KFOLD_OF},
st AS (SELECT k.fold, covar_pop(kf.qty, kf.target) AS c, var_pop(kf.qty) AS v, avg(kf.qty) AS mx, avg(kf.target) AS my
       FROM (SELECT DISTINCT fold FROM kf) k JOIN kf ON kf.fold <> k.fold GROUP BY k.fold)
SELECT kf.fold, ROUND(sqrt(avg((target - ((my - (c / v) * mx) + (c / v) * qty))
                              * (target - ((my - (c / v) * mx) + (c / v) * qty)))), 4) AS rmse, count(*) AS n
FROM kf JOIN st ON st.fold = kf.fold GROUP BY kf.fold"""

DOC_PRED = f"{DOC}, dp AS (SELECT doc_id, label, CASE WHEN letters > 0.78 THEN 1 ELSE 0 END AS pred FROM doc)"
ORACLE["binary_metrics"] = f"""WITH {DOC_PRED},
c AS (SELECT count(*) FILTER (WHERE label = 1 AND pred = 1) AS tp, count(*) FILTER (WHERE label <> 1 AND pred = 1) AS fp,
             count(*) FILTER (WHERE label = 1 AND pred <> 1) AS fn, count(*) FILTER (WHERE label <> 1 AND pred <> 1) AS tn FROM dp),
m AS (SELECT *, tp + fp + fn + tn AS n,
             CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / CAST(tp + fp AS DOUBLE) END AS pr,
             CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / CAST(tp + fn AS DOUBLE) END AS rc FROM c)
SELECT ROUND(CASE WHEN n = 0 THEN 0.0 ELSE (tp + tn) / CAST(n AS DOUBLE) END, 6) AS accuracy,
       ROUND(pr, 6) AS precision, ROUND(rc, 6) AS recall,
       ROUND(CASE WHEN pr + rc = 0 THEN 0.0 ELSE 2 * pr * rc / (pr + rc) END, 6) AS f1, tp, fp, fn, tn, n FROM m"""

REPORT = f"""{SCORED},
cls AS (SELECT CAST(range AS INT) AS c FROM range(10)),
pc AS (SELECT y_true AS t, y_pred AS q, count(*) AS n FROM scored GROUP BY 1, 2),
j AS (SELECT cls.c, COALESCE((SELECT n FROM pc WHERE t = cls.c AND q = cls.c), 0) AS tp,
             COALESCE((SELECT SUM(n) FROM pc WHERE t = cls.c), 0) AS support,
             COALESCE((SELECT SUM(n) FROM pc WHERE q = cls.c), 0) AS npred FROM cls),
per AS (SELECT CAST(c AS VARCHAR) AS label, CAST(support AS BIGINT) AS support, tp,
               CASE WHEN npred = 0 THEN 0.0 ELSE tp / CAST(npred AS DOUBLE) END AS precision,
               CASE WHEN support = 0 THEN 0.0 ELSE tp / CAST(support AS DOUBLE) END AS recall FROM j),
per2 AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM per),
tot AS (SELECT SUM(support) AS n, SUM(tp) AS tp, avg(precision) AS mp, avg(recall) AS mr, avg(f1) AS mf,
               SUM(precision * support) AS wp, SUM(recall * support) AS wr, SUM(f1 * support) AS wf FROM per2),
rep AS (SELECT label, precision, recall, f1, support FROM per2
  UNION ALL SELECT 'accuracy', NULL, NULL, CASE WHEN n = 0 THEN 0.0 ELSE tp / CAST(n AS DOUBLE) END, CAST(n AS BIGINT) FROM tot
  UNION ALL SELECT 'macro avg', mp, mr, mf, CAST(n AS BIGINT) FROM tot
  UNION ALL SELECT 'weighted avg', CASE WHEN n = 0 THEN 0.0 ELSE wp / n END, CASE WHEN n = 0 THEN 0.0 ELSE wr / n END,
                   CASE WHEN n = 0 THEN 0.0 ELSE wf / n END, CAST(n AS BIGINT) FROM tot)"""

ORACLE["classification_report"] = f"""WITH {REPORT}
SELECT label, ROUND(precision, 6) AS precision, ROUND(recall, 6) AS recall, ROUND(f1, 6) AS f1, support FROM rep"""
ORACLE["macro_weighted_f1"] = f"""WITH {REPORT}
SELECT ROUND(max(CASE WHEN label = 'accuracy' THEN f1 END), 6) AS accuracy,
       ROUND(max(CASE WHEN label = 'macro avg' THEN f1 END), 6) AS macro_f1,
       ROUND(max(CASE WHEN label = 'weighted avg' THEN f1 END), 6) AS weighted_f1 FROM rep"""
ORACLE["confusion_matrix"] = f"""WITH {SCORED},
cls AS (SELECT CAST(range AS INT) AS c FROM range(10)),
pc AS (SELECT y_true AS t, y_pred AS q, count(*) AS n FROM scored GROUP BY 1, 2)
SELECT a.c AS y_true, b.c AS y_pred, CAST(COALESCE(pc.n, 0) AS BIGINT) AS n
FROM cls a CROSS JOIN cls b LEFT JOIN pc ON pc.t = a.c AND pc.q = b.c"""

# ---------------------------------------------------------------- clustering
PTS = f"""{CF},
st AS (SELECT avg(acctbal) AS ma, stddev_pop(acctbal) AS sa, avg(spend) AS ms, stddev_pop(spend) AS ss,
              avg(n_orders) AS mn, stddev_pop(n_orders) AS sn FROM cf),
pts AS (SELECT id, segment, acctbal, spend, n_orders,
               (acctbal - ma) / CASE WHEN sa = 0 THEN 1 ELSE sa END AS x1,
               (spend - ms) / CASE WHEN ss = 0 THEN 1 ELSE ss END AS x2,
               (n_orders - mn) / CASE WHEN sn = 0 THEN 1 ELSE sn END AS x3 FROM cf, st),
c0 AS (SELECT c, x1, x2, x3 FROM (SELECT CAST(row_number() OVER (ORDER BY {H('id')}, id) - 1 AS INT) AS c, x1, x2, x3
                                   FROM pts) WHERE c < 5)"""


def _assign(cents, name):
    return f"""{name} AS (SELECT id, c AS cluster FROM (
   SELECT p.id, k.c, row_number() OVER (PARTITION BY p.id ORDER BY
          (p.x1 - k.x1) * (p.x1 - k.x1) + (p.x2 - k.x2) * (p.x2 - k.x2) + (p.x3 - k.x3) * (p.x3 - k.x3), k.c) AS r
   FROM pts p CROSS JOIN {cents} k) WHERE r = 1)"""


def _means(prev, assign, name):
    return f"""{name} AS (SELECT k.c, COALESCE(m.x1, k.x1) AS x1, COALESCE(m.x2, k.x2) AS x2, COALESCE(m.x3, k.x3) AS x3
   FROM {prev} k LEFT JOIN (SELECT a.cluster AS c, avg(p.x1) AS x1, avg(p.x2) AS x2, avg(p.x3) AS x3
                            FROM {assign} a JOIN pts p ON p.id = a.id GROUP BY a.cluster) m ON m.c = k.c)"""


ASSIGNED = PTS + ",\n" + _assign("c0", "a0") + """,
ax AS (SELECT p.*, a0.cluster FROM pts p JOIN a0 ON a0.id = p.id)"""

ORACLE["assign_centroid"] = f"WITH {PTS},\n{_assign('c0', 'a0')}\nSELECT id, cluster FROM a0"
ORACLE["kmeans_fixed_init"] = (f"WITH {PTS},\n{_assign('c0', 'a0')},\n{_means('c0', 'a0', 'c1')},\n{_assign('c1', 'a1')},"
                               f"\n{_means('c1', 'a1', 'c2')},\n{_assign('c2', 'a2')}\nSELECT id, cluster FROM a2")
ORACLE["kmeans_inertia"] = f"""WITH {PTS},
d AS (SELECT p.id, min((p.x1 - k.x1) * (p.x1 - k.x1) + (p.x2 - k.x2) * (p.x2 - k.x2) + (p.x3 - k.x3) * (p.x3 - k.x3)) AS d
      FROM pts p CROSS JOIN c0 k GROUP BY p.id)
SELECT ROUND(SUM(d), 6) AS inertia, count(*) AS n FROM d"""

ORACLE["cluster_sizes"] = f"WITH {ASSIGNED}\nSELECT cluster, count(*) AS n FROM ax GROUP BY cluster"
ORACLE["cluster_profiles"] = f"""WITH {ASSIGNED},
g AS (SELECT cluster, count(*) AS size, avg(acctbal) AS mean_acctbal, avg(spend) AS mean_spend,
             avg(n_orders) AS mean_n_orders FROM ax GROUP BY cluster),
s AS (SELECT cluster, segment, count(*) AS c FROM ax GROUP BY cluster, segment)
SELECT g.cluster, g.size, ROUND(g.size / CAST((SELECT count(*) FROM ax) AS DOUBLE) * 100, 6) AS pct,
       ROUND(mean_acctbal, 4) AS mean_acctbal, ROUND(mean_spend, 4) AS mean_spend, ROUND(mean_n_orders, 6) AS mean_n_orders,
       s.segment, ROUND(s.c / CAST(g.size AS DOUBLE) * 100, 6) AS segment_pct
FROM g JOIN s ON s.cluster = g.cluster"""
ORACLE["profile_pivot"] = f"""WITH {ASSIGNED}
SELECT cluster, """ + ", ".join(
    f"ROUND(count(*) FILTER (WHERE segment = '{s}') / CAST(count(*) AS DOUBLE) * 100, 6) AS pct_{s}"
    for s in ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]) + " FROM ax GROUP BY cluster"

ORACLE["silhouette_sq"] = f"""WITH {ASSIGNED},
sz AS (SELECT cluster, count(*) AS n FROM ax GROUP BY cluster),
per AS (SELECT a.id, a.cluster AS ca, b.cluster AS cb,
               avg((a.x1 - b.x1) * (a.x1 - b.x1) + (a.x2 - b.x2) * (a.x2 - b.x2) + (a.x3 - b.x3) * (a.x3 - b.x3)) AS md
        FROM ax a JOIN ax b ON a.id <> b.id GROUP BY a.id, a.cluster, b.cluster),
own AS (SELECT id, ca, md AS a FROM per WHERE ca = cb),
oth AS (SELECT id, min(md) AS b FROM per WHERE ca <> cb GROUP BY id),
s AS (SELECT ax.id, CASE WHEN sz.n <= 1 THEN 0.0 WHEN GREATEST(own.a, oth.b) = 0 THEN 0.0
                         ELSE (oth.b - own.a) / GREATEST(own.a, oth.b) END AS s
      FROM ax JOIN sz ON sz.cluster = ax.cluster LEFT JOIN own ON own.id = ax.id LEFT JOIN oth ON oth.id = ax.id)
SELECT ROUND(avg(s), 6) AS silhouette, count(*) AS n FROM s"""

ORACLE["silhouette"] = ORACLE["silhouette_sq"].replace(
    "avg((a.x1 - b.x1) * (a.x1 - b.x1) + (a.x2 - b.x2) * (a.x2 - b.x2) + (a.x3 - b.x3) * (a.x3 - b.x3)) AS md",
    "avg(sqrt((a.x1 - b.x1) * (a.x1 - b.x1) + (a.x2 - b.x2) * (a.x2 - b.x2) + (a.x3 - b.x3) * (a.x3 - b.x3))) AS md").replace(
    "AS silhouette, count(*) AS n FROM s", "AS silhouette, CAST(0 AS DOUBLE) AS standard_error, count(*) AS n FROM s")

ORACLE["davies_bouldin"] = f"""WITH {ASSIGNED},
cen AS (SELECT cluster, avg(x1) AS x1, avg(x2) AS x2, avg(x3) AS x3 FROM ax GROUP BY cluster),
sc AS (SELECT a.cluster, avg(sqrt((a.x1 - c.x1) * (a.x1 - c.x1) + (a.x2 - c.x2) * (a.x2 - c.x2) + (a.x3 - c.x3) * (a.x3 - c.x3))) AS s
       FROM ax a JOIN cen c ON c.cluster = a.cluster GROUP BY a.cluster),
r AS (SELECT i.cluster, max((si.s + sj.s) / sqrt((i.x1 - j.x1) * (i.x1 - j.x1) + (i.x2 - j.x2) * (i.x2 - j.x2) + (i.x3 - j.x3) * (i.x3 - j.x3))) AS r
      FROM cen i JOIN cen j ON i.cluster <> j.cluster JOIN sc si ON si.cluster = i.cluster JOIN sc sj ON sj.cluster = j.cluster
      GROUP BY i.cluster)
SELECT ROUND(avg(r), 6) AS davies_bouldin, count(*) AS k FROM r"""

# ---------------------------------------------------------------- lookup and history folds
EVENT_DIM = "dim AS (SELECT * FROM (VALUES ('click', 1), ('purchase', 10), ('view', 2), ('default', 0)) t(event_type, weight))"
ORACLE["lookup_default"] = f"""WITH {EVENT_DIM}
SELECT e.event_id, e.event_type, CAST(COALESCE(d.weight, (SELECT weight FROM dim WHERE event_type = 'default')) AS INT) AS weight
FROM events e LEFT JOIN dim d ON d.event_type = e.event_type"""
ORACLE["lookup_missing"] = f"""WITH {EVENT_DIM}
SELECT event_type, count(*) AS n FROM events WHERE event_type NOT IN (SELECT event_type FROM dim) GROUP BY event_type"""

HIST = """h AS (SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INT) AS e, value AS v FROM events),
hn AS (SELECT user_id, count(*) AS n FROM h GROUP BY user_id)"""

ORACLE["early_stop"] = f"""WITH RECURSIVE {HIST},
r AS (
  SELECT user_id, e, v AS best, e AS be, 0 AS cnt, CAST(NULL AS INT) AS stop FROM h WHERE e = 1
  UNION ALL
  SELECT r.user_id, h.e,
         CASE WHEN r.stop IS NOT NULL THEN r.best WHEN h.v < r.best - CAST(1e-5 AS DOUBLE) THEN h.v ELSE r.best END,
         CASE WHEN r.stop IS NOT NULL THEN r.be WHEN h.v < r.best - CAST(1e-5 AS DOUBLE) THEN h.e ELSE r.be END,
         CASE WHEN r.stop IS NOT NULL THEN r.cnt WHEN h.v < r.best - CAST(1e-5 AS DOUBLE) THEN 0 ELSE r.cnt + 1 END,
         CASE WHEN r.stop IS NOT NULL THEN r.stop
              WHEN NOT (h.v < r.best - CAST(1e-5 AS DOUBLE)) AND r.cnt + 1 >= 4 THEN h.e ELSE NULL END
  FROM r JOIN h ON h.user_id = r.user_id AND h.e = r.e + 1)
SELECT r.user_id, r.stop AS stop_epoch, ROUND(r.best, 6) AS best_loss, r.be AS best_epoch, CAST(hn.n AS INT) AS n_epochs
FROM r JOIN hn ON hn.user_id = r.user_id AND r.e = hn.n"""

ORACLE["lr_plateau"] = f"""WITH RECURSIVE {HIST},
r AS (
  SELECT user_id, e, v AS best, 0 AS bad, CAST(0.001 AS DOUBLE) AS lr, 0 AS red FROM h WHERE e = 1
  UNION ALL
  SELECT user_id, e, best, CASE WHEN bad > 2 THEN 0 ELSE bad END,
         CASE WHEN bad > 2 AND lr - lr * CAST(0.5 AS DOUBLE) > CAST(1e-8 AS DOUBLE) THEN lr * CAST(0.5 AS DOUBLE) ELSE lr END,
         red + CASE WHEN bad > 2 AND lr - lr * CAST(0.5 AS DOUBLE) > CAST(1e-8 AS DOUBLE) THEN 1 ELSE 0 END
  FROM (SELECT r.user_id, h.e,
               CASE WHEN h.v < r.best * CAST(0.9999 AS DOUBLE) THEN h.v ELSE r.best END AS best,
               CASE WHEN h.v < r.best * CAST(0.9999 AS DOUBLE) THEN 0 ELSE r.bad + 1 END AS bad, r.lr, r.red
        FROM r JOIN h ON h.user_id = r.user_id AND h.e = r.e + 1))
SELECT r.user_id, r.lr AS final_lr, r.red AS n_reductions FROM r JOIN hn ON hn.user_id = r.user_id AND r.e = hn.n"""

ORACLE["best_checkpoint"] = f"""WITH {HIST}
SELECT user_id, e AS best_epoch, ROUND(v, 6) AS best_acc FROM (
  SELECT user_id, e, v, row_number() OVER (PARTITION BY user_id ORDER BY v DESC, e) AS r FROM h WHERE v > 0) WHERE r = 1"""

# ---------------------------------------------------------------- scoring
ORACLE["score_regression"] = f"""WITH {HOLDOUT_OF},
s AS (SELECT var_pop(qty) AS s11, var_pop(n_lines) AS s22, covar_pop(qty, n_lines) AS s12,
             covar_pop(qty, target) AS s1y, covar_pop(n_lines, target) AS s2y,
             avg(qty) AS m1, avg(n_lines) AS m2, avg(target) AS my FROM ho WHERE split = 'train'),
b AS (SELECT (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1,
             (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2, m1, m2, my FROM s),
c AS (SELECT b1, b2, my - b1 * m1 - b2 * m2 AS b0 FROM b)
SELECT id, ROUND(b0 + b1 * qty + b2 * n_lines, 4) AS prediction FROM ho, c WHERE split = 'test'"""

PROBA = EMB_LONG + """,
cen AS (SELECT label AS c, pos, AVG(v) AS v FROM emb_long GROUP BY label, pos),
dd AS (SELECT e.vec_id, e.label, m.c, SUM((e.v - m.v) * (e.v - m.v)) AS d FROM emb_long e JOIN cen m ON m.pos = e.pos
       GROUP BY e.vec_id, e.label, m.c),
ex AS (SELECT vec_id, label, c, exp(-(d - min(d) OVER (PARTITION BY vec_id))) AS x FROM dd),
pr AS (SELECT vec_id, label, c, x / SUM(x) OVER (PARTITION BY vec_id) AS p FROM ex)"""

ORACLE["proba_map"] = f"WITH {PROBA}\nSELECT vec_id, CAST(c AS VARCHAR) AS class, ROUND(p, 6) AS prob FROM pr"
ORACLE["top1_confidence"] = f"""WITH {PROBA}
SELECT vec_id, c AS top_class, ROUND(p, 6) AS confidence FROM (
  SELECT vec_id, c, p, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, c) AS r FROM pr) WHERE r = 1"""
ORACLE["log_loss"] = f"""WITH {PROBA},
t AS (SELECT pr.vec_id, -ln(GREATEST(pr.p, CAST(1e-15 AS DOUBLE))) AS l FROM pr WHERE pr.c = pr.label),
top AS (SELECT vec_id, label, c FROM (SELECT vec_id, label, c, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, c) AS r
                                      FROM pr) WHERE r = 1)
SELECT ROUND(avg(t.l), 6) AS loss, ROUND(avg(CASE WHEN top.c = top.label THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(*) AS n
FROM t JOIN top ON top.vec_id = t.vec_id"""

FOOD = """food AS (SELECT * FROM (VALUES (0, 'apple_pie'), (1, 'caesar_salad'), (2, 'cheesecake'), (3, 'chicken_curry'),
  (4, 'french_fries'), (5, 'hamburger'), (6, 'pizza'), (7, 'ramen'), (8, 'sushi'), (9, 'waffles')) t(i, name)),
kcal AS (SELECT * FROM (VALUES ('apple_pie', 237), ('caesar_salad', 190), ('cheesecake', 321), ('chicken_curry', 165),
  ('french_fries', 312), ('hamburger', 295), ('pizza', 266), ('ramen', 436), ('sushi', 150), ('waffles', 291),
  ('default', 250)) t(class, kcal))"""
ORACLE["predictions_with_lookup"] = f"""WITH {SCORED}, {FOOD}
SELECT s.vec_id, ft.name AS true_class, fp.name AS predicted_class,
       CAST(COALESCE(kt.kcal, 250) AS INT) AS true_kcal, CAST(COALESCE(kp.kcal, 250) AS INT) AS predicted_kcal,
       CAST(CASE WHEN s.y_true = s.y_pred THEN 1 ELSE 0 END AS INT) AS correct
FROM scored s LEFT JOIN food ft ON ft.i = s.y_true LEFT JOIN food fp ON fp.i = s.y_pred
LEFT JOIN kcal kt ON kt.class = ft.name LEFT JOIN kcal kp ON kp.class = fp.name"""

# ---------------------------------------------------------------- image jobs (relational twins)
EMB_PX = """emb_px AS (
  SELECT vec_id, label, CAST(pos // 8 AS INT) AS y, CAST(pos % 8 AS INT) AS x,
         CAST(floor((CAST(v AS DOUBLE) - mn) / (mx - mn) * 255) AS INT) AS px
  FROM (SELECT vec_id, label, generate_subscripts(embedding, 1) - 1 AS pos, unnest(embedding) AS v FROM embeddings)
  CROSS JOIN (SELECT CAST(min(list_min(embedding)) AS DOUBLE) AS mn, CAST(max(list_max(embedding)) AS DOUBLE) AS mx
              FROM embeddings)),
rgb AS (SELECT a.vec_id, a.y, a.x, a.y * 8 + a.x AS pos, a.px AS r, b.px AS g, 255 - a.px AS b
        FROM emb_px a JOIN emb_px b ON b.vec_id = a.vec_id AND b.y * 8 + b.x = 63 - (a.y * 8 + a.x))"""

ORACLE["resize_half"] = f"""WITH {EMB_PX},
w AS (SELECT i, j, wr / SUM(wr) OVER (PARTITION BY i) AS w FROM (
        SELECT CAST(o.range AS INT) AS i, CAST(s.range AS INT) AS j,
               GREATEST(1.0 - abs((s.range + 0.5) - (o.range + 0.5) * 2.0) / 2.0, 0.0) AS wr
        FROM range(4) o CROSS JOIN range(8) s))
SELECT p.vec_id, wy.i AS y, wx.i AS x, ROUND(SUM(wy.w * wx.w * p.px), 6) AS v
FROM emb_px p JOIN w wy ON wy.j = p.y JOIN w wx ON wx.j = p.x GROUP BY p.vec_id, wy.i, wx.i"""

ORACLE["grayscale"] = f"""WITH {EMB_PX}
SELECT vec_id, CAST(pos AS INT) AS pos,
       ROUND(r / 255.0 * 0.2125 + g / 255.0 * 0.7154 + b / 255.0 * 0.0721, 6) AS gray FROM rgb"""

ORACLE["pixel_normalize"] = f"""WITH {EMB_PX}
SELECT vec_id, CAST(y * 8 + x AS INT) AS pos, ROUND((px / 255.0 - 0.5) / 0.5, 6) AS v FROM emb_px"""

HOG = EMB_PX + """,
gr AS (SELECT p.vec_id, p.y, p.x,
              CAST(CASE WHEN p.x BETWEEN 1 AND 6 THEN r.px - l.px ELSE 0 END AS DOUBLE) AS gx,
              CAST(CASE WHEN p.y BETWEEN 1 AND 6 THEN d.px - u.px ELSE 0 END AS DOUBLE) AS gy
       FROM emb_px p
       LEFT JOIN emb_px r ON r.vec_id = p.vec_id AND r.y = p.y AND r.x = p.x + 1
       LEFT JOIN emb_px l ON l.vec_id = p.vec_id AND l.y = p.y AND l.x = p.x - 1
       LEFT JOIN emb_px d ON d.vec_id = p.vec_id AND d.y = p.y + 1 AND d.x = p.x
       LEFT JOIN emb_px u ON u.vec_id = p.vec_id AND u.y = p.y - 1 AND u.x = p.x),
ang AS (SELECT vec_id, y, x, sqrt(gx * gx + gy * gy) AS mag, degrees(atan2(gy, gx)) AS a FROM gr),
hb AS (SELECT vec_id, y // 4 AS cy, x // 4 AS cx, mag,
              CAST(LEAST(floor((CASE WHEN a < 0 THEN a + 180 WHEN a >= 180 THEN a - 180 ELSE a END) / 20.0), 8) AS INT) AS bin
       FROM ang),
hc AS (SELECT vec_id, cy, cx, bin, SUM(mag) / 16.0 AS value FROM hb GROUP BY vec_id, cy, cx, bin),
grid AS (SELECT DISTINCT e.vec_id, CAST(a.range AS INT) AS cy, CAST(b.range AS INT) AS cx, CAST(c.range AS INT) AS bin
         FROM emb_px e, range(2) a, range(2) b, range(9) c),
cells AS (SELECT g.vec_id, g.cy, g.cx, g.bin, COALESCE(hc.value, 0.0) AS value
          FROM grid g LEFT JOIN hc ON hc.vec_id = g.vec_id AND hc.cy = g.cy AND hc.cx = g.cx AND hc.bin = g.bin),
n1 AS (SELECT c.vec_id, CAST((c.cy * 2 + c.cx) * 9 + c.bin AS INT) AS i,
              LEAST(c.value / sqrt(s.ss + 1e-10), 0.2) AS v
       FROM cells c JOIN (SELECT vec_id, SUM(value * value) AS ss FROM cells GROUP BY vec_id) s ON s.vec_id = c.vec_id),
blocks AS (SELECT n1.vec_id, n1.i, n1.v / sqrt(s.ss + 1e-10) AS v
           FROM n1 JOIN (SELECT vec_id, SUM(v * v) AS ss FROM n1 GROUP BY vec_id) s ON s.vec_id = n1.vec_id)"""

ORACLE["hog_cells"] = f"WITH {HOG}\nSELECT vec_id, cy, cx, bin, ROUND(value, 6) AS value FROM cells"
ORACLE["hog_blocks"] = f"WITH {HOG}\nSELECT vec_id, i, ROUND(v, 6) AS v FROM blocks"

HIST = """ch AS (SELECT vec_id, 0 AS channel, r AS px FROM rgb UNION ALL SELECT vec_id, 1, g FROM rgb
                UNION ALL SELECT vec_id, 2, b FROM rgb),
hcnt AS (SELECT vec_id, channel, CAST(LEAST(floor(px / (255.0 / 16)), 15) AS INT) AS bin, count(*) AS n FROM ch
         GROUP BY ALL),
hgrid AS (SELECT DISTINCT vec_id, CAST(a.range AS INT) AS channel, CAST(b.range AS INT) AS bin FROM rgb, range(3) a, range(16) b),
hfull AS (SELECT g.vec_id, g.channel, g.bin, CAST(COALESCE(hcnt.n, 0) AS DOUBLE) AS n FROM hgrid g
          LEFT JOIN hcnt ON hcnt.vec_id = g.vec_id AND hcnt.channel = g.channel AND hcnt.bin = g.bin)"""

ORACLE["color_hist_density"] = f"""WITH {EMB_PX}, {HIST}
SELECT vec_id, CAST(channel AS INT) AS channel, bin, ROUND(n / (255.0 / 16) / 64, 6) AS value FROM hfull"""
ORACLE["color_hist_joint"] = f"""WITH {EMB_PX}, {HIST}
SELECT vec_id, CAST(channel AS INT) AS channel, bin,
       ROUND(n / (SUM(n) OVER (PARTITION BY vec_id) + 1e-8), 6) AS value FROM hfull"""
ORACLE["concat_vector"] = f"""WITH {HOG}, {HIST}
SELECT vec_id, i, ROUND(v, 6) AS v FROM blocks
UNION ALL SELECT vec_id, CAST(36 + channel * 16 + bin AS INT), ROUND(n / (255.0 / 16) / 64, 6) FROM hfull"""

# ---------------------------------------------------------------- sources, sinks, projections
ORACLE["csv_roundtrip"] = """SELECT c_mktsegment, count(*) AS n, ROUND(SUM(c_acctbal), 4) AS sum_acctbal,
       min(c_custkey) AS min_key, max(c_custkey) AS max_key FROM customer GROUP BY c_mktsegment"""
ORACLE["read_or_default"] = """SELECT 'all_present' AS case_name, 'real' AS origin, count(*) AS n_rows FROM customer
UNION ALL SELECT 'one_missing', 'default', count(*) FROM nation"""
ORACLE["label_from_name"] = """SELECT p_partkey, lower(p_type) AS class_name,
       CAST(CASE lower(p_type) WHEN 'economy' THEN 0 WHEN 'small' THEN 1 END AS INT) AS label
FROM part WHERE lower(p_type) IN ('economy', 'small')"""
ORACLE["index_tree"] = """SELECT doc_id, source AS subject, lang AS class_name,
       CAST(CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 WHEN 'de' THEN 2 END AS INT) AS label
FROM documents WHERE doc_id % 7 <> 0 AND lang IN ('en', 'fr', 'de')"""
ORACLE["drop_invalid"] = """SELECT lang, CAST(count(*) FILTER (WHERE NOT (text IS NULL OR trim(text) = '')) AS BIGINT) AS n_valid,
       CAST(count(*) FILTER (WHERE text IS NULL OR trim(text) = '') AS BIGINT) AS n_invalid FROM documents GROUP BY lang"""
ORACLE["metrics_json"] = f"""WITH {DOC_PRED},
c AS (SELECT count(*) FILTER (WHERE label = 1 AND pred = 1) AS tp, count(*) FILTER (WHERE label <> 1 AND pred = 1) AS fp,
             count(*) FILTER (WHERE label = 1 AND pred <> 1) AS fn, count(*) FILTER (WHERE label <> 1 AND pred <> 1) AS tn FROM dp)
SELECT 'binary' AS metric_set,
       '{{"tp":' || tp || ',"fp":' || fp || ',"fn":' || fn || ',"tn":' || tn || ',"n":' || (tp + fp + fn + tn) || '}}' AS json FROM c"""
ORACLE["run_summary"] = f"""WITH {HOLDOUT_OF}
SELECT CAST(count(*) FILTER (WHERE split = 'train') AS BIGINT) AS n_train,
       CAST(count(*) FILTER (WHERE split = 'test') AS BIGINT) AS n_test, CAST(7 AS INT) AS n_features,
       'n_lines,qty,gross,yr,total,weighted,age' AS features FROM ho"""
ORACLE["select_features"] = f"WITH {CF}\nSELECT id, ROUND(acctbal, 4) AS acctbal, ROUND(spend, 4) AS spend, ROUND(n_orders, 4) AS n_orders FROM cf"
ORACLE["column_order"] = f"""WITH {OF}
SELECT id, cust, status, ROUND(target, 4) AS target, yr, ROUND(qty, 4) AS qty, ROUND(gross, 4) AS gross,
       ROUND(n_lines, 4) AS n_lines FROM of"""
ORACLE["label_encode"] = f"""WITH {CF}
SELECT id, segment, CAST(list_position(['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'], segment) - 1 AS INT) AS label,
       segment AS decoded FROM cf"""
ORACLE["filter_eq"] = f"WITH {CF}\nSELECT id, ROUND(acctbal, 4) AS acctbal FROM cf WHERE segment = 'BUILDING'"
ORACLE["limit_preview"] = f"WITH {OF}\nSELECT id, ROUND(target, 4) AS target FROM of ORDER BY id LIMIT 10"
ORACLE["math_scalars"] = f"""WITH {OF}
SELECT id, ROUND(abs(target - 150000), 4) AS dev, ROUND(sqrt(qty), 6) AS root_qty,
       ROUND(LEAST(GREATEST(qty, 50.0), 150.0), 4) AS clipped, ROUND(ROUND(qty / 4, 1), 4) AS rounded FROM of"""
ORACLE["run_id_format"] = """SELECT event_id, strftime(ts, '%Y%m%dT%H%M%SZ') AS run_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso
FROM events"""
ORACLE["platt_apply"] = f"""WITH {DOC}
SELECT doc_id, ROUND(1.0 / (1.0 + exp(-4.0 * (letters - 0.78) + 0.1)), 6) AS p FROM doc"""


def _rff_sql():
    import numpy as np

    d, n, gamma = 3, 8, 0.5
    w = [(i, j, float(np.sin(1.0 + i * d + j)) * float(np.sqrt(2.0 * gamma))) for i in range(n) for j in range(d)]
    b = [(i, float((i * 0.7548776662466927) % 1.0 * 2.0 * np.pi)) for i in range(n)]
    wv = ", ".join(f"({i}, {j}, {v!r})" for i, j, v in w)
    bv = ", ".join(f"({i}, {v!r})" for i, v in b)
    return f"""WITH {PTS},
w AS (SELECT * FROM (VALUES {wv}) t(i, j, w)),
bb AS (SELECT * FROM (VALUES {bv}) t(i, b)),
xl AS (SELECT id, 0 AS j, x1 AS x FROM pts UNION ALL SELECT id, 1, x2 FROM pts UNION ALL SELECT id, 2, x3 FROM pts),
pr AS (SELECT xl.id, w.i, SUM(w.w * xl.x) AS s FROM xl JOIN w ON w.j = xl.j GROUP BY xl.id, w.i)
SELECT pr.id, CAST(pr.i AS INT) AS i, ROUND(sqrt(2.0 / {n}) * cos(pr.s + bb.b), 6) AS v FROM pr JOIN bb ON bb.i = pr.i"""


ORACLE["rff_map"] = _rff_sql()

ORACLE["split_by_group"] = f"""WITH g AS (SELECT source, count(*) AS w, {H('source')} AS h FROM documents GROUP BY source),
c AS (SELECT source, COALESCE(SUM(w) OVER (ORDER BY h, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
             CAST(ceil(SUM(w) OVER () * CAST(0.2 AS DOUBLE)) AS BIGINT) AS quota FROM g)
SELECT d.doc_id, d.source, CASE WHEN c.before < c.quota THEN 'test' ELSE 'train' END AS split
FROM documents d JOIN c ON c.source = d.source"""

ORACLE["stream_score"] = f"""WITH {HOLDOUT_OF},
s AS (SELECT var_pop(qty) AS s11, var_pop(n_lines) AS s22, covar_pop(qty, n_lines) AS s12,
             covar_pop(qty, target) AS s1y, covar_pop(n_lines, target) AS s2y,
             avg(qty) AS m1, avg(n_lines) AS m2, avg(target) AS my FROM ho WHERE split = 'train'),
b AS (SELECT (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1,
             (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2, m1, m2, my FROM s),
c AS (SELECT b1, b2, my - b1 * m1 - b2 * m2 AS b0 FROM b)
SELECT id, ROUND(b0 + b1 * qty + b2 * n_lines, 4) AS prediction FROM of, c"""

ORACLE["cv_rmse_summary"] = f"""WITH {KFOLD_OF},
st AS (SELECT k.fold, covar_pop(kf.qty, kf.target) AS c, var_pop(kf.qty) AS v, avg(kf.qty) AS mx, avg(kf.target) AS my
       FROM (SELECT DISTINCT fold FROM kf) k JOIN kf ON kf.fold <> k.fold GROUP BY k.fold),
pf AS (SELECT kf.fold, sqrt(avg((target - ((my - (c / v) * mx) + (c / v) * qty))
                               * (target - ((my - (c / v) * mx) + (c / v) * qty)))) AS rmse
       FROM kf JOIN st ON st.fold = kf.fold GROUP BY kf.fold)
SELECT ROUND(avg(rmse), 4) AS cv_rmse_mean, ROUND(stddev_pop(rmse), 4) AS cv_rmse_std, count(*) AS folds FROM pf"""


# ---------------------------------------------------------------- model fits: relations that hold for a right fit
def _projection(steps):
    """Least squares by orthogonalising the features one after another on the train part ``tr``."""
    ctes = ["e0 AS (SELECT x.*, x.target AS y FROM x)"]
    for i, c in enumerate(steps, 1):
        prev = [f"p{j}" for j in range(1, i)]
        coef = ", ".join(f"covar_pop({c}, {p}) / nullif(var_pop({p}), 0) AS k{j}" for j, p in enumerate(prev, 1))
        ctes.append(f"f{i} AS (SELECT avg({c}) AS m{', ' + coef if coef else ''} FROM e{i - 1} WHERE tr)")
        less = "".join(f" - coalesce(f.k{j}, 0) * e.{p}" for j, p in enumerate(prev, 1))
        ctes.append(f"e{i} AS (SELECT e.*, e.{c} - f.m{less} AS p{i} FROM e{i - 1} e, f{i} f)")
    n = len(steps)
    b = ", ".join(f"covar_pop(y, p{i}) / nullif(var_pop(p{i}), 0) AS b{i}" for i in range(1, n + 1))
    total = " + ".join(f"coalesce(b.b{i}, 0) * e.p{i}" for i in range(1, n + 1))
    ctes.append(f"b AS (SELECT avg(y) AS m, {b} FROM e{n} WHERE tr)")
    ctes.append(f"pred AS (SELECT e.id, e.target, e.split, b.m + {total} AS prediction FROM e{n} e, b)")
    return ",\n".join(ctes)


PREDICTED = f"""{HOLDOUT_OF},
mg AS (SELECT median(gross) AS m FROM ho WHERE split = 'train'),
g AS (SELECT id, split, target, n_lines, qty, COALESCE(gross, mg.m) AS gross, CAST(yr AS DOUBLE) AS yr FROM ho, mg),
q AS (SELECT quantile_cont(gross + qty, 0.25) AS q1, quantile_cont(gross + qty, 0.75) AS q3 FROM g WHERE split = 'train'),
x AS (SELECT g.*, split = 'train' AND gross + qty BETWEEN q1 - 3 * (q3 - q1) AND q3 + 3 * (q3 - q1) AS tr FROM g, q),
{_projection(['n_lines', 'qty', 'gross', 'yr'])}"""
ORACLE["ols_fit"] = f"""WITH {PREDICTED}
SELECT id, ROUND(target, 2) AS target, ROUND(prediction, 2) AS prediction FROM pred WHERE split = 'test'"""


def _fold_fit(fold):
    steps = _projection(["n_lines", "qty", "gross", "yr"])
    return f"""SELECT * FROM (WITH x AS (SELECT *, CASE WHEN fold = {fold} THEN 'test' ELSE 'train' END AS split, fold <> {fold} AS tr FROM kg),
{steps}
SELECT CAST({fold} AS INT) AS fold, ROUND(sqrt(avg((target - prediction) * (target - prediction))), 2) AS rmse, count(*) AS n
FROM pred WHERE split = 'test')"""


ORACLE["cv_rmse_full"] = f"""WITH {KFOLD_OF},
kg AS (SELECT id, fold, target, n_lines, qty, gross, CAST(yr AS DOUBLE) AS yr FROM kf WHERE gross IS NOT NULL)
""" + "\nUNION ALL ".join(_fold_fit(f) for f in range(5))
#: Coefficients from predictions: the fit moved by one unit of a feature.
ORACLE["ols_coefficients"] = f"""WITH {OF},
x AS (SELECT id, target, 'train' AS split, TRUE AS tr, n_lines, qty, gross, CAST(yr AS DOUBLE) AS yr FROM of WHERE gross IS NOT NULL
      UNION ALL SELECT i, 0.0, 'probe', FALSE, CAST(i = -1 AS INT), CAST(i = -2 AS INT), CAST(i = -3 AS INT), CAST(i = -4 AS INT) FROM range(-4, 1) t(i)),
{_projection(['n_lines', 'qty', 'gross', 'yr'])},
moved AS (SELECT id, prediction FROM pred WHERE split = 'probe')
SELECT 'intercept' AS feature, ROUND(prediction, 3) AS coefficient FROM moved WHERE id = 0
UNION ALL SELECT CASE id WHEN -1 THEN 'n_lines' WHEN -2 THEN 'qty' WHEN -3 THEN 'gross' ELSE 'yr' END,
                 ROUND(prediction - (SELECT prediction FROM moved WHERE id = 0), 3) FROM moved WHERE id < 0"""
ORACLE["model_roundtrip"] = f"""WITH {PREDICTED}
SELECT id, ROUND(prediction, 2) AS prediction FROM pred WHERE split = 'test'"""

_TOTAL = """(SELECT ROUND(SUM(var * n), 3) FROM (SELECT count(*) AS n, var_pop(x1) + var_pop(x2) + var_pop(x3) AS var FROM pts))"""
ORACLE["kmeans_relations"] = f"""WITH {PTS}
SELECT count(*) AS n_rows, CAST(LEAST(count(*), 5) AS BIGINT) AS n_clusters, {_TOTAL} AS total_ss FROM pts"""
ORACLE["elbow_relations"] = f"""WITH {PTS}
SELECT CAST(k AS INTEGER) AS k, {_TOTAL} AS total_ss, TRUE AS non_increasing FROM range(2, 11) t(k)"""

ORACLE["assign_new_customers"] = f"""WITH {CF},
ch AS (SELECT cf.*, CASE WHEN row_number() OVER (ORDER BY {H('id')}, id)
                         <= CAST(ceil(count(*) OVER () * CAST(0.2 AS DOUBLE)) AS BIGINT) THEN 'test' ELSE 'train' END AS split FROM cf),
st AS (SELECT avg(acctbal) AS ma, stddev_pop(acctbal) AS sa, avg(spend) AS ms, stddev_pop(spend) AS ss,
              avg(n_orders) AS mn, stddev_pop(n_orders) AS sn FROM ch WHERE split = 'train'),
all_pts AS (SELECT id, split, (acctbal - ma) / sa AS x1, (spend - ms) / ss AS x2, (n_orders - mn) / sn AS x3 FROM ch, st),
pts AS (SELECT * FROM all_pts WHERE split = 'test'),
c0 AS (SELECT c, x1, x2, x3 FROM (SELECT CAST(row_number() OVER (ORDER BY {H('id')}, id) - 1 AS INT) AS c, x1, x2, x3
                                   FROM all_pts WHERE split = 'train') WHERE c < 5),
{_assign('c0', 'a0')}
SELECT id, cluster FROM a0"""

_EMB_TEST = f"t AS ({_stratified(f'{EMB}, src AS (SELECT vec_id, label FROM emb)', 'vec_id', 0.2, 0.0)})"
_ROWS = "SELECT split AS part, label, count(*) AS n_rows, count(*) AS n_in_domain, TRUE AS beats_majority FROM t GROUP BY split, label"
ORACLE["backend_relations"] = f"""WITH {_EMB_TEST}
SELECT backend, r.* FROM ({_ROWS}) r, (VALUES ('forest'), ('mlp'), ('svm_linear'), ('svm_rbf')) v(backend)"""
ORACLE["platt_relations"] = f"""WITH {DOC}
SELECT count(*) AS n_rows, ROUND(avg(label), 4) AS mean_p, ROUND(avg((letters - 0.78) * label), 4) AS mean_fp FROM doc"""


def _newton(names, rows):
    """Newton steps for the sigmoids of every name over the rows (name, f, y) that fit it."""
    return f"""it(k, name, a, b) AS (
  SELECT 0, name, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM ({names})
  UNION ALL
  SELECT k + 1, name, a - (hbb * ga - hab * gb) / (haa * hbb - hab * hab), b - (haa * gb - hab * ga) / (haa * hbb - hab * hab)
  FROM (SELECT k, name, a, b, sum((y - p) * f) AS ga, sum(y - p) AS gb, sum(p * (1 - p) * f * f) AS haa, sum(p * (1 - p) * f) AS hab,
               sum(p * (1 - p)) AS hbb
        FROM (SELECT it.*, r.f, r.y, 1 / (1 + exp(it.a * r.f + it.b)) AS p FROM it JOIN ({rows}) r ON r.name = it.name WHERE k < 15)
        GROUP BY k, name, a, b))"""


ORACLE["platt_fit"] = f"""WITH RECURSIVE {DOC},
{_newton('SELECT 0 AS name', 'SELECT 0 AS name, letters - 0.78 AS f, label AS y FROM doc')}
SELECT ROUND(a, 3) AS a, ROUND(b, 3) AS b FROM it WHERE k = 15"""
ORACLE["svm_probability"] = f"""WITH RECURSIVE {DOC},
fo AS (SELECT doc_id, doc_id % 5 AS fold, letters - 0.78 AS f, label AS y FROM doc),
{_newton('SELECT DISTINCT fold AS name FROM fo', 'SELECT n.fold AS name, fo.f, fo.y FROM fo JOIN (SELECT DISTINCT fold FROM fo) n ON n.fold <> fo.fold')}
SELECT doc_id, ROUND(1 / (1 + exp(it.a * fo.f + it.b)), 5) AS probability FROM fo JOIN it ON it.name = fo.fold AND it.k = 15"""

_UNIT = "(CAST('0x' || substr(md5('42:' || vec_id || ':' || copy || ':{}'), 1, 8) AS BIGINT) / CAST(2147483648 AS DOUBLE) - 1)"
ORACLE["augment_rows"] = f"""WITH {EMB_PX},
c AS (SELECT vec_id, CAST(copy AS INTEGER) AS copy, {_UNIT.format('angle')} * 10 AS angle, {_UNIT.format('y')} * 0.4 AS ty, {_UNIT.format('x')} * 0.4 AS tx
      FROM (SELECT DISTINCT vec_id FROM emb_px), range(1, 3) r(copy)),
s AS (SELECT c.*, CAST(round_even(cos(radians(angle)) * (y - 3.5 - ty) - sin(radians(angle)) * (x - 3.5 - tx) + 3.5, 0) AS INT) AS sy,
             CAST(round_even(sin(radians(angle)) * (y - 3.5 - ty) + cos(radians(angle)) * (x - 3.5 - tx) + 3.5, 0) AS INT) AS sx
      FROM c, range(8) a(y), range(8) b(x))
SELECT s.vec_id, s.copy, ROUND(s.angle, 6) AS angle, ROUND(s.ty, 6) AS shift_y, ROUND(s.tx, 6) AS shift_x,
       CAST(SUM(COALESCE(p.px, 0)) AS BIGINT) AS checksum
FROM s LEFT JOIN emb_px p ON p.vec_id = s.vec_id AND p.y = s.sy AND p.x = s.sx GROUP BY ALL"""
