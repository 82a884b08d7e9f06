"""DuckDB twins of the query bindings (tables are pre-registered views).

Every DOUBLE is rounded to the same digits as the Spark side, every integer
is a BIGINT, and every column carries the same alias as in Spark.
"""

from __future__ import annotations

from outcomelab.functions.buckets import TIER_EDGES, TIER_LABELS
from outcomelab.plans.featureprep import EMB_DIM, PCA_SAMPLE
from outcomelab.plans.tables import BAD_EVERY, DIST_CLASSES, ERA_LAST, ERAS, PRIORITIES

ORACLE_SQL: dict[str, str] = {}
D = 6


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def era_sql(year: str) -> str:
    return (f"CASE WHEN {year} <= {ERA_LAST[0]} THEN {_q(ERAS[0])} "
            f"WHEN {year} <= {ERA_LAST[1]} THEN {_q(ERAS[1])} ELSE {_q(ERAS[2])} END")


def tier_sql(x: str) -> str:
    parts = [f"WHEN {x} > {lo} AND {x} <= {hi} THEN {_q(lab)}"
             for lo, hi, lab in zip(TIER_EDGES[:-1], TIER_EDGES[1:], TIER_LABELS)]
    return "CASE " + " ".join(parts) + " END"


def values_sql(labels, name: str = "label", order: str = "ord") -> str:
    rows = ", ".join(f"({_q(lab)}, {i})" for i, lab in enumerate(labels))
    return f"(VALUES {rows}) AS v({name}, {order})"


def encode_sql(x: str, classes) -> str:
    return "CASE " + " ".join(f"WHEN {x} = {_q(c)} THEN {float(i)}" for i, c in enumerate(classes)) + " END"


def decode_sql(idx: str, classes) -> str:
    return "CASE " + " ".join(f"WHEN {idx} = {i} THEN {_q(c)}" for i, c in enumerate(classes)) + " END"


def hash_sql(seed: str, *cols: str) -> str:
    key = " || '-' || ".join([_q(str(seed))] + [f"CAST({c} AS VARCHAR)" for c in cols])
    return f"('0x' || substr(md5({key}), 1, 15))::BIGINT"


def unit_sql(seed: str, *cols: str) -> str:
    return f"(CAST({hash_sql(seed, *cols)} AS DOUBLE) / {float(2 ** 60)})"


def register(name: str, sql: str) -> None:
    if name in ORACLE_SQL:
        raise ValueError(f"duplicate oracle {name}")
    ORACLE_SQL[name] = sql.strip()


register("load_profile", """
SELECT CAST(count(*) AS BIGINT) AS n_rows,
       CAST(min(year(o_orderdate)) AS BIGINT) AS min_year,
       CAST(max(year(o_orderdate)) AS BIGINT) AS max_year
FROM orders""")

register("era_bucket", f"""
SELECT e.era, CAST(count(*) AS BIGINT) AS n_rows, CAST(any_value(v.ord) AS BIGINT) AS era_order
FROM (SELECT {era_sql('year(o_orderdate)')} AS era FROM orders) e
JOIN {values_sql(ERAS)} ON v.label = e.era
GROUP BY e.era""")

register("sentinel_recode", f"""
WITH m AS (SELECT max(l_discount) AS mx FROM lineitem WHERE l_discount > 0),
r AS (SELECT CAST(l_discount = 0 AS BIGINT) AS recoded,
             CASE WHEN l_discount = 0 THEN m.mx + 1 ELSE l_discount END AS v
      FROM lineitem, m)
SELECT recoded, CAST(count(*) AS BIGINT) AS n_rows, round(min(v), {D}) AS min_value,
       round(max(v), {D}) AS max_value, round(avg(v), {D}) AS avg_value
FROM r GROUP BY recoded""")

register("label_encode", f"""
SELECT o_orderkey, o_orderpriority, {encode_sql('o_orderpriority', PRIORITIES)} AS label
FROM orders""")

register("label_decode", f"""
SELECT o_orderkey, {decode_sql('(' + encode_sql('o_orderpriority', PRIORITIES) + ')', PRIORITIES)} AS o_orderpriority,
       {decode_sql('o_custkey % 5', PRIORITIES)} AS pred_priority
FROM orders""")

_SPLIT = ("CASE WHEN year(o_orderdate) <= 1999 THEN 'train' WHEN year(o_orderdate) = 2000 THEN 'val' "
          "WHEN year(o_orderdate) >= 2001 THEN 'test' END")

register("temporal_split", f"""
SELECT split, CAST(count(*) AS BIGINT) AS n_rows
FROM (SELECT {_SPLIT} AS split FROM orders) s
WHERE split IS NOT NULL GROUP BY split""")


def class_dist_sql(source: str, col: str, classes) -> str:
    return f"""
WITH src AS ({source}), tot AS (SELECT count(*) AS total FROM src),
cnt AS (SELECT {col} AS c, count(*) AS n FROM src GROUP BY {col})
SELECT v.label AS {col}, CAST(v.ord AS BIGINT) AS class_order,
       CAST(coalesce(cnt.n, 0) AS BIGINT) AS n_rows,
       round(CASE WHEN tot.total > 0 THEN coalesce(cnt.n, 0) * 100.0 / tot.total END, {D}) AS pct
FROM {values_sql(classes)} CROSS JOIN tot LEFT JOIN cnt ON cnt.c = v.label"""


register("split_balance", class_dist_sql(
    f"SELECT o_orderpriority FROM orders WHERE ({_SPLIT}) = 'train'", "o_orderpriority", PRIORITIES))

register("binary_flag", """
SELECT CAST(CASE WHEN nullif(o_orderpriority, '3-MEDIUM') IS NOT DISTINCT FROM '5-LOW' THEN 0 ELSE 1 END AS BIGINT) AS flag,
       CAST(count(*) AS BIGINT) AS n_rows
FROM orders GROUP BY 1""")

register("rate_by_key", f"""
SELECT l_quantity, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS n_events,
       round(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) * 100.0 / count(*), {D}) AS rate_pct
FROM lineitem WHERE l_quantity IS NOT NULL
GROUP BY l_quantity ORDER BY l_quantity LIMIT 12""")

register("tier_bin", f"""
SELECT {tier_sql('l_quantity')} AS tier, CAST(count(*) AS BIGINT) AS n_rows
FROM lineitem GROUP BY 1""")


def grid_sql(source: str, row: str, col: str, outcome: str, event: str,
             row_labels, col_labels, support: int = 30) -> str:
    """Dense grid over fixed row labels (row_labels given) or observed rows."""
    ev = f"CASE WHEN {outcome} = {_q(event)} THEN 1 ELSE 0 END"
    cells = (f"SELECT {row} AS r, {col} AS c, count({outcome}) AS n, avg({ev}) * 100.0 AS rate "
             f"FROM src WHERE {row} IS NOT NULL AND {col} IS NOT NULL GROUP BY 1, 2")
    if row_labels is not None:
        rows = f"SELECT label AS r, ord AS r_ord FROM {values_sql(row_labels)}"
        order_cols = "CAST(g.r_ord AS BIGINT) AS row_order, "
    else:
        rows = f"SELECT DISTINCT {row} AS r, NULL AS r_ord FROM src WHERE {row} IS NOT NULL"
        order_cols = ""
    return f"""
WITH src AS ({source}),
cells AS ({cells}),
rws AS ({rows}),
cls AS (SELECT label AS c, ord AS c_ord FROM {values_sql(col_labels)}),
g AS (SELECT * FROM rws CROSS JOIN cls)
SELECT g.r AS {{row_name}}, {order_cols}g.c AS {{col_name}}, CAST(g.c_ord AS BIGINT) AS col_order,
       CAST(coalesce(cells.n, 0) AS BIGINT) AS n, round(cells.rate, {D}) AS rate_pct,
       round(CASE WHEN coalesce(cells.n, 0) >= {support} THEN cells.rate END, {D}) AS rate_pct_masked
FROM g LEFT JOIN cells ON cells.r = g.r AND cells.c = g.c"""


register("tier_rate_grid", grid_sql(
    f"SELECT {tier_sql('l_quantity')} AS qt, {tier_sql('l_linenumber')} AS lt, l_returnflag FROM lineitem",
    "qt", "lt", "l_returnflag", "R", TIER_LABELS, TIER_LABELS).format(
        row_name="quantity_tier", col_name="line_tier"))

_BRAND_GRID = grid_sql(
    f"SELECT p_brand, {tier_sql('p_size')} AS st, p_type FROM part",
    "p_brand", "st", "p_type", "STANDARD", None, TIER_LABELS).format(
        row_name="p_brand", col_name="size_tier")

register("tier_rate_masked", _BRAND_GRID)

register("tier_rate_label", f"""
WITH gr AS ({_BRAND_GRID})
SELECT p_brand, size_tier, n,
       CASE WHEN n >= 30 THEN printf('%.1f%% (n=%d)', round(rate_pct, 1), n)
            ELSE printf('n<30 (n=%d)', n) END AS label
FROM gr""")

_DIST = class_dist_sql("SELECT o_orderpriority FROM orders", "o_orderpriority", DIST_CLASSES)
register("class_distribution", _DIST)

register("cumulative_share", f"""
WITH d AS ({_DIST}), tot AS (SELECT count(*) AS total FROM orders)
SELECT o_orderpriority, class_order, n_rows, pct,
       round(sum(n_rows) OVER (ORDER BY class_order ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
             * 100.0 / tot.total, {D}) AS cum_pct
FROM d CROSS JOIN tot""")

_RETURNS = f"SELECT {era_sql('year(l_shipdate)')} AS era, l_linenumber FROM lineitem WHERE l_returnflag = 'R'"

register("winner_median", f"""
SELECT era, round(median(CAST(l_linenumber AS DOUBLE)), {D}) AS median_value, CAST(count(*) AS BIGINT) AS n_rows
FROM ({_RETURNS}) r GROUP BY era""")

register("share_below", f"""
SELECT era, CAST(count(*) AS BIGINT) AS n_rows,
       round(avg(CASE WHEN l_linenumber <= 2 THEN 1 ELSE 0 END) * 100.0, {D}) AS share_pct
FROM ({_RETURNS}) r GROUP BY era""")

register("boxplot_stats", f"""
WITH src AS (SELECT {era_sql('year(l_shipdate)')} AS era, l_returnflag, CAST(l_quantity AS DOUBLE) AS v
             FROM lineitem WHERE l_quantity IS NOT NULL AND l_returnflag IS NOT NULL),
q AS (SELECT era, l_returnflag, count(*) AS n, quantile_cont(v, 0.25) AS q1,
             quantile_cont(v, 0.5) AS med, quantile_cont(v, 0.75) AS q3
      FROM src GROUP BY era, l_returnflag),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT f.era, f.l_returnflag, CAST(f.n AS BIGINT) AS n, round(f.q1, {D}) AS q1, round(f.med, {D}) AS median,
       round(f.q3, {D}) AS q3, round(f.iqr, {D}) AS iqr, round(f.lo, {D}) AS lo_fence, round(f.hi, {D}) AS hi_fence,
       round(least(min(CASE WHEN s.v >= f.lo THEN s.v END), f.q1), {D}) AS whisker_low,
       round(greatest(max(CASE WHEN s.v <= f.hi THEN s.v END), f.q3), {D}) AS whisker_high,
       CAST(sum(CASE WHEN s.v < f.lo OR s.v > f.hi THEN 1 ELSE 0 END) AS BIGINT) AS n_outliers,
       round(min(s.v), {D}) AS min_value, round(max(s.v), {D}) AS max_value
FROM f JOIN src s ON s.era = f.era AND s.l_returnflag = f.l_returnflag
GROUP BY f.era, f.l_returnflag, f.n, f.q1, f.med, f.q3, f.iqr, f.lo, f.hi""")

register("min_rows_guard", f"""
SELECT p_brand, CAST(count(*) AS BIGINT) AS n_rows,
       round(CASE WHEN count(*) >= 80 THEN avg(p_retailprice) END, {D}) AS mean_value,
       round(CASE WHEN count(*) >= 80 THEN stddev_pop(p_retailprice) ELSE 0.0 END, {D}) AS std_value
FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand""")

register("drop_incomplete", f"""
SELECT o_orderkey, priority, status, round(o_totalprice, {D}) AS o_totalprice
FROM (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority,
             nullif(o_orderstatus, 'F') AS status, o_totalprice FROM orders) t
WHERE o_orderkey IS NOT NULL AND priority IS NOT NULL AND status IS NOT NULL
  AND o_totalprice IS NOT NULL AND NOT isnan(o_totalprice)""")

register("text_scrape", """
SELECT coalesce(regexp_extract(html, '<html lang="([^"]*)"', 1), '') AS lang, CAST(count(*) AS BIGINT) AS n_pages
FROM pages GROUP BY 1""")

register("csv_scan", f"""
SELECT p_type, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(p_size) AS BIGINT) AS sum_size,
       round(avg(p_retailprice), {D}) AS avg_price
FROM part GROUP BY p_type""")


# ---- resampling, scores, metrics -------------------------------------------

from outcomelab.plans.evaluation import FOLDS, K, SAMPLE_N, SCORE_DIGITS, SEED  # noqa: E402

register("sample_exact", f"""
SELECT o_orderkey, o_orderpriority FROM orders
ORDER BY {hash_sql(SEED, 'o_orderkey')}, o_orderkey LIMIT {SAMPLE_N}""")

register("bootstrap_resample", f"""
WITH base AS (SELECT p_partkey, p_size, p_retailprice,
                     row_number() OVER (ORDER BY {hash_sql(f'{SEED}-base', 'p_partkey')}, p_partkey) - 1 AS pos
              FROM part),
m AS (SELECT count(*) AS m FROM part),
draws AS (SELECT pos AS draw_id, {hash_sql(SEED, 'pos')} % m.m AS pick FROM base CROSS JOIN m)
SELECT CAST(d.draw_id AS BIGINT) AS draw_id, b.p_partkey, b.p_size, round(b.p_retailprice, {D}) AS p_retailprice
FROM draws d JOIN base b ON b.pos = d.pick""")

_FOLD = (f"CAST((row_number() OVER (PARTITION BY o_orderpriority ORDER BY {hash_sql(SEED, 'o_orderkey')}, "
         f"o_orderkey) - 1) % {FOLDS} AS INTEGER)")

register("stratified_folds", f"""
SELECT o_orderkey, o_orderpriority, {_FOLD} AS fold FROM orders""")

_PRED = f"SELECT o_orderkey, o_orderpriority AS t, {decode_sql('o_custkey % 5', PRIORITIES)} AS p FROM orders"
_IN = "(" + ", ".join(_q(c) for c in PRIORITIES) + ")"

register("confusion_matrix", f"""
WITH pr AS ({_PRED}),
cm AS (SELECT t, p, count(*) AS n FROM pr GROUP BY t, p)
SELECT a.label AS true_label, CAST(a.ord AS BIGINT) AS true_order,
       b.label AS pred_label, CAST(b.ord AS BIGINT) AS pred_order,
       CAST(coalesce(cm.n, 0) AS BIGINT) AS n
FROM {values_sql(PRIORITIES).replace('AS v(', 'AS a(')} CROSS JOIN {values_sql(PRIORITIES).replace('AS v(', 'AS b(')}
LEFT JOIN cm ON cm.t = a.label AND cm.p = b.label""")

register("confusion_normalized", f"""
WITH cmx AS ({ORACLE_SQL['confusion_matrix']})
SELECT *, round(CASE WHEN sum(n) OVER (PARTITION BY true_label) > 0
                     THEN n / sum(n) OVER (PARTITION BY true_label) END, {D}) AS row_share
FROM cmx""")

# per-class counts from the confusion table (correlated sums), then ratios
_PER_CLASS = f"""
pr AS ({_PRED}),
cm AS (SELECT t, p, count(*) AS n FROM pr GROUP BY t, p),
tot AS (SELECT sum(n) AS n_all, sum(CASE WHEN t IN {_IN} AND p IN {_IN} THEN n ELSE 0 END) AS n_in FROM cm),
pc AS (SELECT v.label, v.ord,
         coalesce((SELECT sum(n) FROM cm WHERE cm.t = v.label AND cm.p = v.label), 0) AS tp,
         coalesce((SELECT sum(n) FROM cm WHERE cm.t = v.label), 0) AS sup,
         coalesce((SELECT sum(n) FROM cm WHERE cm.p = v.label), 0) AS prd,
         coalesce((SELECT sum(n) FROM cm WHERE cm.t = v.label AND cm.p IN {_IN}), 0) AS supin,
         coalesce((SELECT sum(n) FROM cm WHERE cm.p = v.label AND cm.t IN {_IN}), 0) AS prdin
       FROM {values_sql(PRIORITIES)}),
m AS (SELECT pc.*, tot.n_all, tot.n_in,
        CASE WHEN prd > 0 THEN tp * 1.0 / prd ELSE 0.0 END AS prec,
        CASE WHEN sup > 0 THEN tp * 1.0 / sup ELSE 0.0 END AS rec,
        CASE WHEN sup + prd > 0 THEN 2.0 * tp / (sup + prd) ELSE 0.0 END AS f1,
        CASE WHEN (n_in - supin - prdin + tp) + (prdin - tp) > 0
             THEN (n_in - supin - prdin + tp) * 1.0 / ((n_in - supin - prdin + tp) + (prdin - tp))
             ELSE 0.0 END AS spec
      FROM pc CROSS JOIN tot)"""

_SUMMARY = f"""
WITH {_PER_CLASS},
agg AS (SELECT any_value(n_all) AS n_all, any_value(n_in) AS n_in, sum(tp) AS diag,
               sum(supin * prdin) AS pe_num, avg(prec) AS mp, avg(rec) AS mr, avg(spec) AS ms,
               avg(f1) AS mf, sum(f1 * sup) AS wf_num, sum(sup) AS sup_tot FROM m)
SELECT CAST(n_all AS BIGINT) AS n_rows,
       round(diag * 1.0 / n_all, {D}) AS accuracy,
       round(CASE WHEN pe_num * 1.0 / (n_in * n_in) < 1
                  THEN (diag * 1.0 / n_in - pe_num * 1.0 / (n_in * n_in)) / (1 - pe_num * 1.0 / (n_in * n_in)) END, {D}) AS kappa,
       round(mp, {D}) AS macro_precision, round(mr, {D}) AS macro_sensitivity,
       round(ms, {D}) AS macro_specificity, round(mf, {D}) AS macro_f1,
       round(CASE WHEN sup_tot > 0 THEN wf_num / sup_tot ELSE 0.0 END, {D}) AS weighted_f1
FROM agg"""

register("metrics_summary", _SUMMARY)

register("metrics_long", f"""
WITH s AS ({_SUMMARY})
SELECT 'custkey_rule' AS model, metric, CAST(metric_order AS BIGINT) AS metric_order, value FROM (
  SELECT 'accuracy' AS metric, 0 AS metric_order, accuracy AS value FROM s UNION ALL
  SELECT 'kappa', 1, kappa FROM s UNION ALL
  SELECT 'macro_precision', 2, macro_precision FROM s UNION ALL
  SELECT 'macro_sensitivity', 3, macro_sensitivity FROM s UNION ALL
  SELECT 'macro_specificity', 4, macro_specificity FROM s UNION ALL
  SELECT 'macro_f1', 5, macro_f1 FROM s UNION ALL
  SELECT 'weighted_f1', 6, weighted_f1 FROM s) u""")

register("class_report", f"""
WITH {_PER_CLASS},
tot2 AS (SELECT sum(sup) AS st, avg(prec) AS mp, avg(rec) AS mr, avg(f1) AS mf,
                sum(prec * sup) AS wp, sum(rec * sup) AS wr, sum(f1 * sup) AS wf FROM m)
SELECT label AS class, CAST(ord AS BIGINT) AS row_order, round(prec, {D}) AS precision,
       round(rec, {D}) AS recall, round(f1, {D}) AS f1, CAST(sup AS BIGINT) AS support FROM m
UNION ALL
SELECT 'macro avg', {K}, round(mp, {D}), round(mr, {D}), round(mf, {D}), CAST(st AS BIGINT) FROM tot2
UNION ALL
SELECT 'weighted avg', {K + 1},
       round(CASE WHEN st > 0 THEN wp / st ELSE 0 END, {D}), round(CASE WHEN st > 0 THEN wr / st ELSE 0 END, {D}),
       round(CASE WHEN st > 0 THEN wf / st ELSE 0 END, {D}), CAST(st AS BIGINT) FROM tot2""")


def _raw(k: int) -> str:
    return f"(CAST((o_custkey * {k + 1}) % 97 AS DOUBLE) / 97.0)"


_E = [f"exp({_raw(k)} - greatest({', '.join(_raw(j) for j in range(K))}))" for k in range(K)]
_SOFT = (f"SELECT o_orderkey, o_orderpriority, {encode_sql('o_orderpriority', PRIORITIES)} AS label, "
         + ", ".join(f"{_E[k]} AS e{k}" for k in range(K)) + " FROM orders")
_PROBS = (f"SELECT o_orderkey, o_orderpriority, label, "
          + ", ".join(f"e{k} / ({' + '.join(f'e{j}' for j in range(K))}) AS p{k}" for k in range(K))
          + f" FROM ({_SOFT}) s")

register("softmax_scores", f"""
SELECT o_orderkey, {', '.join(f'round(p{k}, {D}) AS p{k}' for k in range(K))},
       round({' + '.join(f'p{k}' for k in range(K))}, {D}) AS p_sum
FROM ({_PROBS}) q""")

_ARGMAX = ("CASE " + " ".join(
    f"WHEN {_raw(k)} = greatest({', '.join(_raw(j) for j in range(K))}) THEN {k}" for k in range(K)) + " END")

register("argmax_label", f"""
SELECT o_orderkey, CAST({_ARGMAX} AS BIGINT) AS pred_index,
       {decode_sql(_ARGMAX, PRIORITIES)} AS pred_priority
FROM orders""")

register("auc_ovr", f"""
WITH q AS ({_PROBS}),
lng AS ({' UNION ALL '.join(f'SELECT {k} AS k, label, round(p{k}, {SCORE_DIGITS}) AS s FROM q' for k in range(K))}),
g AS (SELECT k, s, sum(CASE WHEN label = k THEN 1 ELSE 0 END) AS pos,
             sum(CASE WHEN label <> k THEN 1 ELSE 0 END) AS neg
      FROM lng WHERE label IS NOT NULL GROUP BY k, s),
c AS (SELECT k, pos, neg, coalesce(sum(neg) OVER (PARTITION BY k ORDER BY s
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g),
a AS (SELECT k, CASE WHEN sum(pos) > 0 AND sum(neg) > 0
                     THEN sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) END AS auc
      FROM c GROUP BY k)
SELECT CAST(k AS BIGINT) AS class_index, round(auc, {D}) AS auc FROM a
UNION ALL
SELECT -1, round(CASE WHEN count(auc) = {K} THEN avg(auc) END, {D}) FROM a""")

register("cv_summary", f"""
WITH f AS (SELECT o_orderpriority AS t, {decode_sql('o_custkey % 5', PRIORITIES)} AS p, {_FOLD} AS fold FROM orders),
pc AS (SELECT f.fold, v.label,
         sum(CASE WHEN f.t = v.label AND f.p = v.label THEN 1 ELSE 0 END) AS tp,
         sum(CASE WHEN f.t = v.label THEN 1 ELSE 0 END) AS sup,
         sum(CASE WHEN f.p = v.label THEN 1 ELSE 0 END) AS prd
       FROM f CROSS JOIN {values_sql(PRIORITIES)} GROUP BY f.fold, v.label),
fm AS (SELECT fold, sum(CASE WHEN sup + prd > 0 THEN 2.0 * tp / (sup + prd) ELSE 0.0 END)
                    / sum(CASE WHEN sup + prd > 0 THEN 1 ELSE 0 END) AS macro_f1
       FROM pc GROUP BY fold)
SELECT CAST(count(*) AS BIGINT) AS n_folds, round(avg(macro_f1), {D}) AS mean_score,
       round(stddev_pop(macro_f1), {D}) AS std_score FROM fm""")


# ---- feature preparation ----------------------------------------------------

from outcomelab.plans.featureprep import UNSEEN_TYPE  # noqa: E402

register("standardize", f"""
WITH s AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS sd FROM orders)
SELECT o_orderkey, round((o_totalprice - s.m) / CASE WHEN s.sd > 0 THEN s.sd ELSE 1.0 END, {D}) AS o_totalprice_z
FROM orders CROSS JOIN s""")

register("one_hot", f"""
WITH cats AS (SELECT p_type, row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS idx
              FROM part WHERE p_type <> {_q(UNSEEN_TYPE)} AND p_type IS NOT NULL GROUP BY p_type)
SELECT p.p_partkey, p.p_type, CAST(c.idx AS BIGINT) AS hot_index,
       CAST(CASE WHEN c.idx IS NULL THEN 0 ELSE 1 END AS BIGINT) AS hot_count
FROM part p LEFT JOIN cats c ON c.p_type = p.p_type""")

register("class_weights", f"""
WITH c AS (SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1),
t AS (SELECT sum(n) AS total, count(*) AS k FROM c)
SELECT o_orderpriority, CAST(n AS BIGINT) AS n_rows, round(t.total * 1.0 / (t.k * n), {D}) AS class_weight
FROM c CROSS JOIN t""")

register("gamma_scale", f"""
WITH u AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x, len(embedding) AS d FROM embeddings)
SELECT CAST(count(x) AS BIGINT) AS n_values, CAST(max(d) AS BIGINT) AS dim,
       round(var_pop(x), {D}) AS variance, round(1.0 / (max(d) * var_pop(x)), {D}) AS gamma
FROM u""")

register("pca_variance", f"""
WITH s AS (SELECT abs(corr(l_quantity, l_extendedprice)) AS r, count(*) AS n FROM lineitem)
SELECT CAST(1 AS BIGINT) AS component, round((1 + r) / 2 * 100, {D}) AS variance_pct,
       round((1 + r) / 2 * 100, {D}) AS cumulative_pct, round((1 + r) * n / (n - 1.0), {D}) AS eigenvalue FROM s
UNION ALL
SELECT 2, round((1 - r) / 2 * 100, {D}), 100.0, round((1 - r) * n / (n - 1.0), {D}) FROM s""")

register("predictions_sink", f"""
WITH pr AS ({_PRED})
SELECT t AS true_label, p AS pred_label, CAST(count(*) AS BIGINT) AS n_rows FROM pr GROUP BY 1, 2""")

register("report_scrape", f"""
WITH s AS ({_SUMMARY})
SELECT round(accuracy, 4) AS accuracy, round(macro_f1, 4) AS macro_f1, round(weighted_f1, 4) AS weighted_f1
FROM s""")


register("csv_bad_cells", f"""
SELECT p_type, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(*) FILTER (WHERE p_partkey % {BAD_EVERY} = 0) AS BIGINT) AS n_bad,
       CAST(sum(p_size) FILTER (WHERE p_partkey % {BAD_EVERY} <> 0) AS BIGINT) AS sum_size,
       CAST(sum(p_partkey) AS BIGINT) AS sum_key, round(avg(p_retailprice), {D}) AS avg_price
FROM part GROUP BY p_type""")

# ---- principal components of the embeddings: powers of the correlation matrix ------

# The matrix is squared this often (and scaled by its trace), i.e. raised to the
# power 2 ** SQUARINGS, which leaves the leading eigenvector in every row.
SQUARINGS = 20


def _component(j: int) -> str:
    """``v{j}`` (v, ev) of matrix ``c{j}``, and the deflated matrix ``c{j + 1}``."""
    return f"""
p{j}(i, r, step) USING KEY (i) AS (
  SELECT i, r, 0 FROM c{j}
  UNION
  SELECT a.i, list(list_dot_product(a.r, b.r) / t.tr ORDER BY b.i), any_value(a.step) + 1
  FROM p{j} a CROSS JOIN p{j} b CROSS JOIN (SELECT sum(list_dot_product(r, r)) AS tr FROM p{j}) t
  WHERE a.step < {SQUARINGS} GROUP BY a.i),
n{j} AS (SELECT list_transform(r, lambda x: x / sqrt(list_dot_product(r, r))) AS u FROM p{j} ORDER BY r[i] DESC LIMIT 1),
s{j} AS (SELECT list_transform(u, lambda x: x * CASE WHEN
                u[list_position(list_transform(u, lambda y: abs(y)), list_max(list_transform(u, lambda y: abs(y))))] < 0
                THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END) AS v FROM n{j}),
v{j} AS (SELECT s.v, (SELECT sum(s.v[c.i] * list_dot_product(c.r, s.v)) FROM c{j} c) AS ev FROM s{j} s),
c{j + 1} AS (SELECT c.i, list_transform(range(1, len(c.r) + 1), lambda k: c.r[k] - v.ev * v.v[c.i] * v.v[k]) AS r
             FROM c{j} c CROSS JOIN v{j} v)"""


def _pca(components: int) -> str:
    return f"""
wide AS (SELECT vec_id, label, CAST(embedding[1:{EMB_DIM}] AS DOUBLE[]) AS x FROM embeddings),
cell AS (SELECT vec_id, unnest(range(1, {EMB_DIM} + 1)) AS i, unnest(x) AS x FROM wide),
moment AS (SELECT list(m ORDER BY i) AS m, list(s ORDER BY i) AS s
           FROM (SELECT i, avg(x) AS m, CASE WHEN stddev_pop(x) > 0 THEN stddev_pop(x) ELSE 1 END AS s FROM cell GROUP BY i)),
z AS (SELECT vec_id, label, list_transform(range(1, {EMB_DIM} + 1), lambda i: (x[i] - m[i]) / s[i]) AS z FROM wide CROSS JOIN moment),
col AS (SELECT i, list(x ORDER BY vec_id) AS x
        FROM (SELECT vec_id, unnest(range(1, {EMB_DIM} + 1)) AS i, unnest(z) AS x FROM z) GROUP BY i),
c1 AS (SELECT a.i, list(list_dot_product(a.x, b.x) / (len(a.x) - 1) ORDER BY b.i) AS r FROM col a CROSS JOIN col b GROUP BY a.i),
{','.join(_component(j) for j in range(1, components + 1))}"""


register("pca_loadings", f"""
WITH RECURSIVE {_pca(3)},
every AS ({' UNION ALL '.join(f'SELECT {j} AS component, v, ev FROM v{j}' for j in (1, 2, 3))})
SELECT 'e' || lpad(CAST(i - 1 AS VARCHAR), 2, '0') AS feature, CAST(component AS BIGINT) AS component,
       round(v[i], 3) AS weight, round(v[i] * sqrt(ev), {D}) AS loading, round(v[i] * sqrt(ev) * 3, {D}) AS arrow
FROM every CROSS JOIN range(1, {EMB_DIM} + 1) r(i)""")

register("pca_scores", f"""
WITH RECURSIVE {_pca(2)}
SELECT z.vec_id, z.label, round(list_dot_product(z.z, v1.v), {D}) AS pc1, round(list_dot_product(z.z, v2.v), {D}) AS pc2,
       CASE WHEN z.label IS NULL OR z.label <> 0 THEN 1 ELSE 0 END AS not_class0
FROM z CROSS JOIN v1 CROSS JOIN v2
ORDER BY {hash_sql('42', 'z.vec_id')}, z.vec_id LIMIT {PCA_SAMPLE}""")
