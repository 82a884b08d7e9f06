"""DuckDB twins of the model keys.

The support vector machines are solved a second time, by another method: the
coefficients of a machine are a combination of its training rows, so the twin
iterates on one number a row with the Gram matrix of the rows (accelerated
gradient steps in a recursive query, with the step and momentum that the
smoothness and the penalty give). Both solvers go to the optimum of a strongly
convex objective, so their predictions agree where no two margins tie. The
draws of the Fourier features are the md5 draws of ``functions.draws``.
"""

from __future__ import annotations

from outcomelab.operators.kernel_svm import DELTA
from outcomelab.plans import modeling as m
from outcomelab.plans.oracle import D, _q, decode_sql, encode_sql, hash_sql, register, values_sql
from outcomelab.plans.outcomes import CLASSES, NUMERIC, TARGET

K = m.K
WORDS = r"[^\x20\x09-\x0D]+"


def _hits(pattern: str) -> str:
    return f"length(txt) - length(regexp_replace(txt, '{pattern}', '', 'g'))"


def _share(pattern: str) -> str:
    return f"CASE WHEN length(txt) > 0 THEN ({_hits(pattern)}) / length(txt)::DOUBLE ELSE 0 END"


# The columns of plans.outcomes, in order.
_NUMBERS = {
    "log_chars": "ln(1 + length(txt))", "log_words": "ln(1 + len(ws))",
    "chars_per_word": "CASE WHEN len(ws) > 0 THEN length(txt) / len(ws)::DOUBLE ELSE 0 END",
    "distinct_share": "CASE WHEN len(ws) > 0 THEN len(list_distinct(ws)) / len(ws)::DOUBLE ELSE 0 END",
    "capital_share": _share("[A-Z]"), "digit_share": _share("[0-9]"), "symbol_share": _share("[#*$%&|<>]"),
    "exclaim_share": _share("[!?]"), "stop_share": _share("[.,;:]"), "vowel_share": _share("[aeiouAEIOU]"),
    "log_lines": f"ln(1 + {_hits(chr(92) + 'n')})"}

OUTCOMES = f"""
known AS (SELECT doc_id AS row_id, min(quality) AS q, max(toxic) AS t FROM labels
          WHERE doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL GROUP BY 1),
raw AS (SELECT k.row_id, k.q, k.t, d.lang, d.source, coalesce(d.text, '') AS txt,
               regexp_extract_all(coalesce(d.text, ''), '{WORDS}') AS ws,
               CAST(floor(k.row_id * 100 / ((SELECT max(doc_id) FROM documents) + 1)) AS BIGINT) AS pct
        FROM known k JOIN documents d ON d.doc_id = k.row_id),
named AS (SELECT row_id, pct, lang, source, {', '.join(f'{_NUMBERS[c]} AS {c}' for c in NUMERIC)},
                 CASE WHEN q = 1 THEN CASE WHEN t = 1 THEN {_q(CLASSES[1])} ELSE {_q(CLASSES[0])} END
                      ELSE CASE WHEN t = 1 THEN {_q(CLASSES[3])} ELSE {_q(CLASSES[2])} END END AS {TARGET}
          FROM raw),
outcome AS (SELECT *, CAST({encode_sql(TARGET, CLASSES)} AS BIGINT) AS label,
                   CASE WHEN pct <= {m.TRAIN_LAST} THEN 'train' WHEN pct = {m.VAL} THEN 'val'
                        WHEN pct >= {m.TEST_FIRST} THEN 'test' END AS split,
                   [{', '.join(f'CAST({c} AS DOUBLE)' for c in NUMERIC)}] AS num
            FROM named)"""

register("outcome_rows", f"""
WITH {OUTCOMES}
SELECT row_id, pct, lang, source, {', '.join(f'round({c}, {D}) AS {c}' for c in NUMERIC)}, {TARGET}, label, split
FROM outcome""")


def _scaled(std: str = "stddev_pop") -> str:
    """``scaled``: (set_id, i, label, test, src, z of the numbers) of ``members``
    (set_id, row_id, label, src, num, test), by the training rows of the set."""
    return f"""
cells AS (SELECT set_id, test, unnest(range(1, {len(NUMERIC) + 1})) AS j, unnest(num) AS x FROM members),
moments AS (SELECT set_id, list(mu ORDER BY j) AS mu, list(CASE WHEN sd > 0 THEN sd ELSE 1 END ORDER BY j) AS sd
            FROM (SELECT set_id, j, avg(x) AS mu, {std}(x) AS sd FROM cells WHERE NOT test GROUP BY 1, 2) GROUP BY 1),
seen AS (SELECT DISTINCT set_id, src FROM members WHERE NOT test AND src IS NOT NULL),
scaled AS (SELECT x.set_id, x.row_id, x.label, x.test, x.grp, y.src AS src,
                  row_number() OVER (PARTITION BY x.set_id, x.test ORDER BY x.row_id) AS i,
                  list_transform(range(1, {len(NUMERIC) + 1}), lambda j: (x.num[j] - o.mu[j]) / o.sd[j]) AS z
           FROM members x JOIN moments o ON o.set_id = x.set_id
           LEFT JOIN seen y ON y.set_id = x.set_id AND y.src = x.src)"""


def _linear(constant: bool = True) -> str:
    """``points``: z-scores, an indicator a category, and the constant."""
    one = "[1.0::DOUBLE]" if constant else "[]::DOUBLE[]"
    return f"""
cats AS (SELECT list(src ORDER BY src) AS all_src FROM (SELECT DISTINCT src FROM seen)),
points AS (SELECT s.* EXCLUDE (z), list_concat(list_concat(s.z,
                  list_transform(c.all_src, lambda q: CASE WHEN q = s.src THEN 1.0 ELSE 0.0 END::DOUBLE)), {one}) AS z
           FROM scaled s CROSS JOIN cats c)"""


def _normal_sql(key: str) -> str:
    def unit(end):
        return f"(CAST(('0x' || substr(md5({key} || '-{end}'), 1, 15))::BIGINT AS DOUBLE) / {float(2 ** 60)})"
    return f"sqrt(-2 * ln(1 - {unit('a')})) * cos(2 * pi() * {unit('b')})"


def _fourier(gamma: float, features: int, seed: int) -> str:
    """``points``: Fourier features of the given width, and the constant."""
    offset = f"(CAST(('0x' || substr(md5('{seed}-offset-' || j), 1, 15))::BIGINT AS DOUBLE) / {float(2 ** 60)})"
    return f"""
axis AS (SELECT j, 2 * pi() * {offset} AS off,
                [{', '.join(_normal_sql(f"'{seed}-num{i}-' || j") for i in range(len(NUMERIC)))}] AS w
         FROM range({features}) r(j)),
turns AS (SELECT src, j, {_normal_sql(f"'{seed}-cat-' || src || '-' || j")} AS u
          FROM (SELECT DISTINCT src FROM seen) CROSS JOIN range({features}) r(j)),
points AS (SELECT s.set_id, s.row_id, s.label, s.test, s.grp, s.src, s.i,
                  list_concat(list({(2.0 / features) ** 0.5} * cos({(2.0 * gamma) ** 0.5}
                      * (list_dot_product(s.z, a.w) + coalesce(t.u, 0)) + a.off) ORDER BY a.j), [1.0::DOUBLE]) AS z
           FROM scaled s CROSS JOIN axis a LEFT JOIN turns t ON t.src = s.src AND t.j = a.j
           GROUP BY ALL)""".replace("GROUP BY ALL", "GROUP BY s.set_id, s.row_id, s.label, s.test, s.grp, s.src, s.i")


def _gram() -> str:
    return f"""
sizes AS (SELECT set_id, label, count(*) AS n_c, sum(count(*)) OVER (PARTITION BY set_id) AS n,
                 count(*) OVER (PARTITION BY set_id) AS k FROM points WHERE NOT test GROUP BY 1, 2),
gram AS (SELECT a.set_id, a.row_id, a.i, a.label, a.test, a.grp, list(list_dot_product(a.z, b.z) ORDER BY b.i) AS g
         FROM points a JOIN points b ON b.set_id = a.set_id AND NOT b.test
         GROUP BY a.set_id, a.row_id, a.i, a.label, a.test, a.grp),
own AS (SELECT g.set_id, g.i, g.label, g.g, 1.0 / (s.k * s.n_c) AS w
        FROM gram g JOIN sizes s ON s.set_id = g.set_id AND s.label = g.label WHERE NOT g.test),
heavy AS (SELECT set_id, list(w ORDER BY i) AS ws FROM own GROUP BY 1)"""


# Bounds of the largest eigenvalue of the weighted Gram matrix: its trace, and its largest row sum.
_TOP = """least(sum(o.w * o.g[o.i]),
              max(list_sum(list_transform(list_zip(o.g, h.ws), lambda q: abs(q[1]) * q[2]))))"""


def _machines(c: float, steps: int) -> str:
    """``solved`` (set_id, cls, c) and ``chosen`` (set_id, row_id, grp, label, prediction) of the held-out rows."""
    return f"""
machines AS (SELECT set_id, cls, lam, 1 / (top / {DELTA} + lam) AS eta,
                    (1 - sqrt(lam / (top / {DELTA} + lam))) / (1 + sqrt(lam / (top / {DELTA} + lam))) AS beta, n
             FROM (SELECT o.set_id, {_TOP} AS top, any_value(s.n) AS n, 1.0 / ({c} * any_value(s.n)) AS lam
                   FROM own o JOIN heavy h ON h.set_id = o.set_id JOIN (SELECT DISTINCT set_id, n FROM sizes) s
                   ON s.set_id = o.set_id GROUP BY 1)
             CROSS JOIN range({K}) r(cls)),
solved(set_id, cls, c, y, step) USING KEY (set_id, cls) AS (
  SELECT set_id, cls, list_transform(range(CAST(n AS BIGINT)), lambda x: 0.0::DOUBLE), list_transform(range(CAST(n AS BIGINT)), lambda x: 0.0::DOUBLE), 0 FROM machines
  UNION
  SELECT set_id, cls, list(d ORDER BY i), list(d + beta * (d - was) ORDER BY i), any_value(step) + 1
  FROM (SELECT t.set_id, t.cls, o.i, t.step, p.beta, t.c[o.i] AS was,
               (1 - p.eta * p.lam) * t.y[o.i] + p.eta * o.w * (CASE WHEN o.label = t.cls THEN 1 ELSE -1 END)
               * least(greatest((1 - (CASE WHEN o.label = t.cls THEN 1 ELSE -1 END) * list_dot_product(o.g, t.y)) / {DELTA},
                                0), 1) AS d
        FROM solved t JOIN machines p ON p.set_id = t.set_id AND p.cls = t.cls JOIN own o ON o.set_id = t.set_id
        WHERE t.step < {steps})
  GROUP BY set_id, cls),
chosen AS (SELECT g.set_id, g.row_id, g.grp, g.label,
                  arg_max(s.cls, list_dot_product(g.g, s.c)) AS prediction
           FROM gram g JOIN solved s ON s.set_id = g.set_id WHERE g.test GROUP BY 1, 2, 3, 4)"""


_SPLIT = """
members AS (SELECT 0 AS set_id, row_id, label, source AS src, num, split = 'test' AS test, '' AS grp FROM outcome
            WHERE split IN ('train', 'test') AND label IS NOT NULL)"""


def _prediction(column: str) -> str:
    return f"""
SELECT c.row_id, o.{TARGET}, {decode_sql('c.prediction', CLASSES)} AS {column}
FROM chosen c JOIN outcome o ON o.row_id = c.row_id"""


register("svc_ovr_weighted", f"""
WITH RECURSIVE {OUTCOMES}, {_SPLIT}, {_scaled()}, {_linear()}, {_gram()}, {_machines(1.0, 4000)}
{_prediction('pred_svm_linear')}""")

_FOLD = f"(row_number() OVER (PARTITION BY lang, label ORDER BY {hash_sql(m.SEED, 'row_id')}, row_id) - 1) % {m.GROUP_FOLDS}"

# One training set for each language with enough rows and each held-out fold.
_GROUPS = f"""
folded AS (SELECT row_id, lang, label, source, num, {_FOLD} AS fold, count(*) OVER (PARTITION BY lang) AS n
           FROM outcome WHERE split = 'train' AND label IS NOT NULL),
members AS (SELECT v.ord * {m.GROUP_FOLDS} + r.f AS set_id, f.row_id, f.label, f.source AS src, f.num,
                   f.fold = r.f AS test, f.lang AS grp
            FROM folded f JOIN {values_sql(m.GROUPS)} ON v.label = f.lang CROSS JOIN range({m.GROUP_FOLDS}) r(f)
            WHERE f.n >= {m.GROUP_MIN_ROWS})"""

register("group_cv", f"""
WITH RECURSIVE {OUTCOMES}, {_GROUPS}, {_scaled()}, {_fourier(m.GROUP_GAMMA, m.RFF_FEATURES, m.SEED)}, {_gram()},
{_machines(m.GROUP_C, 1500)},
per_class AS (SELECT c.grp, c.set_id, r.k, count(*) FILTER (WHERE c.label = r.k AND c.prediction = r.k) AS tp,
                     count(*) FILTER (WHERE c.label = r.k) AS sup, count(*) FILTER (WHERE c.prediction = r.k) AS prd
              FROM chosen c CROSS JOIN range({K}) r(k) GROUP BY 1, 2, 3),
per_fold AS (SELECT grp, set_id, sum(CASE WHEN sup + prd > 0 THEN 2.0 * tp / (sup + prd) ELSE 0 END)
                    / sum(CASE WHEN sup + prd > 0 THEN 1 ELSE 0 END) AS f1 FROM per_class GROUP BY 1, 2),
per_group AS (SELECT grp, avg(f1) AS mean_score, stddev_pop(f1) AS std_score FROM per_fold GROUP BY 1)
SELECT v.label AS lang, CAST(v.ord AS BIGINT) AS group_order,
       CAST((SELECT count(*) FROM folded f WHERE f.lang = v.label) AS BIGINT) AS n_rows,
       round(g.mean_score, {D}) AS mean_score, round(coalesce(g.std_score, 0), {D}) AS std_score
FROM {values_sql(m.GROUPS)} LEFT JOIN per_group g ON g.grp = v.label""")


def _softmax(c: float, steps: int) -> str:
    """``solved`` (cls, c, b) of the multinomial logistic regression, intercept
    without a penalty, and ``chosen``. The softmax loss is 1/2-smooth."""
    return f"""
shape AS (SELECT lam, 1 / (top / 2 + lam) AS eta, (1 - sqrt(lam / (top / 2 + lam))) / (1 + sqrt(lam / (top / 2 + lam))) AS beta, n
          FROM (SELECT sum(o.w * (o.g[o.i] + 1)) AS top, any_value(s.n) AS n, 1.0 / ({c} * any_value(s.n)) AS lam
                FROM own o CROSS JOIN (SELECT DISTINCT n FROM sizes) s)),
solved(cls, c, y, b, e, step) USING KEY (cls) AS (
  SELECT cls, list_transform(range(CAST(n AS BIGINT)), lambda x: 0.0::DOUBLE), list_transform(range(CAST(n AS BIGINT)), lambda x: 0.0::DOUBLE), 0.0::DOUBLE, 0.0::DOUBLE, 0
  FROM shape CROSS JOIN (SELECT DISTINCT label AS cls FROM sizes)
  UNION
  SELECT cls, list(d ORDER BY i), list(d + beta * (d - was) ORDER BY i), any_value(e) - any_value(eta) * sum(r),
         any_value(e) - any_value(eta) * sum(r) + any_value(beta) * (any_value(e) - any_value(eta) * sum(r) - any_value(b)),
         any_value(step) + 1
  FROM (SELECT cls, i, step, beta, eta, was, b, e, r, (1 - eta * lam) * now - eta * r AS d
        FROM (SELECT q.*, w * (x / sum(x) OVER (PARTITION BY i) - CASE WHEN label = cls THEN 1 ELSE 0 END) AS r
              FROM (SELECT t.cls, o.i, o.label, o.w, t.step, t.b, t.e, p.beta, p.eta, p.lam, t.c[o.i] AS was, t.y[o.i] AS now,
                           exp(list_dot_product(o.g, t.y) + t.e) AS x
                    FROM solved t CROSS JOIN shape p CROSS JOIN own o WHERE t.step < {steps}) q))
  GROUP BY cls),
chosen AS (SELECT g.set_id, g.row_id, g.grp, g.label, arg_max(s.cls, list_dot_product(g.g, s.c) + s.b) AS prediction
           FROM gram g CROSS JOIN solved s WHERE g.test GROUP BY 1, 2, 3, 4)"""


register("logreg", f"""
WITH RECURSIVE {OUTCOMES}, {_SPLIT}, {_scaled('stddev_samp')}, {_linear(False)}, {_gram()}, {_softmax(1.0, 3000)}
{_prediction('pred_logreg')}""")


# ---- what the grid and the sweep state about their work ---------------------------

_GRID_FOLD = f"(row_number() OVER (PARTITION BY label ORDER BY {hash_sql(m.SEED, 'row_id')}, row_id) - 1) % {m.GRID_FOLDS}"
_P = len(NUMERIC)

# Width 'scale' of a training matrix: z-scored columns have variance 1 (0 if
# constant), an indicator column has its share of rows; widths count the
# categories that the training rows hold.
register("grid_certificate", f"""
WITH {OUTCOMES},
folded AS (SELECT row_id, label, source, num, {_GRID_FOLD} AS fold FROM outcome WHERE split = 'train' AND label IS NOT NULL),
sets AS (SELECT r.f AS held, f.* FROM folded f CROSS JOIN range({m.GRID_FOLDS}) r(f) WHERE f.fold <> r.f),
sized AS (SELECT held, count(*) AS n, count(source) * 1.0 / count(*) AS hot, count(DISTINCT source) AS cats,
                 count(DISTINCT label) AS k FROM sets GROUP BY 1),
live AS (SELECT held, count(*) FILTER (WHERE sd > 0) AS varying
         FROM (SELECT held, j, stddev_pop(x) AS sd
               FROM (SELECT held, unnest(range({_P})) AS j, unnest(num) AS x FROM sets) GROUP BY 1, 2) GROUP BY 1),
of_class AS (SELECT held, label, count(*) AS n_class FROM sets GROUP BY 1, 2),
scaled AS (SELECT s.*, 1 / (({_P} + cats) * ((varying + hot) / ({_P} + cats) - (hot / ({_P} + cats)) ** 2)) AS width
           FROM sized s JOIN live v ON v.held = s.held)
SELECT CAST(s.held AS BIGINT) AS fold, g.label AS gamma, CAST(c.label AS DOUBLE) AS c, j.label AS class,
       CAST(s.n AS BIGINT) AS n_rows, CAST(coalesce(o.n_class, 0) AS BIGINT) AS n_class,
       round(coalesce(s.n * 1.0 / (s.k * o.n_class), 0), {D}) AS class_weight,
       round(1e3 / (CAST(c.label AS DOUBLE) * s.n), {D}) AS penalty_e3,
       round(CASE WHEN g.label = 'scale' THEN s.width ELSE CAST(g.label AS DOUBLE) END, {D}) AS width, true AS certified
FROM scaled s
CROSS JOIN {values_sql(['scale' if g <= 0 else str(g) for g in m.GRID_GAMMA]).replace('AS v(', 'AS g(')}
CROSS JOIN {values_sql([str(c) for c in m.GRID_C]).replace('AS v(', 'AS c(')}
CROSS JOIN {values_sql(CLASSES).replace('AS v(', 'AS j(')}
LEFT JOIN of_class o ON o.held = s.held AND o.label = j.ord""".replace(
    "CASE WHEN g.label = 'scale' THEN s.width ELSE CAST(g.label AS DOUBLE) END",
    "CASE WHEN g.label = 'scale' THEN s.width ELSE TRY_CAST(g.label AS DOUBLE) END"))

_ARMS = ("spark_linearsvc_ovr", "linear_svm_balanced")

register("scaling_curve", f"""
WITH {OUTCOMES},
base AS (SELECT row_id, row_number() OVER (ORDER BY {hash_sql(f'{m.SEED}-base', 'row_id')}, row_id) - 1 AS pos
         FROM outcome WHERE split = 'train' AND label IS NOT NULL),
drawn AS (SELECT r.draw, {hash_sql(m.SEED, 'r.draw')} % (SELECT count(*) FROM base) AS pick
          FROM range({max(m.SCALING_SIZES)}) r(draw)),
rows AS (SELECT d.draw, b.row_id FROM drawn d JOIN base b ON b.pos = d.pick)
SELECT CAST(z.label AS BIGINT) AS n_rows, a.label AS arm, 'ok' AS status,
       CAST(count(DISTINCT r.row_id) AS BIGINT) AS distinct_rows, CAST(sum(r.row_id) AS BIGINT) AS id_sum
FROM {values_sql([str(n) for n in m.SCALING_SIZES]).replace('AS v(', 'AS z(')}
CROSS JOIN {values_sql(_ARMS).replace('AS v(', 'AS a(')} JOIN rows r ON r.draw < CAST(z.label AS BIGINT)
GROUP BY 1, 2""")


register("model_predictions_sink", f"""
WITH {OUTCOMES}
SELECT {TARGET}, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(row_id) AS BIGINT) AS id_sum,
       CAST(0 AS BIGINT) AS without_pred_svm_rbf, CAST(0 AS BIGINT) AS without_pred_svm_linear,
       CAST(0 AS BIGINT) AS without_pred_logreg
FROM outcome WHERE split = 'test' GROUP BY 1""")

