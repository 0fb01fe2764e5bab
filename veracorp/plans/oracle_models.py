"""DuckDB oracles for the Naive Bayes queries."""

from __future__ import annotations

from veracorp.functions import lexicon as L
from veracorp.plans.oracle import hkey, with_base, words2
from veracorp.plans.oracle_lm import REPORT_SELECT, metrics_ctes, metrics_select

SQL: dict[str, str] = {}

_ALPHAS = ", ".join(repr(float(a)) for a in L.NB_ALPHAS)

_NB = f"""
counts AS (SELECT label, count(*) AS cnt FROM processed GROUP BY label),
q AS (
  SELECT label, cnt, floor(t * cnt / n) AS base, t * cnt / n - floor(t * cnt / n) AS frac, t FROM (
    SELECT label, cnt, sum(cnt) OVER () AS n, ceil(0.2 * sum(cnt) OVER ()) AS t FROM counts)),
q2 AS (
  SELECT label, base + CASE WHEN row_number() OVER (ORDER BY frac DESC, label) <= t - sum(base) OVER ()
    THEN 1 ELSE 0 END AS quota FROM q),
ranked AS (
  SELECT doc_id, cleaned_text, label, row_number() OVER (PARTITION BY label ORDER BY {hkey()}) AS rn FROM processed),
split AS (SELECT r.doc_id, r.cleaned_text, r.label, r.rn <= q2.quota AS is_test FROM ranked r JOIN q2 ON r.label = q2.label),
train AS (SELECT * FROM split WHERE NOT is_test),
test AS (SELECT * FROM split WHERE is_test),
tf_tr AS (SELECT doc_id, term, count(*) AS tf FROM (
  SELECT doc_id, unnest({words2('cleaned_text')}) AS term FROM train) GROUP BY ALL),
vocab AS (SELECT term FROM tf_tr GROUP BY term ORDER BY sum(tf) DESC, term LIMIT 5000),
tf_te AS (SELECT doc_id, term, count(*) AS tf FROM (
  SELECT doc_id, unnest({words2('cleaned_text')}) AS term FROM test) WHERE term IN (SELECT term FROM vocab) GROUP BY ALL),
cc AS (SELECT label, count(*) AS n_c FROM train GROUP BY label),
fc AS (SELECT t.label, f.term, sum(f.tf) AS cnt FROM tf_tr f JOIN vocab v ON f.term = v.term
       JOIN train t ON t.doc_id = f.doc_id GROUP BY ALL),
tot AS (SELECT label, sum(cnt) AS tt FROM fc GROUP BY label),
alphas AS (SELECT unnest([{_ALPHAS}]) AS alpha),
theta AS (
  SELECT a.alpha, cc.label, v.term,
    ln((coalesce(fc.cnt, 0) + a.alpha) / (coalesce(tot.tt, 0) + a.alpha * (SELECT count(*) FROM vocab))) AS lt
  FROM alphas a CROSS JOIN cc CROSS JOIN vocab v
  LEFT JOIN fc ON fc.label = cc.label AND fc.term = v.term LEFT JOIN tot ON tot.label = cc.label),
contrib AS (SELECT th.alpha, f.doc_id, th.label, sum(f.tf * th.lt) AS s FROM tf_te f JOIN theta th ON th.term = f.term
            GROUP BY ALL),
scores AS (
  SELECT a.alpha, t.doc_id, cc.label,
    ln(cc.n_c / (SELECT sum(n_c) FROM cc)) + coalesce(c.s, 0.0) AS score
  FROM test t CROSS JOIN alphas a CROSS JOIN cc
  LEFT JOIN contrib c ON c.alpha = a.alpha AND c.doc_id = t.doc_id AND c.label = cc.label),
sm AS (SELECT alpha, doc_id, label, score, score - max(score) OVER (PARTITION BY alpha, doc_id) AS z FROM scores),
probs AS (
  SELECT alpha, doc_id, label, score, exp(z) / sum(exp(z)) OVER (PARTITION BY alpha, doc_id) AS prob FROM sm),
best AS (
  SELECT alpha, doc_id, arg_min(label, (-score, label)) AS pred, arg_min(prob, (-score, label)) AS confidence
  FROM probs GROUP BY alpha, doc_id),
allpreds AS (SELECT b.*, t.label AS truth, t.cleaned_text FROM best b JOIN test t ON t.doc_id = b.doc_id),
preds AS (SELECT * FROM allpreds WHERE alpha = 1.0)"""

SQL["M1_nb_class_counts"] = with_base(_NB) + """
SELECT cc.label, cc.n_c AS class_docs, CAST(coalesce(tot.tt, 0) AS BIGINT) AS total_terms
FROM cc LEFT JOIN tot ON tot.label = cc.label"""

SQL["M1_nb_term_counts"] = with_base(_NB) + "SELECT label, term, CAST(cnt AS BIGINT) AS cnt FROM fc"

SQL["M2_nb_predictions"] = with_base(_NB) + \
    "SELECT doc_id, truth, pred, round(confidence, 6) AS confidence FROM preds"

SQL["M2_nb_probabilities"] = with_base(_NB) + \
    "SELECT doc_id, label, round(prob, 6) AS prob FROM probs WHERE alpha = 1.0"

SQL["M3_nb_alpha_sweep"] = with_base(_NB, """
pa AS (SELECT * FROM allpreds),
cls AS (SELECT DISTINCT alpha, truth AS c FROM pa UNION SELECT DISTINCT alpha, pred FROM pa),
pc AS (
  SELECT cls.alpha, c,
    (SELECT count(*) FROM pa WHERE pa.alpha = cls.alpha AND truth = c AND pred = c) AS tp,
    (SELECT count(*) FROM pa WHERE pa.alpha = cls.alpha AND pred = c) AS npred,
    (SELECT count(*) FROM pa WHERE pa.alpha = cls.alpha AND truth = c) AS support
  FROM cls),
pr AS (
  SELECT alpha, c, support, CASE WHEN npred > 0 THEN tp / npred ELSE 0.0 END AS p,
    CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS r FROM pc),
f AS (SELECT alpha, sum(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END * support) / sum(support) AS f1
      FROM pr GROUP BY alpha),
acc AS (SELECT alpha, avg(CASE WHEN truth = pred THEN 1.0 ELSE 0.0 END) AS accuracy FROM pa GROUP BY alpha),
grid AS (SELECT unnest([""" + _ALPHAS + """]) AS alpha, unnest(range(1, """ + str(len(L.NB_ALPHAS) + 1) + """)) AS o),
res AS (SELECT f.alpha, acc.accuracy, f.f1, grid.o FROM f JOIN acc ON acc.alpha = f.alpha JOIN grid ON grid.alpha = f.alpha)""") + """
SELECT round(alpha, 6) AS alpha, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1_score,
  alpha = (SELECT arg_min(alpha, (-f1, o)) FROM res) AS is_best
FROM res"""

SQL["M7_nb_evaluation"] = with_base(_NB, metrics_ctes()) + metrics_select()
SQL["M7_nb_class_report"] = with_base(_NB, metrics_ctes()) + REPORT_SELECT
SQL["M7_nb_confusion"] = with_base(_NB) + "SELECT truth, pred, count(*) AS cnt FROM preds GROUP BY ALL"

SQL["M8_nb_roc_auc"] = with_base(_NB, """
pt AS (SELECT p.label, p.prob, CASE WHEN t.label = p.label THEN 1 ELSE 0 END AS pos
       FROM probs p JOIN test t ON t.doc_id = p.doc_id WHERE p.alpha = 1.0),
d AS (SELECT label, prob, sum(pos) AS p, sum(1 - pos) AS n FROM pt GROUP BY label, prob),
c AS (SELECT label, prob, p, n,
        sum(p) OVER (PARTITION BY label ORDER BY prob DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp
      FROM d)""") + """
SELECT label, round(CASE WHEN sum(p) > 0 AND sum(n) > 0 THEN sum(n * (2 * tp - p) / 2.0) / (sum(p) * sum(n)) END, 6)
  AS auc, count(*) AS n_thresholds
FROM c GROUP BY label"""

SQL["M8_nb_roc_points"] = with_base(_NB, """
pt AS (SELECT p.label, round(p.prob, 6) AS prob, CASE WHEN t.label = p.label THEN 1 ELSE 0 END AS pos
       FROM probs p JOIN test t ON t.doc_id = p.doc_id WHERE p.alpha = 1.0),
d AS (SELECT label, prob, sum(pos) AS p, sum(1 - pos) AS n FROM pt GROUP BY label, prob)""") + """
SELECT label, prob AS threshold,
  round(sum(n) OVER w / sum(n) OVER (PARTITION BY label), 6) AS fpr,
  round(sum(p) OVER w / sum(p) OVER (PARTITION BY label), 6) AS tpr
FROM d WINDOW w AS (PARTITION BY label ORDER BY prob DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""

SQL["M13_nb_misclassified"] = with_base(_NB) + """
SELECT doc_id, truth AS true_label, pred AS predicted_label, truth || '_to_' || pred AS error_type,
  substr(cleaned_text, 1, 300) AS text
FROM preds WHERE truth <> pred ORDER BY doc_id LIMIT 30"""
