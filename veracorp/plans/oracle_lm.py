"""DuckDB oracles for the n-gram language-model queries."""

from __future__ import annotations

import math

from veracorp.plans.oracle import hkey, with_base, ws_tokens

SQL: dict[str, str] = {}

_LM_SPLIT = f"""
counts AS (SELECT label, count(*) AS cnt FROM combined GROUP BY label),
q AS (
  SELECT label, cnt, floor(t * cnt / n) AS base, t * cnt / n - floor(t * cnt / n) AS frac, t FROM (
    SELECT label, cnt, sum(cnt) OVER () AS n,
      greatest(60, floor(sum(cnt) OVER () * 0.1)) AS t FROM counts)),
q2 AS (
  SELECT label, base + CASE WHEN row_number() OVER (ORDER BY frac DESC, label) <= t - sum(base) OVER ()
    THEN 1 ELSE 0 END AS quota FROM q),
ranked AS (
  SELECT doc_id, text, label, row_number() OVER (PARTITION BY label ORDER BY {hkey()}) AS rn FROM combined),
split AS (SELECT r.doc_id, r.text, r.label, r.rn <= q2.quota AS is_test FROM ranked r JOIN q2 ON r.label = q2.label),
train AS (SELECT * FROM split WHERE NOT is_test),
test AS (SELECT * FROM split WHERE is_test)"""


def _grams(src: str, n: int, keys: str, name: str) -> str:
    start = "[" + ", ".join(["'<START>'"] * (n - 1)) + "]" if n > 1 else "CAST([] AS VARCHAR[])"
    ctx = f"array_to_string(list_slice(g, 1, {n - 1}), ' ')" if n > 1 else "''"
    return f"""
{name}_p AS (SELECT {keys}, list_concat(list_concat({start}, {ws_tokens('text')}), ['<END>']) AS p FROM {src}),
{name} AS (
  SELECT {keys}, array_to_string(g, ' ') AS ngram, {ctx} AS ctx, g[{n}] AS tok FROM (
    SELECT {keys}, list_slice(p, i, i + {n - 1}) AS g
    FROM (SELECT {keys}, p, unnest(range(1, len(p) - {n - 1} + 1)) AS i FROM {name}_p)))"""


_MODEL = _LM_SPLIT + "," + _grams("train", 3, "label", "tg") + """,
ng AS (SELECT label, ngram, ctx, tok, count(*) AS c FROM tg GROUP BY ALL),
cx AS (SELECT label, ctx, count(*) AS ctot, count(DISTINCT tok) AS n1p FROM tg GROUP BY ALL),
ts AS (SELECT u.label, u.tok, u.uni, k.U FROM (SELECT label, tok, count(*) AS uni FROM tg GROUP BY ALL) u
       JOIN (SELECT label, tok, count(*) AS U FROM ng GROUP BY ALL) k ON u.label = k.label AND u.tok = k.tok),
cs AS (SELECT label, count(*) AS V, sum(uni) AS N FROM ts GROUP BY label)"""


def _scored() -> str:
    return _grams("test", 3, "doc_id", "eg") + """,
em AS (SELECT doc_id, ngram, ctx, tok, count(*) AS m FROM eg GROUP BY ALL),
sc AS (
  SELECT e.doc_id, cs.label, e.m, coalesce(ng.c, 0) AS c, coalesce(cx.ctot, 0) AS ctot, coalesce(cx.n1p, 0) AS n1p,
    (SELECT count(*) FROM ng WHERE ng.label = cs.label) AS uniq,
    coalesce(ts.uni, 0) AS uni, coalesce(ts.U, 0) AS U, cs.V, cs.N
  FROM em e CROSS JOIN cs
  LEFT JOIN ng ON ng.label = cs.label AND ng.ngram = e.ngram
  LEFT JOIN cx ON cx.label = cs.label AND cx.ctx = e.ctx
  LEFT JOIN ts ON ts.label = cs.label AND ts.tok = e.tok)"""


_KN = ('CASE WHEN ctot = 0 THEN 1.0 / V ELSE greatest(c - 0.75, 0.0) / ctot + (0.75 / ctot) * U * uni / N END')
_LAP = 'CASE WHEN ctot + V = 0 THEN 1.0 / V ELSE (c + 1.0) / (ctot + 1.0 * V) END'
_FLOOR = repr(math.log(1e-10))


def _ppl(p: str, keys: str) -> str:
    return (f"SELECT {keys}, exp(-sum(m * CASE WHEN {p} > 0 THEN ln({p}) ELSE {_FLOOR} END) / sum(m)) AS perplexity "
            f"FROM sc GROUP BY {keys}")


SQL["G1_extract_ngrams"] = with_base(_grams("combined", 2, "doc_id", "bg")) + \
    "SELECT ngram, count(*) AS cnt FROM bg GROUP BY ngram HAVING count(*) >= 2"

SQL["G2_lm_ngram_counts"] = with_base(_MODEL) + "SELECT label, ngram, c AS cnt FROM ng"

SQL["G3_continuation_counts"] = with_base(_MODEL) + "SELECT label, tok, U AS contexts, uni FROM ts"

SQL["G4_laplace_perplexity"] = with_base(_MODEL, _scored()) + \
    f"SELECT doc_id, label, round(perplexity, 6) AS perplexity FROM ({_ppl(_LAP, 'doc_id, label')})"

SQL["G5_kn_perplexity"] = with_base(_MODEL, _scored()) + \
    f"SELECT doc_id, label, round(perplexity, 6) AS perplexity FROM ({_ppl(_KN, 'doc_id, label')})"

_IKN = ("CASE WHEN ctot = 0 THEN U / uniq ELSE greatest(c - 0.75, 0.0) / ctot + 0.75 * n1p / ctot * U / uniq END")

SQL["G5_interpolated_kn_perplexity"] = with_base(_MODEL, _scored()) + \
    f"SELECT doc_id, label, round(ln(perplexity), 9) AS log_perplexity FROM ({_ppl(_IKN, 'doc_id, label')})"

SQL["G6_corpus_perplexity"] = with_base(_MODEL, _scored()) + \
    f"SELECT label, round(perplexity, 6) AS perplexity FROM ({_ppl(_KN, 'label')})"

SQL["G7_top_ngrams"] = with_base(_MODEL) + """
SELECT label, rank, ngram, c AS cnt FROM (
  SELECT label, ngram, c, row_number() OVER (PARTITION BY label ORDER BY c DESC, ngram) AS rank FROM ng)
WHERE rank <= 20"""

SQL["G8_lm_class_stats"] = with_base(_MODEL) + """
SELECT cs.label, cs.V AS vocab_size, CAST(cs.N AS BIGINT) AS total_ngrams, u.unique_ngrams, d.training_documents
FROM cs JOIN (SELECT label, count(*) AS unique_ngrams FROM ng GROUP BY label) u ON u.label = cs.label
JOIN (SELECT label, count(*) AS training_documents FROM train GROUP BY label) d ON d.label = cs.label"""

_PREDS = f"""
pp AS ({_ppl(_KN, 'doc_id, label')}),
preds AS (
  SELECT p.doc_id, t.label AS truth, p.pred FROM (
    SELECT doc_id, arg_min(label, (perplexity, label)) AS pred FROM pp GROUP BY doc_id) p
  JOIN test t ON t.doc_id = p.doc_id)"""


def metrics_ctes(preds: str = "preds") -> str:
    return f"""
cls AS (SELECT truth AS c FROM {preds} UNION SELECT pred FROM {preds}),
pc AS (
  SELECT c,
    (SELECT count(*) FROM {preds} WHERE truth = c AND pred = c) AS tp,
    (SELECT count(*) FROM {preds} WHERE pred = c) AS npred,
    (SELECT count(*) FROM {preds} WHERE truth = c) AS support
  FROM cls),
pr AS (
  SELECT c, support, CASE WHEN npred > 0 THEN tp / npred ELSE 0.0 END AS precision,
    CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM pc),
rep AS (
  SELECT c AS label, precision, recall,
    CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1,
    CAST(support AS BIGINT) AS support FROM pr)"""


def metrics_select(preds: str = "preds") -> str:
    return f"""
SELECT metric, round(value, 6) AS value FROM (
  SELECT 'accuracy' AS metric, (SELECT avg(CASE WHEN truth = pred THEN 1.0 ELSE 0.0 END) FROM {preds}) AS value
  UNION ALL SELECT 'precision', sum(precision * support) / sum(support) FROM rep
  UNION ALL SELECT 'recall', sum(recall * support) / sum(support) FROM rep
  UNION ALL SELECT 'f1_score', sum(f1 * support) / sum(support) FROM rep)"""


REPORT_SELECT = """
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM (
  SELECT * FROM rep
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM rep
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM rep)"""

SQL["G9_lm_predictions"] = with_base(_MODEL, _scored(), _PREDS) + "SELECT doc_id, truth, pred FROM preds"
SQL["G10_lm_evaluation"] = with_base(_MODEL, _scored(), _PREDS, metrics_ctes()) + metrics_select()
SQL["G10_lm_class_report"] = with_base(_MODEL, _scored(), _PREDS, metrics_ctes()) + REPORT_SELECT

_ANALYSIS = _LM_SPLIT + "," + ",".join(_grams("train", n, "label", f"a{n}") for n in (1, 2, 3)) + """,
an AS (
  SELECT label, 1 AS n, ngram, count(*) AS cnt FROM a1 GROUP BY ALL HAVING count(*) >= 2
  UNION ALL SELECT label, 2, ngram, count(*) FROM a2 GROUP BY ALL HAVING count(*) >= 2
  UNION ALL SELECT label, 3, ngram, count(*) FROM a3 GROUP BY ALL HAVING count(*) >= 2)"""

SQL["G11_ngram_analysis"] = with_base(_ANALYSIS) + "SELECT label, CAST(n AS BIGINT) AS n, ngram, cnt FROM an"

SQL["G12_top_ngrams_per_class"] = with_base(_ANALYSIS) + """
SELECT label, CAST(n AS BIGINT) AS n, rank, ngram, cnt FROM (
  SELECT *, row_number() OVER (PARTITION BY label, n ORDER BY cnt DESC, ngram) AS rank FROM an) WHERE rank <= 20"""

SQL["G8_lm_top5_ngrams"] = SQL["G7_top_ngrams"].replace("WHERE rank <= 20", "WHERE rank <= 5")
