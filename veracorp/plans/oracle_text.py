"""DuckDB oracles for sentence and Treebank tokens, keyword tables and what rests on them."""

from __future__ import annotations

import re

from veracorp.functions import lexicon as L
from veracorp.functions import patterns as P
from veracorp.functions import text as T
from veracorp.operators import sentences as SE
from veracorp.plans.oracle import clean, lit, lst, rr, with_base

SQL: dict[str, str] = {}

_WS = lit(P.WS_RUN)


def _split(e: str) -> str:
    return f"list_filter(regexp_split_to_array({e}, {_WS}), lambda w: w <> '')"


def _by_rules(e: str, rules) -> str:
    c = f"' ' || {e} || ' '"
    for pattern, replacement in rules:
        c = rr(c, pattern, re.sub(r"\$(\d)", r"\\\1", replacement))
    return _split(f"trim({c})")


def treebank(e: str) -> str:
    return _by_rules(e, T.treebank_rules_for_texts())


_CUSTOM = lst(L.DOMAIN_STOPWORDS)


def _kept(tokens: str) -> str:
    return f"list_filter({tokens}, lambda x: NOT list_contains({_CUSTOM}, lower(x)))"


def _removed(tokens: str) -> str:
    return f"list_filter({tokens}, lambda x: list_contains({_CUSTOM}, lower(x)))"


_TB = f"tb AS (SELECT *, {treebank('cleaned_text')} AS t FROM processed)"

SQL["T12_treebank_tokens"] = with_base(_TB) + """
SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, array_to_string(t, ' ') AS tokens FROM tb"""

SQL["R3_process_dataset"] = with_base(_TB) + f"""
SELECT doc_id, label, cleaned_text, CAST(len(t) AS BIGINT) AS n_tokens, CAST(len({_kept('t')}) AS BIGINT) AS n_tokens_no_stopwords FROM tb"""

SQL["ST1_preprocess_stream"] = with_base(_TB) + f"""
SELECT doc_id, array_to_string({_kept('t')}, ' ') AS tokens, array_to_string({_removed('t')}, ' ') AS removed_stopwords FROM tb"""

SQL["V1_preprocess"] = f"""
WITH tb AS (SELECT item_id AS request_id, {treebank(clean('text'))} AS t FROM benchmark
            WHERE length(text) BETWEEN {L.TEXT_MIN_CHARS} AND {L.TEXT_MAX_CHARS})
SELECT request_id, array_to_string({_kept('t')}, ' ') AS tokens, array_to_string({_removed('t')}, ' ') AS removed_stopwords FROM tb"""

# --- T15: three tokenisers over the corpus -----------------------------------------------

_TOKENIZERS = {"treebank": "t", "whitespace": _split("lower(cleaned_text)"), "regex": f"regexp_extract_all(cleaned_text, {lit(P.REGEX_TOKEN)})"}

SQL["T15_tokenizer_comparison"] = with_base(_TB, f"""
vocab AS (SELECT lower(w) AS term FROM (SELECT unnest(regexp_extract_all(cleaned_text, {lit(P.ALPHA_WORD)})) AS w FROM processed) GROUP BY 1 HAVING count(*) >= 2),
tok AS ({' UNION ALL '.join(f"SELECT doc_id, '{n}' AS tokenizer, list_transform({e}, lambda w: lower(w)) AS t, lower(cleaned_text) AS low FROM tb" for n, e in _TOKENIZERS.items())}),
doc AS (SELECT tokenizer, len(t) AS n, regexp_extract_all(low, {lit(P.CONTRACTION_WORD)}) AS contr,
          list_filter(regexp_extract_all(low, {lit(P.LOWER_ASCII_WORD)}), lambda w: list_contains({lst(L.CODE_SWITCH_MARKERS)}, w)) AS marks, t FROM tok),
agg AS (SELECT tokenizer, avg(n) AS a, sum(n) AS total, sum(len(contr)) AS cc, sum(len(list_filter(contr, lambda w: list_contains(t, w)))) AS ck,
          sum(len(marks)) AS mc, sum(len(list_filter(marks, lambda w: list_contains(t, w)))) AS mk, count(*) AS sample_size FROM doc GROUP BY 1),
oov AS (SELECT tokenizer, count(*) AS oov FROM (SELECT tokenizer, unnest(t) AS w FROM tok) WHERE regexp_matches(w, '^\\p{{L}}+$') AND w NOT IN (SELECT term FROM vocab) GROUP BY 1),
r AS (SELECT tokenizer, a AS avg_tokens_per_doc, CASE WHEN total > 0 THEN coalesce(oov, 0) / total ELSE 0.0 END AS oov_rate,
        CASE WHEN cc > 0 THEN ck / cc ELSE 1.0 END AS contraction_handling_rate, CASE WHEN mc > 0 THEN mk / mc ELSE 1.0 END AS code_switch_handling_rate, sample_size
      FROM agg LEFT JOIN oov USING (tokenizer))""") + """
SELECT tokenizer, round(avg_tokens_per_doc, 6) AS avg_tokens_per_doc, round(oov_rate, 6) AS oov_rate,
  round(contraction_handling_rate, 6) AS contraction_handling_rate, round(code_switch_handling_rate, 6) AS code_switch_handling_rate, sample_size,
  row_number() OVER (ORDER BY oov_rate, contraction_handling_rate DESC, code_switch_handling_rate DESC, tokenizer) = 1 AS recommended FROM r"""

# --- T12: abbreviations and sentences over whole documents ---------------------------------

_TOKENS = f"list_filter(regexp_split_to_array(replace(coalesce(text, ''), chr(1), ''), {_WS}), lambda w: w <> '')"
_ABBREVIATIONS = f"""
cand AS (SELECT w FROM (SELECT unnest({_TOKENS}) AS w FROM documents) WHERE regexp_matches(w, {lit(SE.CANDIDATE)})),
typ AS (SELECT lower(regexp_extract(w, {lit(SE.CANDIDATE)}, 1)) AS type, regexp_extract(w, {lit(SE.CANDIDATE)}, 2) <> '' AS dot FROM cand),
cnt AS (SELECT type, count(*) FILTER (dot) AS c1, count(*) FILTER (NOT dot) AS c0 FROM typ GROUP BY type),
tot AS (SELECT greatest(least(sum(c1) / greatest(sum(c0 + c1), 1), 1 - 1e-9), 1e-9) AS p FROM cnt),
abbr AS (SELECT type, c1 AS with_period, c0 AS without_period,
    2 * ((c1 * ln({SE.ABBREVIATION_SHARE}) + c0 * ln(1 - {SE.ABBREVIATION_SHARE})) - (c1 * ln(p) + c0 * ln(1 - p)))
    * exp(-(length(type) - i)) * (i + 1) * pow(length(type) - i, -c0::DOUBLE) AS score
  FROM (SELECT *, length(type) - length(replace(type, '.', '')) AS i FROM cnt WHERE c1 > 0), tot)"""

SQL["T12_abbreviations"] = f"""
WITH {_ABBREVIATIONS.strip()}
SELECT type, with_period, without_period, round(score, 6) AS score FROM abbr"""

SQL["T12_sentence_tokens"] = f"""
WITH {_ABBREVIATIONS.strip()},
known AS (SELECT coalesce(list(type), []) AS k FROM abbr WHERE score >= {SE.ABBREVIATION_SCORE}),
d AS (SELECT doc_id, {_TOKENS} AS t, k FROM documents, known),
m AS (SELECT doc_id, array_to_string(list_transform(t, lambda w, i: CASE
        WHEN NOT regexp_matches(w, {lit(SE.ENDS)}) THEN w
        WHEN regexp_matches(w, {lit(SE.CANDIDATE)}) AND (list_contains(k, lower(regexp_extract(w, {lit(SE.CANDIDATE)}, 1))) OR length(regexp_extract(w, {lit(SE.CANDIDATE)}, 1)) = 1) THEN w
        WHEN regexp_matches(w, {lit(SE.ELLIPSIS)}) AND coalesce(regexp_matches(t[i + 1], {lit(SE.LOWER_NEXT)}), false) THEN w
        ELSE w || chr(1) END), ' ') AS j FROM d),
s AS (SELECT doc_id, list_filter(regexp_split_to_array(j, chr(1) || ' ?'), lambda x: x <> '') AS s FROM m),
tk AS (SELECT doc_id, s, flatten(list_transform(s, lambda x: {_by_rules('x', T.TREEBANK_RULES)})) AS t FROM s)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_sentences, CAST(len(t) AS BIGINT) AS n_tokens, md5(array_to_string(s, chr(10))) AS sentences_md5,
  md5(array_to_string(t, ' ')) AS tokens_md5 FROM tk"""

SQL["T27_keyword_table"] = """
WITH kw AS (SELECT DISTINCT lower(k) AS k FROM (SELECT unnest(string_split(text, ' ')) AS k FROM benchmark) WHERE k <> ''),
m AS (SELECT doc_id, k FROM documents JOIN kw ON contains(lower(text), k))
SELECT doc_id, count(*) AS n_keywords, md5(string_agg(k, ' ' ORDER BY k)) AS keywords_md5 FROM m GROUP BY doc_id"""

# --- R1: statuses and row counts of the stage runs ---------------------------------------------

SQL["R1_stage_runner"] = with_base() + """
SELECT run, stage, CASE WHEN stage = 'models' THEN 'skipped' WHEN run = 1 OR (run = 3 AND stage = 'ngram') THEN 'built' ELSE 'reused' END AS status,
  CASE stage WHEN 'models' THEN 0 WHEN 'storage' THEN 1 WHEN 'ngram' THEN 4 ELSE n END AS rows
FROM (SELECT count(*) AS n FROM combined), (SELECT unnest([1, 2, 3]) AS run), (SELECT unnest(['corpus', 'nlp', 'storage', 'ngram', 'models']) AS stage)"""

SQL["L9_file_verification"] = "SELECT count(*) AS row_count, true AS intact, CAST(0 AS BIGINT) AS files_differing FROM documents"

SQL["E1_apply_config_without_normaliser"] = with_base(f"c AS (SELECT doc_id, label, {treebank(clean('cleaned_text'))} AS t FROM processed)") + f"""
SELECT doc_id, label, array_to_string({_kept('t')}, ' ') AS doc_text FROM c"""
