"""DuckDB SQL oracles, one per registered query with a SQL form.

Written independently of the Spark code path: plain SQL over the driver
views, window functions for keep-first / top-k, list functions for tokens.
Regexes come from ``veracorp.functions.patterns`` (engine-neutral dialect);
RE2 has no back-references, so the repeated-punctuation rule is four replaces.
"""

from __future__ import annotations

from veracorp.functions import lexicon as L
from veracorp.functions import patterns as P


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def lst(words) -> str:
    return "[" + ", ".join(lit(w) for w in words) + "]"


def rr(e: str, pat: str, rep: str) -> str:
    return f"regexp_replace({e}, {lit(pat)}, {lit(rep)}, 'g')"


def strip(e: str) -> str:
    return rr(e, P.EDGE_WS, "")


def clean(e: str) -> str:
    c = f"coalesce(CAST({e} AS VARCHAR), '')"
    c = rr(c, P.HTML_TAG, " ")
    c = rr(c, P.URL, P.URL_TOKEN)
    c = rr(c, P.EMAIL, P.EMAIL_TOKEN)
    c = rr(c, P.MENTION, P.MENTION_TOKEN)
    c = rr(c, P.HASHTAG, r" \1 ")
    for m in P.PUNCT_MARKS:
        c = rr(c, "\\" + m + "{2,}", m)
    c = rr(c, P.EMOJI_RUN, " ")
    return f"lower(trim({rr(c, P.WS_RUN, ' ')}))"


def words(e: str) -> str:
    return f"regexp_extract_all(lower({e}), {lit(P.WORD_RUN)})"


def words2(e: str) -> str:
    return f"list_filter({words(e)}, lambda x: length(x) >= 2)"


def regex_tokens(e: str) -> str:
    return f"regexp_extract_all({e}, {lit(P.REGEX_TOKEN)})"


def ws_tokens(e: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({e}), {lit(P.WS_RUN)}), lambda x: x <> '')"


LABEL = "CASE WHEN l.toxic = 1 THEN 'Fake' WHEN l.quality = 1 THEN 'Real' ELSE 'Satire' END"

BASE = f"""
raw AS (
  SELECT d.doc_id, d.text, {LABEL} AS label, d.source AS source_id,
         CAST(2016 + d.doc_id % 9 AS INTEGER) AS year, d.doc_id AS row_ord
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
canon AS (
  SELECT doc_id, {strip("coalesce(text, '')")} AS text, label, source_id, year, row_ord FROM raw),
canon_f AS (
  SELECT * FROM canon WHERE label IN ('Real', 'Fake', 'Satire') AND length(text) > 0),
combined AS (
  SELECT doc_id, text, label, source_id, year, row_ord FROM (
    SELECT *, row_number() OVER (PARTITION BY text ORDER BY row_ord) AS rn FROM canon_f) WHERE rn = 1),
processed AS (
  SELECT *, {clean("text")} AS cleaned_text FROM combined)"""


def with_base(*ctes: str) -> str:
    extra = "".join(",\n" + c for c in ctes)
    return "WITH " + BASE.strip() + extra + "\n"


def hkey(e: str = "doc_id", seed: int = 42) -> str:
    return f"md5('{seed}|' || CAST({e} AS VARCHAR))"


SQL: dict[str, str] = {}

# --- P ---------------------------------------------------------------------------

SQL["P1_coalesce_text"] = f"""
SELECT conv_id, turn,
  trim({rr("concat_ws(' ', coalesce(CAST(role AS VARCHAR), ''), coalesce(CAST(text AS VARCHAR), ''))", P.WS_RUN, ' ')}) AS text
FROM conversations"""

SQL["P2_label_map"] = """
SELECT doc_id, CASE lower(CAST(toxic AS VARCHAR)) WHEN '0' THEN 'Real' WHEN '1' THEN 'Fake'
  WHEN 'real' THEN 'Real' WHEN 'fake' THEN 'Fake' WHEN 'true' THEN 'Real' WHEN 'false' THEN 'Fake' END AS label
FROM labels"""

SQL["P3_year_extract"] = """
SELECT event_id, CAST(year(ts) AS BIGINT) AS year FROM events"""

SQL["P5_canonical_filter"] = with_base() + "SELECT doc_id, label, md5(text) AS text_md5 FROM canon_f"

SQL["P6_guarded_write"] = with_base() + """
SELECT m AS min_samples, n < m AS failed, CASE WHEN n < m THEN 0 ELSE n END AS rows_kept
FROM (SELECT count(*) AS n FROM combined), (SELECT unnest([1, 1000000000]::BIGINT[]) AS m)"""

SQL["P6_min_rows_check"] = with_base() + """
SELECT count(*) AS total_samples, CAST(5000 AS BIGINT) AS min_samples, count(*) >= 5000 AS meets_minimum
FROM combined"""

# --- D ---------------------------------------------------------------------------

SQL["D1_union_sources"] = with_base() + """
SELECT 'documents' AS source_kind, doc_id, label, CAST(length(text) AS BIGINT) AS n_chars FROM raw
UNION ALL
SELECT 'conversations', conv_id * 1000 + turn, CAST(NULL AS VARCHAR), CAST(length(text) AS BIGINT) FROM conversations"""

SQL["D2_dedup_keep_first"] = with_base() + \
    "SELECT doc_id, label, source_id, year, md5(text) AS text_md5 FROM combined"

SQL["D2_duplicate_rate"] = with_base() + """
SELECT a.n AS initial_size, b.n AS final_size,
  round(CASE WHEN a.n > 0 THEN (a.n - b.n) / a.n * 100.0 ELSE 0.0 END, 6) AS duplicate_rate
FROM (SELECT count(*) AS n FROM canon_f) a, (SELECT count(*) AS n FROM combined) b"""

_COUNTS = "counts AS (SELECT label, count(*) AS cnt FROM combined GROUP BY label)"

SQL["D4_balanced_sample"] = with_base(_COUNTS, """
quota AS (
  SELECT label, cnt, least(300 // k + CASE WHEN idx < 300 % k THEN 1 ELSE 0 END, cnt) AS quota FROM (
    SELECT label, cnt, count(*) OVER () AS k, row_number() OVER (ORDER BY cnt DESC, label) - 1 AS idx FROM counts))""",
                                      f"""
ranked AS (
  SELECT c.doc_id, c.label, row_number() OVER (PARTITION BY c.label ORDER BY {hkey('c.doc_id')}) AS rn
  FROM combined c)""") + """
SELECT r.doc_id, r.label FROM ranked r JOIN quota q ON r.label = q.label
WHERE r.rn <= q.quota OR (SELECT count(*) FROM combined) <= 300"""

SQL["D5_imbalance_check"] = with_base(_COUNTS) + """
SELECT round(max(cnt) / sum(cnt), 6) AS max_class_share, max(cnt) / sum(cnt) > 0.40 AS imbalance_detected,
  count(*) AS num_classes FROM counts"""

SQL["D6_undersample"] = with_base(_COUNTS, f"""
ranked AS (
  SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY {hkey()}) AS rn FROM combined)""") + """
SELECT doc_id, label FROM ranked WHERE rn <= (SELECT min(cnt) FROM counts)"""

SQL["D7_class_weights"] = with_base(_COUNTS) + """
SELECT label, cnt, round(CASE WHEN (SELECT max(cnt) / sum(cnt) FROM counts) > 0.40
  THEN (SELECT sum(cnt) FROM counts) / ((SELECT count(*) FROM counts) * cnt) ELSE 1.0 END, 6) AS weight
FROM counts"""

SQL["D8_hash_sample"] = with_base() + f"SELECT doc_id, label FROM combined ORDER BY {hkey()} LIMIT 200"


def _split_sql(total: str) -> str:
    return with_base(_COUNTS, f"""
q AS (
  SELECT label, cnt, floor(t * cnt / n) AS base, t * cnt / n - floor(t * cnt / n) AS frac, t, n FROM (
    SELECT label, cnt, sum(cnt) OVER () AS n, {total} AS t FROM counts)),
q2 AS (
  SELECT label, base + CASE WHEN row_number() OVER (ORDER BY frac DESC, label) <= t - sum(base) OVER () THEN 1 ELSE 0 END
    AS quota FROM q)""", f"""
ranked AS (
  SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY {hkey()}) AS rn FROM combined)""") + """
SELECT r.doc_id, r.label, r.rn <= q2.quota AS is_test FROM ranked r JOIN q2 ON r.label = q2.label"""


SQL["D9_stratified_split"] = _split_sql("ceil(0.2 * sum(cnt) OVER ())")
SQL["D10_lm_split"] = _split_sql("least(100, greatest(60, floor(sum(cnt) OVER () * 0.1)))")

SQL["D11_first_rows"] = with_base() + "SELECT doc_id, label, source_id FROM combined ORDER BY doc_id LIMIT 10"

# --- A ---------------------------------------------------------------------------

SQL["A1_corpus_breakdown"] = with_base() + """
SELECT CASE WHEN grouping(label) = 0 THEN 'label' ELSE 'source_id' END AS dimension,
  coalesce(label, source_id) AS value, count(*) AS cnt, round(avg(length(text)), 6) AS avg_text_length
FROM combined GROUP BY GROUPING SETS ((label), (source_id))"""

SQL["A1_corpus_summary"] = with_base() + """
SELECT count(*) AS total_samples, count(DISTINCT label) AS num_classes, count(DISTINCT source_id) AS num_sources,
  round(avg(length(text)), 6) AS avg_text_length,
  round(CASE WHEN (SELECT count(*) FROM canon_f) > 0 THEN
    ((SELECT count(*) FROM canon_f) - count(*)) / (SELECT count(*) FROM canon_f) * 100.0 ELSE 0.0 END, 6) AS duplicate_rate
FROM combined"""

_CARDS = """
cls AS (SELECT source_id, label, count(*) AS cnt FROM combined GROUP BY ALL),
bal AS (SELECT source_id, max(cnt) AS mx, min(cnt) AS mn, count(*) AS k FROM cls GROUP BY source_id),
st AS (SELECT source_id, count(*) AS sample_count, avg(year) AS avg_year, min(year) AS year_min, max(year) AS year_max,
         avg(length(text)) AS len_mean, stddev_pop(length(text)) AS len_std FROM combined GROUP BY source_id),
cards AS (
  SELECT st.source_id, sample_count, year_min, year_max,
    CASE WHEN contains(lower(st.source_id), 'liar') THEN 5 WHEN contains(lower(st.source_id), 'isot') THEN 4
         WHEN contains(lower(st.source_id), 'covid') THEN 4 ELSE 3 END AS label_credibility,
    CASE WHEN avg_year IS NULL THEN 2 WHEN avg_year >= 2023 THEN 5 WHEN avg_year >= 2021 THEN 4
         WHEN avg_year >= 2019 THEN 3 ELSE 2 END AS recency,
    CASE WHEN contains(lower(st.source_id), 'pakistan') OR contains(lower(st.source_id), 'dawn')
           OR contains(lower(st.source_id), 'geo') OR contains(lower(st.source_id), 'ary') THEN 5
         WHEN contains(lower(st.source_id), 'covid') THEN 3 ELSE 2 END AS relevance,
    CASE WHEN k <= 1 THEN 1 WHEN mx / mn <= 1.25 THEN 5 WHEN mx / mn <= 1.75 THEN 4 WHEN mx / mn <= 2.5 THEN 3
         WHEN mx / mn <= 4.0 THEN 2 ELSE 1 END AS class_balance,
    CASE WHEN len_mean = 0 THEN 1 WHEN len_std / len_mean < 0.45 THEN 5 WHEN len_std / len_mean < 0.8 THEN 4
         WHEN len_std / len_mean < 1.2 THEN 3 WHEN len_std / len_mean < 1.6 THEN 2 ELSE 1 END AS language_consistency
  FROM st JOIN bal ON st.source_id = bal.source_id)"""

SQL["A2_source_scorecards"] = with_base(_CARDS) + """
SELECT source_id, sample_count, CAST(year_min AS BIGINT) AS year_min, CAST(year_max AS BIGINT) AS year_max,
  CAST(label_credibility AS BIGINT) AS label_credibility, CAST(recency AS BIGINT) AS recency,
  CAST(relevance AS BIGINT) AS relevance, CAST(class_balance AS BIGINT) AS class_balance,
  CAST(language_consistency AS BIGINT) AS language_consistency,
  round((label_credibility + recency + relevance + class_balance + language_consistency) / 5.0, 6) AS average_score
FROM cards"""

SQL["A3_reliability_report"] = with_base(_CARDS) + """
SELECT count(*) AS num_sources, CAST(sum(sample_count) AS BIGINT) AS sample_count,
  round(avg((label_credibility + recency + relevance + class_balance + language_consistency) / 5.0), 6)
    AS overall_reliability_score,
  CAST(min(year_min) AS BIGINT) AS year_min, CAST(max(year_max) AS BIGINT) AS year_max
FROM cards"""

SQL["A4_value_counts"] = with_base() + "SELECT label, count(*) AS cnt FROM combined GROUP BY label"

SQL["A5_year_range"] = with_base() + \
    "SELECT CAST(min(year) AS BIGINT) AS year_min, CAST(max(year) AS BIGINT) AS year_max FROM combined"

SQL["A6_distinct_counts"] = with_base() + \
    "SELECT count(DISTINCT source_id) AS num_sources, count(DISTINCT label) AS num_labels FROM combined"

# --- T ---------------------------------------------------------------------------

SQL["T1_strip_tags"] = f"SELECT page_id, {rr('html', P.HTML_TAG, ' ')} AS out FROM pages"
SQL["T2_mask_urls"] = f"SELECT page_id, {rr('html', P.URL, P.URL_TOKEN)} AS out FROM pages"
SQL["T3_mask_emails"] = f"SELECT doc_id, {rr('text', P.EMAIL, P.EMAIL_TOKEN)} AS out FROM documents"
SQL["T4_mask_mentions"] = f"SELECT doc_id, {rr('text', P.MENTION, P.MENTION_TOKEN)} AS out FROM documents"
SQL["T5_unwrap_hashtags"] = f"SELECT page_id, {rr('html', P.HASHTAG, r' \\1 ')} AS out FROM pages"
_t6 = "text"
for _m in P.PUNCT_MARKS:
    _t6 = rr(_t6, "\\" + _m + "{2,}", _m)
SQL["T6_squeeze_punctuation"] = f"SELECT doc_id, {_t6} AS out FROM documents"
SQL["T7_drop_emoji"] = f"SELECT doc_id, {rr('text', P.EMOJI_RUN, ' ')} AS out FROM documents"
SQL["T8_squash_whitespace"] = f"SELECT doc_id, lower(trim({rr('text', P.WS_RUN, ' ')})) AS out FROM documents"
SQL["T9_clean_documents"] = f"SELECT doc_id, {clean('text')} AS cleaned_text FROM documents"
SQL["T9_clean_pages"] = f"SELECT page_id, {clean('html')} AS cleaned_text FROM pages"


def _hits(pat: str) -> str:
    return f"CAST(sum(CASE WHEN regexp_matches(text, {lit(pat)}) THEN 1 ELSE 0 END) AS BIGINT)"


_rep_any = " OR ".join(f"regexp_matches(text, {lit(chr(92) + m + '{2,}')})" for m in P.PUNCT_MARKS)
SQL["T10_cleaning_audit"] = with_base(f"""
s AS (SELECT text, {clean('text')} AS after FROM combined)""") + f"""
SELECT count(*) AS sample_size, round(avg(length(text)), 6) AS avg_original_length,
  round(avg(length(after)), 6) AS avg_cleaned_length,
  CAST(sum(greatest(length(text) - length(after), 0)) AS BIGINT) AS char_reduction_total,
  {_hits(P.HTML_TAG)} AS html_records, {_hits(P.URL)} AS url_records, {_hits(P.MENTION)} AS mention_records,
  {_hits(P.EMOJI_RUN)} AS emoji_records,
  CAST(sum(CASE WHEN {_rep_any} THEN 1 ELSE 0 END) AS BIGINT) AS repeated_punctuation_records
FROM s"""


def _tok_sql(tok: str) -> str:
    return with_base() + f"""
SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, array_to_string(t, ' ') AS tokens
FROM (SELECT doc_id, {tok} AS t FROM processed)"""


SQL["T11_regex_tokens"] = _tok_sql(regex_tokens("cleaned_text"))
SQL["T14_whitespace_tokens"] = _tok_sql(ws_tokens("cleaned_text"))

SQL["T16_reference_vocabulary"] = with_base() + f"""
SELECT lower(w) AS term, count(*) AS cnt
FROM (SELECT unnest(regexp_extract_all(cleaned_text, {lit(P.ALPHA_WORD)})) AS w FROM processed)
GROUP BY lower(w) HAVING count(*) >= 2"""


def _stop_sql(words) -> str:
    s = lst(words)
    return with_base() + f"""
SELECT doc_id, array_to_string(list_filter(t, lambda x: NOT list_contains({s}, lower(x))), ' ') AS kept,
  array_to_string(list_filter(t, lambda x: list_contains({s}, lower(x))), ' ') AS removed
FROM (SELECT doc_id, {regex_tokens('cleaned_text')} AS t FROM processed)"""


SQL["T17_stopwords_default"] = _stop_sql(L.DEFAULT_STOPWORDS)
SQL["T18_stopwords_domain"] = _stop_sql(L.DOMAIN_STOPWORDS)

SQL["T24_min_token_length"] = with_base() + f"""
SELECT doc_id, array_to_string(list_filter({regex_tokens('cleaned_text')}, lambda x: length(x) >= 3), ' ') AS tokens
FROM processed"""

SQL["T25_code_switch_markers"] = with_base() + f"""
SELECT doc_id, CAST(len(list_filter(regexp_extract_all(lower(text), {lit(P.LOWER_ASCII_WORD)}),
  lambda x: list_contains({lst(L.CODE_SWITCH_MARKERS)}, x))) AS BIGINT) AS n_markers
FROM combined"""

SQL["T26_collapse_whitespace"] = f"SELECT conv_id, turn, trim({rr('text', P.WS_RUN, ' ')}) AS text FROM conversations"

_kws = L.TOPIC_KEYWORDS + ("the", "und", "les")
SQL["T27_keyword_filter"] = "SELECT doc_id FROM documents WHERE " + " OR ".join(
    f"contains(lower(text), {lit(k)})" for k in _kws)

# --- F ---------------------------------------------------------------------------

_TF1 = f"""
tf AS (SELECT doc_id, term, count(*) AS tf FROM (
  SELECT doc_id, unnest({words('cleaned_text')}) AS term FROM processed) GROUP BY doc_id, term),
vocab AS (SELECT term, sum(tf) AS total FROM tf GROUP BY term ORDER BY total DESC, term LIMIT 5000)"""

SQL["F1_bow_vocabulary"] = with_base(_TF1) + "SELECT term, CAST(total AS BIGINT) AS total FROM vocab"

SQL["F2_top_bow_terms"] = with_base(_TF1, """
sums AS (SELECT p.label, t.term, CAST(sum(t.tf) AS BIGINT) AS cnt
         FROM tf t JOIN vocab v ON t.term = v.term JOIN processed p ON t.doc_id = p.doc_id GROUP BY p.label, t.term)""") + """
SELECT label, rank, term, cnt FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY cnt DESC, term) AS rank FROM sums) WHERE rank <= 30"""


def _tfidf_ctes(variant: str, src: str = "processed") -> str:
    idf = ("ln(n / df) + 1.0" if variant == "standard" else "ln((1.0 + n) / (1.0 + df)) + 1.0")
    tfv = "(ln(tf) + 1.0)" if variant == "sublinear" else "tf"
    return f"""
tf2 AS (SELECT doc_id, term, count(*) AS tf FROM (
  SELECT doc_id, unnest({words2('cleaned_text')}) AS term FROM {src}) GROUP BY doc_id, term),
vocab2 AS (SELECT term, sum(tf) AS total FROM tf2 GROUP BY term ORDER BY total DESC, term LIMIT 5000),
idf AS (SELECT t.term, {idf} AS idf FROM (
  SELECT term, CAST(count(*) AS DOUBLE) AS df FROM tf2 WHERE term IN (SELECT term FROM vocab2) GROUP BY term) t,
  (SELECT CAST(count(*) AS DOUBLE) AS n FROM {src}) c),
w0 AS (SELECT t.doc_id, t.term, {tfv} * i.idf AS w FROM tf2 t JOIN idf i ON t.term = i.term),
wts AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM w0)"""


for _v, _name in (("standard", "F3_tfidf_standard"), ("smooth", "F4_tfidf_smooth"),
                  ("sublinear", "F5_tfidf_sublinear")):
    SQL[_name] = with_base(_tfidf_ctes(_v)) + "SELECT doc_id, term, round(weight, 6) AS weight FROM wts"
    SQL["F6_discriminative_" + _v] = with_base(_tfidf_ctes(_v), """
cc AS (SELECT label, count(*) AS n_c FROM processed GROUP BY label),
tot AS (SELECT term, sum(weight) AS tot FROM wts GROUP BY term),
per AS (SELECT p.label, w.term, sum(w.weight) AS s FROM wts w JOIN processed p ON w.doc_id = p.doc_id GROUP BY ALL),
sc AS (
  SELECT cc.label, tot.term,
    coalesce(per.s, 0.0) / cc.n_c - CASE WHEN (SELECT sum(n_c) FROM cc) - cc.n_c > 0
      THEN (tot.tot - coalesce(per.s, 0.0)) / ((SELECT sum(n_c) FROM cc) - cc.n_c) ELSE 0.0 END AS score
  FROM tot CROSS JOIN cc LEFT JOIN per ON per.label = cc.label AND per.term = tot.term)""") + """
SELECT label, rank, term, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY round(score, 9) DESC, term) AS rank FROM sc) WHERE rank <= 15"""


def _retrieval_sql(queries_cte: str, k: int, extra_select: str, join_extra: str) -> str:
    return with_base(_tfidf_ctes("sublinear"), queries_cte, f"""
qtf AS (SELECT query_id, term, count(*) AS tf FROM (
  SELECT query_id, unnest({words2('cleaned_text')}) AS term FROM qs) GROUP BY query_id, term),
qw0 AS (SELECT q.query_id, q.term, (ln(q.tf) + 1.0) * i.idf AS w FROM qtf q JOIN idf i ON q.term = i.term),
qw AS (SELECT query_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY query_id)) AS qw FROM qw0),
sc AS (SELECT q.query_id, d.doc_id, sum(q.qw * d.weight) AS score FROM qw q JOIN wts d ON q.term = d.term
       GROUP BY q.query_id, d.doc_id),
lowdocs AS (SELECT doc_id FROM processed ORDER BY doc_id LIMIT {2 * k}),
fill AS (SELECT qs.query_id, l.doc_id, 0.0 AS score FROM qs CROSS JOIN lowdocs l
         WHERE NOT EXISTS (SELECT 1 FROM sc WHERE sc.query_id = qs.query_id AND sc.doc_id = l.doc_id)),
allsc AS (SELECT * FROM sc UNION ALL SELECT * FROM fill),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank
        FROM allsc) WHERE rank <= {k})""") + f"""
SELECT top.query_id, top.rank, top.doc_id, round(top.score, 6) AS {extra_select} FROM top {join_extra}"""


SQL["F7_cosine_retrieval"] = _retrieval_sql(
    "qs AS (SELECT doc_id AS query_id, cleaned_text FROM processed ORDER BY doc_id LIMIT 10)", 3, "score", "")

SQL["F15_sparsity"] = with_base(_tfidf_ctes("standard")) + """
SELECT (SELECT count(*) FROM processed) AS n_docs, (SELECT count(*) FROM idf) AS vocab_size, count(*) AS nnz,
  round(1.0 - count(*) / ((SELECT count(*) FROM processed) * (SELECT count(*) FROM idf)), 6) AS sparsity
FROM wts"""

SQL["V5_retrieve_similar"] = _retrieval_sql(
    f"qs AS (SELECT item_id AS query_id, {clean('text')} AS cleaned_text FROM benchmark WHERE length(text) BETWEEN {L.TEXT_MIN_CHARS} AND {L.TEXT_MAX_CHARS})",
    L.TOP_K_DEFAULT, "similarity_score, p.source_id AS source, p.label",
    "JOIN processed p ON p.doc_id = top.doc_id")
