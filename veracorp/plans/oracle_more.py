"""DuckDB oracles for lake, source and miscellaneous queries."""

from __future__ import annotations

from veracorp.plans.oracle import with_base

SQL: dict[str, str] = {}

SQL["L2_fetch_latest"] = with_base() + "SELECT doc_id, label FROM combined"

SQL["L4_raw_profile"] = """
SELECT column_name, null_count, (SELECT count(*) FROM documents) AS row_count FROM (
  SELECT 'doc_id' AS column_name, count(*) - count(doc_id) AS null_count FROM documents
  UNION ALL SELECT 'text', count(*) - count(text) FROM documents
  UNION ALL SELECT 'lang', count(*) - count(lang) FROM documents
  UNION ALL SELECT 'source', count(*) - count(source) FROM documents
  UNION ALL SELECT 'n_chars', count(*) - count(n_chars) FROM documents)"""

SQL["L5_processed_profile"] = """
SELECT count(*) AS row_count, CAST(3 AS BIGINT) AS n_columns,
  CAST(sum((doc_id = 0)::INT) + sum((quality = 0)::INT) + sum((toxic = 0)::INT) AS BIGINT) AS zero_cells,
  round((sum((doc_id = 0)::INT) + sum((quality = 0)::INT) + sum((toxic = 0)::INT)) / (count(*) * 3.0), 6) AS sparsity
FROM labels"""

SQL["L6_embeddings_version"] = """
SELECT count(*) AS vocab_size, CAST(max(len(embedding)) AS BIGINT) AS embedding_dim, count(*) AS stored_rows
FROM embeddings"""

SQL["L7_lineage"] = with_base() + """
SELECT 'processed_training_dataset' AS dataset_name, count(*) AS row_count, CAST(3 AS BIGINT) AS n_columns,
  'clean,tokenize,custom_stopwords' AS preprocessing_steps FROM combined"""

SQL["L8_integrity_report"] = """
WITH a AS (
  SELECT count(*) AS n, (count(*) - count(doc_id)) + (count(*) - count(text)) + (count(*) - count(lang))
    + (count(*) - count(source)) + (count(*) - count(n_chars)) AS nulls FROM documents),
d AS (SELECT count(*) AS distinct_rows FROM (SELECT DISTINCT * FROM documents))
SELECT a.n AS row_count, CAST(a.nulls AS BIGINT) AS null_cells,
  round(CASE WHEN a.n > 0 THEN a.nulls / (a.n * 5.0) ELSE 0.0 END, 6) AS null_ratio,
  a.n - d.distinct_rows AS duplicate_rows, a.nulls / (a.n * 5.0) > 0.1 AS high_null_warning,
  a.n - d.distinct_rows > 0 AS duplicate_warning
FROM a, d"""

# --- sources ---------------------------------------------------------------------

from veracorp.functions import patterns as _P  # noqa: E402
from veracorp.plans.oracle import SQL as _BASE_SQL, rr as _rr  # noqa: E402

_COLL = f"trim({_rr('text', _P.WS_RUN, ' ')})"

SQL["S1_csv_scan"] = with_base() + "SELECT doc_id, md5(text) AS text_md5, label FROM combined"
SQL["S3_parquet_scan"] = with_base() + "SELECT doc_id, label FROM combined"
SQL["S4_json_scan"] = SQL["S1_csv_scan"]
SQL["S2_tsv_scan"] = with_base() + f"""
SELECT label, CAST(2016 AS BIGINT) AS year, md5({_COLL}) AS text_md5 FROM combined WHERE label IN ('Real', 'Fake')"""
SQL["S6_file_name_labels"] = with_base() + f"""
SELECT label, CAST(year AS BIGINT) AS year, md5({_COLL}) AS text_md5 FROM combined WHERE label IN ('Real', 'Fake')"""
SQL["S7_covid_labels"] = with_base() + f"""
SELECT label, CAST(2020 AS BIGINT) AS year, md5({_COLL}) AS text_md5 FROM combined WHERE label IN ('Real', 'Fake')"""
SQL["S8_first_existing_file"] = with_base() + f"""
SELECT label, CAST(year AS BIGINT) AS year, md5({_COLL}) AS text_md5 FROM combined"""
SQL["S9_combined_sources"] = with_base(f"""
src AS (
  SELECT 'LIAR' AS source_id, 0 AS rnk, label, {_COLL} AS t, doc_id FROM combined WHERE label IN ('Real', 'Fake')
  UNION ALL SELECT 'ISOT', 1, label, {_COLL}, doc_id FROM combined WHERE label IN ('Real', 'Fake')
  UNION ALL SELECT 'COVID-19', 2, label, {_COLL}, doc_id FROM combined WHERE label IN ('Real', 'Fake')
  UNION ALL SELECT 'SelfBuilt', 3, label, {_COLL}, doc_id FROM combined)""") + """
SELECT source_id, label, count(*) AS cnt FROM (
  SELECT *, row_number() OVER (PARTITION BY t ORDER BY rnk, doc_id) AS rn FROM src WHERE length(t) > 0) WHERE rn = 1
GROUP BY source_id, label"""
SQL["S15_json_report"] = _BASE_SQL["A3_reliability_report"]

SQL["M15_standardize"] = """
SELECT event_id, round((value - avg(value) OVER ()) / CASE WHEN stddev_pop(value) OVER () = 0 THEN 1.0
  ELSE stddev_pop(value) OVER () END, 6) AS z_value FROM events"""

# --- serving ---------------------------------------------------------------------

from veracorp.functions import lexicon as _L  # noqa: E402
from veracorp.plans.oracle import clean as _clean, lst as _lst  # noqa: E402

_CS = _lst(_L.DOMAIN_STOPWORDS)
SQL["V1_preprocess_clean_split"] = f"""
SELECT request_id,
  array_to_string(list_filter(t, lambda x: NOT list_contains({_CS}, lower(x))), ' ') AS tokens,
  array_to_string(list_filter(t, lambda x: list_contains({_CS}, lower(x))), ' ') AS removed_stopwords
FROM (SELECT item_id AS request_id,
        list_filter(regexp_split_to_array({_clean('text')}, '[{_P.WS_CHARS}]+'), lambda x: x <> '') AS t
      FROM benchmark WHERE length(text) BETWEEN {_L.TEXT_MIN_CHARS} AND {_L.TEXT_MAX_CHARS})"""

SQL["V6_request_validation"] = """
SELECT conv_id * 1000 + turn AS request_id, reason IS NULL AS accepted, reason FROM (
  SELECT conv_id, turn, CASE WHEN text IS NULL THEN 'missing_text' WHEN length(text) < 10 THEN 'text_too_short'
    WHEN length(text) > 10000 THEN 'text_too_long' END AS reason FROM conversations)"""

SQL["V6_batch_validation"] = """
SELECT conv_id AS batch_id, count(*) AS n_texts, count(*) BETWEEN 1 AND 100 AS accepted
FROM conversations GROUP BY conv_id"""

# --- vector arithmetic on the embeddings table ------------------------------------------

_EMB = """
ex AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) AS pos
       FROM embeddings),
cent AS (SELECT label, pos, avg(x) AS x FROM ex GROUP BY label, pos)"""

SQL["F12_label_centroids"] = "WITH " + _EMB.strip() + """
SELECT CAST(label AS BIGINT) AS label, CAST(pos - 1 AS BIGINT) AS pos, round(x, 6) AS value FROM cent"""

SQL["F10_centroid_neighbours"] = "WITH " + _EMB.strip() + """,
dots AS (SELECT c.label AS probe, e.vec_id, sum(e.x * c.x) AS d FROM ex e JOIN cent c ON e.pos = c.pos GROUP BY ALL),
vn AS (SELECT vec_id, sqrt(sum(x * x)) AS n FROM ex GROUP BY vec_id),
cn AS (SELECT label, sqrt(sum(x * x)) AS n FROM cent GROUP BY label),
sim AS (SELECT d.probe, d.vec_id, CASE WHEN vn.n > 0 AND cn.n > 0 THEN d.d / (vn.n * cn.n) END AS similarity
        FROM dots d JOIN vn ON vn.vec_id = d.vec_id JOIN cn ON cn.label = d.probe
        WHERE CAST(d.vec_id AS VARCHAR) <> CAST(d.probe AS VARCHAR))
SELECT CAST(probe AS BIGINT) AS label, rank, vec_id, round(similarity, 6) AS similarity FROM (
  SELECT *, row_number() OVER (PARTITION BY probe ORDER BY similarity DESC NULLS LAST, vec_id) AS rank FROM sim)
WHERE rank <= 5"""

SQL["F10_vector_neighbours"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
s AS (SELECT p.vec_id, q.vec_id AS neighbour, list_cosine_similarity(p.v, q.v) AS s FROM v p JOIN v q ON p.vec_id % 20 = 0 AND p.vec_id <> q.vec_id)
SELECT vec_id, rank, neighbour, round(s, 6) AS similarity FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(s, 9) DESC, neighbour) AS rank FROM s) WHERE rank <= 5"""

SQL["F11_pair_similarity"] = """
WITH ex AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) AS pos
            FROM embeddings),
d AS (SELECT a.vec_id, b.vec_id AS next_id, sum(a.x * b.x) AS d FROM ex a JOIN ex b
      ON b.vec_id = a.vec_id + 1 AND a.pos = b.pos GROUP BY ALL),
n AS (SELECT vec_id, sqrt(sum(x * x)) AS n FROM ex GROUP BY vec_id)
SELECT d.vec_id, d.next_id, round(CASE WHEN n1.n > 0 AND n2.n > 0 THEN d.d / (n1.n * n2.n) END, 6) AS similarity
FROM d JOIN n n1 ON n1.vec_id = d.vec_id JOIN n n2 ON n2.vec_id = d.next_id"""

SQL["P4_drop_null_rows"] = with_base() + "SELECT doc_id, label FROM raw WHERE text IS NOT NULL AND label IS NOT NULL"

SQL["S14_parquet_sink"] = with_base() + "SELECT doc_id, label, md5(cleaned_text) AS cleaned_md5 FROM processed"

from veracorp.plans.oracle import words as _words, words2 as _words2  # noqa: E402

SQL["T10_cleaning_samples"] = with_base(f"""
s AS (SELECT doc_id, text, {_clean('text')} AS after FROM combined)""") + """
SELECT doc_id, substr(text, 1, 200) AS before, substr(after, 1, 200) AS after, CAST(length(text) AS BIGINT) AS before_len,
  CAST(length(after) AS BIGINT) AS after_len FROM s"""

SQL["F1_bow_stats"] = with_base(f"""
tf AS (SELECT doc_id, term, count(*) AS tf FROM (
  SELECT doc_id, unnest({_words('cleaned_text')}) AS term FROM processed) GROUP BY doc_id, term),
vocab AS (SELECT term, sum(tf) AS total FROM tf GROUP BY term ORDER BY total DESC, term LIMIT 5000)""") + """
SELECT (SELECT count(*) FROM processed) AS n_docs, (SELECT count(*) FROM vocab) AS vocab_size, count(*) AS nnz,
  round(1.0 - count(*) / ((SELECT count(*) FROM processed) * (SELECT count(*) FROM vocab)), 6) AS sparsity
FROM tf WHERE term IN (SELECT term FROM vocab)"""

# --- record dedup, feature widths --------------------------------------------------------

from veracorp.plans.oracle_models import _NB  # noqa: E402

_SQ = lambda e: f"trim({_rr(e, _P.WS_RUN, ' ')})"

SQL["D3_record_dedup"] = with_base(f"""
it AS (SELECT source_id AS source, doc_id AS ord, split_part(text, chr(10), 1) AS t1, text FROM combined),
it2 AS (SELECT source, ord, {_SQ('t1')} AS title, {_SQ('substr(text, length(t1) + 2)')} AS descr FROM it),
rec AS (SELECT source, ord, {_SQ(_rr("title || '. ' || descr", '^[. ]+|[. ]+$', ''))} AS t FROM it2
        WHERE length(title) > 0 OR length(descr) > 0),
d AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY ord) AS rn FROM rec WHERE length(t) > 0)""") + """
SELECT source, ord, md5(t) AS text_md5 FROM d WHERE rn = 1"""

SQL["M10_polynomial_features"] = with_base(_NB) + """
SELECT doc_id, CAST(d AS BIGINT) AS degree, CAST(CASE d WHEN 1 THEN 2 WHEN 2 THEN 5 ELSE 9 END AS BIGINT) AS width
FROM train, (SELECT unnest([1, 2, 3]) AS d) g"""

SQL["M10_polynomial_values"] = with_base("""
m AS (SELECT doc_id, ln(1 + length(cleaned_text)) AS x, ln(1 + len(string_split(cleaned_text, ' '))) AS y FROM processed),
v AS (SELECT doc_id, 1 AS degree, [x, y] AS v FROM m
      UNION ALL SELECT doc_id, 2, [x, x * x, y, x * y, y * y] FROM m
      UNION ALL SELECT doc_id, 3, [x, x * x, x * x * x, y, x * y, x * x * y, y * y, x * y * y, y * y * y] FROM m),
s AS (SELECT doc_id, degree, list_sort(list_transform(v, lambda e: round(e, 6))) AS v FROM v)""") + """
SELECT doc_id, CAST(degree AS BIGINT) AS degree, CAST(unnest(generate_series(0, len(v) - 1)) AS BIGINT) AS place, unnest(v) AS value FROM s"""

SQL["F13_concatenated_features"] = with_base(_NB, f"""
vocab4k AS (SELECT term FROM tf_tr GROUP BY term ORDER BY sum(tf) DESC, term LIMIT 4000),
idf4k AS (SELECT term, ln((1.0 + (SELECT count(*) FROM train)) / (1.0 + count(*))) + 1.0 AS idf FROM tf_tr WHERE term IN (SELECT term FROM vocab4k) GROUP BY term),
tf_all AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({_words2('cleaned_text')}) AS term FROM split) GROUP BY ALL),
w4k AS (SELECT doc_id, tf * idf AS w FROM tf_all JOIN idf4k USING (term)),
sums AS (SELECT doc_id, count(*) AS entries, sum(w) / sqrt(sum(w * w)) AS total FROM w4k GROUP BY doc_id)""") + """
SELECT s.doc_id, v.n AS tfidf_dim, CAST(200 AS BIGINT) AS w2v_dim, v.n + 200 AS concat_dim, coalesce(entries, 0) AS tfidf_entries, round(coalesce(total, 0.0), 6) AS tfidf_total
FROM split s LEFT JOIN sums USING (doc_id), (SELECT count(*) AS n FROM vocab4k) v"""

# --- feeds, posts, streams and sinks ------------------------------------------------------

_FEED = f"""
it AS (SELECT source_id AS source, doc_id AS ord, split_part(text, chr(10), 1) AS t1, text FROM combined),
it2 AS (SELECT source, ord, {_SQ('t1')} AS title, {_SQ('substr(text, length(t1) + 2)')} AS descr FROM it),
rec AS (SELECT source, ord, {_SQ(_rr("title || '. ' || descr", '^[. ]+|[. ]+$', ''))} AS text,
          strftime(make_timestamp((1700000000 + ord * 3600) * 1000000), '%a, %d %b %Y %H:%M:%S +0000') AS date,
          'http://' || source || '.example/' || ord AS url,
          CAST(year(make_timestamp((1700000000 + ord * 3600) * 1000000)) AS INTEGER) AS year
        FROM it2 WHERE length(title) > 0 OR length(descr) > 0)"""

SQL["S10_feed_items"] = with_base(_FEED) + """
SELECT source, text, 'Real' AS label, date, url, CAST(year AS BIGINT) AS year
FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY ord) AS rn FROM rec) WHERE rn <= 20"""

SQL["R4_feed_dataset_build"] = with_base(_FEED) + """
SELECT text, 'Real' AS label, source, date, url
FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY ord) AS rn FROM rec WHERE length(text) > 0) WHERE rn = 1"""

# The stream's form of D3: one record per text, the first by order.
SQL["ST3_feed_dedup_stream"] = with_base(_FEED) + """
SELECT source, ord, text, date, url, year
FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY ord) AS rn FROM rec WHERE length(text) > 0) WHERE rn = 1"""


def _posts(key: str, label: str, source: str, method: str, reason: str) -> str:
    return f"""
WITH p AS (SELECT conv_id * 1000 + turn AS id, text, role AS key,
             strftime(make_timestamp((1700000000 + conv_id * 3600 + turn * 60) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS date
           FROM conversations),
cap AS (SELECT greatest(10, 200 // greatest(count(DISTINCT key), 1)) AS c FROM p),
r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY id) AS rn FROM p WHERE length(trim(coalesce(text, ''))) > 0),
top AS (SELECT * FROM r WHERE rn <= (SELECT c FROM cap) ORDER BY key, id LIMIT 200)
SELECT {_SQ('text')} AS text, '{label}' AS label, '{source}' || key AS source, date, 'post/' || id AS url,
  '{method}' AS collection_method, '{reason}' AS label_reason FROM top"""


SQL["S11_search_posts"] = _posts("query", "Fake", "X search: ", "search", "matched a misinformation search query")
SQL["S12_timeline_posts"] = _posts("handle", "Satire", "X:@", "timeline", "posted by a satire account")

SQL["S13_csv_sink_no_overwrite"] = with_base() + "SELECT doc_id, label, md5(text) AS text_md5, true AS refused_overwrite FROM combined"

SQL["L3_list_versions"] = with_base() + """
SELECT 'processed/corpus/data' AS key, CAST(3 AS BIGINT) AS versions, count(*) AS row_count FROM combined
UNION ALL SELECT 'processed/corpus/metadata', 3, 1"""
