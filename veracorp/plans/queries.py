"""Registered queries: one per operator id of the blueprint.

Each query takes (spark, sf_dir), reads the driver tables (or data Spark
derives from them) in full and returns a DataFrame whose columns are aliased
exactly like the matching SQL oracle in ``veracorp.plans.oracle``.
Floating outputs are rounded to 6 places, integer outputs are BIGINT.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracorp.functions import lexicon as L
from veracorp.functions import text as T
from veracorp.operators import corpus as C
from veracorp.operators import features as FE
from veracorp.operators import retrieval as R
from veracorp.operators.inference import accepted
from veracorp.operators.lake import path_exists
from veracorp.operators.observed import TooFewRows, write_guarded
from veracorp.plans.base import combined, processed, raw, round6
from veracorp.session import cut_lineage, shared_dir, source_key
from veracorp.sources.tables import table

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def _long(c):
    return (F.col(c) if isinstance(c, str) else c).cast("long")


# --- P: projections, label and date mapping, filters ----------------------------

@query("P1_coalesce_text")
def q_p1(spark, sf):
    conv = table(spark, sf, "conversations")
    return conv.select("conv_id", "turn", T.coalesce_text(["role", "text"]).alias("text"))


@query("P2_label_map")
def q_p2(spark, sf):
    lab = table(spark, sf, "labels")
    return lab.select("doc_id", C.normalize_label(F.col("toxic"), L.LABEL_MAP_BINARY).alias("label"))


@query("P3_year_extract")
def q_p3(spark, sf):
    ev = table(spark, sf, "events")
    # first candidate column with any parseable value wins; else null years
    candidates = ["props", "ts"]
    chosen = None
    for c in candidates:
        parsed = F.try_to_timestamp(F.col(c).cast("string"))
        if ev.where(parsed.isNotNull()).limit(1).count() > 0:
            chosen = parsed
            break
    year = F.year(chosen) if chosen is not None else F.lit(None).cast("int")
    return ev.select("event_id", _long(year).alias("year"))


@query("P5_canonical_filter")
def q_p5(spark, sf):
    return C.canonical_filter(raw(spark, sf)).select("doc_id", "label", F.md5("text").alias("text_md5"))


@query("P6_min_rows_check")
def q_p6(spark, sf):
    c = combined(spark, sf).agg(F.count(F.lit(1)).alias("total_samples"))
    return c.select("total_samples", F.lit(5000).cast("long").alias("min_samples"),
                    (F.col("total_samples") >= 5000).alias("meets_minimum"))


@query("P6_guarded_write")
def q_p6g(spark, sf):
    """The guard in the write: a corpus of enough rows stays, a shorter one fails the job and leaves nothing."""
    docs = cut_lineage(combined(spark, sf).select("doc_id", "label"))
    rows = []
    for least in (1, 10**9):
        path = shared_dir(spark, "guarded") + "/corpus"
        try:
            write_guarded(docs, path, least)
            failed = False
        except TooFewRows:
            failed = True
        rows.append((least, failed, spark.read.parquet(path).count() if path_exists(spark, path) else 0))
    return spark.createDataFrame(rows, "min_samples long, failed boolean, rows_kept long")


# --- D: union, dedup, sampling, balancing ----------------------------------------

@query("D1_union_sources")
def q_d1(spark, sf):
    docs = raw(spark, sf).select(F.lit("documents").alias("source_kind"), "doc_id", "label",
                                 _long(F.length("text")).alias("n_chars"))
    conv = table(spark, sf, "conversations").select(
        F.lit("conversations").alias("source_kind"), (F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"),
        F.lit(None).cast("string").alias("label"), _long(F.length("text")).alias("n_chars"))
    return docs.unionByName(conv)


@query("D2_dedup_keep_first")
def q_d2(spark, sf):
    return combined(spark, sf).select("doc_id", "label", "source_id", "year", F.md5("text").alias("text_md5"))


@query("D2_duplicate_rate")
def q_d2r(spark, sf):
    before = C.canonical_filter(raw(spark, sf))
    return C.duplicate_stats(before).select(
        _long("initial_size").alias("initial_size"), _long("final_size").alias("final_size"),
        round6("duplicate_rate").alias("duplicate_rate"))


@query("D4_balanced_sample")
def q_d4(spark, sf):
    return C.balanced_sample(cut_lineage(combined(spark, sf)), target=300).select("doc_id", "label")


@query("D5_imbalance_check")
def q_d5(spark, sf):
    return C.imbalance_report(combined(spark, sf)).select(
        round6("max_class_share").alias("max_class_share"), "imbalance_detected",
        _long("num_classes").alias("num_classes"))


@query("D6_undersample")
def q_d6(spark, sf):
    return C.undersample(cut_lineage(combined(spark, sf))).select("doc_id", "label")


@query("D7_class_weights")
def q_d7(spark, sf):
    return C.class_weights(combined(spark, sf)).select("label", _long("cnt").alias("cnt"),
                                                       round6("weight").alias("weight"))


@query("D8_hash_sample")
def q_d8(spark, sf):
    return C.hash_sample(combined(spark, sf), 200).select("doc_id", "label")


@query("D9_stratified_split")
def q_d9(spark, sf):
    return C.stratified_split(cut_lineage(combined(spark, sf)), test_size=0.2).select("doc_id", "label", "is_test")


def lm_split(spark, sf, size=C.lm_test_rows):
    df = cut_lineage(combined(spark, sf))     # read by the count, the histogram and the flag pass
    n = df.count()
    return C.stratified_split(df, test_size=None, test_rows=size(n))


@query("D10_lm_split")
def q_d10(spark, sf):
    return lm_split(spark, sf).select("doc_id", "label", "is_test")


@query("D11_first_rows")
def q_d11(spark, sf):
    return C.first_rows(combined(spark, sf), 10).select("doc_id", "label", "source_id")


# --- A: statistics ------------------------------------------------------------------

@query("A1_corpus_breakdown")
def q_a1(spark, sf):
    return C.corpus_breakdown(combined(spark, sf)).select(
        "dimension", "value", _long("cnt").alias("cnt"), round6("avg_text_length").alias("avg_text_length"))


@query("A1_corpus_summary")
def q_a1s(spark, sf):
    before = C.canonical_filter(raw(spark, sf))
    s = C.corpus_summary(before, C.dedup_first(before))
    return s.select(_long("total_samples").alias("total_samples"), _long("num_classes").alias("num_classes"),
                    _long("num_sources").alias("num_sources"), round6("avg_text_length").alias("avg_text_length"),
                    round6("duplicate_rate").alias("duplicate_rate"))


@query("A2_source_scorecards")
def q_a2(spark, sf):
    s = C.source_scorecards(combined(spark, sf))
    ints = ["label_credibility", "recency", "relevance", "class_balance", "language_consistency"]
    return s.select("source_id", _long("sample_count").alias("sample_count"),
                    _long("year_min").alias("year_min"), _long("year_max").alias("year_max"),
                    *[_long(c).alias(c) for c in ints], round6("average_score").alias("average_score"))


@query("A3_reliability_report")
def q_a3(spark, sf):
    r = C.reliability_report(combined(spark, sf))
    return r.select(_long("num_sources").alias("num_sources"), _long("sample_count").alias("sample_count"),
                    round6("overall_reliability_score").alias("overall_reliability_score"),
                    _long("year_min").alias("year_min"), _long("year_max").alias("year_max"))


@query("A4_value_counts")
def q_a4(spark, sf):
    return C.value_counts(combined(spark, sf), "label").select("label", _long("cnt").alias("cnt"))


@query("A5_year_range")
def q_a5(spark, sf):
    return combined(spark, sf).agg(_long(F.min("year")).alias("year_min"), _long(F.max("year")).alias("year_max"))


@query("A6_distinct_counts")
def q_a6(spark, sf):
    return combined(spark, sf).agg(_long(F.count_distinct("source_id")).alias("num_sources"),
                                   _long(F.count_distinct("label")).alias("num_labels"))


# --- T: text operators ----------------------------------------------------------

def _pages_step(spark, sf, fn):
    pg = table(spark, sf, "pages")
    return pg.select("page_id", fn(F.col("html")).alias("out"))


@query("T1_strip_tags")
def q_t1(spark, sf):
    return _pages_step(spark, sf, T.strip_tags)


@query("T2_mask_urls")
def q_t2(spark, sf):
    return _pages_step(spark, sf, T.mask_urls)


@query("T3_mask_emails")
def q_t3(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.mask_emails(F.col("text")).alias("out"))


@query("T4_mask_mentions")
def q_t4(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.mask_mentions(F.col("text")).alias("out"))


@query("T5_unwrap_hashtags")
def q_t5(spark, sf):
    return _pages_step(spark, sf, T.unwrap_hashtags)


@query("T6_squeeze_punctuation")
def q_t6(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.squeeze_punctuation(F.col("text")).alias("out"))


@query("T7_drop_emoji")
def q_t7(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.drop_emoji(F.col("text")).alias("out"))


@query("T8_squash_whitespace")
def q_t8(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.lower(T.squash_whitespace(F.col("text"))).alias("out"))


@query("T9_clean_documents")
def q_t9(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.clean_text(F.col("text")).alias("cleaned_text"))


@query("T9_clean_pages")
def q_t9p(spark, sf):
    return table(spark, sf, "pages").select("page_id", T.clean_text(F.col("html")).alias("cleaned_text"))


@query("T10_cleaning_audit")
def q_t10(spark, sf):
    from veracorp.functions import patterns as P
    s = combined(spark, sf)
    before, after = F.col("text"), T.clean_text(F.col("text"))
    hit = lambda pat: F.sum(F.when(before.rlike(pat), 1).otherwise(0))
    return s.agg(
        _long(F.count(F.lit(1))).alias("sample_size"),
        round6(F.avg(F.length(before))).alias("avg_original_length"),
        round6(F.avg(F.length(after))).alias("avg_cleaned_length"),
        _long(F.sum(F.greatest(F.length(before) - F.length(after), F.lit(0)))).alias("char_reduction_total"),
        _long(hit(P.HTML_TAG)).alias("html_records"),
        _long(hit(P.URL)).alias("url_records"),
        _long(hit(P.MENTION)).alias("mention_records"),
        _long(hit(P.EMOJI_RUN)).alias("emoji_records"),
        _long(hit(P.REPEATED_PUNCT)).alias("repeated_punctuation_records"))


def _token_query(spark, sf, tok_fn):
    p = processed(spark, sf)
    return p.select("doc_id", tok_fn(F.col("cleaned_text")).alias("_t")).select(
        "doc_id", _long(F.size("_t")).alias("n_tokens"), T.join_tokens("_t").alias("tokens"))


@query("T11_regex_tokens")
def q_t11(spark, sf):
    return _token_query(spark, sf, T.regex_tokens)


@query("T14_whitespace_tokens")
def q_t14(spark, sf):
    return _token_query(spark, sf, T.whitespace_tokens)


@query("T16_reference_vocabulary")
def q_t16(spark, sf):
    from veracorp.functions import patterns as P
    p = processed(spark, sf)
    words = p.select(F.explode(F.regexp_extract_all(F.col("cleaned_text"), F.lit(P.ALPHA_WORD), 0)).alias("w"))
    return (words.groupBy(F.lower("w").alias("term")).agg(_long(F.count(F.lit(1))).alias("cnt"))
            .where(F.col("cnt") >= 2))


def _stopword_query(spark, sf, custom):
    p = processed(spark, sf).select("doc_id", T.regex_tokens(F.col("cleaned_text")).alias("_t"))
    return p.select("doc_id", T.join_tokens(T.kept_tokens("_t", custom)).alias("kept"),
                    T.join_tokens(T.removed_tokens("_t", custom)).alias("removed"))


@query("T17_stopwords_default")
def q_t17(spark, sf):
    return _stopword_query(spark, sf, False)


@query("T18_stopwords_domain")
def q_t18(spark, sf):
    return _stopword_query(spark, sf, True)


@query("T24_min_token_length")
def q_t24(spark, sf):
    p = processed(spark, sf).select("doc_id", T.regex_tokens(F.col("cleaned_text")).alias("_t"))
    return p.select("doc_id", T.join_tokens(T.min_length_tokens("_t", 3)).alias("tokens"))


@query("T25_code_switch_markers")
def q_t25(spark, sf):
    p = combined(spark, sf)
    return p.select("doc_id", _long(F.size(T.marker_words(F.col("text"), L.CODE_SWITCH_MARKERS))).alias("n_markers"))


@query("T26_collapse_whitespace")
def q_t26(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", T.squash_whitespace(F.col("text")).alias("text"))


@query("T27_keyword_filter")
def q_t27(spark, sf):
    kws = L.TOPIC_KEYWORDS + ("the", "und", "les")
    return table(spark, sf, "documents").where(T.any_keyword(F.col("text"), kws)).select("doc_id")


# --- F: features ------------------------------------------------------------------

@query("F1_bow_vocabulary")
def q_f1(spark, sf):
    p = processed(spark, sf)
    _, vocab = FE.bow(p, "cleaned_text", 5000, materialize=True)
    return vocab.select("term", _long("total").alias("total"))


@query("F2_top_bow_terms")
def q_f2(spark, sf):
    p = processed(spark, sf)
    tf, _ = FE.bow(p, "cleaned_text", 5000, materialize=True)
    return FE.top_terms_per_class(tf, p, 30).select("label", _long("rank").alias("rank"), "term",
                                                    _long("cnt").alias("cnt"))


def _tfidf_query(variant):
    def q(spark, sf):
        p = cut_lineage(processed(spark, sf))
        w, _ = FE.tfidf(p, "cleaned_text", variant, 5000, materialize=True)
        return w.select("doc_id", "term", round6("weight").alias("weight"))
    return q


REGISTRY["F3_tfidf_standard"] = _tfidf_query("standard")
REGISTRY["F4_tfidf_smooth"] = _tfidf_query("smooth")
REGISTRY["F5_tfidf_sublinear"] = _tfidf_query("sublinear")


def _discriminative_query(variant):
    def q(spark, sf):
        p = cut_lineage(processed(spark, sf))
        w, _ = FE.tfidf(p, "cleaned_text", variant, 5000, materialize=True)
        return FE.discriminative_terms(w, p, 15).select(
            "label", _long("rank").alias("rank"), "term", round6("score").alias("score"))
    return q


REGISTRY["F6_discriminative_standard"] = _discriminative_query("standard")
REGISTRY["F6_discriminative_smooth"] = _discriminative_query("smooth")
REGISTRY["F6_discriminative_sublinear"] = _discriminative_query("sublinear")


@query("F7_cosine_retrieval")
def q_f7(spark, sf):
    p = cut_lineage(processed(spark, sf))
    w, idf = FE.tfidf(p, "cleaned_text", "sublinear", 5000, materialize=True)
    queries = C.first_rows(p, 10).select(F.col("doc_id").alias("query_id"), "cleaned_text")
    qv = FE.query_vectors(queries, idf, "cleaned_text", "sublinear")
    top = cut_lineage(R.ImpactIndex.build(cut_lineage(w)).top_k(qv, 3))
    out = R.filled(top, queries.select("query_id"), p, 3)
    return out.select("query_id", _long("rank").alias("rank"), "doc_id", round6("score").alias("score"))


@query("F15_sparsity")
def q_f15(spark, sf):
    p = cut_lineage(processed(spark, sf))
    n = p.count()
    w, idf = FE.tfidf(p, "cleaned_text", "standard", 5000, n_docs=n)
    v = idf.count()
    return FE.sparsity(w, n, v).select("n_docs", "vocab_size", _long("nnz").alias("nnz"),
                                       round6("sparsity").alias("sparsity"))


def retrieval_bundle(spark, sf) -> str:
    """Folder of the retrieval index over these tables (idf, blocks, terms, documents); built where it is not there yet."""
    root = shared_dir(spark, "retrieval-" + source_key(spark, sf), unique=False)
    if not R.ImpactIndex.saved(spark, root):
        p = cut_lineage(processed(spark, sf))
        w, idf = FE.tfidf(p, "cleaned_text", "sublinear", 5000, materialize=True)
        idf.write.mode("overwrite").parquet(f"{root}/idf")
        p.select("doc_id", F.col("source_id").alias("source"), "label").write.mode("overwrite").parquet(f"{root}/documents")
        R.ImpactIndex.build(cut_lineage(w)).save(root)      # its terms are written last
    return root


@query("V5_retrieve_similar")
def q_v5(spark, sf):
    root = retrieval_bundle(spark, sf)
    docs = spark.read.parquet(f"{root}/documents")
    asked = accepted(table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text"))            # V6
    asked = asked.select("query_id", T.clean_text(F.col("text")).alias("cleaned_text"))
    qv = FE.query_vectors(asked, spark.read.parquet(f"{root}/idf"), "cleaned_text", "sublinear")
    top = cut_lineage(R.ImpactIndex.load(spark, root).top_k(qv, L.TOP_K_DEFAULT))
    top = R.filled(top, asked.select("query_id"), docs, L.TOP_K_DEFAULT)
    return (top.join(docs, "doc_id")
            .select("query_id", _long("rank").alias("rank"), "doc_id", round6("score").alias("similarity_score"), "source", "label"))
