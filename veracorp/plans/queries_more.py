"""Registered queries: tokeniser comparison, stopword impact, normalisers,
ablation / run tracking (T12, T15, T19-T23, E1-E7) and z-scoring (M15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from veracorp.functions import lexicon as L
from veracorp.functions import text as T
from veracorp.operators import experiments as EX
from veracorp.operators import keywords as KW
from veracorp.operators import linear as LN
from veracorp.operators import normalize as NZ
from veracorp.operators import sentences as SE
from veracorp.operators import tokenizers as TK
from veracorp.operators.lake import path_exists
from veracorp.plans.base import processed, round6
from veracorp.session import cut_lineage, drop_folder, shared_dir, source_key, staged
from veracorp.sources.tables import table

REGISTRY = {}


def query(name):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def _L(c):
    return (F.col(c) if isinstance(c, str) else c).cast("long")


@query("T12_treebank_tokens")
def q_t12(spark, sf):
    p = processed(spark, sf).select("doc_id", T.treebank_tokens(F.col("cleaned_text")).alias("_t"))
    return p.select("doc_id", _L(F.size("_t")).alias("n_tokens"), T.join_tokens("_t").alias("tokens"))


@query("T12_abbreviations")
def q_t12a(spark, sf):
    a = SE.abbreviation_scores(table(spark, sf, "documents"))
    return a.select("type", "with_period", "without_period", round6("score").alias("score"))


@query("T12_sentence_tokens")
def q_t12s(spark, sf):
    """Sentences and their tokens over the whole documents, with the abbreviations of the same corpus."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    known = SE.abbreviations(docs)
    d = docs.select("doc_id", SE.sentences(F.col("text"), known).alias("s"))
    d = d.select("doc_id", "s", F.flatten(F.transform("s", T.treebank_sentence_tokens)).alias("t"))
    return d.select("doc_id", _L(F.size("s")).alias("n_sentences"), _L(F.size("t")).alias("n_tokens"), F.md5(F.array_join("s", "\n")).alias("sentences_md5"),
                    F.md5(T.join_tokens("t")).alias("tokens_md5"))


@query("T27_keyword_table")
def q_t27t(spark, sf):
    """Documents by the benchmark's words that they hold, as substrings."""
    words = table(spark, sf, "benchmark").select(F.explode(F.split("text", " ")).alias("keyword"))
    m = KW.keyword_matches(table(spark, sf, "documents"), words)
    return m.select("doc_id", _L(F.size("keywords")).alias("n_keywords"), F.md5(F.array_join("keywords", " ")).alias("keywords_md5"))


@query("T15_tokenizer_comparison")
def q_t15(spark, sf):
    p = cut_lineage(processed(spark, sf))
    r = TK.compare_tokenizers(p, p)
    return r.select("tokenizer", round6("avg_tokens_per_doc").alias("avg_tokens_per_doc"),
                    round6("oov_rate").alias("oov_rate"),
                    round6("contraction_handling_rate").alias("contraction_handling_rate"),
                    round6("code_switch_handling_rate").alias("code_switch_handling_rate"),
                    _L("sample_size").alias("sample_size"), "recommended")


@query("T19_stopword_impact")
def q_t19(spark, sf):
    """Removal rates, and the classifiers of both lists fitted and compared on the whole corpus."""
    p = staged(processed(spark, sf).select("doc_id", "label", "cleaned_text"))
    rates = TK.stopword_removal(p)

    def run(item):
        name, custom = item
        prepared = p.select("doc_id", "label", TK.kept_text(T.treebank_tokens(F.col("cleaned_text")), custom).alias("doc_text"))
        cfg = {"name": name, "stopwords": name, "normalization": "none", "min_token_length": 1, "max_features": 3000}
        return name, EX.run_config(p, cfg, ["corpus"], variant="smooth", prepared=prepared)["weighted_f1"]

    f1 = LN.side_by_side(spark, run, (("default", False), ("custom", True)))
    delta = f1[1][1] - f1[0][1]
    f = spark.createDataFrame(f1, "stopword_list string, weighted_f1 double")
    return rates.join(f, "stopword_list").select(
        "stopword_list", round6("token_removal_rate").alias("token_removal_rate"), "unique_removed",
        round6("weighted_f1").alias("weighted_f1"), F.lit(round(delta, 6)).alias("f1_delta_custom_minus_default"))


def _vocab(spark, sf):
    p = processed(spark, sf)
    return p.select(F.explode(T.regex_tokens(F.lower("cleaned_text"))).alias("term")).distinct()


def _norm_query(method):
    def q(spark, sf):
        return NZ.vocabulary_map(_vocab(spark, sf), method).select("term", "norm")
    return q


REGISTRY["T20_porter_stems"] = _norm_query("porter")
REGISTRY["T21_snowball_stems"] = _norm_query("snowball")
REGISTRY["T22_lemmas"] = _norm_query("wordnet")


@query("T23_normalizer_comparison")
def q_t23(spark, sf):
    r = NZ.compare_normalizers(cut_lineage(_vocab(spark, sf)))
    return r.select("method", _L("terms").alias("terms"), _L("normalized_terms").alias("normalized_terms"),
                    _L("over_stemmed").alias("over_stemmed"), round6("vocabulary_reduction").alias("vocabulary_reduction"))


# --- experiments ---------------------------------------------------------------------

def ablation_runs(spark, sf):
    """The six-run ablation; the runs table is a stage table reused by E3-E7."""
    path = shared_dir(spark, "runs-" + source_key(spark, sf), unique=False) + "/runs"
    if path_exists(spark, path + "/_SUCCESS"):
        return spark.read.schema(EX.RUNS_SCHEMA).parquet(path)
    root = shared_dir(spark, "ablation-docs")
    docs = staged(processed(spark, sf).select("doc_id", "label", "source_id", "cleaned_text"), root)
    runs = EX.run_ablation(spark, docs, path)
    drop_folder(spark, root)
    return runs


@query("E1_apply_config_without_normaliser")
def q_e1p(spark, sf):
    return EX.apply_config(processed(spark, sf), L.ABLATION_GRID[1]).select("doc_id", "label", "doc_text")


@query("E1_apply_config")
def q_e1(spark, sf):
    cfg = L.ABLATION_GRID[4]          # custom stopwords, lemma rules, min length 3
    d = EX.apply_config(processed(spark, sf), cfg)
    return d.select("doc_id", "label", "doc_text")


@query("E2_ablation_runs")
def q_e2(spark, sf):
    r = ablation_runs(spark, sf)
    return r.select("run_name", "family", "model_family", round6("weighted_f1").alias("weighted_f1"),
                    round6(F.col("metrics")["accuracy"]).alias("accuracy"))


@query("E3_run_records")
def q_e3(spark, sf):
    r = ablation_runs(spark, sf)
    return r.select("run_id", "run_name", F.explode("metrics").alias("metric", "value")) \
        .select("run_id", "run_name", "metric", round6("value").alias("value"))


@query("E4_parallel_coordinates")
def q_e4(spark, sf):
    return EX.parallel_coordinates(ablation_runs(spark, sf)).withColumn("f1_weighted", round6("f1_weighted"))


@query("E5_best_run")
def q_e5(spark, sf):
    return EX.best_run(ablation_runs(spark, sf)).withColumn("weighted_f1", round6("weighted_f1"))


@query("E6_model_promotion")
def q_e6(spark, sf):
    """Register the runs in grid order as successive Staging versions and apply the promotion rule."""
    runs = {r["run_name"]: (r["run_id"], r["weighted_f1"]) for r in ablation_runs(spark, sf).collect()}  # 6 runs
    versions = spark.createDataFrame([], "version long, run_id string, stage string, f1 double")
    for v, cfg in enumerate(L.ABLATION_GRID, start=1):
        rid, f1 = runs[cfg["name"]]
        versions = versions.unionByName(spark.createDataFrame([(v, rid, "Staging", f1)], versions.schema))
        versions = EX.promote(versions, f1).drop("promoted")
        versions = spark.createDataFrame(versions.collect(), versions.schema)    # <= 6 rows
    return versions.select("version", "run_id", "stage", round6("f1").alias("f1"))


@query("E7_leaderboard")
def q_e7(spark, sf):
    r = EX.leaderboard(ablation_runs(spark, sf))
    return r.select(_L("rank").alias("rank"), "run_id", "run_name", round6("weighted_f1").alias("weighted_f1"))


@query("E7_best_run_metrics")
def q_e7m(spark, sf):
    return EX.best_metrics(ablation_runs(spark, sf)).select("run_name", "metric_name", round6("value").alias("value"))


# --- M15: population-std z-scores -----------------------------------------------------

def standardize(df, cols):
    """(x - mean) / population std per column; zero std divides by 1.  Two scalars per column."""
    st = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    out = []
    for c in cols:
        s = st[f"s_{c}"] or 0.0
        out.append(((F.col(c) - F.lit(st[f"m_{c}"])) / F.lit(s if s != 0 else 1.0)).alias(f"z_{c}"))
    return out


@query("M15_standardize")
def q_m15(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select("event_id", *standardize(ev, ["value"])).select("event_id", round6("z_value").alias("z_value"))


# --- ids covered inside larger queries, registered on their own ----------------------

@query("P4_drop_null_rows")
def q_p4(spark, sf):
    from veracorp.plans.base import raw
    r = raw(spark, sf)
    return r.na.drop(subset=["text", "label"]).select("doc_id", "label")


@query("D3_record_dedup")
def q_d3(spark, sf):
    from veracorp.plans.base import combined
    from veracorp.sources import feeds as FD
    root = shared_dir(spark, "records")
    FD.land_feed(combined(spark, sf), f"{root}/items")
    rec = FD.feed_records(spark, f"{root}/items", limit=None)
    return FD.deduplicate_records(rec).select("source", "ord", F.md5("text").alias("text_md5"))


@query("S14_parquet_sink")
def q_s14(spark, sf):
    from veracorp.sources import files as FS
    root = shared_dir(spark, "parquet-sink")
    p = processed(spark, sf).select("doc_id", "label", "cleaned_text")
    FS.write_table(p, f"{root}/processed.parquet")
    back = FS.read_table(spark, f"{root}/processed.parquet")
    return back.select("doc_id", "label", F.md5("cleaned_text").alias("cleaned_md5"))


@query("M10_polynomial_features")
def q_m10(spark, sf):
    from pyspark.ml.feature import PolynomialExpansion
    from veracorp.plans.queries_ml import _pca, lr_context
    ctx = lr_context(spark, sf)
    tr, _, _ = _pca(ctx)
    tr = cut_lineage(tr)
    out = None
    for d in (1, 2, 3):
        x = PolynomialExpansion(degree=d, inputCol="xy", outputCol="poly").transform(tr)
        from pyspark.ml.functions import vector_to_array
        part = x.select("doc_id", F.lit(d).cast("long").alias("degree"),
                        F.size(vector_to_array("poly")).cast("long").alias("width"))
        out = part if out is None else out.unionByName(part)
    return out


@query("T10_cleaning_samples")
def q_t10s(spark, sf):
    """The audited rows: first 200 characters before / after cleaning and both lengths."""
    from veracorp.plans.base import combined
    s = combined(spark, sf)
    after = T.clean_text(F.col("text"))
    return s.select("doc_id", F.substring("text", 1, 200).alias("before"), F.substring(after, 1, 200).alias("after"),
                    _L(F.length("text")).alias("before_len"), _L(F.length(after)).alias("after_len"))


@query("F1_bow_stats")
def q_f1s(spark, sf):
    """Shape, sparsity and vocabulary size of the bag-of-words matrix (top 5,000 terms)."""
    from veracorp.operators import features as FE
    p = cut_lineage(processed(spark, sf))
    n = p.count()
    tf, vocab = FE.bow(p, "cleaned_text", 5000, materialize=True)
    v = vocab.count()
    return FE.sparsity(tf.withColumnRenamed("tf", "weight"), n, v).select(
        "n_docs", "vocab_size", _L("nnz").alias("nnz"), round6("sparsity").alias("sparsity"))


@query("M10_polynomial_values")
def q_m10v(spark, sf):
    """Degrees 1 to 3 over two measures of every document (logs of its characters and words): the expanded values."""
    from pyspark.ml.feature import PolynomialExpansion
    from pyspark.ml.functions import array_to_vector, vector_to_array
    d = processed(spark, sf).select("doc_id", F.array(F.log1p(F.length("cleaned_text")), F.log1p(F.size(F.split("cleaned_text", " ")))).alias("xy"))
    d = cut_lineage(d.withColumn("xy", array_to_vector("xy")))
    out = None
    for degree in (1, 2, 3):
        x = PolynomialExpansion(degree=degree, inputCol="xy", outputCol="poly").transform(d)
        part = x.select("doc_id", F.lit(degree).cast("long").alias("degree"),
                        F.posexplode(F.sort_array(F.transform(vector_to_array("poly"), lambda v: F.round(v, 6)))).alias("place", "value"))
        out = part if out is None else out.unionByName(part)
    return out.select("doc_id", "degree", _L("place").alias("place"), "value")
