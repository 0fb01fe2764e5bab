"""Registered n-gram language-model queries (G1-G12) and their metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from veracorp.operators import corpus as C
from veracorp.operators import metrics as ME
from veracorp.operators import ngram as NG
from veracorp.operators.lake import path_exists
from veracorp.plans.base import combined, round6
from veracorp.plans.queries import lm_split
from veracorp.session import cut_lineage, shared_dir, source_key

REGISTRY = {}


def query(name):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def _L(c):
    return (F.col(c) if isinstance(c, str) else c).cast("long")


def _split(spark, sf):
    s = cut_lineage(lm_split(spark, sf, C.lm_eval_rows))
    return s.where(~F.col("is_test")), s.where(F.col("is_test"))


def _model(spark, sf, n=3):
    train, test = _split(spark, sf)
    return NG.NGramModel(train, n=n), test


def _saved_model(spark, sf, n=3):
    """The scoring form of the model for these tables; fitted and saved where it is not there yet."""
    root = shared_dir(spark, f"lm{n}-" + source_key(spark, sf), unique=False)
    if not path_exists(spark, f"{root}/classes/_SUCCESS"):
        s = lm_split(spark, sf, C.lm_eval_rows).select("doc_id", "text", "label", "is_test")
        s.write.mode("overwrite").parquet(f"{root}/split")
        NG.NGramModel(spark.read.parquet(f"{root}/split").where("NOT is_test"), n=n, materialize=False).save(root)
    return NG.SavedNGramModel(spark, root), spark.read.parquet(f"{root}/split").where("is_test")


@query("G1_extract_ngrams")
def q_g1(spark, sf):
    return NG.extract_ngrams(combined(spark, sf), 2, min_count=2).select("ngram", _L("cnt").alias("cnt"))


@query("G2_lm_ngram_counts")
def q_g2(spark, sf):
    m, _ = _model(spark, sf)
    return m.ngram_counts.select("label", "ngram", _L("c").alias("cnt"))


@query("G3_continuation_counts")
def q_g3(spark, sf):
    m, _ = _model(spark, sf)
    return m.tok_stats.select("label", "tok", _L("U").alias("contexts"), _L("uni").alias("uni"))


@query("G4_laplace_perplexity")
def q_g4(spark, sf):
    m, test = _saved_model(spark, sf)
    return m.perplexity(test, "laplace").select("doc_id", "label", round6("perplexity").alias("perplexity"))


@query("G5_kn_perplexity")
def q_g5(spark, sf):
    m, test = _saved_model(spark, sf)
    return m.perplexity(test, "kneser-ney").select("doc_id", "label", round6("perplexity").alias("perplexity"))


@query("G5_interpolated_kn_perplexity")
def q_g5i(spark, sf):
    m, test = _saved_model(spark, sf)
    # perplexities reach ~1e10 here, so the log is reported (9 places) to stay comparable across engines
    return m.perplexity(test, "interpolated_kn").select(
        "doc_id", "label", F.round(F.log("perplexity"), 9).alias("log_perplexity"))


@query("G6_corpus_perplexity")
def q_g6(spark, sf):
    m, test = _saved_model(spark, sf)
    return m.perplexity(test, "kneser-ney", per_doc=False).select("label", round6("perplexity").alias("perplexity"))


@query("G7_top_ngrams")
def q_g7(spark, sf):
    m, _ = _model(spark, sf)
    return m.top_ngrams(20).select("label", _L("rank").alias("rank"), "ngram", _L("c").alias("cnt"))


@query("G8_lm_class_stats")
def q_g8(spark, sf):
    m, _ = _model(spark, sf)
    return m.class_stats.select("label", _L("V").alias("vocab_size"), _L("N").alias("total_ngrams"),
                                _L("unique_ngrams").alias("unique_ngrams"),
                                _L("training_documents").alias("training_documents"))


def _lm_preds(spark, sf):
    m, test = _saved_model(spark, sf)
    return cut_lineage(m.predict(test)).join(test.select("doc_id", F.col("label").alias("truth")), "doc_id")


@query("G9_lm_predictions")
def q_g9(spark, sf):
    return _lm_preds(spark, sf).select("doc_id", "truth", "pred")


@query("G10_lm_evaluation")
def q_g10(spark, sf):
    return ME.metrics_long(_lm_preds(spark, sf)).select("metric", round6("value").alias("value"))


@query("G10_lm_class_report")
def q_g10r(spark, sf):
    r = ME.with_averages(ME.per_class_report(_lm_preds(spark, sf)))
    return r.select("label", round6("precision").alias("precision"), round6("recall").alias("recall"),
                    round6("f1").alias("f1"), "support")


@query("G11_ngram_analysis")
def q_g11(spark, sf):
    train, _ = _split(spark, sf)
    return NG.analyze_ngrams(train).select("label", _L("n").alias("n"), "ngram", _L("cnt").alias("cnt"))


@query("G12_top_ngrams_per_class")
def q_g12(spark, sf):
    train, _ = _split(spark, sf)
    return NG.compare_ngrams(NG.analyze_ngrams(train)).select(
        "label", _L("n").alias("n"), _L("rank").alias("rank"), "ngram", _L("cnt").alias("cnt"))


@query("G8_lm_top5_ngrams")
def q_g8t(spark, sf):
    """The five most frequent trigrams of each class model (part of the per-class training stats)."""
    m, _ = _model(spark, sf)
    return m.top_ngrams(5).select("label", _L("rank").alias("rank"), "ngram", _L("c").alias("cnt"))
