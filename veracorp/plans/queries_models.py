"""Registered Naive Bayes queries (M1-M3, M7, M8, M13) on the 80/20 stratified split."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from veracorp.functions import lexicon as L
from veracorp.functions.text import word_tokens_2plus
from veracorp.operators import corpus as C
from veracorp.operators import features as FE
from veracorp.operators import metrics as ME
from veracorp.operators.naive_bayes import MultinomialNB
from veracorp.plans.base import processed, round6
from veracorp.session import cut_lineage

REGISTRY = {}


def query(name):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def _L(c):
    return (F.col(c) if isinstance(c, str) else c).cast("long")


def nb_setup(spark, sf):
    """Split, train-fitted BoW vocabulary (2+ char tokens, top 5,000), fitted NB, test term occurrences."""
    p = cut_lineage(processed(spark, sf).select("doc_id", "label", "cleaned_text"))
    s = cut_lineage(C.stratified_split(p, test_size=0.2))
    train, test = s.where(~F.col("is_test")), s.where(F.col("is_test"))
    nb = fitted_nb(train)
    return nb, term_occurrences(test), test


def term_occurrences(docs, *carry):
    return docs.select("doc_id", *carry, F.explode(word_tokens_2plus(F.col("cleaned_text"))).alias("term"))


def fitted_nb(train, max_features: int = 5000) -> MultinomialNB:
    """Counts by class and term in one aggregate; the vocabulary is their top by total."""
    counts = cut_lineage(term_occurrences(train, "label").groupBy("label", "term").agg(F.count(F.lit(1)).alias("cnt")))
    vocab = cut_lineage(FE.top_vocabulary(counts.withColumnRenamed("cnt", "tf"), max_features))
    return MultinomialNB(counts, train.select("doc_id", "label"), vocab)


def nb_predictions(spark, sf, alphas=(1.0,)):
    nb, terms, test = nb_setup(spark, sf)
    return cut_lineage(nb.predict(terms, test, alphas)
                       .join(test.select("doc_id", F.col("label").alias("truth"), "cleaned_text"), "doc_id"))


@query("M1_nb_class_counts")
def q_m1(spark, sf):
    nb, _, _ = nb_setup(spark, sf)
    tot = nb.term_counts.groupBy("label").agg(F.sum("cnt").alias("total_terms"))
    return nb.class_docs.join(tot, "label", "left").select(
        "label", _L("n_c").alias("class_docs"), _L(F.coalesce("total_terms", F.lit(0))).alias("total_terms"))


@query("M1_nb_term_counts")
def q_m1t(spark, sf):
    nb, _, _ = nb_setup(spark, sf)
    return nb.term_counts.select("label", "term", _L("cnt").alias("cnt"))


@query("M2_nb_predictions")
def q_m2(spark, sf):
    return nb_predictions(spark, sf).select("doc_id", "truth", "pred", round6("confidence").alias("confidence"))


@query("M2_nb_probabilities")
def q_m2p(spark, sf):
    nb, terms, test = nb_setup(spark, sf)
    return nb.predict_proba(terms, test).select("doc_id", "label", round6("prob").alias("prob"))


@query("M3_nb_alpha_sweep")
def q_m3(spark, sf):
    p = nb_predictions(spark, sf, L.NB_ALPHAS)
    s = ME.summary_metrics(p, keys=["alpha"])
    # best alpha = first maximum of weighted F1 in grid order (a window over the 6-row grid table)
    order = F.array_position(F.array(*[F.lit(float(a)) for a in L.NB_ALPHAS]), F.col("alpha"))
    w = Window.orderBy(F.desc("f1_score"), order)
    return (s.withColumn("is_best", F.row_number().over(w) == 1)
            .select(round6("alpha").alias("alpha"), round6("accuracy").alias("accuracy"),
                    round6("f1_score").alias("f1_score"), "is_best"))


@query("M7_nb_evaluation")
def q_m7(spark, sf):
    return ME.metrics_long(nb_predictions(spark, sf)).select("metric", round6("value").alias("value"))


@query("M7_nb_class_report")
def q_m7r(spark, sf):
    r = ME.with_averages(ME.per_class_report(nb_predictions(spark, sf)))
    return r.select("label", round6("precision").alias("precision"), round6("recall").alias("recall"),
                    round6("f1").alias("f1"), "support")


@query("M7_nb_confusion")
def q_m7c(spark, sf):
    return ME.confusion(nb_predictions(spark, sf)).select("truth", "pred", _L("cnt").alias("cnt"))


def nb_probabilities(spark, sf):
    """Test posteriors with the truth; several branches read them, so they are materialised once."""
    nb, terms, test = nb_setup(spark, sf)
    return cut_lineage(nb.predict_proba(terms, test).join(test.select("doc_id", F.col("label").alias("truth")), "doc_id"))


@query("M8_nb_roc_auc")
def q_m8(spark, sf):
    return ME.ovr_auc(nb_probabilities(spark, sf), "truth", "label", "prob").select(
        "label", round6("auc").alias("auc"), _L("n_thresholds").alias("n_thresholds"))


@query("M8_nb_roc_points")
def q_m8p(spark, sf):
    """ROC curve of each class over scores rounded to 6 places (engines differ in the last bits)."""
    probs = nb_probabilities(spark, sf).withColumn("prob", round6("prob"))
    return ME.roc_points(probs, "truth", "label", "prob").select(
        "label", "threshold", round6("fpr").alias("fpr"), round6("tpr").alias("tpr"))


@query("M13_nb_misclassified")
def q_m13(spark, sf):
    p = nb_predictions(spark, sf).where(F.col("truth") != F.col("pred"))
    return (p.orderBy("doc_id").limit(30)
            .select("doc_id", F.col("truth").alias("true_label"), F.col("pred").alias("predicted_label"),
                    F.concat_ws("_to_", "truth", "pred").alias("error_type"),
                    F.substring("cleaned_text", 1, 300).alias("text")))
