"""Hand-computed goldens: language models, idf, scorecard, sampling, weights."""

import math

import pytest
from pyspark.sql import functions as F

from veracorp.operators import corpus as C
from veracorp.operators import features as FE
from veracorp.operators.ngram import NGramModel


def test_lm_goldens(spark):
    train = spark.createDataFrame([("L", "a b"), ("L", "a c")], "label string, text string")
    test = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    m = NGramModel(train, n=2)
    kn = m.perplexity(test, "kneser-ney").first()["perplexity"]
    lap = m.perplexity(test, "laplace").first()["perplexity"]
    assert kn == pytest.approx(2.116534735957599, rel=1e-12)
    assert lap == pytest.approx(2.4662120743304703, rel=1e-12)
    st = m.class_stats.first()
    assert (st["V"], st["N"]) == (4, 6)


def test_idf_goldens(spark):
    n = F.lit(3.0)
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "d double")
    std = [r[0] for r in df.select(FE.idf_column(n, F.col("d"), "standard")).collect()]
    smo = [r[0] for r in df.select(FE.idf_column(n, F.col("d"), "smooth")).collect()]
    assert std == pytest.approx([2.0986122887, 1.4054651081, 1.0], abs=1e-9)
    assert smo == pytest.approx([1.6931471806, 1.2876820725, 1.0], abs=1e-9)


def test_scorecard_golden(spark):
    rows = [("LIAR", "Real", 2016, "x" * 10), ("LIAR", "Real", 2016, "x" * 12), ("LIAR", "Real", 2016, "x" * 14),
            ("LIAR", "Fake", 2016, "x" * 40), ("LIAR", "Fake", 2016, "x" * 24)]
    df = spark.createDataFrame(rows, "source_id string, label string, year int, text string")
    r = C.source_scorecards(df).first()
    assert (r["label_credibility"], r["recency"], r["relevance"], r["class_balance"],
            r["language_consistency"]) == (5, 2, 2, 4, 4)
    assert r["average_score"] == pytest.approx(3.4)


def _classes(spark, sizes):
    rows, i = [], 0
    for lab, n in sizes.items():
        for _ in range(n):
            rows.append((i, lab))
            i += 1
    return spark.createDataFrame(rows, "doc_id long, label string")


def _dist(df):
    return {r["label"]: r["count"] for r in df.groupBy("label").count().collect()}


def test_balanced_sample_golden(spark):
    df = _classes(spark, {"Real": 10, "Fake": 6, "Satire": 2})
    assert _dist(C.balanced_sample(df, 10)) == {"Real": 4, "Fake": 3, "Satire": 2}


def test_undersample_golden(spark):
    df = _classes(spark, {"Real": 10, "Fake": 6, "Satire": 2})
    assert _dist(C.undersample(df)) == {"Real": 2, "Fake": 2, "Satire": 2}


def test_class_weights_golden(spark):
    df = _classes(spark, {"Real": 10, "Fake": 6, "Satire": 2})
    w = {r["label"]: r["weight"] for r in C.class_weights(df).collect()}
    assert w == pytest.approx({"Real": 0.6, "Fake": 1.0, "Satire": 3.0})


def test_split_quota_sums(spark):
    df = _classes(spark, {"Real": 301, "Fake": 52, "Satire": 47})
    s = C.stratified_split(df, test_size=0.2)
    assert s.where("is_test").count() == math.ceil(0.2 * 400)
    assert s.count() == 400


def test_dedup_keeps_first(spark):
    rows = [(3, "same"), (1, "same"), (2, "other"), (5, "same")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("source_rank", F.lit(0)) \
        .withColumn("row_ord", F.col("doc_id"))
    got = sorted((r["doc_id"], r["text"]) for r in C.dedup_first(df).collect())
    assert got == [(1, "same"), (2, "other")]


def test_kn_mass_after_context(spark):
    """Mass after context 'a' over the vocabulary: 0.75 as coded, 1.0 interpolated."""
    train = spark.createDataFrame([("L", "a b"), ("L", "a c")], "label string, text string")
    m = NGramModel(train, n=2)
    docs = spark.createDataFrame([(1, "a a"), (2, "a b"), (3, "a c"), (4, "a")], "doc_id long, text string")
    s = m.scored_ngrams(docs).where(F.col("ctx") == "a").dropDuplicates(["ngram"])
    coded = s.agg(F.sum(m.probability("kneser-ney"))).first()[0]
    interp = s.agg(F.sum(m.probability("interpolated_kn"))).first()[0]
    assert coded == pytest.approx(0.75)
    assert interp == pytest.approx(1.0)
    probs = {r["tok"]: r["p"] for r in s.select("tok", m.probability("kneser-ney").alias("p")).collect()}
    assert probs == pytest.approx({"a": 0.125, "b": 0.1875, "c": 0.1875, "<END>": 0.25})
