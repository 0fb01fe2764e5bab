"""Vectors built in the JVM, and the classifier as a saved ML pipeline."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from veracorp.operators import features as FE
from veracorp.operators import inference as INF
from veracorp.operators import linear as LN
from veracorp.operators import serving as SV
from veracorp.operators.vectors import sparse_parts, sparse_vector
from veracorp.plans.base import processed
from veracorp.plans.queries_ml import lr_context
from veracorp.session import shared_dir


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def no_python(df):
    return not any(node in plan(df) for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "PythonUDF"))


def test_sparse_vectors_are_exact_and_read_back(spark):
    rows = [(1, [0, 3], [0.1, 1 / 3]), (2, [], []), (3, [4], [5e-324]), (4, [1, 2], [-1.7976931348623157e308, 2.0**-1074 * 3])]
    df = spark.createDataFrame(rows, "id int, i array<int>, v array<double>").withColumn("x", sparse_vector(5, F.col("i"), F.col("v")))
    assert no_python(df)
    assert {r.id: r.x for r in df.collect()} == {i: Vectors.sparse(5, ix, vs) for i, ix, vs in rows}
    back = df.select("id", sparse_parts(F.col("x")).alias("p")).select("id", "p.*").collect()
    assert [(r.id, r["size"], r["indices"], r["values"]) for r in back] == [(i, 5, ix, vs) for i, ix, vs in rows]
    unit = Normalizer(inputCol="x", outputCol="u").transform(df).where("id = 1").first().u
    assert unit.norm(2) == pytest.approx(1.0)


def test_document_vectors_hold_the_weights_and_stay_in_the_jvm(spark):
    p = processed(spark, SF_SMALL)
    w, idf = FE.tfidf(p, "cleaned_text", "sublinear", 200)
    index = LN.vocabulary_index(idf)
    none = p.limit(1).select(F.lit(-1).cast("long").alias("doc_id"), "label")
    vectors = LN.to_vectors(w, index, p.select("doc_id", "label").unionByName(none), 200)
    assert no_python(vectors)
    place = {r.term: r.idx for r in index.collect()}
    want = {}
    for r in w.collect():
        want.setdefault(r.doc_id, {})[place[r.term]] = r.weight
    got = {r.doc_id: dict(zip(r.features.indices.tolist(), r.features.values.tolist())) for r in vectors.collect()}
    assert got == {i: want.get(i, {}) for i in got} and set(want) <= set(got) and got[-1] == {}


@pytest.fixture(scope="module")
def fitted(spark):
    ctx = lr_context(spark, SF_SMALL, 300)
    return ctx, LN.fit_ovr(ctx["train"], ctx["classes"], "l2")


def test_loaded_pipeline_gives_the_rows_of_the_fitted_models(spark, fitted):
    ctx, models = fitted
    root = shared_dir(spark, "pipeline-test")
    SV.classifier_pipeline(ctx, models).write().overwrite().save(f"{root}/pipeline")
    loaded = PipelineModel.load(f"{root}/pipeline")
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "zzzz qqqq unseen words"), (-4, "<b>the</b> the THE http://x.y")], "request_id long, text string")
    requests = ctx["test_rows"].select(F.col("doc_id").alias("request_id"), "text").unionByName(odd)
    scored = loaded.transform(requests)
    assert no_python(scored) and "Exchange" not in plan(loaded.transform(spark.read.parquet(f"{SF_SMALL}/documents.parquet")))
    assert scored.columns == ["request_id", "text", "prediction", "confidence", "class_probabilities"]
    got = {r.request_id: r for r in scored.collect()}
    want = {(r.doc_id, r.label): r.prob for r in LN.ovr_probabilities(models, ctx["test"]).collect()}
    best = {r.doc_id: (r.pred, r.confidence) for r in LN.argmax_label(LN.ovr_probabilities(models, ctx["test"])).collect()}
    for i, r in got.items():
        assert sum(r.class_probabilities.values()) == pytest.approx(1) and r.confidence == max(r.class_probabilities.values())
        if i >= 0:
            assert (r.prediction, pytest.approx(r.confidence, abs=1e-9)) == best[i]
            for label, p in r.class_probabilities.items():
                assert p == pytest.approx(want[i, label], abs=1e-9)
    assert got[-1].class_probabilities == got[-2].class_probabilities == got[-3].class_probabilities


def test_pipeline_equals_the_bundle_of_tables(spark, fitted):
    ctx, models = fitted
    requests = ctx["test_rows"].select(F.col("doc_id").alias("request_id"), "text")
    tables = {r.request_id: r for r in INF.Classifier.fitted(ctx, models).classify(requests).collect()}
    pipeline = {r.request_id: r for r in SV.classifier_pipeline(ctx, models).transform(INF.accepted(requests)).collect()}
    assert set(tables) == set(pipeline)
    for i, r in tables.items():
        assert r.prediction == pipeline[i].prediction and r.confidence == pytest.approx(pipeline[i].confidence, abs=1e-9)
