"""Registered MLlib classifier queries.

Training results depend on the solver, so these have no SQL oracle; tests
check invariants (probabilities sum to one, label domain, AUC range).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from veracorp.operators import corpus as C
from veracorp.operators import features as FE
from veracorp.operators import inference as INF
from veracorp.operators import linear as LN
from veracorp.operators import metrics as ME
from veracorp.operators import retrieval as R
from veracorp.operators import serving as SV
from veracorp.plans.base import processed, round6
from veracorp.session import cut_lineage, shared_dir, source_key

REGISTRY = {}


def query(name):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def _L(c):
    return (F.col(c) if isinstance(c, str) else c).cast("long")


def lr_context(spark, sf, max_features=5000):
    """80/20 split, sublinear TF-IDF fitted on train, sparse vectors for both sides."""
    s = cut_lineage(C.stratified_split(processed(spark, sf), test_size=0.2))
    train, test = s.where(~F.col("is_test")), s.where(F.col("is_test"))
    n_train = train.count()
    # dealt by document once, so that counting and weighing shuffle no postings; tokenised once
    w_train, idf = FE.tfidf(train.repartition("doc_id"), "cleaned_text", "sublinear", max_features, n_docs=n_train, materialize=True)
    idf = cut_lineage(idf)
    w_test, _ = FE.tfidf(test.repartition("doc_id"), "cleaned_text", "sublinear", vocab=idf)
    index = cut_lineage(LN.vocabulary_index(idf))
    size = index.count()
    vtr = cut_lineage(LN.to_vectors(w_train, index, train, size))
    vte = cut_lineage(LN.to_vectors(w_test, index, test, size))
    ltr = w_train.join(F.broadcast(index), "term").select("doc_id", "idx", "weight")        # for ``_pca`` alone
    lte = w_test.join(F.broadcast(index), "term").select("doc_id", "idx", "weight")
    classes = sorted(r["label"] for r in vtr.select("label").distinct().collect())   # label domain
    return {"train": vtr, "test": vte, "index": index, "idf": idf, "classes": classes, "size": size,
            "test_rows": test, "long_train": ltr, "long_test": lte}


def _ovr_eval(ctx, reg, models=None):
    models = LN.fit_ovr(ctx["train"], ctx["classes"], reg) if models is None else models
    probs = cut_lineage(LN.ovr_probabilities(models, ctx["test"]))
    preds = LN.argmax_label(probs).join(ctx["test"].select("doc_id", F.col("label").alias("truth")), "doc_id")
    return models, probs, preds


REGULARIZATIONS = ("l1", "l2", "elasticnet")


def _lr_comparison(spark, sf, ctx=None):
    """l1 / l2 / elastic-net metrics as a stage table, reused by M14 and M16, and the models, where they were fitted for it."""
    from veracorp.operators.lake import path_exists
    path = shared_dir(spark, "lrcmp-" + source_key(spark, sf), unique=False) + "/metrics"
    models = {}
    if not path_exists(spark, path + "/_SUCCESS"):
        metrics, models = _m4_compute(ctx if ctx is not None else lr_context(spark, sf))
        metrics.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path), models


@query("M4_lr_regularization_comparison")
def q_m4(spark, sf):
    return _lr_comparison(spark, sf)[0]


def _m4_compute(ctx):
    models = LN.fit_ovr_each(ctx["train"], ctx["classes"], REGULARIZATIONS)
    out = None
    for reg in REGULARIZATIONS:
        _, _, preds = _ovr_eval(ctx, reg, models[reg])
        s = ME.summary_metrics(preds).withColumn("regularization", F.lit(reg))
        out = s if out is None else out.unionByName(s)
    return out.select("regularization", round6("accuracy").alias("accuracy"), round6("precision").alias("precision"),
                      round6("recall").alias("recall"), round6("f1_score").alias("f1_score")), models


@query("M5_lr_predictions")
def q_m5(spark, sf):
    ctx = lr_context(spark, sf)
    _, _, preds = _ovr_eval(ctx, "l2")
    return preds.select("doc_id", "truth", "pred", round6("confidence").alias("confidence"))


@query("M5_lr_probabilities")
def q_m5p(spark, sf):
    ctx = lr_context(spark, sf)
    _, probs, _ = _ovr_eval(ctx, "l2")
    return probs.select("doc_id", "label", round6("prob").alias("prob"))


@query("M6_lr_top_features")
def q_m6(spark, sf):
    ctx = lr_context(spark, sf)
    models = LN.fit_ovr(ctx["train"], ctx["classes"], "l2")
    return LN.top_coefficients(models, ctx["index"], spark, 20).select(
        "label", _L("rank").alias("rank"), "term", round6("coefficient").alias("coefficient"))


@query("M8_lr_roc_auc")
def q_m8(spark, sf):
    ctx = lr_context(spark, sf)
    _, probs, _ = _ovr_eval(ctx, "l2")
    p = probs.join(ctx["test"].select("doc_id", F.col("label").alias("truth")), "doc_id")
    return ME.ovr_auc(p, "truth", "label", "prob").select("label", round6("auc").alias("auc"),
                                                          _L("n_thresholds").alias("n_thresholds"))


@query("M14_best_lr")
def q_m14(spark, sf):
    return _best_lr(_lr_comparison(spark, sf)[0])


def _best_lr(m):
    return m.agg(F.max_by("regularization", F.struct("f1_score", F.negative(
        F.array_position(F.array(F.lit("l1"), F.lit("l2"), F.lit("elasticnet")), F.col("regularization")))))
        .alias("best_regularization"), F.max("f1_score").alias("best_f1_score"))


@query("M17_multinomial_lr")
def q_m17(spark, sf):
    ctx = lr_context(spark, sf, max_features=3000)
    idx, model = LN.fit_multinomial(ctx["train"])
    preds = LN.multinomial_predict(idx, model, ctx["test"]).join(
        ctx["test"].select("doc_id", F.col("label").alias("truth")), "doc_id")
    return ME.metrics_long(preds).select("metric", round6("value").alias("value"))


def _pca(ctx):
    return LN.pca_2d(cut_lineage(ctx["long_train"]), cut_lineage(ctx["long_test"]), ctx["train"].select("doc_id", "label"),
                     ctx["test"].select("doc_id", "label"), ctx["size"])


@query("M9_pca_projection")
def q_m9(spark, sf):
    ctx = lr_context(spark, sf)
    tr, _, explained = _pca(ctx)
    return tr.select("doc_id", "label", round6("y0").alias("pc1"), round6("y1").alias("pc2"),
                     F.lit(round(explained, 6)).alias("explained_variance_ratio"))


@query("M11_polynomial_degrees")
def q_m11(spark, sf):
    ctx = lr_context(spark, sf)
    tr, te, _ = _pca(ctx)
    models = LN.polynomial_models(cut_lineage(tr), cut_lineage(te))
    out = None
    v = ctx["size"]
    for d, (idx, m, trd, ted, width) in models.items():
        ptr = LN.multinomial_predict(idx, m, trd, features="features_poly").join(
            trd.select("doc_id", F.col("label").alias("truth")), "doc_id")
        pte = LN.multinomial_predict(idx, m, ted, features="features_poly").join(
            ted.select("doc_id", F.col("label").alias("truth")), "doc_id")
        a = ME.summary_metrics(ptr).first()
        b = ME.summary_metrics(pte).first()
        row = spark.createDataFrame(
            [(d, float(a["accuracy"]), float(b["accuracy"]), float(b["f1_score"]), int(width),
              int((v + 2) * (v + 1) // 2))],
            "degree long, train_accuracy double, test_accuracy double, f1_score double, "
            "feature_space_size long, degree_2_full_feature_space_size long").select(
            "degree", round6("train_accuracy").alias("train_accuracy"), round6("test_accuracy").alias("test_accuracy"),
            round6("f1_score").alias("f1_score"), "feature_space_size", "degree_2_full_feature_space_size")
        out = row if out is None else out.unionByName(row)
    return out


@query("M16_serving_bundle")
def q_m16(spark, sf):
    """Write the serving bundle (vocabulary/idf, coefficients, the ML pipeline, retrieval index, metadata) and list it."""
    ctx = lr_context(spark, sf)
    metrics, fitted = _lr_comparison(spark, sf, ctx)
    best = _best_lr(metrics).first()
    reg = best["best_regularization"]
    models = fitted[reg] if reg in fitted else LN.fit_ovr(ctx["train"], ctx["classes"], reg)
    root = shared_dir(spark, "bundle")
    SV.classifier_pipeline(ctx, models).write().overwrite().save(f"{root}/pipeline")
    INF.Classifier.fitted(ctx, models).save(root)
    p = processed(spark, sf)
    w, _ = FE.tfidf(p, "cleaned_text", "sublinear", vocab=ctx["idf"])
    R.ImpactIndex.build(cut_lineage(w)).save(f"{root}/retrieval")
    p.select("doc_id", "text", "cleaned_text", "label", "source_id").write.mode("overwrite").parquet(f"{root}/corpus")
    n_sources = p.agg(F.count_distinct("source_id")).first()[0]
    meta = spark.createDataFrame(
        [(f"logistic_regression_{reg}", "production", "1.0.0", float(best["best_f1_score"]), len(ctx["classes"]),
          int(n_sources), root)],
        "model_name string, stage string, version string, f1_score double, num_classes long, source_count long, "
        "path string")
    meta.write.mode("overwrite").json(f"{root}/metadata")
    return meta.select("model_name", "stage", "version", round6("f1_score").alias("f1_score"), "num_classes",
                       "source_count")
