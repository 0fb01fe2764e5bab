"""Registered inference and streaming queries (V1-V4, V6, ST1-ST3)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from veracorp.functions import text as T
from veracorp.operators import inference as INF
from veracorp.operators import linear as LN
from veracorp.operators import serving as SV
from veracorp.operators.lake import path_exists
from veracorp.plans.base import combined, processed, round6
from veracorp.plans.queries_ml import lr_context
from veracorp.session import shared_dir, source_key
from veracorp.sources import feeds as FD
from veracorp.sources.tables import table
from veracorp.streaming import streams as ST

REGISTRY = {}


def query(name):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def _L(c):
    return (F.col(c) if isinstance(c, str) else c).cast("long")


def _requests(spark, sf):
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("request_id"), "text")


@query("V1_preprocess")
def q_v1(spark, sf):
    p = INF.preprocess(INF.accepted(_requests(spark, sf)))
    return p.select("request_id", T.join_tokens("tokens").alias("tokens"),
                    T.join_tokens("removed_stopwords").alias("removed_stopwords"))


@query("V1_preprocess_clean_split")
def q_v1s(spark, sf):
    p = INF.preprocess(INF.accepted(_requests(spark, sf)), steps=("clean", "stopwords"))
    return p.select("request_id", T.join_tokens("tokens").alias("tokens"),
                    T.join_tokens("removed_stopwords").alias("removed_stopwords"))


@query("V6_request_validation")
def q_v6(spark, sf):
    conv = table(spark, sf, "conversations")
    req = conv.select((F.col("conv_id") * 1000 + F.col("turn")).alias("request_id"), "text")
    return INF.validate(req).select("request_id", "accepted", "reason")


@query("V6_batch_validation")
def q_v6b(spark, sf):
    conv = table(spark, sf, "conversations").select(F.col("conv_id").alias("batch_id"), "text")
    return INF.validate_batches(conv).select("batch_id", _L("n_texts").alias("n_texts"), "accepted")


def saved_bundle(spark, sf) -> str:
    """Folder of the bundle fitted to these tables; fitted and saved where it is not there yet.
    It holds the classifier as an ML pipeline and, for explanations, as tables."""
    root = shared_dir(spark, "bundle-" + source_key(spark, sf), unique=False)
    if not path_exists(spark, f"{root}/intercepts/_SUCCESS"):          # the part that is written last
        ctx = lr_context(spark, sf)
        models = LN.fit_ovr(ctx["train"], ctx["classes"], "l2")
        SV.classifier_pipeline(ctx, models).write().overwrite().save(f"{root}/pipeline")
        INF.Classifier.fitted(ctx, models).save(root)
    return root


def _pipeline(spark, sf) -> PipelineModel:
    return PipelineModel.load(f"{saved_bundle(spark, sf)}/pipeline")


def _classifier(spark, sf):
    return INF.Classifier.load(spark, saved_bundle(spark, sf))


@query("V2_classify")
def q_v2(spark, sf):
    r = _pipeline(spark, sf).transform(INF.accepted(_requests(spark, sf)))
    return r.select("request_id", "prediction", round6("confidence").alias("confidence"),
                    F.to_json("class_probabilities").alias("class_probabilities"))


@query("V3_explain")
def q_v3(spark, sf):
    e = _classifier(spark, sf).explain(_requests(spark, sf))
    return e.select("request_id", _L("rank").alias("rank"), "term", round6("contribution").alias("contribution"))


@query("V4_classify_batch")
def q_v4(spark, sf):
    r = _pipeline(spark, sf).transform(INF.accepted(_requests(spark, sf)))
    return r.groupBy("prediction").agg(F.count(F.lit(1)).alias("cnt"))


# --- streams ---------------------------------------------------------------------

DOC_SCHEMA = "doc_id long, text string, label string"


def _land_docs(spark, sf, parts: int = 4) -> str:
    root = shared_dir(spark, "stream-in")
    combined(spark, sf).select("doc_id", "text", "label").repartition(parts, "doc_id") \
        .write.parquet(f"{root}/docs")
    return f"{root}/docs"


@query("ST1_preprocess_stream")
def q_st1(spark, sf):
    landed = _land_docs(spark, sf)
    out = shared_dir(spark, "st1")
    ST.preprocess_stream(spark, landed, DOC_SCHEMA, f"{out}/data", f"{out}/_checkpoint")
    return spark.read.parquet(f"{out}/data")


@query("ST2_scoring_stream")
def q_st2(spark, sf):
    clf = _pipeline(spark, sf)
    landed = _land_docs(spark, sf)
    out = shared_dir(spark, "st2")
    ST.scoring_stream(spark, clf, landed, DOC_SCHEMA, f"{out}/data", f"{out}/_checkpoint")
    return spark.read.parquet(f"{out}/data").select("request_id", "prediction", round6("confidence").alias("confidence"))


@query("ST3_feed_dedup_stream")
def q_st3(spark, sf):
    root = shared_dir(spark, "st3")
    FD.land_feed(combined(spark, sf), f"{root}/items")
    ST.feed_dedup_stream(spark, f"{root}/items", f"{root}/data", f"{root}/_checkpoint")
    return spark.read.parquet(f"{root}/data").select("source", "ord", "text", "date", "url", "year")
