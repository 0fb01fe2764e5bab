"""Batch inference on request tables (V1-V4, V6).

The reference serves single requests over HTTP; here a request table (or a
stream of them) runs through the same Column pipeline, so one job serves any
number of requests.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veracorp.functions import lexicon as L
from veracorp.functions.text import (clean_text, kept_tokens, removed_tokens, treebank_tokens)
from veracorp.functions import patterns as P
from veracorp.operators import features as FE
from veracorp.operators import linear as LN


def validate(requests: DataFrame, text: str = "text", top_k: Column | None = None) -> DataFrame:   # V6
    """accepted / reason per request: text length 10..10,000 chars, optional top_k 1..20."""
    n = F.length(F.coalesce(F.col(text), F.lit("")))
    reason = (F.when(F.col(text).isNull(), F.lit("missing_text"))
              .when(n < L.TEXT_MIN_CHARS, F.lit("text_too_short"))
              .when(n > L.TEXT_MAX_CHARS, F.lit("text_too_long")))
    if top_k is not None:
        reason = reason.when((top_k < L.TOP_K_MIN) | (top_k > L.TOP_K_MAX), F.lit("top_k_out_of_range"))
    return requests.withColumn("reason", reason).withColumn("accepted", F.col("reason").isNull())


def validate_batches(requests: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Batch-level bound: 1..100 texts per batch."""
    c = requests.groupBy(batch).agg(F.count(F.lit(1)).alias("n_texts"))
    return c.withColumn("accepted", (F.col("n_texts") >= L.BATCH_MIN) & (F.col("n_texts") <= L.BATCH_MAX))


def preprocess(requests: DataFrame, steps: Sequence[str] = ("clean", "tokenize", "stopwords"),
               text: str = "text") -> DataFrame:                                                     # V1
    t = F.col(text)
    if "clean" in steps:
        t = clean_text(t)
    toks = treebank_tokens(t) if "tokenize" in steps else \
        F.filter(F.split(t, P.WS_RUN), lambda x: x != "")
    out = requests.withColumn("_t", toks)
    if "stopwords" in steps:
        out = out.withColumn("tokens", kept_tokens("_t", True)).withColumn("removed_stopwords", removed_tokens("_t", True))
    else:
        out = out.withColumn("tokens", F.col("_t")).withColumn("removed_stopwords", F.array().cast("array<string>"))
    return out.drop("_t")


def accepted(requests: DataFrame, text: str = "text") -> DataFrame:
    """The requests that pass V6, without its columns: the gate in front of V1-V5."""
    return validate(requests, text).where("accepted").drop("accepted", "reason")


class Classifier:
    """The serving bundle: one-vs-rest LR over TF-IDF as DataFrames of bounded size.

    ``vocabulary`` (term, idf, idx, mu, sd) holds max_features rows, ``coefficients``
    (label, idx, coefficient) classes x max_features, ``intercepts`` a row per class.
    Scores are joins and sums, so a loaded bundle needs no fitted MLlib objects.
    """

    PARTS = ("vocabulary", "coefficients", "intercepts")

    def __init__(self, vocabulary: DataFrame, coefficients: DataFrame, intercepts: DataFrame):
        self.vocabulary, self.coefficients, self.intercepts = vocabulary, coefficients, intercepts

    @classmethod
    def fitted(cls, ctx: dict, models: LN.OneVsRest) -> Classifier:
        spark = ctx["index"].sparkSession
        n = ctx["train"].count()
        mean = ctx["long_train"].groupBy("idx").agg((F.sum("weight") / n).alias("mu"))
        sd = spark.createDataFrame([(i, v) for i, v in enumerate(models.scale)], "idx long, sd double")
        vocabulary = (ctx["idf"].join(ctx["index"], "term").join(F.broadcast(sd), "idx").join(mean, "idx", "left")
                      .fillna(0.0, ["mu"]))
        rows = [(c, i, float(v)) for c, m in models.items() for i, v in enumerate(m.coefficients.toArray())]
        return cls(vocabulary, spark.createDataFrame(rows, "label string, idx long, coefficient double"),
                   spark.createDataFrame([(c, float(m.intercept)) for c, m in models.items()], "label string, intercept double"))

    def save(self, root: str) -> None:
        for part in self.PARTS:
            getattr(self, part).write.mode("overwrite").parquet(f"{root}/{part}")

    @classmethod
    def load(cls, spark, root: str) -> Classifier:
        return cls(*[spark.read.parquet(f"{root}/{part}") for part in cls.PARTS])

    def _weights(self, requests: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
        """The requests that pass V6, and their (doc_id, idx, term, weight, mu, sd)."""
        req = accepted(requests.select(F.col(id_col).alias("doc_id"), "text"))
        req = req.select("doc_id", clean_text(F.col("text")).alias("cleaned_text"), F.lit("?").alias("label"))
        w, _ = FE.tfidf(req, "cleaned_text", "sublinear", vocab=self.vocabulary.drop("idx", "mu", "sd"))
        return req, w.join(F.broadcast(self.vocabulary.select("term", "idx", "mu", "sd")), "term")

    def probabilities(self, requests: DataFrame, id_col: str = "request_id") -> DataFrame:
        """(doc_id, label, prob), normalised over classes."""
        req, w = self._weights(requests, id_col)
        value = F.col("weight") / F.when(F.col("sd") > 0, F.col("sd")).otherwise(1.0)
        sums = (w.select("doc_id", "idx", value.alias("x")).join(F.broadcast(self.coefficients), "idx")
                .groupBy("doc_id", "label").agg(F.sum(F.col("x") * F.col("coefficient")).alias("s")))
        classes = F.array(*[F.struct(F.lit(r["label"]).alias("label"), F.lit(r["intercept"]).alias("intercept"))
                            for r in self.intercepts.orderBy("label").collect()])        # a row per class
        every = req.select("doc_id", F.explode(classes).alias("c")).select("doc_id", "c.*")
        margin = F.col("intercept") + F.coalesce("s", F.lit(0.0))
        raw = every.join(sums, ["doc_id", "label"], "left").select("doc_id", "label", (1 / (1 + F.exp(-margin))).alias("raw"))
        return raw.withColumn("prob", F.col("raw") / F.sum("raw").over(Window.partitionBy("doc_id")))

    def classify(self, requests: DataFrame, id_col: str = "request_id") -> DataFrame:                 # V2, V4
        probs = self.probabilities(requests, id_col)
        best = F.min(F.struct(F.negative("prob").alias("o"), "label", "prob"))                       # ties: first class
        return (probs.groupBy("doc_id").agg(best.alias("b"), F.map_from_entries(F.collect_list(F.struct("label", "prob")))
                                            .alias("class_probabilities"))
                .select(F.col("doc_id").alias(id_col), F.col("b.label").alias("prediction"), F.col("b.prob").alias("confidence"),
                        "class_probabilities"))

    def explain(self, requests: DataFrame, id_col: str = "request_id", top_n: int = 5) -> DataFrame:   # V3
        """Top present features by |z-score x coefficient of the predicted class|."""
        pred = self.classify(requests, id_col).select(F.col(id_col).alias("doc_id"), F.col("prediction").alias("label"))
        _, w = self._weights(requests, id_col)
        x = w.join(pred, "doc_id").join(F.broadcast(self.coefficients), ["label", "idx"])
        z = F.when(F.col("sd") > 0, (F.col("weight") - F.col("mu")) / F.col("sd")).otherwise(0.0)
        x = x.withColumn("contribution", z * F.col("coefficient"))
        win = Window.partitionBy("doc_id").orderBy(F.desc(F.abs("contribution")), "term")
        return (x.withColumn("rank", F.row_number().over(win)).where(F.col("rank") <= top_n)
                .select(F.col("doc_id").alias(id_col), "rank", "term", "contribution"))
