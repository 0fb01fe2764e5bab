"""Classification metrics (M7) and one-vs-rest ROC / AUC (M8) as DataFrames.

Everything is derived from the (truth, pred) confusion counts, a table with
at most k*k rows, so the heavy part is one partial-aggregated count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def confusion(preds: DataFrame, truth: str = "truth", pred: str = "pred", keys: Sequence[str] = ()) -> DataFrame:
    return preds.groupBy(*keys, F.col(truth).alias("truth"), F.col(pred).alias("pred")).agg(
        F.count(F.lit(1)).alias("cnt"))


def per_class_report(preds: DataFrame, truth: str = "truth", pred: str = "pred",
                     keys: Sequence[str] = ()) -> DataFrame:
    """precision / recall / f1 / support per class over labels seen in truth or pred (0 on 0/0)."""
    keys = list(keys)
    cm = confusion(preds, truth, pred, keys)
    # a cell counts for its true class and for its predicted one: one aggregate, no join; a null class counts nothing
    hit, zero = F.coalesce(F.col("truth") == F.col("pred"), F.lit(False)), F.lit(0).cast("long")

    def share(cls, tp, support, npred):
        known = F.col(cls).isNotNull()
        return F.struct(F.col(cls).alias("cls"), tp.alias("tp"), F.when(known, support).otherwise(zero).alias("support"),
                        F.when(known, npred).otherwise(zero).alias("npred"))

    r = (cm.select(*keys, F.explode(F.array(share("truth", F.when(hit, F.col("cnt")).otherwise(zero), F.col("cnt"), zero),
                                            share("pred", zero, zero, F.col("cnt")))).alias("s"))
         .groupBy(*keys, F.col("s.cls").alias("cls"))
         .agg(F.sum("s.tp").alias("tp"), F.sum("s.support").alias("support"), F.sum("s.npred").alias("npred")))
    p = F.when(F.col("npred") > 0, F.col("tp") / F.col("npred")).otherwise(F.lit(0.0))
    rc = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    r = r.withColumn("precision", p).withColumn("recall", rc)
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
                ).otherwise(F.lit(0.0))
    return r.withColumn("f1", f1).select(*keys, F.col("cls").alias("label"), "precision", "recall", "f1",
                                         F.col("support").cast("long").alias("support"))


def with_averages(report: DataFrame) -> DataFrame:
    """The class report with its macro-average and support-weighted-average rows."""
    n = F.sum("support")
    both = report.agg(*[F.avg(c).alias(f"m_{c}") for c in ("precision", "recall", "f1")],
                      *[(F.sum(F.col(c) * F.col("support")) / n).alias(f"w_{c}") for c in ("precision", "recall", "f1")],
                      n.cast("long").alias("support"))
    rows = both.where("support IS NOT NULL").select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("label"), *[F.col(f"{k}_{c}").alias(c) for c in ("precision", "recall", "f1")], F.col("support"))
        for name, k in (("macro avg", "m"), ("weighted avg", "w"))])).alias("r")).select("r.*")
    return report.unionByName(rows)


def summary_metrics(preds: DataFrame, truth: str = "truth", pred: str = "pred",
                    keys: Sequence[str] = ()) -> DataFrame:
    """One row per key: accuracy and support-weighted precision / recall / f1.

    Accuracy is sum(tp) / N, which is the support-weighted recall, so one
    aggregate over the per-class report gives all four numbers.
    """
    keys = list(keys)
    rep = per_class_report(preds, truth, pred, keys)
    n = F.sum("support")
    return rep.groupBy(*keys).agg((F.sum(F.col("recall") * F.col("support")) / n).alias("accuracy"),
                                  (F.sum(F.col("precision") * F.col("support")) / n).alias("precision"),
                                  (F.sum(F.col("recall") * F.col("support")) / n).alias("recall"),
                                  (F.sum(F.col("f1") * F.col("support")) / n).alias("f1_score"))


def metrics_long(preds: DataFrame, truth: str = "truth", pred: str = "pred") -> DataFrame:
    s = summary_metrics(preds, truth, pred)
    return s.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
                                        for c in ("accuracy", "precision", "recall", "f1_score")])).alias("m")
                    ).select("m.*")


def roc_points(scores: DataFrame, label_col: str = "truth", cls_col: str = "label",
               score_col: str = "prob", buckets: int = 256) -> DataFrame:
    """Exact one-vs-rest ROC points per class: a row per distinct score with the counts p, n
    at it, tp, fp down to it, and fpr, tpr.

    ``scores`` has one row per (document, class).  Rows are first collapsed to distinct
    (class, score) with positive and negative counts (partial aggregation absorbs hot
    scores).  The running sums need a global order: scores are dealt to ranges between
    quantiles of the distinct scores, so that saturated posteriors spread over many
    ranges; a window inside each range and one over the ranges' totals give the sums.
    """
    pos = (F.col(label_col) == F.col(cls_col)).cast("long")
    d = scores.groupBy(cls_col, score_col).agg(F.sum(pos).alias("p"), F.sum(1 - pos).alias("n"))
    cuts = d.agg(F.percentile_approx(score_col, [i / buckets for i in range(1, buckets)], 10 * buckets)).first()[0] or []
    ranges = F.array(*[F.lit(float(c)) for c in sorted(set(cuts))])
    # descending score order == ascending range number, then descending score
    above = F.size(F.filter(ranges, lambda c: c > F.col(score_col))) if cuts else F.lit(0)
    d = d.withColumn("_b", above)
    inb = Window.partitionBy(cls_col, "_b").orderBy(F.desc(score_col)).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_cp", F.sum("p").over(inb)).withColumn("_cn", F.sum("n").over(inb))
    bt = d.groupBy(cls_col, "_b").agg(F.sum("p").alias("_bp"), F.sum("n").alias("_bn"))      # buckets rows per class
    ob = Window.partitionBy(cls_col).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(cls_col)
    bt = bt.select(cls_col, "_b", F.coalesce(F.sum("_bp").over(ob), F.lit(0)).alias("_op"),
                   F.coalesce(F.sum("_bn").over(ob), F.lit(0)).alias("_on"),
                   F.sum("_bp").over(whole).alias("positives"), F.sum("_bn").over(whole).alias("negatives"))
    return (d.join(bt, [cls_col, "_b"])
            .select(F.col(cls_col).alias("label"), F.col(score_col).alias("threshold"), "p", "n", "positives", "negatives",
                    (F.col("_cp") + F.col("_op")).alias("tp"), (F.col("_cn") + F.col("_on")).alias("fp"))
            .withColumn("fpr", F.when(F.col("negatives") > 0, F.col("fp") / F.col("negatives")))
            .withColumn("tpr", F.when(F.col("positives") > 0, F.col("tp") / F.col("positives"))))


def ovr_auc(scores: DataFrame, label_col: str = "truth", cls_col: str = "label",
            score_col: str = "prob", buckets: int = 256) -> DataFrame:
    """Exact one-vs-rest ROC AUC per class (trapezoid over distinct scores, ties count half)."""
    points = roc_points(scores, label_col, cls_col, score_col, buckets)
    area = F.sum(F.col("n") * (2 * F.col("tp") - F.col("p")) / 2.0)      # between this point and the one before
    return points.groupBy("label").agg(
        F.when((F.max("positives") > 0) & (F.max("negatives") > 0), area / (F.max("positives") * F.max("negatives"))).alias("auc"),
        F.count(F.lit(1)).alias("n_thresholds"))
