"""Linear classifiers on TF-IDF: one-vs-rest and multinomial logistic regression
(MLlib), PCA + polynomial expansion (M4-M6, M9-M11, M14-M17).

Objective mapping: sklearn minimises ``C * sum_i w_i loss_i + penalty(b)``;
MLlib minimises ``(1 / sum_i w_i) sum_i w_i loss_i + lambda * penalty(b)``.
Dividing the first by ``C * sum_i w_i`` gives ``lambda = 1 / (C * sum_i w_i)``;
balanced weights sum to n, so ``regParam = 1 / (C n)``.  l1 -> elasticNetParam
1, l2 -> 0, elastic net (ratio .5) -> .5.  Features are divided by their
unweighted population standard deviation before the penalty, once for all
classes (centring is absorbed by the intercept, which keeps the vectors
sparse); MLlib's own standardisation would weight rows and differ by class.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import ElementwiseProduct, PolynomialExpansion, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veracorp.operators.vectors import sparse_vector

ELASTIC = {"l1": 1.0, "l2": 0.0, "elasticnet": 0.5}
TOL = 1e-4          # the reference solver's default stopping tolerance
# Non-zero numbers in a partition of training rows.  A fit takes up to some thousand steps, each a job over all partitions:
# where there is little in them, a step's time is that of its tasks' and stages' start.
PART_NONZEROS = 4_000_000
# Fits that run side by side.  An iteration is a short job, so one fit alone leaves the cluster waiting for the
# driver; each keeps its own blocks of the training rows (in memory, else on disk), so they are few.
FITS_AT_ONCE = 3


def side_by_side(spark: SparkSession, run: Callable, items: Iterable, at_once: int = FITS_AT_ONCE) -> list:
    """``run`` of every item, in order, ``at_once`` at a time; the first error ends it."""
    items = list(items)
    with ThreadPool(max(1, min(at_once, len(items)))) as pool:
        return pool.map(inheritable_thread_target(spark)(run), items, chunksize=1)


def vocabulary_index(idf: DataFrame) -> DataFrame:
    """(term, idx): alphabetical order, like the reference's feature names."""
    return idf.select("term", (F.row_number().over(Window.orderBy("term")) - 1).alias("idx"))


def to_vectors(weights: DataFrame, index: DataFrame, docs: DataFrame, size: int,
               id_col: str = "doc_id", label: str = "label") -> DataFrame:
    """Long (doc, term, weight) -> one sparse vector per document (docs without terms -> zero vector)."""
    rows = (weights.join(F.broadcast(index), "term")            # index: <= max_features rows
            .groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct("idx", "weight"))).alias("_e")))
    d = docs.select(id_col, label).join(rows, id_col, "left")
    e = F.coalesce(F.col("_e"), F.array().cast("array<struct<idx:int,weight:double>>"))
    return d.select(id_col, label, sparse_vector(size, F.transform(e, lambda x: x["idx"]), F.transform(e, lambda x: x["weight"])).alias("features"))


def balanced_binary_weight(df: DataFrame, target: str) -> DataFrame:
    """sklearn 'balanced' for a 0/1 target: n / (2 * n_class)."""
    w = Window.partitionBy()
    c = df.groupBy(target).agg(F.count(F.lit(1)).alias("_nc"))
    c = c.withColumn("_n", F.sum("_nc").over(w)).select(target, (F.col("_n") / (2.0 * F.col("_nc"))).alias("weight"))
    return df.join(F.broadcast(c), target)


class OneVsRest(dict):
    """Binary models by class over features divided by ``scale`` (population standard deviations)."""

    scale = None

    def scaled(self, df: DataFrame, features: str = "features") -> DataFrame:
        factors = [1.0 / s if s > 0 else 1.0 for s in self.scale]
        return ElementwiseProduct(scalingVec=Vectors.dense(factors), inputCol=features, outputCol="scaled").transform(df)


def _spread(df: DataFrame, features: str = "features") -> tuple[list[float], int, int]:
    """Unweighted population standard deviation of every feature (a vector of max_features numbers), rows, non-zero numbers."""
    r = df.agg(Summarizer.metrics("variance", "count", "numNonZeros").summary(F.col(features)).alias("s")).select("s.variance", "s.count", "s.numNonZeros").first()
    n = max(r["count"], 1)
    return [float(v * (n - 1) / n) ** 0.5 for v in r["variance"].toArray()], r["count"], int(r["numNonZeros"].toArray().sum())


def population_std(df: DataFrame, features: str = "features") -> list[float]:
    """Unweighted population standard deviation of every feature (a vector of max_features numbers)."""
    return _spread(df, features)[0]


def packed(df: DataFrame, nonzeros: int) -> DataFrame:
    """Training rows in as few partitions as hold about PART_NONZEROS each; never in more than there are."""
    return df.coalesce(max(1, -(-nonzeros // PART_NONZEROS)))


def _lean(model):
    """The model without its training summary: that one holds the session, which tasks cannot be sent once
    the session has watched an ``Observation``."""
    model._java_obj.setSummary(SparkContext._active_spark_context._jvm.scala.Option.empty())
    return model


def fit_ovr(train: DataFrame, classes: Sequence[str], regularization: str = "l2", C: float = 1.0,
            max_iter: int = 1000) -> OneVsRest:
    """One binary model per class, balanced weights, features scaled by their population std."""
    return fit_ovr_each(train, classes, (regularization,), C, max_iter)[regularization]


def fit_ovr_each(train: DataFrame, classes: Sequence[str], regularizations: Sequence[str], C: float = 1.0,
                 max_iter: int = 1000) -> dict[str, OneVsRest]:
    """``fit_ovr`` by regularization.  All fits stand in one queue, so that none waits for another regularization's slowest."""
    scale, n, nonzeros = _spread(train)
    models = {reg: OneVsRest() for reg in regularizations}
    for m in models.values():
        m.scale = scale
    train = packed(models[regularizations[0]].scaled(train), nonzeros)

    def fit(item):         # a distributed job
        reg, cls = item
        b = train.withColumn("y", (F.col("label") == cls).cast("double"))
        b = balanced_binary_weight(b, "y")
        lr = LogisticRegression(featuresCol="scaled", labelCol="y", weightCol="weight",
                                regParam=1.0 / (C * n), elasticNetParam=ELASTIC[reg],
                                standardization=False, maxIter=max_iter, tol=TOL, family="binomial")
        return _lean(lr.fit(b))

    items = [(reg, cls) for reg in regularizations for cls in classes]
    # where the rows are a partition or two, a fit uses that many cores, and its blocks are small
    at_once = max(FITS_AT_ONCE, train.sparkSession.sparkContext.defaultParallelism // train.rdd.getNumPartitions())
    for (reg, cls), model in zip(items, side_by_side(train.sparkSession, fit, items, at_once), strict=True):     # the label domain
        models[reg][cls] = model
    return models


def ovr_probabilities(models: dict, df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc, label, prob) normalised over classes, plus raw per-class probability."""
    parts = []
    scaled = models.scaled(df.select(id_col, "features"))
    for cls, m in models.items():
        p = m.transform(scaled).select(
            id_col, F.lit(cls).alias("label"), vector_to_array("probability")[1].alias("raw"))
        parts.append(p)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    w = Window.partitionBy(id_col)
    return out.withColumn("prob", F.col("raw") / F.sum("raw").over(w))


def argmax_label(probs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Highest probability; ties -> first class in sorted order."""
    return probs.groupBy(id_col).agg(F.min(F.struct(F.negative("prob"), F.col("label"), F.col("prob").alias("p")))
                                     .alias("_b")).select(id_col, F.col("_b.label").alias("pred"),
                                                          F.col("_b.p").alias("confidence"))


def top_coefficients(models: dict, index: DataFrame, spark, top_n: int = 20) -> DataFrame:
    """Top features by |coefficient| per class (coefficients are a bounded max_features vector)."""
    rows = []
    for cls, m in models.items():
        arr = m.coefficients.toArray()
        rows.extend((cls, i, float(v)) for i, v in enumerate(arr))
    coef = spark.createDataFrame(rows, "label string, idx long, coefficient double")
    w = Window.partitionBy("label").orderBy(F.desc(F.abs("coefficient")), "idx")
    return (coef.join(F.broadcast(index), "idx").withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= top_n))


def fit_multinomial(train: DataFrame, C: float = 1.0, balanced: bool = True, standardize: bool = False,
                    max_iter: int = 1000, features: str = "features"):
    """Plain multinomial LR (M17): balanced weights n / (k n_c), l2 with regParam 1/(C n)."""
    _, n, nonzeros = _spread(train, features)
    train = packed(train, nonzeros)
    if balanced:
        w = Window.partitionBy()
        c = train.groupBy("label").agg(F.count(F.lit(1)).alias("_nc"))
        c = c.withColumn("_n", F.sum("_nc").over(w)).withColumn("_k", F.count(F.lit(1)).over(w)) \
            .select("label", (F.col("_n") / (F.col("_k") * F.col("_nc"))).alias("weight"))
        train = train.join(F.broadcast(c), "label")
    else:
        train = train.withColumn("weight", F.lit(1.0))
    from pyspark.ml.feature import StringIndexer
    idx = StringIndexer(inputCol="label", outputCol="y", stringOrderType="alphabetAsc").fit(train)
    lr = LogisticRegression(featuresCol=features, labelCol="y", weightCol="weight", regParam=1.0 / (C * n),
                            elasticNetParam=0.0, standardization=standardize, maxIter=max_iter, tol=TOL,
                            family="multinomial")
    return idx, _lean(lr.fit(idx.transform(train)))


def multinomial_predict(idx, model, df: DataFrame, id_col: str = "doc_id", features: str = "features") -> DataFrame:
    labels = idx.labels
    p = model.transform(df.select(id_col, F.col(features).alias(model.getFeaturesCol())))
    return p.select(id_col, F.element_at(F.array(*[F.lit(x) for x in labels]),
                                         F.col("prediction").cast("int") + 1).alias("pred"),
                    F.array_max(vector_to_array("probability")).alias("confidence"))


def pca_2d(long_train: DataFrame, long_test: DataFrame, train_docs: DataFrame, test_docs: DataFrame,
           dim: int, k: int = 2, oversample: int = 8, iters: int = 7, seed: int = 42,
           id_col: str = "doc_id"):
    """Centred PCA to k dims by randomized subspace iteration on the sparse long table.

    ``long_*`` are (doc, idx, weight).  Each pass is Y = Xc V (broadcast join of
    the dim x l block, aggregate by doc) and Z = Xc^T Y (join on doc, aggregate
    by idx); only dim x l numbers (bounded by max_features) reach the driver.
    Centring is applied algebraically, so X is never densified.  Returns the
    projected train and test frames (doc, label, pc1.., xy) and the explained
    variance ratio.
    """
    import numpy as np

    spark = long_train.sparkSession
    l_cols = k + oversample
    n = train_docs.count()
    st = long_train.groupBy("idx").agg(F.sum("weight").alias("s"), F.sum(F.col("weight") ** 2).alias("ss")).collect()
    mu = np.zeros(dim)
    ss = 0.0
    for r in st:
        mu[r["idx"]] = r["s"] / n
        ss += r["ss"]
    total_var = (ss - n * float(mu @ mu)) / max(n - 1, 1)

    def block_df(V):
        return spark.createDataFrame([(int(j), [float(x) for x in V[j]]) for j in range(dim)],
                                     "idx long, v array<double>")

    def xv(long_df, docs, V):
        """Xc V as (doc, y0..y{l-1})."""
        c = mu @ V
        agg = [F.sum(F.col("weight") * F.col("v")[i]).alias(f"y{i}") for i in range(V.shape[1])]
        y = long_df.join(F.broadcast(block_df(V)), "idx").groupBy(id_col).agg(*agg)
        y = docs.select(id_col).join(y, id_col, "left")
        return y.select(id_col, *[(F.coalesce(F.col(f"y{i}"), F.lit(0.0)) - float(c[i])).alias(f"y{i}")
                                  for i in range(V.shape[1])])

    def xty(Y, m):
        Y = Y.persist()
        sums = Y.agg(*[F.sum(f"y{i}").alias(f"y{i}") for i in range(m)]).first()
        z = (long_train.join(Y, id_col).groupBy("idx")
             .agg(*[F.sum(F.col("weight") * F.col(f"y{i}")).alias(f"z{i}") for i in range(m)]).collect())
        Y.unpersist()
        Z = np.zeros((dim, m))
        for r in z:
            Z[r["idx"]] = [r[f"z{i}"] for i in range(m)]
        return Z - np.outer(mu, np.array([sums[f"y{i}"] for i in range(m)]))

    rng = np.random.default_rng(seed)
    V, _ = np.linalg.qr(rng.standard_normal((dim, l_cols)))
    for _ in range(iters):
        V, _ = np.linalg.qr(xty(xv(long_train, train_docs, V), l_cols))
    Z = xty(xv(long_train, train_docs, V), l_cols)          # Xc^T Xc V
    evals, evecs = np.linalg.eigh(V.T @ Z)
    order = np.argsort(evals)[::-1][:k]
    comps = V @ evecs[:, order]                               # dim x k principal axes
    for j in range(k):                                        # deterministic sign
        if comps[np.argmax(np.abs(comps[:, j])), j] < 0:
            comps[:, j] = -comps[:, j]
    explained = float(sum(evals[order]) / max(n - 1, 1) / total_var) if total_var > 0 else 0.0

    def proj(long_df, docs):
        y = xv(long_df, docs, comps)
        return docs.join(y, id_col).withColumn("xy", array_to_vector(F.array(*[F.col(f"y{i}") for i in range(k)])))

    return proj(long_train, train_docs), proj(long_test, test_docs), explained


def polynomial_models(train2d: DataFrame, test2d: DataFrame, degrees=(1, 2, 3), max_iter: int = 1000):
    """Per degree: expansion (no bias) -> standard scaling -> multinomial LR (C=1, unweighted)."""
    out = {}
    for d in degrees:
        pe = PolynomialExpansion(degree=d, inputCol="xy", outputCol="poly")
        tr, te = pe.transform(train2d), pe.transform(test2d)
        sc = StandardScaler(inputCol="poly", outputCol="z_sample", withMean=True, withStd=True).fit(tr)
        width, n = len(sc.mean), tr.count()
        # from the sample to the population standard deviation
        pop = ElementwiseProduct(scalingVec=Vectors.dense([(n / max(n - 1, 1)) ** 0.5] * width), inputCol="z_sample", outputCol="features_poly")
        tr, te = pop.transform(sc.transform(tr)), pop.transform(sc.transform(te))
        idx, m = fit_multinomial(tr, balanced=False, standardize=False, max_iter=max_iter, features="features_poly")
        out[d] = (idx, m, tr, te, width)
    return out
