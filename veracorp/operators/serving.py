"""The classifier as a Spark ML pipeline.

``classifier_pipeline`` puts cleaner, tokens, counts over the fitted vocabulary, sublinear TF-IDF, scaling, one
logistic model per class and their normalisation into one ``PipelineModel``.  It is saved and loaded by
Spark's own ML persistence, scores a table or a stream row by row without a shuffle, and runs in the JVM: the
stages written here are compositions of Column functions.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracorp.functions.text import clean_text, word_tokens_2plus
from veracorp.operators.linear import OneVsRest
from veracorp.operators.vectors import sparse_parts, sparse_vector


class TextCleaner(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """The cleaner (T9) followed by the TF-IDF tokens."""

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), word_tokens_2plus(clean_text(F.col(self.getInputCol()))))


class SublinearTfidf(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """(1 + ln count) x idf, scaled to unit length, over a vector of counts.  ``idf`` holds max_features numbers."""

    idf = Param(Params._dummy(), "idf", "idf by index", typeConverter=TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, idf=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        idf = F.array(*[F.lit(float(x)) for x in self.getOrDefault(self.idf)])

        def weighted(parts):
            return F.zip_with(parts["indices"], parts["values"], lambda i, n: (F.log(n) + 1.0) * F.get(idf, i))

        def unit(values):
            norm = F.sqrt(F.aggregate(values, F.lit(0.0), lambda t, x: t + x * x))
            return F.transform(values, lambda x: x / norm)

        # each step binds its value by a one-element transform, as a plain column would be worked out per element
        def let(value, body):
            return F.get(F.transform(F.array(value), body), 0)

        parts = sparse_parts(F.col(self.getInputCol()))
        made = let(parts, lambda p: let(weighted(p), lambda w: F.struct(p["size"].alias("size"), p["indices"].alias("indices"), unit(w).alias("values"))))
        out = dataset.withColumn("_made", made)
        return out.withColumn(self.getOutputCol(), sparse_vector(F.col("_made.size"), F.col("_made.indices"), F.col("_made.values"))).drop("_made")


class ClassScores(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """prediction, confidence, class_probabilities from one probability vector per class; ties go to the first class."""

    classes = Param(Params._dummy(), "classes", "labels in order", typeConverter=TypeConverters.toListString)
    inputCols = Param(Params._dummy(), "inputCols", "a probability vector per label", typeConverter=TypeConverters.toListString)
    dropCols = Param(Params._dummy(), "dropCols", "columns of earlier stages that go", typeConverter=TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, classes=None, inputCols=None, dropCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        labels = self.getOrDefault(self.classes)
        out = dataset.withColumn("_raw", F.array(*[vector_to_array(F.col(c))[1] for c in self.getOrDefault(self.inputCols)]))
        total = F.aggregate("_raw", F.lit(0.0), lambda t, x: t + x)
        out = out.withColumn("_total", total).withColumn("_p", F.transform("_raw", lambda x: x / F.col("_total")))
        best = F.array_position("_p", F.array_max("_p")).cast("int")
        names = F.array(*[F.lit(x) for x in labels])
        return (out.withColumn("prediction", F.element_at(names, best)).withColumn("confidence", F.array_max("_p"))
                .withColumn("class_probabilities", F.map_from_arrays(names, F.col("_p")))
                .drop("_raw", "_total", "_p", *self.getOrDefault(self.dropCols)))


def classifier_pipeline(ctx: dict, models: OneVsRest, text: str = "text") -> PipelineModel:
    """The fitted classifier over raw text.  ``ctx`` holds the fitted ``idf`` and term ``index`` (max_features rows)."""
    terms = ctx["idf"].join(ctx["index"], "term").orderBy("idx").collect()      # max_features rows
    counts = CountVectorizerModel.from_vocabulary([r["term"] for r in terms], inputCol="_tokens", outputCol="_counts", minTF=1.0)
    factors = [1.0 / s if s > 0 else 1.0 for s in models.scale]
    stages = [TextCleaner(inputCol=text, outputCol="_tokens"), counts,
              SublinearTfidf(inputCol="_counts", outputCol="_tfidf", idf=[r["idf"] for r in terms]),
              ElementwiseProduct(scalingVec=Vectors.dense(factors), inputCol="_tfidf", outputCol="scaled")]
    own = ["_tokens", "_counts", "_tfidf", "scaled"]
    probabilities = []
    for i, model in enumerate(models.values()):
        m = model.copy()
        m.setPredictionCol(f"_y{i}")
        m.setProbabilityCol(f"_p{i}")
        m.setRawPredictionCol(f"_r{i}")
        stages.append(m)
        probabilities.append(f"_p{i}")
        own += [f"_y{i}", f"_p{i}", f"_r{i}"]
    return PipelineModel([*stages, ClassScores(classes=list(models), inputCols=probabilities, dropCols=own)])
