"""Driver tables -> the unified corpus.

The test tables carry no three-class label, so the label is defined once here:
``Fake`` when toxic, else ``Real`` when quality, else ``Satire``, over
``documents JOIN labels``.  ``source_id`` is the document source and ``year``
is synthetic (``2016 + doc_id % 9``), stated as such.  ``row_ord`` (= doc_id)
and ``source_rank`` make "keep first" well defined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan a driver table.

    A Parquet file with a single row group is read by one task, which would
    serialise all per-row work before the first shuffle.  When the scan yields
    fewer partitions than the cluster's parallelism, the rows are spread
    round-robin; a large input (many files / row groups) is left as scanned.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    target = spark.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df


def label_expr(toxic="toxic", quality="quality"):
    return (F.when(F.col(toxic) == 1, F.lit("Fake"))
            .when(F.col(quality) == 1, F.lit("Real"))
            .otherwise(F.lit("Satire")))


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpus rows before any filtering: doc_id, text, label, source_id, year, source_rank, row_ord."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return (docs.join(labels, "doc_id")
            .select("doc_id", "text", label_expr().alias("label"),
                    F.col("source").alias("source_id"),
                    (F.lit(2016) + F.col("doc_id") % 9).cast("int").alias("year"),
                    F.lit(0).alias("source_rank"),
                    F.col("doc_id").alias("row_ord")))
