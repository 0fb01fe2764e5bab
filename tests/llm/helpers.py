"""Fixtures shared by the training-data operator tests."""

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


def docs_df(spark, rows):
    """rows: (doc_id, text) pairs -> a documents table."""
    full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
    return spark.createDataFrame(full, DOCS)


def write_docs(spark, tmp_path, rows, name="documents"):
    """Write a documents table below ``tmp_path``; returns the folder to pass as sf_dir."""
    docs_df(spark, rows).write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)
