"""Registered lake queries (L1-L9).  Each writes into a fresh lake below the
shared checkpoint folder and reads back through the manifest."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from veracorp.operators import lake as LK
from veracorp.plans.base import combined, processed, raw, round6
from veracorp.session import shared_dir
from veracorp.sources.tables import table

REGISTRY = {}


def query(name):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def _lake(spark):
    return LK.Lake(spark, shared_dir(spark, "lake"))


@query("L1_versioned_upload")
def q_l1(spark, sf):
    lk = _lake(spark)
    df = combined(spark, sf).select("doc_id", "text", "label", "source_id", "year")
    a = lk.upload_raw(df, "combined_sources", "unified corpus")
    b = lk.upload_raw(df, "combined_sources", "unified corpus, second version")
    assert a["file_path"] != b["file_path"]
    return lk.manifest().select("key", "row_count", (F.col("size_bytes") > 0).alias("has_bytes"), "hash")


@query("L2_fetch_latest")
def q_l2(spark, sf):
    lk = _lake(spark)
    lk.upload_processed(raw(spark, sf).select("doc_id", "label"), "training")
    lk.upload_processed(combined(spark, sf).select("doc_id", "label"), "training", preprocessing_steps=["dedup"])
    data, _ = lk.fetch_for_training("training")
    return data


@query("L3_list_versions")
def q_l3(spark, sf):
    lk = _lake(spark)
    df = combined(spark, sf).select("doc_id", "label")
    for _ in range(3):
        lk.upload_processed(df, "corpus")
    return (lk.list_versions("processed", "corpus").groupBy("key")
            .agg(F.count(F.lit(1)).cast("long").alias("versions"), F.max("row_count").alias("row_count")))


@query("L4_raw_profile")
def q_l4(spark, sf):
    return LK.raw_profile(table(spark, sf, "documents")).select(
        "column_name", F.col("null_count").cast("long").alias("null_count"),
        F.col("row_count").cast("long").alias("row_count"))


@query("L5_processed_profile")
def q_l5(spark, sf):
    return LK.processed_profile(table(spark, sf, "labels")).select(
        F.col("row_count").cast("long").alias("row_count"), "n_columns", "zero_cells",
        round6("sparsity").alias("sparsity"))


@query("L6_embeddings_version")
def q_l6(spark, sf):
    lk = _lake(spark)
    vec = table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("word"),
                                                F.col("embedding").alias("vector"))
    info = lk.upload_embeddings(vec, "driver_vectors", hyperparameters={"source": "embeddings"})
    md = info["metadata"]
    back, _ = lk.download("embeddings/driver_vectors/model")
    return back.agg(F.count(F.lit(1)).alias("stored_rows")).select(
        F.lit(int(md["vocab_size"])).cast("long").alias("vocab_size"),
        F.lit(int(md["embedding_dim"])).cast("long").alias("embedding_dim"), F.col("stored_rows").cast("long"))


@query("L7_lineage")
def q_l7(spark, sf):
    lk = _lake(spark)
    p = processed(spark, sf).select("doc_id", "label", "cleaned_text")
    lk.upload_processed(p, "processed_training_dataset", "mixed", ["clean", "tokenize", "custom_stopwords"])
    lin = lk.lineage("processed_training_dataset")
    return spark.createDataFrame(
        [(lin["dataset_name"], lin["row_count"], len(json.loads(lin["columns"])),
          ",".join(json.loads(lin["preprocessing_steps"])))],
        "dataset_name string, row_count long, n_columns long, preprocessing_steps string")


@query("L8_integrity_report")
def q_l8(spark, sf):
    r = LK.integrity_report(table(spark, sf, "documents"))
    return r.select(F.col("row_count").cast("long"), "null_cells", round6("null_ratio").alias("null_ratio"),
                    "duplicate_rows", "high_null_warning", "duplicate_warning")


@query("L9_table_digest")
def q_l9(spark, sf):
    d = table(spark, sf, "documents")
    return LK.table_digest(d).select(F.col("row_count").cast("long"), "digest")


@query("L9_file_verification")
def q_l9f(spark, sf):
    """A version of the documents: its rows, whether its files give the manifest's root, files that differ."""
    lk = _lake(spark)
    info = lk.upload("raw/documents/dataset", table(spark, sf, "documents"))
    return spark.createDataFrame([(info["row_count"], lk.intact("raw/documents/dataset"), lk.verify_files("raw/documents/dataset").count())],
                                 "row_count long, intact boolean, files_differing long")
