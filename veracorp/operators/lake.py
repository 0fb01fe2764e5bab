"""Three-layer versioned lake (raw / processed / embeddings) on Parquet.

Every upload writes ``<root>/<key>/version=<ts>-<uid>/`` and appends one row
to the ``<root>/_manifest`` Parquet table (key, versioned_key, file_path,
timestamp, size_bytes, hash, metadata map).  Versions are unique (the
reference's same-second overwrite is fixed) and lookups are manifest filters.
The content hash is an order-insensitive table digest, taken with the row count and the
profiles while the version is written, so an upload is one pass over the data.  Each version
also keeps the sha256 of its files and their Merkle root: a changed byte is found and its file named.
"""

from __future__ import annotations

import datetime as _dt
import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veracorp.operators.observed import observed_write

MANIFEST_SCHEMA = ("key string, versioned_key string, file_path string, timestamp string, size_bytes long, "
                   "hash string, row_count long, metadata map<string,string>, format string, files_root string")
FILES_SCHEMA = "versioned_key string, file string, length long, sha256 string"


def _row_hash(df: DataFrame) -> Column:
    """64-bit hash of a row; it covers which columns are null, as xxhash64 alone passes over nulls."""
    nulls = [F.col(c).isNull() for c in df.columns]
    return F.xxhash64(*nulls, *[F.col(c) for c in df.columns]).cast("decimal(38,0)")


def table_digest(df: DataFrame) -> DataFrame:                                    # L9
    """(row_count, digest): sum of 64-bit row hashes as a decimal, independent of row order."""
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.coalesce(F.sum(_row_hash(df)), F.lit(0)).cast("string").alias("digest"))


def file_digests(spark: SparkSession, path: str) -> DataFrame:                  # L9
    """(file, length, sha256) of every data file below ``path``, by its name there.  A task holds one file at a time, so
    a file must fit a binary value (2 GB); Spark's writers stay far below."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    # both names without their scheme; a loaded file stands alone
    plain = F.regexp_replace("path", "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    root = re.sub("^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", path).rstrip("/")
    name = F.when(plain.startswith(root + "/"), F.substring(plain, len(root) + 2, 2**31 - 1)).otherwise(F.substring_index(plain, "/", -1))
    return files.select(name.alias("file"), "length", F.sha2("content", 256).alias("sha256"))


def files_root(digests: DataFrame) -> str:
    """Merkle root over (file, sha256): nodes are named by the first digits of a hash of the file's name (65,536, then
    256 groups), so that no group grows beyond a share of the files, and a node is the hash of its children by name."""
    def node(children: Column) -> Column:
        return F.sha2(F.array_join(F.transform(F.sort_array(children), lambda x: F.concat(x["name"], F.lit(":"), x["h"], F.lit(";"))), ""), 256)
    level = digests.select(F.sha2("file", 256).alias("at"), F.col("file").alias("name"), F.col("sha256").alias("h"))
    for digits in (4, 2):
        level = level.groupBy(F.substring("at", 1, digits).alias("at")).agg(node(F.collect_list(F.struct("name", "h"))).alias("h")).select("at", F.col("at").alias("name"), "h")
    return level.agg(node(F.collect_list(F.struct("name", "h"))).alias("root")).first()["root"]


def path_size(spark: SparkSession, path: str) -> int:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


class Lake:
    LAYERS = ("raw", "processed", "embeddings")

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.manifest_path = f"{self.root}/_manifest"

    # --- L1 ------------------------------------------------------------------
    def upload(self, key: str, data: DataFrame | dict, metadata: dict | None = None, measures: dict[str, Column] | None = None,
               describe: Callable[[dict], dict] | None = None) -> dict:
        """Write a new version.  ``measures`` are aggregates taken in the write; ``describe`` turns them into metadata."""
        ts = _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%dT%H-%M-%S.%f")
        version = f"{ts}-{uuid.uuid4().hex[:8]}"
        path = f"{self.root}/{key}/version={version}"
        if isinstance(data, DataFrame):
            frame, kind = data, "parquet"
        else:
            frame, kind = self.spark.createDataFrame([(json.dumps(data, default=str, sort_keys=True),)], "payload string"), "json"
        # rows, digest and whatever the caller measures are taken as the rows are written
        seen = observed_write(frame, lambda d: d.write.mode("errorifexists").format(kind).save(path),
                              digest=F.coalesce(F.sum(_row_hash(frame)), F.lit(0)).cast("string"), **(measures or {}))
        files = file_digests(self.spark, path)
        files.select(F.lit(f"{key}_{version}").alias("versioned_key"), "*").write.mode("append").parquet(f"{self.root}/_files")
        metadata = {**(metadata or {}), **(describe(seen) if describe else {})}
        meta = {k: (v if isinstance(v, str) else json.dumps(v, default=str, sort_keys=True)) for k, v in metadata.items()}
        row = {"key": key, "versioned_key": f"{key}_{version}", "file_path": path, "timestamp": version,
               "size_bytes": path_size(self.spark, path), "hash": seen["digest"], "row_count": int(seen["n"]),
               "metadata": meta, "format": kind, "files_root": files_root(self.files(f"{key}_{version}"))}
        self.spark.createDataFrame([row], MANIFEST_SCHEMA).write.mode("append").parquet(self.manifest_path)
        return row

    # --- L9 ------------------------------------------------------------------
    def files(self, versioned_key: str) -> DataFrame:
        """Digests of a version's files as they were written."""
        return self.spark.read.schema(FILES_SCHEMA).parquet(f"{self.root}/_files").where(F.col("versioned_key") == versioned_key)

    def verify_files(self, key: str, version: str | None = None) -> DataFrame:
        """(file, status) of the files that are not as they were written: changed, missing or added."""
        rec = self.version_record(key, version)
        then = self.files(rec["versioned_key"]).select("file", F.col("sha256").alias("then"))
        now = file_digests(self.spark, rec["file_path"]).select("file", F.col("sha256").alias("now"))
        status = F.when(F.col("now").isNull(), "missing").when(F.col("then").isNull(), "added").when(F.col("then") != F.col("now"), "changed")
        return then.join(now, "file", "full").select("file", status.alias("status")).where("status IS NOT NULL")

    def intact(self, key: str, version: str | None = None) -> bool:
        """Whether the version's files still give the root in the manifest."""
        rec = self.version_record(key, version)
        return files_root(file_digests(self.spark, rec["file_path"])) == rec["files_root"]

    def manifest(self) -> DataFrame:
        return self.spark.read.schema(MANIFEST_SCHEMA).parquet(self.manifest_path)

    # --- L2 ------------------------------------------------------------------
    def version_record(self, key: str, version: str | None = None) -> dict:
        m = self.manifest().where(F.col("key") == key)
        if version is not None:
            m = m.where(F.col("timestamp") == version)
        rec = m.agg(F.max_by(F.struct(*[F.col(c) for c in m.columns]), F.col("timestamp")).alias("r")).first()["r"]
        if rec is None:
            raise FileNotFoundError(f"the lake holds no version of {key}")
        return rec.asDict(recursive=True)

    def download(self, key: str, version: str | None = None) -> tuple[DataFrame, dict]:
        rec = self.version_record(key, version)
        return self.spark.read.format(rec["format"] or "parquet").load(rec["file_path"]), rec

    # --- L3 ------------------------------------------------------------------
    def list_versions(self, layer: str = "processed", prefix: str = "") -> DataFrame:
        full = f"{layer}/{prefix}" if prefix else f"{layer}/"
        return self.manifest().where(F.col("key").startswith(full))

    # --- L4 / L5 / L6 --------------------------------------------------------
    def upload_raw(self, df: DataFrame, source_name: str, description: str = "") -> dict:
        nulls = {f"null_{i}": F.count_if(F.col(c).isNull()) for i, c in enumerate(df.columns)}
        meta = {"source": source_name, "description": description, "columns": json.dumps(df.columns), "dtypes": json.dumps(dict(df.dtypes))}

        def describe(seen: dict) -> dict:
            meta.update(row_count=str(seen["n"]), missing_values=json.dumps({c: seen[f"null_{i}"] for i, c in enumerate(df.columns)}))
            return meta
        info = self.upload(f"raw/{source_name}/dataset", df, {}, nulls, describe)
        self.upload(f"raw/{source_name}/metadata", meta | {"memory_usage": info["size_bytes"]})
        return info

    def upload_processed(self, df: DataFrame, name: str, vectorizer_type: str = "tfidf",
                         preprocessing_steps=()) -> dict:
        meta = {"name": name, "vectorizer_type": vectorizer_type,
                "preprocessing_steps": json.dumps(list(preprocessing_steps)), "columns": json.dumps(df.columns),
                "creation_timestamp": _dt.datetime.now(_dt.timezone.utc).isoformat()}

        def describe(seen: dict) -> dict:
            cells = seen["n"] * len(df.columns)
            meta.update(row_count=str(seen["n"]), sparsity=repr(seen["zero_cells"] / cells if cells else None))
            return meta
        info = self.upload(f"processed/{name}/data", df, {}, {"zero_cells": _zero_cells(df)}, describe)
        self.upload(f"processed/{name}/metadata", meta)
        return info

    def upload_embeddings(self, vectors: DataFrame, name: str, model_type: str = "word2vec",
                          hyperparameters: dict | None = None) -> dict:
        meta = {"name": name, "model_type": model_type, "hyperparameters": json.dumps(hyperparameters or {}),
                "creation_timestamp": _dt.datetime.now(_dt.timezone.utc).isoformat()}

        def describe(seen: dict) -> dict:
            meta.update(vocab_size=str(seen["n"]), embedding_dim=str(seen["dim"] or 0))
            return meta
        info = self.upload(f"embeddings/{name}/model", vectors, {}, {"dim": F.max(F.size("vector"))}, describe)
        self.upload(f"embeddings/{name}/metadata", meta)
        return info

    def fetch_for_training(self, name: str, version: str | None = None) -> tuple[DataFrame, dict]:
        return self.download(f"processed/{name}/data", version)

    # --- L7 / L8 -------------------------------------------------------------
    def lineage(self, name: str) -> dict:
        rec = self.version_record(f"processed/{name}/data")
        md = rec["metadata"]
        return {"dataset_name": name, "creation_timestamp": md.get("creation_timestamp"),
                "preprocessing_steps": md.get("preprocessing_steps", "[]"),
                "row_count": int(md.get("row_count", 0)), "columns": md.get("columns", "[]")}

    def validate(self, name: str) -> DataFrame:
        df, _ = self.fetch_for_training(name)
        return integrity_report(df)


def raw_profile(df: DataFrame) -> DataFrame:                                     # L4
    """One pass: row count and null count of every column (long form)."""
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    one = df.agg(*aggs)
    return one.select(F.col("_n").alias("row_count"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("dtype"), F.col(c).alias("null_count"))
        for c, t in df.dtypes])).alias("s")).select("row_count", "s.*")


def _zero_cells(df: DataFrame) -> Column:
    numeric = [c for c, t in df.dtypes if t in ("int", "bigint", "double", "float", "smallint", "tinyint")
               or t.startswith("decimal")]
    zeros = [F.count_if(F.col(c) == 0) for c in numeric]
    return sum(zeros[1:], zeros[0]) if zeros else F.count_if(F.lit(False))


def processed_profile(df: DataFrame) -> DataFrame:                               # L5
    """Rows, columns and the share of zero cells (numeric columns) over all cells."""
    total_zero = _zero_cells(df)
    ncols = len(df.columns)
    return df.agg(F.count(F.lit(1)).alias("row_count"), total_zero.alias("zero_cells")).select(
        "row_count", F.lit(ncols).cast("long").alias("n_columns"), F.col("zero_cells").cast("long").alias("zero_cells"),
        F.when(F.col("row_count") > 0, F.col("zero_cells") / (F.col("row_count") * ncols)).alias("sparsity"))


def integrity_report(df: DataFrame) -> DataFrame:                                # L8
    """Overall null ratio, duplicate rows and the resulting warnings (measured, not just pass/fail)."""
    cols = df.columns
    nulls = [F.count_if(F.col(c).isNull()) for c in cols]
    total_nulls = sum(nulls[1:], nulls[0])
    # duplicates: count rows per 128-bit row digest (xxhash64 + md5 of the row as JSON), so the
    # shuffle carries ~24 bytes per row instead of the row; partial aggregation collapses hot copies
    row = F.struct(*[F.col(c) for c in cols])
    dup = (df.groupBy(F.xxhash64(*[F.col(c) for c in cols]).alias("_h1"), F.md5(F.to_json(row)).alias("_h2"))
           .count().agg(F.sum(F.col("count") - 1)).first()[0] or 0)
    r = df.agg(F.count(F.lit(1)).alias("row_count"), total_nulls.alias("null_cells")).withColumn(
        "duplicate_rows", F.lit(int(dup)).cast("long"))
    ratio = F.when(F.col("row_count") > 0, F.col("null_cells") / (F.col("row_count") * len(cols))).otherwise(0.0)
    return r.select("row_count", F.col("null_cells").cast("long").alias("null_cells"), ratio.alias("null_ratio"),
                    F.coalesce(F.col("duplicate_rows"), F.lit(0)).cast("long").alias("duplicate_rows"),
                    (ratio > 0.1).alias("high_null_warning"),
                    (F.coalesce(F.col("duplicate_rows"), F.lit(0)) > 0).alias("duplicate_warning"))
