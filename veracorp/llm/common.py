"""Small shared pieces of the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veracorp.session import ensure_checkpoint_dir

# ASCII white space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
ASCII_SPACE = r"[\x20\x09-\x0D]+"

# For oracles: CRC-32 of a decimal number, bit by bit (DuckDB has no such function).
CRC32_SQL = """xor(4294967295::UBIGINT, list_reduce(
  [4294967295::UBIGINT] || list_transform(string_split({0}::VARCHAR, ''), lambda c: ascii(c)::UBIGINT),
  lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[], lambda x, z: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))))"""


# Bytes of an Arrow batch on its way to Python: texts are long, and 10,000 rows of them would fill a task's memory.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def whole_text(col: str = "text") -> Column:
    """The text column with null read as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder; Spark's writers create it."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: the
    lineage ends there, so a lost executor costs only tasks of the next step.  The
    write's shuffle files go as soon as the table is there."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    bound_batches(spark)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
