"""The corpus pipeline: stages over ``documents``, each written as Parquet and reread by the next.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns what it
keeps.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veracorp.llm.common import documents, shared_path
from veracorp.llm.exact_dedup import stage_exact_dedup
from veracorp.llm.minhash import stage_near_dedup
from veracorp.llm.packing import stage_packing
from veracorp.llm.secrets import stage_secrets
from veracorp.llm.toxicity import stage_toxicity

STAGES = [
    ("toxicity", stage_toxicity),          # documents that score 0.5 or more go
    ("exact_dedup", stage_exact_dedup),    # one row of every group of equal texts stays
    ("near_dedup", stage_near_dedup),      # one document of every near-duplicate group stays
    ("secrets", stage_secrets),            # secrets are replaced in the texts
    ("packing", stage_packing),            # token pieces with their sequence and offset
]

# Toxicity is a trained model and packing a heuristic: SQL cannot express either.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = documents(spark, sf_dir)
    for name, step in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
