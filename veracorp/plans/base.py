"""Shared corpus stages used by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracorp.operators import corpus as C
from veracorp.sources.tables import labelled_documents, table


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return labelled_documents(spark, sf)


def combined(spark: SparkSession, sf: str) -> DataFrame:
    """Canonical filter + keep-first dedup (the reference's combined corpus)."""
    return C.combine(raw(spark, sf))


def processed(spark: SparkSession, sf: str) -> DataFrame:
    return C.cleaned(combined(spark, sf))


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


def round6(c):
    return F.round(c.cast("double") if not isinstance(c, str) else F.col(c).cast("double"), 6)
