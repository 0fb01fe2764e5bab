"""ML vectors built and read in the JVM.

MLlib takes vectors of its own type, for which Catalyst has no constructor of the sparse
form and no accessor.  A vector column is a struct underneath (type, size, indices, values), and
Spark's JSON functions write and read it as such: ``to_json`` of the struct, ``from_json``
with the vector type.  Doubles survive the round trip exactly, and no row visits Python.
"""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_VECTOR = T.StructType([T.StructField("v", VectorUDT())])
_PARTS = "v struct<size:int,indices:array<int>,values:array<double>>"


def sparse_vector(size: int | Column, indices: Column, values: Column) -> Column:
    """The sparse vector of ``size`` with ``values`` at the ascending ``indices``."""
    size = size if isinstance(size, Column) else F.lit(int(size))
    parts = F.struct(F.lit(0).alias("type"), size.cast("int").alias("size"), indices.cast("array<int>").alias("indices"),
                     values.cast("array<double>").alias("values"))
    return F.from_json(F.to_json(F.struct(parts.alias("v"))), _VECTOR)["v"]


def sparse_parts(vector: Column) -> Column:
    """(size, indices, values) of a column of sparse vectors."""
    return F.from_json(F.to_json(F.struct(vector.alias("v"))), _PARTS)["v"]
