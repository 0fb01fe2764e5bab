"""Token normalisers on the distinct vocabulary.

The stemmers are Python functions, so they run once per *distinct* term in a
pandas UDF (Arrow batches) and the (term, norm) table is joined back to the
token occurrences.  The vocabulary grows far slower than the corpus, and the
join is left to AQE (broadcast when it is small, shuffle otherwise).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from veracorp.functions.stemmers import lemma_rules, porter, snowball
from veracorp.session import broadcast_if_small

METHODS = ("porter", "snowball", "wordnet")


@F.pandas_udf(StringType())
def _porter(s: pd.Series) -> pd.Series:
    return s.map(porter)


@F.pandas_udf(StringType())
def _snowball(s: pd.Series) -> pd.Series:
    return s.map(snowball)


@F.pandas_udf(StringType())
def _lemma(s: pd.Series) -> pd.Series:
    return s.map(lemma_rules)


UDFS = {"porter": _porter, "snowball": _snowball, "wordnet": _lemma}


def vocabulary_map(terms: DataFrame, method: str, col: str = "term",
                   lexicon: DataFrame | None = None) -> DataFrame:
    """(term, norm) for every distinct term.  For 'wordnet' a user (token, lemma) table wins over the rules."""
    v = terms.select(col).distinct()
    out = v.select(col, UDFS[method](F.col(col)).alias("norm"))
    if method == "wordnet" and lexicon is not None:
        lx = lexicon.select(F.col("token").alias(col), F.col("lemma"))
        out = out.join(lx, col, "left").select(col, F.coalesce("lemma", "norm").alias("norm"))
    return out


def normalize_long(tokens_long: DataFrame, method: str, col: str = "token") -> DataFrame:
    """Replace ``col`` in a long (doc, pos, token) table by its normalised form."""
    if method in (None, "none"):
        return tokens_long
    m = broadcast_if_small(vocabulary_map(tokens_long, method, col))
    return tokens_long.join(m, col).withColumn(col, F.col("norm")).drop("norm")


def over_stemmed(original: Column, norm: Column) -> Column:
    """len(norm) <= max(2, int(len(original) / 2))."""
    return F.length(norm) <= F.greatest(F.lit(2), F.floor(F.length(original) * 0.5))


def compare_normalizers(terms: DataFrame, col: str = "term") -> DataFrame:       # T23
    """Per method: distinct terms, distinct normalised forms, vocabulary reduction, over-stemming count."""
    parts = []
    for m in METHODS:
        mp = vocabulary_map(terms, m, col)
        parts.append(mp.agg(F.count(F.lit(1)).alias("terms"), F.count_distinct("norm").alias("normalized_terms"),
                            F.count_if(over_stemmed(F.col(col), F.col("norm")) & F.lit(m != "wordnet"))
                            .alias("over_stemmed")).withColumn("method", F.lit(m)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("vocabulary_reduction", 1.0 - F.col("normalized_terms") / F.col("terms"))
