"""Substring search for keyword tables of any length.

A list of literals is scanned keyword by keyword, so its cost is texts x keywords.  Here a
keyword is found by its anchor, its first GRAM characters: the hashes of a text's distinct grams
equi-join those of the anchors, and only keywords whose anchor the text seems to hold are searched in it.  The
anchors are broadcast where their size is counted to be small, and the texts are dealt by id first, so
that no gram is shuffled.  Hashes are rolled over Arrow batches; up to IN_TASK anchor hashes go along, so that only
grams which some keyword starts with leave Python.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from veracorp.session import broadcast_if_small, cut_lineage

GRAM = 12           # a long anchor is rarely held without its keyword; each length costs one pass over the characters
IN_TASK = 200_000   # anchor hashes that tasks get (8 bytes each)

_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_HIGH = np.uint64(48)


def gram_hashes(sizes: Sequence[int], wanted: np.ndarray | None = None) -> Callable[[pd.Series], pd.Series]:
    """Texts -> distinct 64-bit hashes of their substrings of ``sizes`` characters, those of ``wanted`` (sorted) if given."""
    seen = None
    if wanted is not None:      # by their high bits, so that few grams are looked up
        seen = np.zeros(1 << 16, dtype=bool)
        seen[wanted.view(np.uint64) >> _HIGH] = True

    def one(text: str) -> np.ndarray:
        chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        found, rolled = [], np.zeros(len(chars) + 1, dtype=np.uint64)
        for n in range(1, min(max(sizes), len(chars)) + 1):
            rolled = rolled[:-1] * _STEP + chars[n - 1:] + np.uint64(1)
            if n in sizes:
                grams = (rolled ^ np.uint64(n)) * _MIX
                found.append(grams if seen is None else grams[seen[grams >> _HIGH]])
        grams = np.unique(np.concatenate(found)).view(np.int64) if found else np.empty(0, dtype=np.int64)
        return grams if wanted is None else grams[np.isin(grams, wanted)]

    return lambda texts: texts.map(one)


@F.pandas_udf(LongType())
def anchor_hash(anchors: pd.Series) -> pd.Series:
    """The hash of each anchor, as ``gram_hashes`` gives it."""
    return anchors.map(lambda a: gram_hashes((len(a),))(pd.Series([a]))[0][0])


def keyword_matches(docs: DataFrame, keywords: DataFrame, id_col: str = "doc_id", text: str = "text", keyword: str = "keyword",
                    gram: int = GRAM) -> DataFrame:
    """(id, keywords): the keywords that occur in each text as substrings, case ignored, sorted; texts without any
    are left out.  Null texts hold none; null and empty keywords are left out.  Ids are unique."""
    def hashes(sizes, wanted=None):
        return F.pandas_udf(gram_hashes(sizes, wanted), ArrayType(LongType()))

    low = docs.select(id_col, F.lower(F.coalesce(F.col(text), F.lit(""))).alias("_low")).repartition(id_col)
    words = keywords.select(F.lower(keyword).alias("keyword")).where(F.length("keyword") > 0).distinct()
    words = words.withColumn("_a", F.substring("keyword", 1, gram))
    # an anchor is shorter than ``gram`` only where it is the whole keyword: the gram of its own length
    words = cut_lineage(words.select("keyword", F.length("_a").alias("n"), anchor_hash("_a").alias("anchor")))
    sizes = [r[0] for r in words.select("n").distinct().collect()]    # at most ``gram`` numbers
    if not sizes:
        return low.select(id_col, F.array().cast("array<string>").alias("keywords")).where("false")
    anchors = words.select("anchor").distinct().limit(IN_TASK + 1).collect()
    wanted = np.array(sorted(r[0] for r in anchors), dtype=np.int64) if len(anchors) <= IN_TASK else None
    held = low.select(id_col, F.explode(hashes(tuple(sizes), wanted)("_low")).alias("anchor"))
    likely = (held.join(broadcast_if_small(words.select("keyword", "anchor"), materialize=False), "anchor")
              .groupBy(id_col).agg(F.collect_set("keyword").alias("likely")))
    held_ones = F.sort_array(F.filter("likely", lambda k: F.contains(F.col("_low"), k)))
    # as an element, so that the condition below does not search every text a second time
    found = low.join(likely, id_col).select(id_col, F.explode(F.array(held_ones)).alias("keywords"))
    return found.where(F.size("keywords") > 0)
