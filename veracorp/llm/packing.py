"""Operator 5, best-fit packing by sum of squares.

Every document becomes its token ids and a closing id 0; only documents longer than a
sequence are cut.  Pieces are dealt to groups of about GROUP_PIECES pieces by a hash of
the document and of the piece's row number in a staged table, so that rows that share an
id, or have none, spread too, and each group is packed on its own, so the number of packing tasks grows
with the input and none holds more than one group; a group wastes a few sequences at
most.  Within a group pieces come in descending length.  The packer keeps, for every
residual gap, the number of open sequences that have it, and puts a piece where the sum
of the squares of these counts becomes smallest (ties: the smallest gap that fits).

Defined results: null text is empty and packs as the closing id alone; repeated rows
are packed each; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracorp.llm import hashing as H
from veracorp.llm.common import documents, stage, whole_text
from veracorp.llm.word_bpe import WordBpe

CAPACITY = 2048
END = b"\0\0\0\0"
GROUP_PIECES = 40_000
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_loaded: dict[str, WordBpe] = {}


def _coder(path: str) -> WordBpe:
    """The tokenizer of this Python worker; its table of words is bounded arrays of some 15 MB."""
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]


def _cut(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path)
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), [t.encode() for t in batch.column("text").to_pylist()]
            for lo, hi in H.chunks(texts):
                rows = []
                for doc, coded in zip(ids[lo:hi], coder.encode(texts[lo:hi])):
                    coded += END
                    for k, at in enumerate(range(0, len(coded), 4 * capacity)):
                        part = coded[at:at + 4 * capacity]
                        rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
                cols = list(zip(*rows))
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                                 names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(_cut(path, capacity), _PIECES)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of every piece, placed in the given order."""
    count = np.zeros(capacity + 1, np.int64)
    open_by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    seq, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    made = 0
    for k, s in enumerate(lengths.tolist()):
        best, gap = (2 * count[capacity - s] + 1, 0) if s < capacity else (0, 0)
        if s < capacity:
            fits = count[s + 1:capacity]
            change = np.where(fits > 0, 2 * (count[1:capacity - s] - fits) + 2, np.iinfo(np.int64).max)
            if len(change):
                i = int(change.argmin())
                if change[i] <= best:
                    best, gap = change[i], s + 1 + i
            if count[s] and 1 - 2 * count[s] <= best:
                gap = s
        if gap:
            number = open_by_gap[gap].pop()
            count[gap] -= 1
        else:
            number, gap, made = made, capacity, made + 1
        seq[k], offset[k] = number, capacity - gap
        if gap > s:
            open_by_gap[gap - s].append(number)
            count[gap - s] += 1
    return seq, offset


def _pack(capacity: int):
    def run(key, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        seq, offset = sum_of_squares(group["length"].to_numpy(), capacity)
        return group.assign(sequence_id=seq + (int(key[0]) << 40), offset=offset).drop(columns=["lot", "row"])
    return run


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces (with their fixed number, row) with sequence_id and offset."""
    lots = max(1, round(cut.count() / GROUP_PIECES))
    lot = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "row"), F.lit(lots)).cast("int")
    return (cut.withColumn("lot", lot).groupBy("lot")
            .applyInPandas(_pack(capacity), f"{_PIECES}, sequence_id long, offset long"))


def packed(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    path = path or public_tokenizers.path("word_bpe_49k.json")
    return pack(stage(pieces(docs, path, capacity).withColumn("row", F.monotonically_increasing_id()), "pieces"), capacity)


def stage_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document that is left, packed; a row per piece."""
    return packed(docs.select("doc_id", "text"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir).select("doc_id", "text"))


REGISTRY = {"op5_packing": op5_packing}
