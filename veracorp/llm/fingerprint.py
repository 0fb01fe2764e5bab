"""Operator 10, document fingerprints: invertible Bloom lookup sketches.

A text is cut into paragraphs at line ends and after words whose hash is divisible
by CUT, so that the cuts depend on the words alone and an edit moves none but its own.
Every paragraph's digest, numbered among equal ones, is added to three cells of the
sketch (count, key sum, check sum).  The sketches of two versions are subtracted cell
by cell; cells left with one key are peeled until none remain, which recovers the
digests found in one version only.  Where peeling gets stuck both texts are sketched
anew with four times the cells.  Likeness is 1 - differing / (all paragraphs of both).

A document's successor is found by range: ids are dealt to buckets by quantiles, and
each bucket is given one guest row, the first of the next bucket (the last bucket gets
the first row of all).  Only one row per bucket moves twice.

Defined results: null text is empty; texts without words have no paragraphs and are
alike (1.0) if both have none; a single row succeeds itself; null ids come last, rows
of one id in text order; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracorp.llm import hashing as H
from veracorp.llm.common import documents, whole_text

CUT = 4
CELLS = 24                 # of the stored fingerprint; retries use 4, 16, ... times as many
BUCKETS_PER_PARTITION = 4
_U = np.uint64
_SALT = H.numbers(31, 3)


def paragraph_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Digest of every paragraph, numbered among equal ones of its text; offsets by text."""
    words, starts, ends, first, _ = H.words_of(texts)
    if not len(words):
        return words, np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(b" ".join(texts), np.uint8)
    lines = np.cumsum(data == 10)
    last = (words % _U(CUT)) == 0
    last[:-1] |= lines[starts[1:]] > lines[ends[:-1] - 1]
    closing = first[1:][first[1:] > first[:-1]] - 1     # a text's last word closes its last paragraph
    last[closing] = True
    stop = np.flatnonzero(last) + 1
    begin = np.concatenate([[0], stop[:-1]])
    digest = H.spans(H.prefix_of(words), begin, stop)
    offsets = np.searchsorted(begin, first)
    text = np.searchsorted(offsets, np.arange(len(digest)), side="right")
    order = np.lexsort((digest, text))
    d, t = digest[order], text[order]
    fresh = np.concatenate([[True], (d[1:] != d[:-1]) | (t[1:] != t[:-1])])
    run = np.arange(len(d)) - np.maximum.accumulate(np.where(fresh, np.arange(len(d)), 0))
    keys = np.empty_like(d)
    keys[order] = H.mix(d + run.astype(np.uint64) * _U(H.BASE))
    return keys, offsets


def _check(keys: np.ndarray) -> np.ndarray:
    return H.mix(keys ^ _U(0xA5A5A5A5A5A5A5A5)) >> _U(32)


def _cells_of(keys: np.ndarray, row: np.ndarray, cells: int) -> np.ndarray:
    """(3, n) cell numbers: one in each third of the row's cells."""
    third = cells // 3
    return np.stack([row * cells + j * third + (H.mix(keys + _SALT[j]) % _U(third)).astype(np.int64)
                     for j in range(3)])


class Sketch:
    """Sketches of several texts side by side: count, key sum and check sum per cell."""

    def __init__(self, keys: np.ndarray, offsets: np.ndarray, cells: int):
        rows = len(offsets) - 1
        self.cells, self.rows = cells, rows
        self.count = np.zeros(rows * cells, np.int64)
        self.key = np.zeros(rows * cells, np.uint64)
        self.check = np.zeros(rows * cells, np.uint64)
        row = np.repeat(np.arange(rows), np.diff(offsets))
        self._add(keys, row, np.ones(len(keys), np.int64))

    def _add(self, keys, row, sign):
        times = sign.astype(np.uint64)       # -1 is 2**64 - 1, which subtracts
        for at in _cells_of(keys, row, self.cells):
            np.add.at(self.count, at, sign)
            np.add.at(self.key, at, keys * times)
            np.add.at(self.check, at, _check(keys) * times)

    def minus(self, other: Sketch) -> Sketch:
        out = object.__new__(Sketch)
        out.cells, out.rows = self.cells, self.rows
        out.count, out.key, out.check = self.count - other.count, self.key - other.key, self.check - other.check
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Digests recovered (row, key) and which rows came apart completely; empties the cells."""
        got_rows, got_keys = [], []
        look = np.flatnonzero(np.abs(self.count) == 1)
        while len(look):
            sign = self.count[look]
            keys = self.key[look] * sign.astype(np.uint64)
            pure = (np.abs(sign) == 1) & (_check(keys) == self.check[look] * sign.astype(np.uint64))
            look, sign, keys = look[pure], sign[pure], keys[pure]
            row = look // self.cells
            _, one = np.unique(keys ^ H.mix(row.astype(np.uint64)), return_index=True)
            keys, row, sign = keys[one], row[one], sign[one]
            if not len(keys):
                break
            got_rows.append(row)
            got_keys.append(keys)
            self._add(keys, row, -sign)
            look = np.unique(_cells_of(keys, row, self.cells))
            look = look[np.abs(self.count[look]) == 1]
        left = (self.count != 0) | (self.key != 0) | (self.check != 0)
        done = ~left.reshape(self.rows, self.cells).any(axis=1)
        empty = np.zeros(0, np.int64)
        return (np.concatenate(got_rows) if got_rows else empty, np.concatenate(got_keys) if got_keys else empty.view(np.uint64), done)

    def strings(self, offsets: np.ndarray) -> list[str]:
        """Each sketch as text: number of paragraphs, then counts, key sums and check sums."""
        shape = (self.rows, self.cells)
        parts = [np.diff(offsets).astype("<u4").reshape(-1, 1).view(np.uint8), self.count.reshape(shape).astype("<i4").view(np.uint8),
                 self.key.reshape(shape).astype("<u8").view(np.uint8), self.check.reshape(shape).astype("<u4").view(np.uint8)]
        return [base64.b64encode(x.tobytes()).decode() for x in np.hstack(parts)]


def _take(keys, offsets, rows):
    sizes = np.diff(offsets)[rows]
    out = np.concatenate([[0], np.cumsum(sizes)])
    index = np.repeat(offsets[rows] - out[:-1], sizes) + np.arange(out[-1])
    return keys[index], out


def differing(a: tuple, b: tuple) -> np.ndarray:
    """Number of digests in one version only, for each pair of texts of ``a`` and ``b``."""
    out = np.zeros(len(a[1]) - 1, np.int64)
    todo, cells = np.arange(len(out)), CELLS
    while len(todo):
        x, y = _take(*a, todo), _take(*b, todo)
        rows, _, done = Sketch(*x, cells).minus(Sketch(*y, cells)).peel()
        found = np.bincount(rows, minlength=len(todo))
        out[todo[done]] = found[done]
        todo, cells = todo[~done], cells * 4
    return out


def likeness(a: tuple, b: tuple) -> np.ndarray:
    total = np.diff(a[1]) + np.diff(b[1])
    return 1 - np.divide(differing(a, b), total, out=np.zeros(len(total)), where=total > 0)


def _rows(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in ("bucket", "guest", "doc_id", "text")))


def _pairs(batches):
    """(doc_id, text, next text) of the rows that are no guests."""
    held = None
    for row in _rows(batches):
        if held is not None and not held[1]:
            yield held[2], held[3], row[3]
        held = row


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    group, size = [], 0

    def flush():
        ids = [g[0] for g in group]
        edited = [t[:len(t) - len(t) // 3] + n[:len(t) // 3] for _, t, n in group]
        coded = [e.encode() for e in edited]
        own, alt, nxt = (paragraph_keys(x) for x in ([g[1].encode() for g in group], coded, [g[2].encode() for g in group]))
        return pa.RecordBatch.from_pydict({
            "doc_id": pa.array(ids, pa.int64()),
            "n_chars": pa.array([len(g[1]) for g in group], pa.int64()),
            "edited_sha256": [hashlib.sha256(c).hexdigest() for c in coded],
            "fingerprint": Sketch(*own, CELLS).strings(own[1]),
            "edited_fingerprint": Sketch(*alt, CELLS).strings(alt[1]),
            "near_edited": likeness(own, alt), "near_next": likeness(own, nxt)})

    for row in _pairs(batches):
        group.append(row)
        size += len(row[1]) + 1
        if size >= 1 << 19:
            yield flush()
            group, size = [], 0
    if group:
        yield flush()


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next per row."""
    spark = docs.sparkSession
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-2**63))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"), key.alias("key"))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))) * BUCKETS_PER_PARTITION
    cuts = rows.agg(F.percentile_approx("key", [i / parts for i in range(1, parts)], 10000)).first()[0] or []
    cuts = sorted(set(cuts), reverse=True)
    bucket = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c > F.col("key"))) if cuts else F.lit(0)
    rows = rows.withColumn("bucket", bucket)
    heads = [tuple(r) for r in rows.groupBy("bucket").agg(F.max("key")).orderBy("bucket").collect()]  # a row per bucket
    if not heads:
        heads = [(0, 0)]
    gets = [(heads[i][0], heads[(i + 1) % len(heads)][1]) for i in range(len(heads))]
    wanted = spark.createDataFrame(gets, "bucket int, key long")
    first = (rows.drop("bucket").join(F.broadcast(wanted.select("key").distinct()), "key", "left_semi")
             .groupBy("key").agg(F.min("text").alias("text")))
    guests = wanted.join(first, "key").select(F.lit(None).cast("long").alias("doc_id"), "text", "key", "bucket", F.lit(True).alias("guest"))
    dealt = (rows.withColumn("guest", F.lit(False)).unionByName(guests)
             .repartition("bucket").sortWithinPartitions("bucket", "guest", F.desc("key"), "text"))
    return dealt.select("bucket", "guest", "doc_id", "text").mapInArrow(
        _fingerprints, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                       "near_edited double, near_next double")


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir).select("doc_id", "text"))


REGISTRY = {"op10_fingerprints": op10_fingerprints}
