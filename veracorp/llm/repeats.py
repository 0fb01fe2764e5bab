"""Repeated windows across a corpus: what operators 4 and 9 share.

A window is ``width`` consecutive tokens (bytes or words) of one document.  Every window
has an anchor, the smallest hash of its ``k``-token grams; equal windows have equal
anchors.  A piece is a maximal run of windows with one anchor.  Only pieces whose anchor
occurs again can hold a repeated window: the others, nearly all of a corpus, leave here.
Equal pieces collapse to one, with the place of their first occurrence; an operator then
works out, for each distinct piece, where each of its windows occurs first.  As all
windows that can be equal share an anchor, anchors are a complete routing: they are
dealt to shards of bounded size and shards are independent.

An anchor whose distinct pieces are more than a task's memory takes (the edge of a
passage that a large share of documents holds, or very long pieces) is no shard's: its
windows are grouped one by one by their hash, with partial aggregation, which has no
large group.

Places are ordered by (doc_id, text hash, start); null ids come last.  Rows that repeat an
id count as one document where the texts are equal.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracorp.llm import hashing as H
from veracorp.llm.common import stage, whole_text

LAST_ID = 2**63 - 1
PIECE = "anchor long, phash long, doc long, th int, start int, n int, again boolean"


@dataclass(frozen=True)
class Spec:
    words: bool           # tokens are words, else bytes
    width: int            # tokens per window
    k: int                # tokens per gram of the anchor
    shard_tokens: int     # tokens of distinct pieces per shard
    hot_tokens: int       # most tokens of one anchor's distinct pieces that a task's memory takes


def identified(docs: DataFrame) -> DataFrame:
    """doc (null ids last), th (text hash), text, doc_id."""
    text = whole_text()
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc"),
                       F.hash(text).alias("th"), text.alias("text"), F.col("doc_id"))


def _tokens(texts: list[bytes], words: bool) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums over the tokens of all texts, and the first token of each."""
    if words:
        h, _, _, first, _ = H.words_of(texts)
        return H.prefix_of(h), first
    first = np.cumsum([0] + [len(t) for t in texts])
    return H.prefix(np.frombuffer(b"".join(texts), np.uint8)), first


def _pieces(spec: Spec):
    w = spec.width - spec.k + 1

    def of(texts: list[bytes]):
        sums, first = _tokens(texts, spec.words)
        grams = H.grams(sums, spec.k)
        low = H.sliding_minimum(grams, w)
        if not len(low):
            return None
        # windows that cross texts belong to none
        sizes = np.maximum(np.diff(first) - spec.width + 1, 0)
        inside = np.zeros(len(low) + 1, np.int64)
        for a, n in zip(first[:-1][sizes > 0], sizes[sizes > 0]):
            inside[a] += 1
            inside[a + n] -= 1
        inside = np.cumsum(inside[:-1]) > 0
        new = inside.copy()
        new[1:] &= (low[1:] != low[:-1]) | ~inside[:-1]
        new[first[:-1][sizes > 0]] = True
        start = np.flatnonzero(new)
        if not len(start):
            return None
        text = np.searchsorted(first, start, side="right") - 1
        stop = np.minimum(np.append(start[1:], len(low)), first[text] + sizes[text])
        n, anchor = stop - start, low[start]
        phash = H.spans(sums, start, stop - 1 + spec.width)
        # does the anchor's gram occur twice within the piece?
        reach = n + w - 1
        offset = np.cumsum(reach) - reach
        at = np.arange(reach.sum()) - np.repeat(offset - start, reach)
        again = np.add.reduceat((grams[at] == np.repeat(anchor, reach)).astype(np.int64), offset) > 1
        return text, anchor, phash, start - first[text], n, again

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            docs, ths = batch.column("doc").to_numpy(zero_copy_only=False), batch.column("th").to_numpy(zero_copy_only=False)
            for lo, hi in H.chunks(texts):
                found = of(texts[lo:hi])
                if found is None:
                    continue
                text, anchor, phash, start, n, again = found
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(phash.view(np.int64)), pa.array(docs[lo + text]), pa.array(ths[lo + text]),
                     pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(again)],
                    names=["anchor", "phash", "doc", "th", "start", "n", "again"])
    return run


def pieces(docs: DataFrame, spec: Spec) -> DataFrame:
    return docs.select("doc", "th", "text").mapInArrow(_pieces(spec), PIECE)


def candidates(docs: DataFrame, spec: Spec) -> DataFrame:
    """Pieces whose anchor occurs again, in another piece or in the same.  Pieces are staged, so that
    the texts are gone through once and the count reads two of their columns."""
    found = stage(pieces(docs, spec), "all-pieces")
    shared = (found.groupBy("anchor").agg(F.count("*").alias("rows"), F.max("again").alias("again"))
              .where("rows > 1 OR again").select("anchor"))
    return found.join(shared, "anchor")


def distinct(cand: DataFrame) -> DataFrame:
    """One row per distinct piece: first (doc, th, start), n, again, and what its anchor holds."""
    one = cand.groupBy("anchor", "phash").agg(F.min(F.struct("doc", "th", "start")).alias("first"), F.max("n").alias("n"), F.max("again").alias("again"))
    one = stage(one, "distinct-pieces")
    load = one.groupBy("anchor").agg(F.count("*").alias("peers"), F.sum("n").alias("windows"), F.max("again").alias("loops"))
    return one.drop("again").join(load, "anchor")


def _cut_texts(spec: Spec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, doc, th, wanted in zip(*(batch.column(c).to_pylist() for c in ("text", "doc", "th", "wanted"))):
                data = text.encode()
                if spec.words:
                    starts, ends = H.word_bounds(np.frombuffer(data, np.uint8))
                for w in wanted:
                    a, b = w["start"], w["start"] + w["n"] - 1 + spec.width
                    part = data[starts[a]:ends[b - 1]] if spec.words else data[a:b]
                    out.append((w["anchor"], w["phash"], doc, th, a, w["n"], w["shard"], part))
                if len(out) > 20_000:
                    yield _text_batch(out)
                    out = []
            if out:
                yield _text_batch(out)
    return run


_TEXT = pa.schema([("anchor", pa.int64()), ("phash", pa.int64()), ("doc", pa.int64()), ("th", pa.int32()),
                   ("start", pa.int32()), ("n", pa.int32()), ("shard", pa.int32()), ("part", pa.binary())])


def _text_batch(rows):
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _TEXT)], schema=_TEXT)


def with_texts(docs: DataFrame, needed: DataFrame, spec: Spec) -> DataFrame:
    """The needed distinct pieces with their bytes, cut from their first documents."""
    wanted = (needed.select("first.doc", "first.th", F.struct("first.start", "n", "anchor", "phash", "shard").alias("w"))
              .groupBy("doc", "th").agg(F.collect_list("w").alias("wanted")))
    texts = docs.select("doc", "th", "text").join(wanted, ["doc", "th"])
    texts = texts.select("text", "doc", "th", "wanted")
    cut = texts.mapInArrow(_cut_texts(spec), "anchor long, phash long, doc long, th int, start int, n int, shard int, part binary")
    return cut


def _windows(spec: Spec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "phash", "doc", "th", "start", "n")]
            for r, part in enumerate(batch.column("part").to_pylist()):
                sums, _ = _tokens([part], spec.words)
                h = H.grams(sums, spec.width)
                anchor, phash, doc, th, start, n = (c[r] for c in cols)
                at = np.arange(n, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, anchor)), pa.array(np.full(n, phash)), pa.array(np.full(n, doc)), pa.array(np.full(n, th)),
                     pa.array((start + at).astype(np.int32)), pa.array(at), pa.array(h.view(np.int64))],
                    names=["anchor", "phash", "doc", "th", "start", "at", "window"])
    return run


RUNS = "anchor long, phash long, runs array<struct<lo:int,hi:int,doc:long,th:int,start:int>>"


def hot_runs(texts: DataFrame, spec: Spec) -> DataFrame:
    """RUNS of the pieces that no shard takes: windows one by one, grouped by hash."""
    rows = stage(texts.mapInArrow(_windows(spec), "anchor long, phash long, doc long, th int, start int, at int, window long"), "hot-windows")
    firsts = rows.groupBy("anchor", "window").agg(F.min(F.struct("doc", "th", "start")).alias("first"))
    told = rows.select("anchor", "phash", "at", "window").join(firsts, ["anchor", "window"]).select(
        "anchor", "phash", "at", "first.doc", "first.th", (F.col("first.start") - F.col("at")).alias("shift"))
    # windows at one distance from their first places, without gaps, are one run
    from pyspark.sql import Window

    same = ["anchor", "phash", "doc", "th", "shift"]
    island = F.col("at") - F.row_number().over(Window.partitionBy(*same).orderBy("at"))
    runs = (told.withColumn("island", island).groupBy(*same, "island").agg(F.min("at").alias("lo"), (F.max("at") + 1).alias("hi"))
            .select("anchor", "phash", F.struct("lo", "hi", "doc", "th", (F.col("shift") + F.col("lo")).alias("start")).alias("run")))
    return runs.groupBy("anchor", "phash").agg(F.collect_list("run").alias("runs"))


def shards(needed: DataFrame, spec: Spec) -> DataFrame:
    """Deal whole anchors to shards of about ``shard_tokens`` tokens."""
    total = needed.agg(F.sum(F.col("n") + spec.width)).first()[0] or 0
    count = max(1, -(-total // spec.shard_tokens))
    return needed.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(count)).cast("int"))


def removed(docs: DataFrame, spec: Spec, solve: Callable[[DataFrame], DataFrame], simple: str | None, earlier) -> DataFrame:
    """doc, th, spans: token spans [lo, hi) of every document that windows with an earlier
    occurrence cover.  ``solve`` turns pieces with texts into RUNS, shard by shard;
    ``simple`` is SQL for distinct pieces that need no solving as all their windows
    occur first where the piece does; ``earlier(run)`` says if a run lies before the
    occurrence (columns doc, th, start)."""
    cand = stage(candidates(docs, spec), "candidate-pieces")
    every = stage(distinct(cand), "pieces")
    hot = f"(windows + peers * {spec.width - 1} > {spec.hot_tokens})"
    easy = f"NOT {hot} AND ({simple})" if simple else "false"
    todo = shards(every.where(f"NOT {hot} AND NOT ({easy})"), spec)
    todo = todo.unionByName(every.where(hot).withColumn("shard", F.lit(-1)))
    texts = stage(with_texts(docs, todo, spec), "piece-texts")
    runs = solve(texts.where("shard >= 0")).unionByName(hot_runs(texts.where("shard < 0"), spec))
    if simple:
        whole = F.array(F.struct(F.lit(0).alias("lo"), F.col("n").alias("hi"), F.col("first.doc").alias("doc"),
                                 F.col("first.th").alias("th"), F.col("first.start").alias("start")))
        runs = runs.unionByName(every.where(easy).select("anchor", "phash", whole.alias("runs")))
    runs = stage(runs, "runs")
    hits = (cand.select("anchor", "phash", "doc", "th", "start").join(runs, ["anchor", "phash"])
            .select("doc", "th", "start", F.explode("runs").alias("run")).where(earlier(F.col("run"))))
    span = F.struct((F.col("start") + F.col("run.lo")).alias("lo"), (F.col("start") + F.col("run.hi") - 1 + spec.width).alias("hi"))
    return stage(hits.groupBy("doc", "th").agg(F.collect_list(span).alias("spans")), "removed-spans")


def covered(n: int, spans: list[dict]) -> np.ndarray:
    """Which of ``n`` tokens the spans cover."""
    edge = np.zeros(n + 1, np.int64)
    if spans:
        np.add.at(edge, [s["lo"] for s in spans], 1)
        np.add.at(edge, [s["hi"] for s in spans], -1)
    return np.cumsum(edge[:-1]) > 0
