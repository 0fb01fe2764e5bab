"""Operator 4, suffix-array dedup with linear grouping construction.

Pieces of text that can hold a repeated 100-byte string (see ``repeats``) are dealt to
shards.  The runs of windows that a shard's distinct pieces may share, equal runs once, are
joined into one text whose suffixes are sorted by grouping.  First, suffixes are grouped
by Lyndon prefix: groups are taken in descending order; each member finds its previous
smaller suffix by following the pointers of members already done, and those suffixes, whose Lyndon prefix grows by the group's, move to new
groups right behind their old ones, the more copies they gain the higher.  Then the order
inside the groups is emitted in one ascending pass: a suffix, once placed, places the
suffixes whose Lyndon prefix ends where it starts.  No step renames or recurses, and both
are linear.  In suffix order equal 100-byte strings are neighbours, and the first place of
such a run removes all others.

A piece that is the only distinct one under its anchor, and holds the anchor once, has no
second string to be sorted against: copies of it follow its first occurrence.

Defined results: null text is empty; matches never cross documents; rows that repeat an id
and text are one document, whose bytes do not remove each other across rows; null ids come
last; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracorp.llm import hashing as H
from veracorp.llm.common import documents
from veracorp.llm.repeats import RUNS, Spec, covered, identified, removed

WIDTH = 100
SPEC = Spec(words=False, width=WIDTH, k=20, shard_tokens=300_000, hot_tokens=3_000_000)


def lyndon_groups(text: list[int]) -> tuple[list[list[int]], array, array]:
    """The non-empty groups of suffixes by Lyndon prefix in ascending order, the number of
    every suffix's group and its previous smaller suffix (-1: none)."""
    n = len(text)
    rank = {c: i for i, c in enumerate(sorted(set(text)))}
    group = array("i", (rank[c] for c in text))
    members: list[list[int]] = [[] for _ in rank]
    for i, g in enumerate(group):
        members[g].append(i)
    # the groups' order, as a list linked both ways; -1 is beyond either end
    down, up = list(range(-1, len(rank) - 1)), [*range(1, len(rank)), -1]
    previous, done = array("i", [-1]) * n, bytearray(n)
    descending = []
    g = len(rank) - 1
    while g >= 0:
        moves: dict[tuple[int, int], list[int]] = {}     # (old group, copies gained) -> suffixes
        last, copies = -1, 0
        alive = [s for s in members[g] if group[s] == g]
        for s in alive:
            p = s - 1
            while p >= 0 and done[p]:
                p = previous[p]
            previous[s] = p
            done[s] = 1
            if p == last:
                copies += 1
            else:
                if last >= 0:
                    moves.setdefault((group[last], copies), []).append(last)
                last, copies = p, 1
        if last >= 0:
            moves.setdefault((group[last], copies), []).append(last)
        # more copies stand higher: put in from the most copies down, each right above the old group
        for old, copies in sorted(moves, reverse=True) if len(moves) > 1 else moves:
            moved = moves[old, copies]
            new = len(members)
            members.append(moved)
            above = up[old]
            down.append(old)
            up.append(above)
            up[old] = new
            down[above] = new
            for p in moved:
                group[p] = new
        if alive:
            members[g] = alive
            descending.append(g)
        g = down[g]
    place = {g: i for i, g in enumerate(reversed(descending))}
    return [members[g] for g in reversed(descending)], array("i", (place[g] for g in group)), previous


def suffix_array(text: list[int]) -> array:
    """Start positions of the suffixes of ``text`` in ascending order."""
    n = len(text)
    groups, group, previous = lyndon_groups(text)
    head, at = [], 0
    for g in groups:
        head.append(at)
        at += len(g)
    order = array("i", [0]) * n
    x = n - 1
    while x >= 0:                      # Lyndon prefixes that end with the text
        g = group[x]
        order[head[g]] = x
        head[g] += 1
        x = previous[x]
    for i in range(n):
        s = order[i]
        x, stop = s - 1, previous[s]
        while x != stop:               # Lyndon prefixes that end where suffix s starts
            g = group[x]
            order[head[g]] = x
            head[g] += 1
            x = previous[x]
    return order


def _alike(data: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether neighbours in suffix order have a common prefix of WIDTH or more: byte by byte, no hash takes part."""
    out = np.ones(len(a), bool)
    left = np.arange(len(a))
    for at in range(0, WIDTH, 20):      # neighbours that differ early leave early
        step = np.arange(at, min(at + 20, WIDTH))
        for lo in range(0, len(left), 1 << 16):
            some = left[lo:lo + (1 << 16)]
            out[some] = (data[a[some][:, None] + step] == data[b[some][:, None] + step]).all(axis=1)
        left = left[out[left]]
    return out


def _groups_of_windows(runs: list[bytes]) -> list[np.ndarray]:
    """For each of the distinct strings, a number per window: equal windows, equal numbers."""
    sizes = np.array([len(r) for r in runs])
    begin = np.cumsum(sizes + 1) - sizes - 1
    data = np.frombuffer(b"\0".join(runs), np.uint8)
    symbols = data.astype(np.int64) + 1
    symbols[begin[1:] - 1] = 0
    order = np.array(suffix_array(symbols.tolist()), np.int64)
    owner = np.repeat(np.arange(len(runs)), sizes + 1)[:len(data)]
    whole = np.arange(len(data)) - begin[owner] + WIDTH <= sizes[owner]        # a window starts here
    order = order[whole[order]]
    number = np.zeros(len(data), np.int64)
    number[order] = np.cumsum(np.concatenate([[False], ~_alike(data, order[:-1], order[1:])]))
    return [number[a:a + n - WIDTH + 1] for a, n in zip(begin.tolist(), sizes.tolist())]


def _solve(key, group: pd.DataFrame) -> pd.DataFrame:
    """RUNS of one shard: for each piece, where its windows occur first.

    Windows whose hash is unique in the shard occur nowhere else.  The maximal runs of
    the others, equal ones once, make the text whose suffixes are sorted; there the common
    prefixes of neighbours decide which windows are equal, so hashes that collide cost time only."""
    parts = group["part"].tolist()
    joined = b"\0".join(parts)
    sizes = np.array([len(p) for p in parts])
    begin = np.cumsum(sizes + 1) - sizes - 1
    owner = np.repeat(np.arange(len(parts)), sizes - WIDTH + 1)                # of every window
    shift = np.arange(len(owner)) - np.repeat(np.cumsum(sizes - WIDTH + 1) - (sizes - WIDTH + 1), sizes - WIDTH + 1)
    position = begin[owner] + shift
    doc, th, start = (group[c].to_numpy().astype(np.int64) for c in ("doc", "th", "start"))
    _, which, count = np.unique(H.grams(H.prefix(np.frombuffer(joined, np.uint8)), WIDTH)[position], return_inverse=True, return_counts=True)
    again = count[which] > 1
    number = np.arange(len(owner))
    opens, closes = again.copy(), again.copy()
    inner = again[1:] & again[:-1] & (owner[1:] == owner[:-1])
    opens[1:] &= ~inner
    closes[:-1] &= ~inner
    bounds = list(zip(np.flatnonzero(opens).tolist(), (np.flatnonzero(closes) + 1).tolist()))
    texts: dict[bytes, int] = {}
    named = [texts.setdefault(joined[position[a]:position[b - 1] + WIDTH], len(texts)) for a, b in bounds]
    if texts:
        numbers = _groups_of_windows(list(texts))
        for (a, b), name in zip(bounds, named):
            number[a:b] = len(owner) + numbers[name]
    # the first place of every group of equal windows
    by_place = np.lexsort((start[owner] + shift, th[owner], doc[owner]))
    _, first, of = np.unique(number[by_place], return_index=True, return_inverse=True)
    source = np.empty(len(owner), np.int64)
    source[by_place] = by_place[first[of]]
    f_doc, f_th, f_start = doc[owner[source]], th[owner[source]], start[owner[source]] + shift[source]
    change = np.ones(len(owner), bool)
    change[1:] = ((owner[1:] != owner[:-1]) | (f_doc[1:] != f_doc[:-1]) | (f_th[1:] != f_th[:-1])
                  | (f_start[1:] - shift[1:] != f_start[:-1] - shift[:-1]))
    cut = np.flatnonzero(change)
    runs: list[list[dict]] = [[] for _ in parts]
    for a, b in zip(cut.tolist(), np.append(cut[1:], len(owner)).tolist()):
        runs[owner[a]].append({"lo": int(shift[a]), "hi": int(shift[b - 1]) + 1, "doc": int(f_doc[a]), "th": int(f_th[a]), "start": int(f_start[a])})
    return pd.DataFrame({"anchor": group["anchor"], "phash": group["phash"], "runs": runs})


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            data = text.encode()
            if not spans:
                rows.append((len(data), 0, 0, hashlib.sha256(data).hexdigest()))
                continue
            gone = covered(len(data), spans)
            kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
            rows.append((len(data), len(data) - len(kept), int(np.sum(np.diff(gone.astype(np.int8), prepend=0) == 1)), hashlib.sha256(kept).hexdigest()))
        cols = list(zip(*rows)) if rows else [(), (), (), ()]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(cols, types)]],
                                         names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _earlier(run):
    """The run's first place lies before the occurrence that the row holds."""
    same = (run["doc"] == F.col("doc")) & (run["th"] == F.col("th"))
    return (run["doc"] < F.col("doc")) | (same & (run["start"] < F.col("start") + run["lo"]))


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 per row."""
    rows = identified(docs)
    spans = removed(rows, SPEC, lambda texts: texts.groupBy("shard").applyInPandas(_solve, RUNS),
                    simple="peers = 1 AND NOT loops", earlier=_earlier)
    return (rows.join(spans, ["doc", "th"], "left").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "spans")
            .mapInArrow(_kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(documents(spark, sf_dir).select("doc_id", "text"))


REGISTRY = {"op4_suffix_dedup": op4_suffix_dedup}
