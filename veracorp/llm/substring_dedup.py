"""Operator 9, substring dedup by suffix automata of reference shards.

The reference is the corpus's own repeated content: its distinct pieces (see
``repeats``), dealt to shards of bounded size by anchor.  Each shard becomes one suffix
automaton over words, whose states know the smallest doc_id in which their strings
occur.  Pieces stream through the automaton of their shard: the matching statistics give,
at every word, the longest earlier match, and follow suffix links down to the state that
holds the last WIDTH words, whose smallest doc_id is the window's first document.  A
document's words are removed where a window's first document comes before it.

The automaton of a shard is built in the task that its pieces stream through, from at
most ``shard_tokens`` words; documents that share a piece share its statistics.

Defined results: null and empty texts have no words; only documents of smaller doc_id
count, so repeats within one document and among rows of one id stay; null ids come last;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracorp.llm import hashing as H
from veracorp.llm.common import documents
from veracorp.llm.repeats import RUNS, Spec, covered, identified, removed

WIDTH = 13
SPEC = Spec(words=True, width=WIDTH, k=5, shard_tokens=100_000, hot_tokens=400_000)


class SuffixAutomaton:
    """Automaton of all substrings of the added word sequences."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.doc = [-1], [0], [1 << 63]

    def _state(self, length: int, doc: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        self.doc.append(doc)
        return len(self.next) - 1

    def _split(self, p: int, word, q: int) -> int:
        """A state for the strings of ``q`` up to the length that ``p`` reaches."""
        nxt, link = self.next, self.link
        clone = self._state(self.length[p] + 1, self.doc[q])
        nxt[clone] = dict(nxt[q])
        link[clone] = link[q]
        link[q] = clone
        while p >= 0 and nxt[p].get(word) == q:
            nxt[p][word] = clone
            p = link[p]
        return clone

    def add(self, words: list, doc: int) -> None:
        """Add one sequence that occurs in ``doc``."""
        nxt, link, length = self.next, self.link, self.length
        last = 0
        for word in words:
            q = nxt[last].get(word)
            if q is not None:       # the extended string is known
                if length[q] != length[last] + 1:
                    q = self._split(last, word, q)
                last = q
                self.doc[q] = min(self.doc[q], doc)
                continue
            new, p = self._state(length[last] + 1, doc), last
            while p >= 0 and word not in nxt[p]:
                nxt[p][word] = new
                p = link[p]
            if p >= 0:
                q = nxt[p][word]
                link[new] = q if length[q] == length[p] + 1 else self._split(p, word, q)
            last = new

    def close(self) -> None:
        """Smallest documents pass from longer strings to the shorter ones they end with."""
        doc, link = self.doc, self.link
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            if doc[s] < doc[link[s]]:
                doc[link[s]] = doc[s]

    def first_documents(self, words: list, width: int) -> list[int]:
        """For every window of ``words``, the smallest document that holds it."""
        nxt, link, length, doc = self.next, self.link, self.length, self.doc
        out, state, size = [], 0, 0
        for word in words:
            while state and word not in nxt[state]:
                state = link[state]
                size = length[state]
            if word in nxt[state]:
                state = nxt[state][word]
                size += 1
            if size >= width:
                while length[link[state]] >= width:    # the state of the last ``width`` words
                    state = link[state]
                size = width
                out.append(doc[state])
        return out


def _solve(key, group: pd.DataFrame) -> pd.DataFrame:
    """RUNS of one shard."""
    names: dict[bytes, int] = {}
    texts = [[names.setdefault(w, len(names)) for w in part.split()] for part in group["part"]]
    reference = SuffixAutomaton()
    for words, doc in zip(texts, group["doc"].tolist()):
        reference.add(words, doc)
    reference.close()
    out = []
    for words in texts:
        firsts = np.array(reference.first_documents(words, WIDTH), np.int64)
        cut = np.flatnonzero(np.diff(firsts)) + 1
        out.append([{"lo": int(a), "hi": int(b), "doc": int(firsts[a]), "th": 0, "start": 0}
                    for a, b in zip([0, *cut], [*cut, len(firsts)])])
    return pd.DataFrame({"anchor": group["anchor"], "phash": group["phash"], "runs": out})


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            words = text.encode().split()
            gone = covered(len(words), spans)
            kept = [w for w, g in zip(words, gone.tolist()) if not g] if spans else words
            rows.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
        cols = list(zip(*rows)) if rows else [(), (), ()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())],
                                         names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def substring_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 per row."""
    rows = identified(docs)
    spans = removed(rows, SPEC, lambda texts: texts.groupBy("shard").applyInPandas(_solve, RUNS),
                    simple=None, earlier=lambda run: run["doc"] < F.col("doc"))
    return (rows.join(spans, ["doc", "th"], "left").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "spans")
            .mapInArrow(_kept, "doc_id long, n_words long, n_removed long, kept_sha256 string"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(documents(spark, sf_dir).select("doc_id", "text"))


REGISTRY = {"op9_substring_dedup": op9_substring_dedup}

SQL = {"op9_substring_dedup": r"""
WITH w AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS ws FROM documents),
word AS (SELECT doc_id, unnest(ws) AS word, unnest(generate_series(1, len(ws))) AS i FROM w),
win AS (
  SELECT doc_id, i, min(doc_id) OVER (PARTITION BY array_to_string(list_slice(ws, i, i + 12), ' ')) < doc_id AS gone
  FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 12)) AS i FROM w WHERE len(ws) >= 13)),
flagged AS (
  SELECT word.doc_id, word.i, word, coalesce(max(gone::INT) OVER (PARTITION BY word.doc_id ORDER BY word.i
         ROWS BETWEEN 12 PRECEDING AND CURRENT ROW), 0) = 1 AS gone
  FROM word LEFT JOIN win ON win.doc_id = word.doc_id AND win.i = word.i),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept, count(*) FILTER (gone) AS n_removed
         FROM flagged GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""}
