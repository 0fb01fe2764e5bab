"""Task-side helpers of operator 6: texts cut into units, and the lattice's rows put together again.

All work on Arrow batches by arrays, a chunk of texts at a time.  A text's bytes are those of
its escaped form with one space for every U+2581, and one space before them.  It is cut between
two characters that stand side by side in no piece, of which one at least is ASCII: no edge and
no merge crosses such a place.  Units are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from veracorp.llm import hashing as H
from veracorp.llm.word_bpe import _gather

SPACE = "▁"
CHUNK = 2 << 20            # bytes of text whose units are told apart at once
# a code is 32-bit numbers as binary: Spark takes a time that grows with the square of a batch for arrays that are null in most rows
CUT_SCHEMA = "k int, unit string, doc_id long, text string, n_units long, code binary"
RUNS_SCHEMA = "doc_id long, text string, n_units long, runs array<struct<ids: array<int>, unit: string, edges: array<bigint>>>"


def cut_table(pieces: list[str]) -> np.ndarray:
    """For two bytes side by side, first * 256 + second: whether no piece spans them."""
    joined = np.zeros((256, 256), bool)
    joined[128:, 128:] = True

    def of(c: str) -> slice:
        b = 32 if c == SPACE else ord(c)
        return slice(b, b + 1) if b < 128 else slice(128, 256)

    for a, b in {p[i:i + 2] for p in pieces for i in range(len(p) - 1)}:
        joined[of(a), of(b)] = True
    return ~joined.ravel()


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of strings or binaries without nulls one after the other, and the place of each (one more)."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = texts.buffers()
    places = np.frombuffer(places, np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[places[0]:places[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, places - places[0]


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans [start, end) of ``data`` as strings."""
    size = ends - starts
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(_gather(data, starts, size))])


class Units:
    """The units of a chunk of texts: their spans, hashes, and which hold more than ``longest`` characters."""

    def __init__(self, texts: pa.Array, cut: np.ndarray, longest: int | None):
        texts = pc.replace_substring(texts, SPACE, " ")
        texts = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(" ", texts, "")).cast(pa.string())
        self.data, self.places = data, places = _bytes_of(texts)
        begin, space = np.zeros(len(data), bool), data == 32
        begin[1:] = cut[data[:-1].astype(np.uint16) << 8 | data[1:]]
        word = space.copy()                         # where a run of spaces starts
        word[1:] &= ~space[:-1]
        first = places[:-1][places[1:] > places[:-1]]
        begin[first] = word[first] = True
        self.n_words = np.diff(np.searchsorted(np.flatnonzero(word), places))
        starts = np.flatnonzero(begin)
        self.long = np.zeros(len(starts), bool)
        ends = np.append(starts[1:], len(data))
        if longest is not None and (ends - starts > longest).any():
            chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            many = chars[ends] - chars[starts] > longest
            of = np.cumsum(word[starts])            # the word that a unit is in; the library gets whole words
            whole = np.isin(of, of[many])
            kept = word[starts] | ~whole
            starts, self.long = starts[kept], whole[kept]
            ends = np.append(starts[1:], len(data))
        self.starts, self.ends = starts, ends
        self.hashes = H.spans(H.prefix(data), starts, ends)

    def strings(self, which: np.ndarray) -> pa.Array:
        return _strings(self.data, self.starts[which], self.ends[which])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of batches of about CHUNK bytes of text, one text at least."""
    for batch in batches:
        total = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
        start = 0
        while start < len(batch):
            done = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, done + CHUNK, "right")))
            yield batch.slice(start, end - start)
            start = end


def counting(cut: np.ndarray, longest: int | None):
    """text -> unit, n: the distinct units of every chunk, long ones left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            units = Units(chunk.column("text"), cut, longest)
            short = np.flatnonzero(~units.long)
            _, first, n = np.unique(units.hashes[short], return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([units.strings(short[first]), pa.array(n, pa.int64())], names=["unit", "n"])
    return run


def known_units(rows: list[tuple[str, list[int]]]) -> tuple[np.ndarray, ...]:
    """A table of units with their ids: hashes in order, place and number of the ids, all ids."""
    data, places = _bytes_of(pa.array([u for u, _ in rows], pa.string()))
    hashes = H.spans(H.prefix(data), places[:-1], places[1:])
    size = np.array([len(ids) for _, ids in rows], np.int64)
    order = np.argsort(hashes)
    return hashes[order], (np.cumsum(size) - size)[order], size[order], np.array([i for _, ids in rows for i in ids], np.int32)


def cutting(cut: np.ndarray, longest: int | None, table, whole_words):
    """doc_id, text -> CUT_SCHEMA, by chunks: first its distinct units that ``table`` (a broadcast of
    known_units) lacks, numbered k; then its documents, with a null k and a code: ids of units in the
    table or of long ones (by ``whole_words``), -2 - k for a unit k, and -1 at the end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, place, size, flat = table.value
        for chunk in _chunks(batches):
            units = Units(chunk.column("text"), cut, longest)
            at = np.searchsorted(known, units.hashes)
            hit = (np.append(known, np.uint64(0))[at] == units.hashes) & (at < len(known)) & ~units.long
            far, long = np.flatnonzero(~hit & ~units.long), np.flatnonzero(units.long)
            _, first, own = np.unique(units.hashes[far], return_index=True, return_inverse=True)
            coded = whole_words([u[1:] for u in units.strings(long).to_pylist()]) if len(long) else []
            pool = np.concatenate([flat, -2 - np.arange(len(first)), [i for ids in coded for i in ids], [-1]]).astype(np.int32)
            offset, count = np.empty(len(hit), np.int64), np.ones(len(hit), np.int64)
            offset[hit], count[hit] = place[at[hit]], size[at[hit]]
            offset[far] = len(flat) + own
            count[long] = [len(ids) for ids in coded]
            offset[long] = len(flat) + len(first) + np.cumsum(count[long]) - count[long]
            closed = np.searchsorted(units.starts, units.places[1:])
            count = np.insert(count, closed, 1)
            code = _gather(pool, np.insert(offset, closed, len(pool) - 1), count)
            ends = np.cumsum(count)[closed + np.arange(len(closed))]
            offsets = (4 * np.concatenate([[0], ends])).astype(np.int32)
            codes = pa.Array.from_buffers(pa.binary(), len(chunk), [None, pa.py_buffer(offsets), pa.py_buffer(code)])
            yield _batch(pa.array(np.arange(len(first)), pa.int32()), units.strings(far[first]), None, None, None, None)
            yield _batch(None, pa.array([""] * len(chunk)), chunk.column("doc_id"), chunk.column("text"), pa.array(units.n_words, pa.int64()), codes)
    return run


def _batch(*columns: pa.Array | None) -> pa.RecordBatch:
    types = [pa.int32(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    rows = next(len(c) for c in columns if c is not None)
    arrays = [pa.nulls(rows, t) if c is None else c for c, t in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=["k", "unit", "doc_id", "text", "n_units", "code"])


def gathering(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """k, edge, unit and the documents' columns, in the order that ``cutting`` gave -> RUNS_SCHEMA: a document
    as runs of ids, each followed by a unit with its edges (the last one by none)."""
    held, lattice = [], (pa.array([], pa.string()), pa.array([], pa.list_(pa.int64())))
    for batch in batches:
        document = batch.column("k").is_null().to_numpy(zero_copy_only=False)
        turns = (np.flatnonzero(document[1:] != document[:-1]) + 1).tolist()
        for a, b in zip([0, *turns], [*turns, len(batch)], strict=True):
            part = batch.slice(a, b - a)
            if b > a and not document[a]:
                held.append(part.select(["k", "edge", "unit"]))
            elif b > a:
                if held:
                    lattice, held = _lattice(pa.Table.from_batches(held)), []
                yield _runs(part, *lattice)


def _lattice(rows: pa.Table) -> tuple[pa.Array, pa.Array]:
    """The units k = 0, 1, ... and the edges of each."""
    k = rows.column("k").to_numpy()
    if (k[1:] < k[:-1]).any():
        order = np.argsort(k, kind="stable")
        rows, k = rows.take(order), k[order]
    names = rows.column("unit").combine_chunks().drop_null()       # on one row of every unit
    if len(names) != k[-1] + 1:
        raise ValueError(f"{k[-1] + 1} units, {len(names)} of them with a name")
    edges = pa.array(rows.column("edge").to_numpy())
    return names, pa.ListArray.from_arrays(pa.array(np.searchsorted(k, np.arange(len(names) + 1)), pa.int32()), edges)


def _runs(documents: pa.RecordBatch, names: pa.Array, edges: pa.Array) -> pa.RecordBatch:
    code, places = _bytes_of(documents.column("code"))
    flat = code.view(np.int32)
    stops = np.flatnonzero(flat < 0)
    ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], stops - np.arange(len(stops))]), pa.int32()), pa.array(flat[flat >= 0]))
    unit = -2 - flat[stops].astype(np.int64)
    unit = pa.array(unit, mask=unit < 0)
    runs = pa.StructArray.from_arrays([ids, names.take(unit), edges.take(unit)], ["ids", "unit", "edges"])
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.searchsorted(stops, places[1:] // 4)]), pa.int32()), runs)
    return pa.RecordBatch.from_arrays([*(documents.column(c) for c in ("doc_id", "text", "n_units")), lists],
                                      names=["doc_id", "text", "n_units", "runs"])
