"""Token ids of whole texts under a word-level BPE tokenizer file, distinct word by distinct word.

The tokenizer drops white space and never merges across it, so a text's ids are its
words' ids in order.  The words of a chunk of texts are told apart by 64-bit hashes, all at once;
words that are new are coded and go to a bounded table of arrays that lives as long as the
coder, and the ids of all words of the chunk are then gathered from it.  New words made of
lower-case Latin letters (ASCII and U+00C0 to U+00FF, a final period or comma allowed) are merged
together, all stems of one length as one array: in each round every word merges its
lowest-ranked pair, which is the order the tokenizer itself uses.  All other words go to the library.
"""

from __future__ import annotations

import json
import os

import numpy as np

from veracorp.llm import hashing as H

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

TABLE_WORDS = 400_000      # words the table holds before it is emptied
LONGEST = 32               # bytes of a stem; longer words go to the library
NO_PAIR = np.int64(1 << 40)


def _byte_characters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(plain))
    return out


class WordBpe:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        chars = _byte_characters()
        self.inner = np.array([vocab[chars[b]] for b in range(256)], np.int64)
        self.final = np.array([vocab[chars[b] + end] for b in range(256)], np.int64)
        self._empty()

    def _empty(self) -> None:
        """The table: hashes in order, and the place and number of each word's ids in ``flat``."""
        self.known, self.flat = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        self.place, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 20 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_PAIR)

    def _merge(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of one length, given as rows of bytes: (ids one after the other, number of ids of each)."""
        ids = self.inner[data]
        ids[:, -1] = self.final[data[:, -1]]
        rank = self._rank(ids[:, :-1], ids[:, 1:])
        rows, counts = np.arange(len(data)), np.zeros(len(data), np.int64)
        out = np.zeros(data.shape, np.uint32)
        while len(rows):
            if ids.shape[1] > 1:
                at = rank.argmin(axis=1)
                best = rank[np.arange(len(rows)), at]
                more = best < NO_PAIR
            else:
                more = np.zeros(len(rows), bool)
            done = rows[~more]
            out[done, :ids.shape[1]] = ids[~more]
            counts[done] = ids.shape[1]
            if not more.any():
                break
            rows, ids, rank, at, best = rows[more], ids[more], rank[more], at[more], best[more]
            column, each = np.arange(ids.shape[1] - 1), np.arange(len(rows))
            ids = np.where(column <= at[:, None], ids[:, :-1], ids[:, 1:])
            ids[each, at] = self.merged[best]
            if ids.shape[1] > 1:
                column = column[:-1]
                rank = np.where(column < at[:, None], rank[:, :-1], rank[:, 1:])
                left, right = at > 0, at < ids.shape[1] - 1
                rank[each[left], at[left] - 1] = self._rank(ids[each[left], at[left] - 1], ids[each[left], at[left]])
                rank[each[right], at[right]] = self._rank(ids[each[right], at[right]], ids[each[right], at[right] + 1])
        return out[np.arange(data.shape[1]) < counts[:, None]], counts

    def _stems(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids) of the stems [start, end) of ``data``, in their order."""
        sums = H.prefix(data)
        _, first, own = np.unique(H.spans(sums, starts, ends), return_index=True, return_inverse=True)
        size = (ends - starts)[first]
        counts, parts, order = np.zeros(len(first), np.int64), [], []
        for width in np.unique(size):
            group = np.flatnonzero(size == width)
            ids, n = self._merge(data[starts[first[group]][:, None] + np.arange(width)])
            counts[group] = n
            parts.append(ids)
            order.append(group)
        order, flat = np.concatenate(order), np.concatenate(parts)
        offset = np.empty(len(first), np.int64)
        offset[order] = np.cumsum(counts[order]) - counts[order]
        return _gather(flat, offset[own], counts[own]), counts[own]

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> None:
        """Add the words [start, end) of ``data``, which the table lacks."""
        size = ends - starts
        data, ends = _gather(data, starts, size), np.cumsum(size)       # their bytes alone
        starts = ends - size
        low, letter = _lowered(data)
        odd = np.concatenate([[0], np.cumsum(~letter)])
        tail = np.isin(data[ends - 1], (44, 46)) & (ends - starts > 1)
        stem_ends = ends - tail
        plain = (odd[stem_ends] == odd[starts]) & (stem_ends - starts <= LONGEST)
        flat, counts = [], np.zeros(len(starts), np.int64)
        if plain.any():
            ids, n = self._stems(low, starts[plain], stem_ends[plain])
            marked = tail[plain]
            total = n + marked
            at = np.cumsum(total) - total
            joined = np.empty(total.sum(), np.uint32)
            joined[np.repeat(at - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
            joined[(at + n)[marked]] = self.final[data[ends[plain][marked] - 1]]
            flat.append(joined)
            counts[plain] = total
        other = np.flatnonzero(~plain)
        if len(other):
            blob = data.tobytes()
            coded = self.tokenizer.encode_batch_fast([blob[a:b].decode() for a, b in zip(starts[other].tolist(), ends[other].tolist())], add_special_tokens=False)
            counts[other] = [len(e.ids) for e in coded]
            flat.append(np.array([i for e in coded for i in e.ids], np.uint32))
        order = np.concatenate([np.flatnonzero(plain), other])
        offset = np.empty(len(starts), np.int64)
        offset[order] = len(self.flat) + np.cumsum(counts[order]) - counts[order]
        self.flat = np.concatenate([self.flat, *flat])
        at = np.searchsorted(self.known, hashes)      # both are in order
        self.known, self.place, self.size = np.insert(self.known, at, hashes), np.insert(self.place, at, offset), np.insert(self.size, at, counts)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of every text as little-endian 32-bit numbers."""
        hashes, starts, ends, first, _ = H.words_of(texts)
        if not len(hashes):
            return [b""] * len(texts)
        if len(self.known) > TABLE_WORDS:
            self._empty()
        found, at, own = np.unique(hashes, return_index=True, return_inverse=True)
        new = ~np.isin(found, self.known, assume_unique=True)
        if new.any():
            data = np.frombuffer(b" ".join(texts), np.uint8)
            self._learn(data, starts[at[new]], ends[at[new]], found[new])
        row = np.searchsorted(self.known, found)[own]
        size = self.size[row]
        ids = _gather(self.flat, self.place[row], size).astype("<u4", copy=False).tobytes()
        edges = 4 * np.concatenate([[0], np.cumsum(size)])[first]
        return [ids[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]


def _gather(flat: np.ndarray, offset: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs [offset, offset + size) of ``flat`` one after the other."""
    ends = np.cumsum(size)
    return flat[np.repeat(offset - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]


def _lowered(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of words in lower case, and which of them belong to Latin letters up to U+00FF."""
    low = data.copy()
    low[(data >= 65) & (data <= 90)] += 32
    lead = data == 0xC3                       # U+00C0 to U+00FF; U+00D7 and U+00F7 are no letters
    follows = np.zeros(len(data), bool)
    follows[1:] = lead[:-1]
    low[follows & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)] += 32
    sound = follows & (data != 0x97) & (data != 0xB7)
    letter = ((low >= 97) & (low <= 122)) | sound
    letter[:-1] |= lead[:-1] & sound[1:]
    return low, letter
