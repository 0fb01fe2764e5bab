"""Vectorised hashing of byte and word sequences, used inside tasks.

Hashes are polynomial over a fixed random table, modulo 2**64, with a final
mix; they depend on the bytes alone, so every executor computes the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_U = np.uint64
_GOLDEN = _U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of SplitMix64."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def numbers(seed: int, n: int) -> np.ndarray:
    """``n`` fixed random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix(_U(seed) * _GOLDEN + np.arange(1, n + 1, dtype=np.uint64) * _GOLDEN)


BASE = 0x5851F42D4C957F2D
_INVERSE = pow(BASE, -1, 1 << 64)
_TABLE = numbers(11, 256)
_LOWER = _TABLE.copy()
_LOWER[65:91] = _TABLE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grow(n: int) -> None:
    """Powers of the base and of its inverse up to exponent ``n``."""
    for k, base in enumerate((BASE, _INVERSE)):
        p = _powers[k]
        while len(p) <= n:
            p = np.concatenate([p, p * _U(pow(base, len(p), 1 << 64))])
        _powers[k] = p


def prefix(data: np.ndarray, lower: bool = False) -> np.ndarray:
    """Prefix sums of the polynomial over ``data`` (uint8); one longer than it."""
    _grow(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER if lower else _TABLE)[data] * _powers[0][:len(data)], out=out[1:])
    return out


def prefix_of(values: np.ndarray) -> np.ndarray:
    """``prefix`` over a sequence of 64-bit hashes, such as the words of a text."""
    _grow(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers[0][:len(values)], out=out[1:])
    return out


def spans(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the subsequences [start, end)."""
    h = (sums[ends] - sums[starts]) * _powers[1][starts]
    return mix(h ^ (ends - starts).astype(np.uint64) * _GOLDEN)


def grams(sums: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all subsequences of length ``k``."""
    n = len(sums) - k
    if n <= 0:
        return np.zeros(0, np.uint64)
    return mix((sums[k:] - sums[:n]) * _powers[1][:n])


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs free of ASCII white space."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~_SPACE[data]
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def chunks(texts: list[bytes], size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Slices of ``texts`` of about ``size`` bytes, one text at least."""
    start = total = 0
    for i, t in enumerate(texts):
        if total and total + len(t) > size:
            yield start, i
            start, total = i, 0
        total += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def words_of(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of several texts at once: (hashes, starts, ends in the joined bytes,
    first word of each text, start of each text in the joined bytes); the first-word
    array has one closing entry."""
    joined = b" ".join(texts)
    data = np.frombuffer(joined, np.uint8)
    begin = np.cumsum([0] + [len(t) + 1 for t in texts])
    starts, ends = word_bounds(data)
    h = spans(prefix(data, lower), starts, ends)
    return h, starts, ends, np.searchsorted(starts, begin), begin[:-1]


def sliding_minimum(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values (block prefix and suffix minima)."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    blocks = -(-len(x) // w)
    padded = np.full(blocks * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(x)] = x
    grid = padded.reshape(blocks, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1:w - 1 + n])
