"""Vectorised word splitting and hashing of Arrow string batches.

Words are maximal runs of bytes accepted by a 256-entry table.  Every separator
used here is ASCII, so working on UTF-8 bytes gives the same words as working on
code points.  Work is done in pieces of about one megabyte, so the memory of a
task follows the largest single text, not the number of rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LONG = 64                                   # longer words are hashed one by one
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POW = np.cumprod(np.full(_LONG, 0x9E3779B97F4A7C15 | 1, dtype=np.uint64))

IDENTITY = np.arange(256, dtype=np.uint8)
LOWER = IDENTITY.copy()
LOWER[65:91] += 32                           # A-Z only

# Any byte but space and the six control characters 0x09-0x0D.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, 9, 10, 11, 12, 13]] = False

# ASCII letters, and every byte of a multi-byte character.
LETTERS = np.zeros(256, dtype=bool)
LETTERS[65:91] = LETTERS[97:123] = LETTERS[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over a 64-bit word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def texts(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 text boundaries; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0]:bounds[-1]], bounds - bounds[0]


def pieces(bounds: np.ndarray, size: int = 1 << 20):
    """Ranges of consecutive texts holding about ``size`` bytes (one text at least)."""
    i, n = 0, len(bounds) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + size, "right")) - 1)
        yield i, j
        i = j


def spans(data: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end bytes of the words, and for each text the index of its first word
    (n + 1 entries).  A word never crosses a text boundary."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    inside = table[data]
    after = np.empty_like(inside)             # is the byte before part of the same word?
    after[0] = False
    after[1:] = inside[:-1]
    cuts = bounds[:-1][bounds[:-1] < len(data)]
    after[cuts] = False
    starts = np.flatnonzero(inside & ~after)
    after[:-1] = inside[1:]                   # now: is the byte behind?
    after[-1] = False
    after[cuts[cuts > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray = IDENTITY) -> np.ndarray:
    """A 64-bit hash of every word after mapping its bytes through ``fold``."""
    out = np.empty(len(starts), np.uint64)
    lens = ends - starts
    total = np.concatenate([[0], np.cumsum(lens)])
    k = 0
    while k < len(starts):
        e = max(k + 1, int(np.searchsorted(total, total[k] + (1 << 18), "right")) - 1)
        ln, cum = lens[k:e], total[k:e] - total[k]
        if e == k + 1 and ln[0] > _LONG:
            out[k] = 0
        else:
            pos = np.arange(total[e] - total[k])
            inner = pos - np.repeat(cum, ln)
            b = fold[data[np.repeat(starts[k:e], ln) + inner]]
            out[k:e] = np.add.reduceat(_BYTE[b] * _POW[np.minimum(inner, _LONG - 1)], cum) + ln.astype(np.uint64)
        k = e
    for i in np.flatnonzero(lens > _LONG):
        word = fold[data[starts[i]:ends[i]]].tobytes()
        out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return mix(out)


def hash_words(words: list[bytes]) -> np.ndarray:
    """The same hashes for a list of separate words."""
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words], dtype=np.int64)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    return hashes(data, starts, ends) if words else np.zeros(0, np.uint64)


def code_points(data: np.ndarray) -> np.ndarray:
    """Prefix counts of code points: entry i is how many begin before byte i."""
    return np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
