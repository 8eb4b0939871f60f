"""Whole Arrow batches of text as byte arrays: word and line spans, hashes, repeats.

Small numpy helpers for functions that Spark calls with Arrow batches. A word is a run
of bytes other than space and tab to carriage return (``[^\\x20\\x09-\\x0D]+``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of the splitmix64 generator: a bijection that scatters 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _MIX_1
    x ^= x >> np.uint64(27)
    x *= _MIX_2
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _rolling(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        both = []
        for factor in (base, pow(base, -1, 1 << 64)):
            steps = np.full(max(n, CHUNK_BYTES + 1), factor, np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        _powers[base] = have = tuple(both)
    return have


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts on end, and n + 1 offsets; a null counts as empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(data: np.ndarray, offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, end, bytes, offsets) of neighbouring texts of about ``limit`` bytes together."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def word_spans(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each run of bytes that aren't ``breaks``, and n + 1 positions of the texts among them."""
    solid = ~breaks[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data), bool)
    before[:1], before[1:] = False, solid[:-1]
    after = np.empty(len(data), bool)
    after[-1:], after[:-1] = False, solid[1:]
    starts = np.flatnonzero(solid & ~(before & ~edge[:-1]))
    ends = np.flatnonzero(solid & ~(after & ~edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """64-bit hash of each span of bytes, one of two kinds; spans may overlap."""
    powers, inverse = _rolling(_BASES[which], len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    terms = _BYTE[data] ^ np.uint64(0x5555) if which else _BYTE[data]
    np.cumsum(terms * powers[:len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * _ODD)


def owners(bounds: np.ndarray) -> np.ndarray:
    """Number of the text of each entry, from n + 1 positions."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` neighbouring words (of one text or across texts)."""
    n = max(0, len(words) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = mix(out * _ODD + words[k:k + n] + np.uint64(k))
    return out


def repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: occurs more than once; occurs earlier."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    again, earlier = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    earlier[order[1:]] = same
    again[order[1:]] = same
    again[order[:-1]] |= same
    return again, earlier


def per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the values of each text, from n + 1 positions."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
