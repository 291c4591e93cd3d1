"""Words of Arrow text columns as 64-bit hashes, a whole batch at a time.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D; A-Z are lower-cased.
Both rules work on UTF-8 bytes, so a batch is one numpy array and no Python loop runs
over words.  A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
PIECE_BYTES = 1 << 20
_rng = np.random.default_rng(20240229)
_ODD = U(int(_rng.integers(1, 1 << 62)) * 2 + 1)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]
_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_MULT = _rng.integers(1, 1 << 62, 64, dtype=np.uint64) * U(2) + U(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_ODD**i and its inverse modulo 2**64 for i < n, grown on demand."""
    if len(_powers[0]) < n:
        size = max(n, PIECE_BYTES + 1)
        inverse = U(pow(int(_ODD), -1, 1 << 64))
        for k, base in enumerate((_ODD, inverse)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    h = h ^ (h >> U(33))
    h = h * U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U(29))
    h = h * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(32))


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string array; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(col.buffers()[1], kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = col.buffers()[2]
    return (np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)), offsets


def pieces(col: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row offsets) of runs of rows of about ``limit`` bytes; a longer text is a run of its own."""
    data, offsets = text_buffers(col)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the index of each row's first word (with the total at the end)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    word = _IS_WORD[data]
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = word[:-1], word[1:]
    inner = offsets[(offsets > 0) & (offsets < n)]
    before[inner] = False
    after[inner - 1] = False
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the index of each row's first word (with the total at the end)."""
    starts, ends, first = word_bounds(data, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), first
    power, inverse = _power_tables(len(data))
    total = np.cumsum(_BYTE[data] * power, dtype=np.uint64)
    h = total[ends - 1]
    h[1:] -= total[starts[1:] - 1]
    if starts[0]:
        h[0] -= total[starts[0] - 1]
    return mix(h * inverse[starts]), first


def runs(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` items (the caller drops runs that cross rows)."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = h[:n] * _MULT[0]
    for k in range(1, size):
        out = out + h[k:k + n] * _MULT[k]
    return mix(out + U(size))


def one_run(h: np.ndarray) -> np.uint64:
    """Hash of a whole sequence of fewer than 64 items, equal to ``runs(h, len(h))[0]``."""
    return runs(h, len(h))[0]
