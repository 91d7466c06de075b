"""Word and shingle hashes over Arrow string buffers, vectorised in numpy.

Words are ``[^\\x20\\x09-\\x0D]+`` of the UTF-8 bytes with A-Z lower-cased.  A word's
hash is a polynomial over random byte values modulo 2**64, taken from one running
sum over the buffer, so no Python object is made per word.  Work goes in pieces of
at most ``PIECE`` bytes; a longer text is cut at white space and joined again as hash
arrays (8 bytes a word).
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
SHINGLE = 5

_rng = np.random.Generator(np.random.PCG64(20240611))
_BYTE = _rng.integers(1, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_LOWER = _BYTE[_LOWER]
_WORD = np.ones(256, dtype=bool)
_WORD[[32, 9, 10, 11, 12, 13]] = False
_30, _27, _31 = np.uint64(30), np.uint64(27), np.uint64(31)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, PIECE + 1)
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser (splitmix64), element by element."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    high = x >> _30
    x ^= high
    x *= _M1
    np.right_shift(x, _27, out=high)
    x ^= high
    x *= _M2
    np.right_shift(x, _31, out=high)
    x ^= high
    return x


def _piece_words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of one piece, and how many words end up in each row."""
    n = len(data)
    if n == 0:
        return np.empty(0, np.uint64), np.zeros(len(bounds) - 1, np.int64)
    power, inverse = _power_tables(n + 1)
    word = _WORD[data]
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    edge[0] = edge[n] = True
    gap = ~word
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = gap[:-1]
    starts = np.flatnonzero(word & (before | edge[:n]))
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = gap[1:]
    ends = np.flatnonzero(word & (after | edge[1:])) + 1
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_LOWER[data] * power[:n], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts]), np.diff(np.searchsorted(starts, bounds))


def _cuts(data: np.ndarray, lo: int, hi: int) -> list[int]:
    """Cut points inside one long row: white space near every ``PIECE`` bytes."""
    out, at = [lo], lo
    while hi - at > PIECE:
        window = data[at:at + PIECE]
        gaps = np.flatnonzero(~_WORD[window[-65536:]])
        if len(gaps) == 0:
            gaps_all = np.flatnonzero(~_WORD[window])
            if len(gaps_all) == 0:  # one word longer than a piece: take it whole
                rest = np.flatnonzero(~_WORD[data[at:hi]])
                step = int(rest[0]) + 1 if len(rest) else hi - at
            else:
                step = int(gaps_all[-1]) + 1
        else:
            step = PIECE - min(65536, len(window)) + int(gaps[-1]) + 1
        at += step
        out.append(at)
    if out[-1] != hi:
        out.append(hi)
    return out


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, row offsets and null flags of a string or binary Arrow array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    null = np.asarray(column.is_null())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw, off, null


def words(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, word hashes, word offsets by row) for runs of rows, in order."""
    if len(column) == 0:
        return
    raw, off, _ = buffers(column)
    row, rows = 0, len(off) - 1
    while row < rows:
        stop = int(np.searchsorted(off, off[row] + PIECE, side="right")) - 1
        stop = min(max(stop, row + 1), rows)
        lo, hi = int(off[row]), int(off[stop])
        if hi - lo <= PIECE or stop > row + 1:
            h, n = _piece_words(raw[lo:hi], off[row:stop + 1] - lo)
            yield row, h, np.concatenate([[0], np.cumsum(n)])
        else:
            cut = _cuts(raw, lo, hi)
            parts = [_piece_words(raw[a:b], np.array([0, b - a]))[0] for a, b in zip(cut, cut[1:])]
            h = np.concatenate(parts)
            yield row, h, np.array([0, len(h)])
        row = stop


def rolling(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of every run of ``width`` consecutive entries of ``h``."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = h[:n].copy()
    for i in range(1, width):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += h[i:i + n]
    return mix(out, width)


def shingle_sets(column: pa.Array, width: int = SHINGLE) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes).  Fewer words than ``width``: the whole
    sequence is one shingle; no words: an empty set."""
    for first, h, off in words(column):
        runs = rolling(h, width)
        for i in range(len(off) - 1):
            lo, hi = int(off[i]), int(off[i + 1])
            if hi - lo >= width:
                u = np.sort(runs[lo:hi - width + 1])
                yield first + i, u[np.concatenate([[True], u[1:] != u[:-1]])]
            elif hi > lo:
                yield first + i, rolling(h[lo:hi], hi - lo)
            else:
                yield first + i, np.empty(0, np.uint64)
