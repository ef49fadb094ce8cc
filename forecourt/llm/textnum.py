"""Words of Arrow texts as numpy arrays: positions and 64-bit hashes, without a loop over words.

A word is a maximal run of bytes outside a set of separators. Its hash is a polynomial over byte codes
taken from one prefix sum, so the cost follows the bytes. Memory is bounded: sums cover at most
``PIECE`` bytes plus one word.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 21

WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True

#: White space, control and ASCII punctuation.
NONWORD = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BASE = 0x9E3779B97F4A7C15
_EXACT = mix(np.arange(1, 257, dtype=np.uint64))
_LOWER = _EXACT.copy()
_LOWER[65:91] = _EXACT[97:123]
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(max(n, PIECE + 1), base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers


def texts(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the bounds of its rows; null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, values = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def lower_latin(data: np.ndarray) -> np.ndarray:
    """The bytes with capital letters of Latin-1 (in UTF-8: C3 80 to C3 9E) as small ones; A-Z are left to ``word_hashes``."""
    capital = (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)
    out = data.copy()
    out[1:][capital] += 0x20
    return out


def words(data: np.ndarray, bounds: np.ndarray, separators: np.ndarray = WHITE) -> tuple[np.ndarray, ...]:
    """Row, first byte and end byte of every word, in order."""
    inside = ~separators[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = bounds[(bounds > 0) & (bounds < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    counts = np.diff(np.searchsorted(starts, bounds))
    return np.repeat(np.arange(len(counts)), counts), starts, ends


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each word; ``lower`` takes A-Z as a-z."""
    codes, out, at = _LOWER if lower else _EXACT, np.empty(len(starts), np.uint64), 0
    while at < len(starts):
        base = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, base + PIECE, "right")))
        up, down = _power_tables(int(ends[to - 1] - base) + 1)
        sums = np.zeros(int(ends[to - 1] - base) + 1, np.uint64)
        np.cumsum(codes[data[base : ends[to - 1]]] * up[: len(sums) - 1], out=sums[1:])
        s, e = starts[at:to] - base, ends[at:to] - base
        out[at:to] = mix((sums[e] - sums[s]) * down[s])
        at = to
    return out


def shingles(rows: np.ndarray, hashes: np.ndarray, n_rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every run of ``size`` words; a row with fewer words has its whole sequence as one."""
    counts = np.bincount(rows, minlength=n_rows)
    begin = np.concatenate(([0], np.cumsum(counts)))[:-1]
    runs = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
    row = np.repeat(np.arange(n_rows), runs)
    at = np.arange(len(row)) - np.repeat(np.cumsum(runs) - runs, runs) + begin[row]
    out = np.full(len(row), size, np.uint64)
    width = counts[row]
    for k in range(size):
        part = np.where(k < width, hashes[np.minimum(at + k, len(hashes) - 1)], np.uint64(k + 1))
        out = mix(out ^ (part + np.uint64(k + 1)))
    return row, out


def row_slices(data: np.ndarray, bounds: np.ndarray, most: int = PIECE):
    """Ranges of rows of about ``most`` bytes each, so that arrays over words stay small."""
    at, n = 0, len(bounds) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + most, "right")) - 1)
        yield at, to, data[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at]
        at = to
