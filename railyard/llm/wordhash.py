"""Vectorised word hashing over Arrow batches (numpy inside a task)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_U = np.uint64
_space = np.zeros(256, bool)
_space[[0x20, *range(0x09, 0x0E)]] = True
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_byte_value = np.random.RandomState(20240611).randint(0, 2**63 - 1, 256).astype(np.uint64) * _U(2) + _U(1)
_byte_value = _byte_value[_lower]  # of bytes as they are
_BASE = 0x9E3779B97F4A7C17  # odd
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Tables:
    up = _powers(_BASE, 1 << 16)
    down = _powers(_INVERSE, 1 << 16)

    @classmethod
    def at_least(cls, n: int) -> None:
        if len(cls.up) < n:
            cls.up, cls.down = _powers(_BASE, 2 * n), _powers(_INVERSE, 2 * n)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x + _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES, rows: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, UTF-8 bytes, offsets) of runs of whole texts, of at most ``rows`` texts where what is made of
    a run grows with their number; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        end = min(end, first + rows) if rows else end
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` (A-Z lower-cased), and the texts' offsets among them."""
    return words_in(data, offsets)[:2]


def words_in(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``word_hashes``, and where in ``data`` each word starts and ends."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    _Tables.at_least(n + 1)
    inside = ~_space[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < n)]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_byte_value[data] * _Tables.up[:n], out=total[1:])
    hashes = (total[ends] - total[starts]) * _Tables.down[starts]
    return mix(hashes + (ends - starts).astype(np.uint64)), np.searchsorted(starts, offsets), starts, ends


def lower_case(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z lower-cased."""
    return _lower[data]


def shingle_sets(hashes: np.ndarray, words_at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, end to end, and the texts' offsets among them.

    A text of fewer words gives its whole sequence as one shingle; a text without words gives none."""
    n = len(hashes)
    rolled = mix(hashes)
    for i in range(1, width):
        rolled = rolled[:max(0, n - i)]
        rolled = mix(rolled + hashes[i:])
    sets, sizes = [], np.zeros(len(words_at), np.int64)
    for d in range(len(words_at) - 1):
        lo, hi = int(words_at[d]), int(words_at[d + 1])
        if lo == hi:
            continue
        if hi - lo < width:
            h = mix(hashes[lo:lo + 1])
            for x in range(lo + 1, hi):
                h = mix(h + hashes[x:x + 1])
            own = mix(h + _U(hi - lo))
        else:
            own = np.sort(rolled[lo:hi - width + 1])
            own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        sets.append(own)
        sizes[d + 1] = len(own)
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.cumsum(sizes)


def sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum of each text's values, modulo 2**64."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


def list_column(values: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values.view(np.int64)))
