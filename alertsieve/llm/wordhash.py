"""Word and word-n-gram hashes of whole texts, vectorised over Arrow batches.

A text is read as UTF-8 bytes.  A byte table says which bytes belong to words and folds
A-Z; words never cross a text's end.  Every word gets a 64-bit polynomial hash (prefix sums
over the batch, so the cost is per byte, not per word), mixed with its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_SPAN = 1 << 16
#: Bytes of text worked on at once (just under a power of two, as the tables of powers are as long
#: as one); one longer text is still one piece.
CHUNK_BYTES = (1 << 20) - 1024


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _byte_table(is_word) -> np.ndarray:
    """Random odd value for every folded word byte, 0 for the rest."""
    value = mix(np.arange(1, 257, dtype=U) * U(0xD1342543DE82EF95)) | U(1)
    out = np.zeros(256, dtype=U)
    for b in range(256):
        low = b + 32 if 65 <= b <= 90 else b
        if is_word(low):
            out[b] = value[low]
    return out


#: Words are what white space separates.
SPACED = _byte_table(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: Words are runs of letters, digits and characters beyond ASCII.
ALNUM = _byte_table(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A)

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, n of each at least."""
    size = _SPAN
    while size < n:
        size *= 2
    if size not in _powers:
        _powers.clear()
        one = np.full(size, _BASE, dtype=U)
        inv = np.full(size, pow(_BASE, -1, 1 << 64), dtype=U)
        one[0] = inv[0] = 1
        _powers[size] = np.cumprod(one), np.cumprod(inv)
    return _powers[size]


def chunks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of pieces of a string column; NULL is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    at = 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield at, data[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at]
        at = end


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, index of the first word of every text and the total)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, U), np.zeros(len(offsets), np.int64)
    v = table[data]
    inside = v != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < n]
    begins[heads] = inside[heads]
    ends = np.empty(n, dtype=bool)
    ends[:-1] = inside[:-1] & (~inside[1:] | begins[1:])
    ends[-1] = inside[-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    power, inverse = _power(n + 1)
    v *= power[:n]
    np.cumsum(v, out=v)
    total = v[end - 1]
    before = start > 0
    total[before] -= v[start[before] - 1]
    h = mix(total * inverse[start] + (end - start).astype(U) * U(0xA0761D6478BD642F))
    return h, np.searchsorted(start, offsets).astype(np.int64)


def ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from every position on (len(h) - n + 1 of them, over text ends too)."""
    if len(h) < n:
        return np.zeros(0, U)
    out = np.full(len(h) - n + 1, n, dtype=U)
    for i in range(n):
        out = mix(out * U(0x9FB21C651E98DF25) + h[i:len(h) - n + 1 + i]) if i % 4 == 3 else \
            out * U(0x9FB21C651E98DF25) + h[i:len(h) - n + 1 + i]
    return mix(out)
