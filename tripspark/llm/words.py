"""Words and shingles of Arrow text columns as numpy arrays of 64-bit hashes.

A word is a run of bytes outside 0x20 and 0x09-0x0D (on UTF-8 bytes the same
runs as on code points). All functions work on whole batches; the Python
interpreter is not entered once per word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20  # spans hashed at a time

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

_rng = np.random.default_rng(20240611)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MASK = np.array([(1 << (8 * i)) - 1 for i in range(9)], np.uint64)
_STEP = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (in place on a copy)."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its row offsets (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):  # no chunk
        column = pa.array([], pa.large_string())
    column = column.fill_null("").cast(pa.large_string()) if column.null_count else column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def word_spans(data: np.ndarray, offs: np.ndarray, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (byte offsets) of all words, and for each row the
    number of words before it (length rows + 1). ``between``: for each byte,
    whether it lies between words."""
    n = len(data)
    if n == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offs), np.int64)
    ink = ~between[data]
    cut = np.zeros(n + 1, bool)
    cut[offs] = True
    first = ink.copy()
    first[1:] &= ~ink[:-1] | cut[1:n]
    last = ink.copy()
    last[:-1] &= ~ink[1:] | cut[1:n]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offs)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, read eight bytes at a time."""
    out = np.empty(len(starts), np.uint64)
    if not len(starts):
        return out
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:len(data)] = data
    eight = np.ndarray((len(data),), "<u8", padded, strides=(1,))
    for i in range(0, len(starts), BLOCK):
        s, left = starts[i:i + BLOCK], (ends - starts)[i:i + BLOCK]
        h = mix(left.astype(np.uint64) * _BASE)
        live = np.arange(len(s))
        while len(live):
            chunk = eight[s] & _MASK[np.minimum(left, 8)]
            h[live] = mix(h[live] ^ chunk) * _BASE
            more = left > 8
            live, s, left = live[more], s[more] + 8, left[more] - 8
        out[i:i + BLOCK] = mix(h)
    return out


def word_hashes(data: np.ndarray, offs: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (A-Z lower-cased) and the number before each row."""
    starts, ends, rows = word_spans(data, offs)
    return span_hashes(LOWER[data] if lower else data, starts, ends), rows


def shingles(words: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles in order, the index of each one's first
    word, and its row. A row of 1 to k - 1 words gives its whole sequence as
    one shingle, a row without words none."""
    count = np.diff(rows)
    row = np.repeat(np.arange(len(count)), count)
    n = len(words)
    acc = np.zeros(n, np.uint64)
    for j in range(min(k, n)):
        acc[:n - j] += words[j:] * _STEP[j]
    left = rows[1:][row] - np.arange(n)  # words from here to the row's end
    keep = left >= k
    for m in range(1, k):  # short rows: the sum of their own words only
        at = rows[:-1][count == m]
        if len(at):
            total = np.zeros(len(at), np.uint64)
            for j in range(m):
                total += words[at + j] * _STEP[j]
            acc[at] = total + np.uint64(m)
            keep[at] = True
    at = np.flatnonzero(keep)
    return mix(acc[at]), at, row[at]


def distinct(values: np.ndarray, row: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each row, and row offsets into them. ``row``
    must ascend."""
    v = values.copy()
    offs = np.searchsorted(row, np.arange(n_rows + 1))
    for a, b in zip(offs[:-1].tolist(), offs[1:].tolist()):
        v[a:b].sort()
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (row[1:] != row[:-1])
    return v[new], np.concatenate([[0], np.cumsum(new)])[offs]
