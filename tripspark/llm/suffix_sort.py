"""Suffix arrays with common-prefix values by external induced sorting.

Suffixes are induced in the order of their first symbol. A bucket queue keeps
one list of tuples (position, common prefix with the tuple before it) per
symbol: taking the queue's least symbol, looking at what precedes each suffix
and pushing that in turn is the whole of the L pass; the S pass runs the other
way round. Lists are numpy arrays, so a step handles a whole bucket at once.
Lists beyond the memory limit go to files in the shared folder that the caller
names (any that ``pyarrow.fs`` opens), and the order comes out bucket by
bucket, so it never has to be held as a whole.

The sorted LMS substrings are named; if names repeat, the string of names is
sorted by the same induction. A name string with more than ``WIDE`` symbols
has too many buckets for that and is sorted by prefix doubling.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
from pyarrow import fs

WIDE = 4096
BIG = np.int64(1) << 40


class BucketQueue:
    """A first-in first-out list of (position, common prefix) per symbol.
    Without a folder all lists stay in memory."""

    def __init__(self, sigma: int, memory: int, folder: str | None):
        self.lists: list[list] = [[] for _ in range(sigma)]
        self.taken = [0] * sigma
        self.held, self.memory, self.folder = 0, memory, folder
        self.store, self.paths, self.files = None, [], []

    def push(self, symbol: int, positions: np.ndarray, common: np.ndarray) -> None:
        item = np.stack([positions, common])
        self.lists[symbol].append(item)
        self.held += item.nbytes
        if self.held > self.memory and self.folder is not None:
            self._spill()

    def _spill(self) -> None:
        """What is in memory goes to one new file."""
        if self.store is None:
            self.store, self.root = fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", self.folder))
            self.store.create_dir(self.root, recursive=True)
        self.paths.append(f"{self.root}/{uuid.uuid4().hex}")
        at = 0
        with self.store.open_output_stream(self.paths[-1]) as out:
            for entries in self.lists:
                for i, entry in enumerate(entries):
                    if isinstance(entry, np.ndarray):
                        out.write(entry.tobytes())
                        entries[i] = (len(self.files), at, entry.shape[1])
                        at += entry.nbytes
        self.files.append(self.store.open_input_file(self.paths[-1]))
        self.held = 0

    def close(self) -> None:
        """Remove the files. Those of a lost executor stay until the job
        clears its scratch folder."""
        for path, file in zip(self.paths, self.files):
            file.close()
            self.store.delete_file(path)
        self.paths, self.files = [], []

    def _load(self, entry) -> np.ndarray:
        if isinstance(entry, np.ndarray):
            return entry
        file, at, n = entry
        return np.frombuffer(self.files[file].read_at(16 * n, at), np.int64).reshape(2, n)

    def take(self, symbol: int) -> np.ndarray | None:
        """What was pushed to the symbol since the last call."""
        entries = self.lists[symbol]
        if self.taken[symbol] == len(entries):
            return None
        new = [self._load(e) for e in entries[self.taken[symbol]:]]
        self.taken[symbol] = len(entries)
        return np.concatenate(new, 1)

    def all(self, symbol: int) -> np.ndarray:
        """All that was ever pushed to the symbol; it is given up with that."""
        entries = [self._load(e) for e in self.lists[symbol]]
        self.lists[symbol], self.taken[symbol] = [], 0
        return np.concatenate(entries, 1) if entries else np.empty((2, 0), np.int64)


class _Inducer:
    """One pass: pushes what precedes each suffix that is taken."""

    def __init__(self, text: np.ndarray, wanted: np.ndarray, sigma: int, memory: int, folder: str | None):
        self.text, self.wanted = text, wanted
        self.queue = BucketQueue(sigma, memory, folder)
        self.since = np.full(sigma, BIG)  # least common prefix of neighbours since the last push
        self.pushed = np.zeros(sigma, bool)

    def feed(self, positions: np.ndarray, common: np.ndarray) -> None:
        """Suffixes in order, each with its common prefix to the one before."""
        if not len(positions):
            return
        before = positions - 1
        at = np.flatnonzero((positions > 0) & self.wanted[before])
        symbols = self.text[before[at]]
        order = np.argsort(symbols, kind="stable")
        at, symbols = at[order], symbols[order]
        edges = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1], [True]])) if len(at) else [0]
        total = int(common.min())
        since = np.minimum(self.since, total)
        for a, b in zip(edges[:-1], edges[1:]):
            d, mine = int(symbols[a]), at[a:b]
            starts = np.concatenate([[0], mine[:-1] + 1])
            low = np.minimum.reduceat(common[:mine[-1] + 1], starts)
            low[0] = min(low[0], self.since[d])
            low += 1
            if not self.pushed[d]:
                low[0] = 0
                self.pushed[d] = True
            self.queue.push(d, before[mine], low)
            rest = common[mine[-1] + 1:]
            since[d] = rest.min() if len(rest) else BIG
        self.since = since


def _types(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each position: S type (smaller than the next suffix), and the
    length of the run of equal symbols that starts here. The last symbol is
    the unique smallest one."""
    n = len(text)
    edges = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1], [True]]))
    size = np.diff(edges)
    symbol = text[edges[:-1]]
    rising = np.ones(len(size), bool)
    rising[:-1] = symbol[:-1] < symbol[1:]
    return np.repeat(rising, size), np.repeat(edges[1:].astype(np.int32), size) - np.arange(n, dtype=np.int32)


def _induce(text, small, run, sigma, lms, common, memory, folder) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Both passes from the LMS suffixes in (assumed) order. Yields positions
    and their common prefixes with the one before, in blocks: the blocks from
    the last to the first, each in ascending order."""
    left = _Inducer(text, ~small, sigma, memory, folder)
    right = _Inducer(text, small, sigma, memory, folder)
    try:
        edges = np.searchsorted(text[lms], np.arange(sigma + 1))
        for c in range(sigma):
            last, first = None, True
            while (got := left.queue.take(c)) is not None:
                last = int(got[0, -1])
                left.feed(got[0], got[1])
                first = False
            own, shared = lms[edges[c]:edges[c + 1]], common[edges[c]:edges[c + 1]].copy()
            if len(own):
                shared[0] = 0 if first else min(int(run[last]), int(run[own[0]]))
                left.feed(own, shared)
        for c in range(sigma - 1, -1, -1):
            last = None
            while (got := right.queue.take(c)) is not None:
                last = int(got[0, -1])
                right.feed(got[0], got[1])
            large = left.queue.all(c)
            n = large.shape[1]
            if n:
                shared = np.empty(n, np.int64)
                shared[1:] = large[1, :0:-1]
                shared[0] = 0 if last is None else min(int(run[last]), int(run[large[0, -1]]))
                right.feed(large[0, ::-1], shared)
            less = right.queue.all(c)
            m = less.shape[1]
            if m:
                up = np.empty(m, np.int64)
                up[1:] = less[1, :0:-1]
                up[0] = min(int(run[less[0, -1]]), int(run[large[0, -1]])) if n else 0
                yield less[0, ::-1], up
            if n:
                yield large[0], large[1]
        yield np.array([len(text) - 1]), np.zeros(1, np.int64)
    finally:
        left.queue.close()
        right.queue.close()


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Common prefix lengths of pairs of suffixes, up to ``cap``."""
    n = len(text)
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    for k in range(cap):
        if not len(live):
            break
        x, y = a[live] + k, b[live] + k
        same = (x < n) & (y < n)
        same[same] = text[x[same]] == text[y[same]]
        live = live[same]
        out[live] += 1
    return out


def _doubling(names: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of a string by their first ``depth`` symbols."""
    rank, step, n = names.astype(np.int64), 1, len(names)
    while True:
        second = np.full(n, -1, np.int64)
        second[:n - step] = rank[step:] if step < n else second[:0]
        order = np.lexsort((second, rank))
        r, s = rank[order], second[order]
        new = np.cumsum(np.concatenate([[0], (r[1:] != r[:-1]) | (s[1:] != s[:-1])]))
        rank = np.empty(n, np.int64)
        rank[order] = new
        step *= 2
        if new[-1] == n - 1 or step >= depth or step >= n:
            return order


def blocks(text: np.ndarray, sigma: int, depth: int, memory: int = 64 << 20, folder: str | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of all suffixes in order, and the common prefix of each with
    the one before (exact up to ``depth``), in blocks: the blocks from the
    last to the first, each in ascending order. Suffixes that agree in their
    first ``depth`` symbols may come in any order. The last symbol must be 0
    and occur nowhere else."""
    n = len(text)
    if n == 1:
        yield np.zeros(1, np.int64), np.zeros(1, np.int64)
        return
    small, run = _types(text)
    is_lms = np.zeros(n, bool)
    is_lms[1:] = small[1:] & ~small[:-1]
    places = np.flatnonzero(is_lms)
    order = places
    if len(places) > 1:
        # LMS substrings in order: induced from the LMS suffixes in any order
        start = places[np.argsort(text[places], kind="stable")]
        induced = _induce(text, small, run, sigma, start, np.zeros(len(start), np.int64), memory, folder)
        order = np.concatenate([p[is_lms[p]] for p, _ in induced][::-1])
        index = np.full(n, -1, np.int32)
        index[places] = np.arange(len(places))
        size = np.append(np.diff(places) + 1, 1)
        a, b = order[:-1], order[1:]
        length = size[index[a]]
        same = length == size[index[b]]
        same[same] = common_prefix(text, a[same], b[same], int(length.max())) >= length[same]
        name = np.empty(len(places), np.int64)
        name[index[order]] = np.cumsum(np.concatenate([[0], ~same]))
        del index, size, a, b, length
        count = int(name.max()) + 1
        if count < len(places):
            # an LMS substring moves on by a symbol at least
            order = places[suffixes(name, count, depth, memory, folder)[0] if count <= WIDE else _doubling(name, depth)]
    shared = np.zeros(len(order), np.int64)
    shared[1:] = common_prefix(text, order[:-1], order[1:], depth)
    yield from _induce(text, small, run, sigma, order, shared, memory, folder)


def suffixes(text: np.ndarray, sigma: int, depth: int, memory: int = 64 << 20, folder: str | None = None) -> tuple[np.ndarray, np.ndarray]:
    """What :func:`blocks` yields, put together in ascending order."""
    found = list(blocks(text, sigma, depth, memory, folder))[::-1]
    return np.concatenate([p for p, _ in found]), np.concatenate([c for _, c in found])
