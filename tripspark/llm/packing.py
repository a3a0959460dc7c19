"""Operator 6: packing documents into training sequences, order preserved.

The documents of one scan partition, each closed by an end id, form a stream
of tokens. Window cuts are chosen by dynamic programming over the ends of
documents and sentences. A window is a sequence of at most ``size`` tokens and
costs its padding (none if its length is a power of two) plus a penalty for
the cut behind it: none at a document's end, little at a sentence's end, more
inside a sentence. The cheapest predecessor over all windows that fit is the
minimum of a sliding range, kept by monotone queues, so the whole stream takes
linear time.

No shuffle: partitions are packed on their own, and a partition's tail is cut
into windows whose lengths are powers of two. A stream is decided in segments
of bounded size; the undecided rest of one is the start of the next.

Defined cases: a null text counts as empty and gives the end id alone; null
ids stay null; repeated rows are packed one by one; an empty table gives no
pieces; a sentence longer than a window gets forced cuts.
"""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tripspark.llm import runtime, tokens

SEGMENT = 1 << 20  # tokens decided at a time
SENTENCE_CUT = 1.0  # penalties, in tokens of padding
INNER_CUT = 6.0
WINDOW = 1.0  # cost of a window, so that tiny ones do not pay
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def sentence_flags(tok: tokens.PieceTokenizer) -> tuple[np.ndarray, np.ndarray]:
    """For each id: its text ends a sentence; its text starts with white space."""
    ends, opens = np.zeros(tok.n_vocab, bool), np.zeros(tok.n_vocab, bool)
    space, feed = tok.bytes_to_chars[0x20], tok.bytes_to_chars[0x0A]
    for text, i in tok.tokenizer.get_vocab().items():
        bare = text.rstrip("\"')]").replace("</w>", "")
        ends[i] = bare.endswith((".", "!", "?", feed))
        opens[i] = text.startswith((space, feed)) or not tok.spaced
    return ends, opens


def choose_cuts(nodes: np.ndarray, penalty: np.ndarray, size: int, total: int, final: bool) -> list[int]:
    """Window ends for a stream of ``total`` tokens.

    ``nodes`` are the candidate cuts (ascending, at most ``size`` apart, from
    the start of the stream on), ``penalty`` their costs. If ``final``, the
    last window ends at ``total``; else the rest stays undecided.
    """
    pos = [0, *nodes.tolist()]
    pen = [0.0, *penalty.tolist()]
    n = len(pos)
    at = np.array(pos)
    powers = []
    step = 1
    while step < size:
        if step >= 32:
            i = np.searchsorted(at, at - step)
            powers.append(np.where((i < n) & (at[np.minimum(i, n - 1)] == at - step), i, -1).tolist())
        step *= 2
    cost, back, inner = [0.0] * n, [-1] * n, [False] * n
    key = [0.0] * n  # cost + position: what the queues keep ascending
    near, far = deque([0]), deque()
    moved = 0  # nodes before this one have been offered to the far queue
    for j in range(1, n):
        p = pos[j]
        while near and pos[near[0]] < p - size:
            near.popleft()
        while pos[moved] < p - size:  # one full window and an inner cut away
            k = key[moved]
            while far and key[far[-1]] >= k:
                far.pop()
            far.append(moved)
            moved += 1
        while far and pos[far[0]] < p - 2 * size:
            far.popleft()
        best, src, cut = key[near[0]] + size - p + WINDOW, near[0], False
        if far:
            c = key[far[0]] + 2 * size - p + INNER_CUT + 2 * WINDOW
            if c < best:
                best, src, cut = c, far[0], True
        for power in powers:
            i = power[j]
            if i >= 0 and cost[i] + WINDOW < best:
                best, src, cut = cost[i] + WINDOW, i, False
        cost[j], back[j], inner[j] = best + pen[j], src, cut
        key[j] = k = cost[j] + p
        while near and key[near[-1]] >= k:
            near.pop()
        near.append(j)
    # the end of the path: the rest behind it is the next segment's, or is cut into powers of two
    low = int(np.searchsorted(at, total - size))
    rest = lambda p: (bin(total - p).count("1") * (WINDOW + INNER_CUT) if final else 0.0)
    j = min(range(min(low, n - 1), n), key=lambda i: (cost[i] + rest(pos[i]) - (0 if final else pos[i] * 1e-3), i))
    tail, p = [], pos[j]
    if final:
        for bit in reversed(range(size.bit_length())):
            if total - p >> bit & 1:
                p += 1 << bit
                tail.append(p)
    cuts = []
    while j > 0:
        cuts.append(pos[j])
        if inner[j]:
            cuts.append(pos[back[j]] + size)
        j = back[j]
    return cuts[::-1] + tail


class _Stream:
    """Tokens of one partition that are not yet in a sequence."""

    def __init__(self, tok: tokens.PieceTokenizer, size: int, first_sequence: int, with_ids: bool):
        self.tok, self.size, self.sequence, self.with_ids = tok, size, first_sequence, with_ids
        self.ends, self.opens = sentence_flags(tok)
        self.ids = np.empty(0, tok.dtype)
        self.names: list = []  # documents that reach into the stream
        self.starts, self.totals = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, names: list, ids: np.ndarray, offs: np.ndarray) -> None:
        self.starts = np.concatenate([self.starts, offs[:-1] + len(self.ids)])
        self.totals = np.concatenate([self.totals, np.diff(offs)])
        self.names += names
        self.ids = np.concatenate([self.ids, ids])

    def _nodes(self) -> tuple[np.ndarray, np.ndarray]:
        ids, n = self.ids, len(self.ids)
        doc_end = self.starts + self.totals
        kind = np.full(n + 1, 9.0)
        ends = self.ends[ids]
        ends[:-1] &= self.opens[ids[1:]] | ends[1:]
        kind[np.flatnonzero(ends) + 1] = SENTENCE_CUT
        kind[doc_end] = 0.0
        kind[0] = 9.0
        at = np.flatnonzero(kind < 9.0)
        gaps = np.diff(np.concatenate([[0], at, [n]]))
        far = np.flatnonzero(gaps > self.size)  # forced cuts in long sentences
        if len(far):
            base = np.concatenate([[0], at])[far]
            forced = np.concatenate([b + np.arange(self.size, g, self.size) for b, g in zip(base.tolist(), gaps[far].tolist())])
            kind[forced] = INNER_CUT
            at = np.flatnonzero(kind < 9.0)
        return at, kind[at]

    def cut(self, final: bool) -> pa.RecordBatch | None:
        total = len(self.ids)
        if not total:
            return None
        ends = np.array(choose_cuts(*self._nodes(), self.size, total, final), np.int64)
        if not len(ends):
            return None
        done = int(ends[-1])
        begins = np.concatenate([[0], ends[:-1]])
        stop = np.minimum(self.starts + self.totals, total)
        edges = np.union1d(np.concatenate([begins, ends]), np.clip(np.concatenate([self.starts, stop]), 0, done))
        a, b = edges[:-1], edges[1:]
        window = np.searchsorted(begins, a, "right") - 1
        doc = np.searchsorted(self.starts, a, "right") - 1
        raw = self.ids[:done].astype("<u4")
        out = {
            "doc_id": pa.array([self.names[d] for d in doc.tolist()], pa.int64()),
            "start": pa.array(a - self.starts[doc]), "length": pa.array(b - a),
            "ids_crc32": pa.array([zlib.crc32(raw[i:j]) for i, j in zip(a.tolist(), b.tolist())], pa.int64()),
            "doc_tokens": pa.array(self.totals[doc]), "sequence_id": pa.array(self.sequence + window),
            "offset": pa.array(a - begins[window]),
        }
        if self.with_ids:
            out["ids"] = pa.ListArray.from_arrays(pa.array(edges - edges[0], pa.int32()), pa.array(raw.astype(np.int32)))
        self.sequence += len(ends)
        live = int(np.searchsorted(self.starts + self.totals, done, "right"))
        self.names = self.names[live:]
        self.starts, self.totals = self.starts[live:] - done, self.totals[live:]
        self.ids = self.ids[done:].copy()
        return pa.RecordBatch.from_pydict(out)


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 0, size: int = 1024, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece of a document in a sequence. ``with_ids`` adds the
    piece's ids. ``size`` must be a power of two."""
    if size & (size - 1):
        raise ValueError("size must be a power of two")
    runtime.prepare(docs.sparkSession)

    def run(batches):
        tok = tokens.tokenizer_for(tokenizer_path)
        stream = _Stream(tok, size, TaskContext.get().partitionId() << 33, with_ids)
        for batch in batches:
            ids, offs = tokens.with_end(*tok.encode(batch.column(1)), end_id)
            stream.add(batch.column(0).to_pylist(), ids, offs)
            if len(stream.ids) >= SEGMENT and (out := stream.cut(False)) is not None:
                yield out
        if (out := stream.cut(True)) is not None:
            yield out

    frame = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return frame.mapInArrow(run, SCHEMA + ", ids array<int>" * with_ids)
