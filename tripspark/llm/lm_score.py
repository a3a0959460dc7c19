"""Operator 8: language-model scores by deleted interpolation.

Model, over words and one end token per text:

    p(w | h) = a[b(h)] * c(h, w) / c(h)  +  (1 - a[b(h)]) * p(w)
    p(w)     = m * c(w) / N              +  (1 - m) / (V + 1)

where b(h) is the bucket (power of two) of the context's count. The weights a
and m come from one expectation-maximisation over both levels on a held-out
tenth of the training texts, with counts of the other nine tenths, run until
it no longer gains; the scores use all of them.

Counts move, texts do not. Texts are cut into cells of some million tokens,
written once to the shared folder as codes into the cell's own word list. Each
cell asks for the counts of its distinct words and bigrams: one sorted list
per range of the key space. A range adds up what all cells sent, which is the
corpus count, and answers each cell in the order of its list. A frequent word
is one entry per cell, so no key is hot; a range holds a fixed share of the
keys and their number grows with the corpus.

Words are known by 64-bit hashes. Defined cases: a null or empty text is the
end token alone; a null id counts as the empty text when folds are dealt (so
it is held out); repeated rows are counted and scored one by one; without
training text every probability is 1 / (V + 1) = 1; an empty table gives no
rows.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.llm import runtime, words
from tripspark.llm.token_output import pack_values, unpack_values

CELL_TOKENS = 3_000_000
RANGE_KEYS = 3_000_000
END, BEGIN = np.uint64(0xE5D0F0E5D0F0E5D1), np.uint64(0xBE610000BE610001)
STEP = 4  # histogram bins per octave
GAIN = 1e-10  # log likelihood per token that a round of EM must add to be followed by another
TRAIN, DEV = 1, 2  # bits of a text's role
OUT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
_CELLS = "cell long, n_tokens long, doc_ids array<long>, counts array<int>, role int, vocab binary, control binary, data binary"
_ASKS = "range long, cell long, kind int, n int, keys binary, train binary, dev binary"
_ANSWERS = "cell long, range long, kind int, n int, train binary, dev binary, seen long, total long, core_seen long, core_total long"


@dataclass
class Model:
    """Corpus totals and mixture weights."""

    tokens: int = 0  # N and V of all training texts
    words: int = 0
    core_tokens: int = 0  # and of those that are not in the held-out tenth
    core_words: int = 0
    unigram: float = 0.5  # m
    bigram: list[float] = field(default_factory=lambda: [0.0] + [0.5] * 63)  # a, by bucket


def fold(doc_id) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10


def _pack(values: np.ndarray) -> bytes:
    control, data = pack_values(values)
    return len(control).to_bytes(8, "little") + control + data


def _unpack(blob: bytes, n: int) -> np.ndarray:
    size = int.from_bytes(blob[:8], "little")
    view = memoryview(blob)
    return unpack_values(view[8:8 + size], view[8 + size:], n)


def _pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as byte planes of their differences."""
    if not len(keys):
        return b""
    diff = np.diff(keys, prepend=np.uint64(0))
    wide = max(1, -(-int(diff[1:].max() if len(diff) > 1 else 0).bit_length() // 8))
    planes = diff.copy()
    planes[0] = 0
    body = np.ascontiguousarray(planes.view(np.uint8).reshape(-1, 8)[:, :wide].T).tobytes()
    return keys[:1].tobytes() + bytes([wide]) + body


def _unpack_keys(blob: bytes, n: int) -> np.ndarray:
    if not n:
        return np.empty(0, np.uint64)
    out = np.zeros((n, 8), np.uint8)
    wide = blob[8]
    out[:, :wide] = np.frombuffer(blob, np.uint8, offset=9).reshape(wide, n).T
    diff = out.view(np.uint64).reshape(-1)
    diff[0] = np.frombuffer(blob, np.uint64, 1)[0]
    return np.cumsum(diff, dtype=np.uint64)


def _cells():
    def run(batches):
        part = TaskContext.get().partitionId() << 32
        made = 0
        open_: dict[int, list] = {}  # role -> [ids, counts, hashes, tokens]

        def close(role: int):
            nonlocal made
            ids, counts, hashes, n = open_.pop(role)
            vocab, code, often = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
            order = np.argsort(-often, kind="stable")
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            control, data = pack_values(rank[code.reshape(-1)])
            made += 1
            return pa.RecordBatch.from_pydict({
                "cell": pa.array([part | made << 2 | role], pa.int64()), "n_tokens": pa.array([n], pa.int64()),
                "doc_ids": pa.array([ids], pa.list_(pa.int64())), "counts": pa.array([counts], pa.list_(pa.int32())),
                "role": pa.array([role], pa.int32()), "vocab": pa.array([vocab[order].tobytes()], pa.binary()),
                "control": pa.array([control], pa.binary()), "data": pa.array([data], pa.binary())})

        for batch in batches:
            hashes, rows = words.word_hashes(*words.text_bytes(batch.column(1)))
            for i, doc in enumerate(batch.column(0).to_pylist()):
                f = fold(doc)
                role = 0 if f == 0 else TRAIN | DEV if f == 1 else TRAIN
                cell = open_.setdefault(role, [[], [], [], 0])
                cell[0].append(doc)
                n = int(rows[i + 1] - rows[i]) + 1
                cell[1].append(n)
                cell[2].append(np.append(hashes[rows[i]:rows[i + 1]], END))
                cell[3] += n
                if cell[3] >= CELL_TOKENS:
                    yield close(role)
        for role in sorted(open_):
            yield close(role)

    return run


class _Cell:
    """A stored cell: its tokens, distinct words and distinct bigrams, the
    latter two in the order of their keys."""

    def __init__(self, row: dict):
        self.docs, self.counts, self.role = row["doc_ids"], np.array(row["counts"], np.int64), row["role"]
        vocab = np.frombuffer(row["vocab"], np.uint64)
        code = unpack_values(row["control"], row["data"], row["n_tokens"]).astype(np.int64)
        order = np.argsort(vocab)
        place = np.empty(len(vocab), np.int64)
        place[order] = np.arange(len(vocab))
        self.words, self.word = vocab[order], place[code]
        self.ends = np.cumsum(self.counts)
        before = np.empty(len(code), np.int64)
        before[1:] = self.word[:-1]
        before[self.ends - self.counts] = len(vocab)  # the start of a text
        self.before = before
        pairs, pair = np.unique(before * (len(vocab) + 1) + self.word, return_inverse=True)
        hashes = np.append(self.words, BEGIN)
        keys = words.mix(words.mix(hashes[pairs // (len(vocab) + 1)]) + hashes[pairs % (len(vocab) + 1)] * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(keys)
        place = np.empty(len(keys), np.int64)
        place[order] = np.arange(len(keys))
        self.bigrams, self.bigram = keys[order], place[pair.reshape(-1)]

    def asks(self, bits: int):
        """(kind, range, first, last) of the lists this cell sends."""
        for kind, keys in ((1, self.words), (2, self.bigrams)):
            top = keys >> np.uint64(64 - bits) if bits else np.zeros(len(keys), np.uint64)
            edges = np.searchsorted(top, np.arange((1 << bits) + 1, dtype=np.uint64))
            for r in range(1 << bits):
                if edges[r] < edges[r + 1]:
                    yield kind, r, int(edges[r]), int(edges[r + 1])

    def answered(self, answers: list[dict], column: str) -> tuple[np.ndarray, np.ndarray]:
        """Corpus counts of the distinct words and bigrams."""
        out = {}
        for kind, keys in ((1, self.words), (2, self.bigrams)):
            parts = [_unpack(a[column], a["n"]) for a in sorted((a for a in answers if a["kind"] == kind), key=lambda a: a["range"])]
            out[kind] = np.concatenate(parts).astype(np.int64) if parts else np.empty(0, np.int64)
            if len(out[kind]) != len(keys):
                raise ValueError("answers do not match the cell")
        return out[1], out[2]


def _ask(bits: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                cell = _Cell(row)
                often = {1: np.bincount(cell.word, minlength=len(cell.words)), 2: np.bincount(cell.bigram, minlength=len(cell.bigrams))}
                keys = {1: cell.words, 2: cell.bigrams}
                out = []
                for kind, r, a, b in cell.asks(bits):
                    n = often[kind][a:b]
                    none = np.zeros(b - a, np.int64)
                    out.append({"range": r, "cell": row["cell"], "kind": kind, "n": b - a, "keys": _pack_keys(keys[kind][a:b]),
                                "train": _pack(n if cell.role & TRAIN else none), "dev": _pack(n if cell.role & DEV else none)})
                schema = pa.schema([("range", pa.int64()), ("cell", pa.int64()), ("kind", pa.int32()), ("n", pa.int32()), ("keys", pa.binary()), ("train", pa.binary()), ("dev", pa.binary())])
                yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _answer(table: pa.Table) -> pa.Table:
    """All lists of one range -> their corpus counts, and the range's totals."""
    out = []
    for kind in (1, 2):
        rows = [r for r in table.to_pylist() if r["kind"] == kind]
        if not rows:
            continue
        sizes = [r["n"] for r in rows]
        _, inverse = np.unique(np.concatenate([_unpack_keys(r["keys"], r["n"]) for r in rows]), return_inverse=True)
        inverse = inverse.reshape(-1)
        sums = {c: np.bincount(inverse, np.concatenate([_unpack(r[c], r["n"]) for r in rows])).astype(np.int64) for c in ("train", "dev")}
        core = sums["train"] - sums["dev"]
        at = 0
        for i, r in enumerate(rows):
            own = inverse[at:at + sizes[i]]
            at += sizes[i]
            first = i == 0 and kind == 1
            out.append({"cell": r["cell"], "range": r["range"], "kind": kind, "n": r["n"], "train": _pack(sums["train"][own]), "dev": _pack(sums["dev"][own]),
                        "seen": int((sums["train"] > 0).sum()) if first else 0, "total": int(sums["train"].sum()) if first else 0,
                        "core_seen": int((core > 0).sum()) if first else 0, "core_total": int(core.sum()) if first else 0})
    schema = pa.schema([("cell", pa.int64()), ("range", pa.int64()), ("kind", pa.int32()), ("n", pa.int32()), ("train", pa.binary()), ("dev", pa.binary()),
                        ("seen", pa.int64()), ("total", pa.int64()), ("core_seen", pa.int64()), ("core_total", pa.int64())])
    return pa.Table.from_pylist(out, schema)


def bucket(context_count: np.ndarray) -> np.ndarray:
    """0: never seen; else 1 + floor(log2 of the count)."""
    return np.frexp(context_count.astype(np.float64))[1]


def _parts(cell: _Cell, uni: np.ndarray, bi: np.ndarray, texts: int):
    """Per token: count of the word, of the bigram, of the context."""
    context = np.append(uni, texts)[cell.before]
    return uni[cell.word], bi[cell.bigram], context


def _histogram(model: Model, texts: int):
    """Held-out tokens by (bucket, log ratios to the uniform part)."""

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        cell, answers = _Cell(left.to_pylist()[0]), right.to_pylist()
        (ut, bt), (ud, bd) = cell.answered(answers, "train"), cell.answered(answers, "dev")
        w, hw, h = _parts(cell, ut - ud, bt - bd, texts)
        uniform = 1 / (model.core_words + 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            one = np.where(w > 0, np.round(STEP * np.log2(w / max(model.core_tokens, 1) / uniform)), -9999)
            two = np.where(hw > 0, np.round(STEP * np.log2(hw / h / uniform)), -9999)
        rows, n = np.unique(np.stack([bucket(h), two.astype(np.int64), one.astype(np.int64)], 1), axis=0, return_counts=True)
        return pa.table({"bucket": pa.array(rows[:, 0].astype(np.int64)), "two": pa.array(rows[:, 1]), "one": pa.array(rows[:, 2]), "n": pa.array(n)})

    return run


def estimate_weights(rows: pd.DataFrame) -> tuple[float, list[float]]:
    """EM for m and all a[bucket] together on the histogram (columns bucket,
    two, one, n). It ends when a round raises the log likelihood of a token by
    less than ``GAIN``; as EM never lowers it, that always happens."""
    n = rows["n"].to_numpy(float)
    ratio = lambda c: np.where(rows[c] == -9999, 0.0, np.exp2(rows[c].to_numpy(float) / STEP))
    one, two, b = ratio("one"), ratio("two"), rows["bucket"].to_numpy(int)
    total = np.bincount(b, n, 64)
    m, a, before = 0.5, np.where(np.arange(64) > 0, 0.5, 0.0), -np.inf
    while n.sum() > 0:
        upper, middle, lower = a[b] * two, (1 - a[b]) * m * one, (1 - a[b]) * (1 - m)
        p = upper + middle + lower
        now = float(n @ np.log(p)) / n.sum()
        if now - before < GAIN:
            break
        before = now
        a = np.clip(np.bincount(b, n * upper / p, 64) / np.maximum(total, 1), 0, 1 - 1e-6)
        middle, lower = (float(n @ (x / p)) for x in (middle, lower))
        m = min(max(middle / max(middle + lower, 1e-300), 1e-6), 1 - 1e-6)
    a = np.where(total > 0, np.maximum(a, 1e-6), a).tolist()
    a[0] = 0.0
    for k in range(1, 64):
        if not total[k]:
            a[k] = a[k - 1]
    return m, a


def _scored(model: Model, texts: int):
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        cell, answers = _Cell(left.to_pylist()[0]), right.to_pylist()
        w, hw, h = _parts(cell, *cell.answered(answers, "train"), texts)
        low = model.unigram * w / max(model.tokens, 1) + (1 - model.unigram) / (model.words + 1) if model.tokens else np.ones(len(w))
        a = np.array(model.bigram)[bucket(h)]
        p = a * hw / np.maximum(h, 1) + (1 - a) * low
        base = np.log10((w + 0.1) / (model.tokens + 0.1 * (model.words + 1)))
        at = cell.ends - cell.counts
        return pa.table({
            "doc_id": pa.array(cell.docs, pa.int64()), "held_out": pa.array([not cell.role & TRAIN] * len(cell.docs)),
            "n_tokens": pa.array(cell.counts), "n_known": pa.array(np.add.reduceat((w > 0).astype(np.int64), at)),
            "train_tokens": pa.array([model.tokens] * len(cell.docs), pa.int64()),
            "base_score": pa.array(np.add.reduceat(base, at)), "score": pa.array(np.add.reduceat(np.log10(p), at))})

    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, Model]:
    """Scores of all texts (one row each) and the model behind them."""
    spark = docs.sparkSession
    runtime.prepare(spark)
    frame = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    cells = runtime.stored(frame.mapInArrow(_cells(), _CELLS), "lm-cells", compression="zstd")
    size = cells.agg(F.sum("n_tokens").alias("n"), F.sum(F.when(F.col("role") > 0, F.size("doc_ids"))).alias("texts"),
                     F.sum(F.when(F.col("role") == TRAIN, F.size("doc_ids"))).alias("core")).first()
    if not size["n"]:
        return spark.createDataFrame([], OUT), Model()
    bits = max(0, math.ceil(math.log2(size["n"] / RANGE_KEYS)))
    asks = cells.mapInArrow(_ask(bits), _ASKS)
    answers = runtime.stored(asks.groupBy("range").applyInArrow(_answer, _ANSWERS), "lm-answers", compression="zstd")
    totals = answers.where("total > 0").agg(*[F.sum(c).alias(c) for c in ("seen", "total", "core_seen", "core_total")]).first()
    model = Model(totals["total"] or 0, totals["seen"] or 0, totals["core_total"] or 0, totals["core_seen"] or 0)
    own = answers.select("cell", "range", "kind", "n", "train", "dev")

    def joined(run, schema: str, only: str = "true") -> DataFrame:
        return cells.where(only).groupBy("cell").cogroup(own.where(only).groupBy("cell")).applyInArrow(run, schema)

    held = f"cell & {DEV} > 0"  # a cell's number ends with its role
    found = joined(_histogram(model, size["core"] or 0), "bucket long, two long, one long, n long", held)
    # at most one row per bucket and pair of bins
    rows = found.groupBy("bucket", "two", "one").agg(F.sum("n").alias("n")).toPandas()
    if len(rows):
        model.unigram, model.bigram = estimate_weights(rows.sort_values(["bucket", "two", "one"]))
    return joined(_scored(model, size["texts"] or 0), OUT), model
