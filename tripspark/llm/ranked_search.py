"""Operator 12: ranked lexical search with bit-sliced Bloom signatures.

Index (:func:`build`). Documents go into blocks of similar length. A block is a
bit matrix with a column per document: a term sets the bits of its ``HASHES``
rows, and again in other rows for each level 2, 4, 8 that its occurrences
reach. A term's rows ANDed are a bitmap over the block's documents that holds
each one with the term (at that level), and by chance a few more. A block also
holds its documents' texts and lengths and how many of them hold each of its
terms. Every document is indexed; nothing in the index depends on the queries.

Search (:func:`search`). Document frequencies are summed over the blocks. For
each query the level bitmaps of its terms, weighted by what reaching the level
can add to a score at most, sum up to an upper bound for every document of a
block. Documents whose bound is not below the tenth best score found so far
are scored exactly, from their texts; each task keeps its ten best per query,
and the ten best of these are the result. Scores are whole numbers, so bounds
and ties are exact too.

Queries come in slices of at most ``SLICE`` distinct terms, which is all that a
task gets besides its blocks; each slice reads the index once. Rows that leave
a task: ten per query.

Terms are compared by 64-bit hashes of their bytes (two of a query's and the
corpus's terms agree by chance with a probability of 1e-19 per pair).

Defined cases: documents that are null, empty or without a term are not
counted and never found. A null doc_id sorts behind all others. Repeated rows
are documents of their own. A query without terms finds nothing; repeated
query rows each give their rows. Empty tables give no rows; extra columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripspark.llm import runtime, words

HASHES = 2  # rows of a term
LEVELS = 4  # occurrences of at least 1, 2, 4, 8
BITS_PER_ENTRY = 16  # rows of a block for each entry of its largest document
BLOCK_DOCS, BLOCK_BYTES = 1024, 1 << 20
SLICE = 8192  # distinct terms searched at a time
TOP = 10
INDEX = ("rows int, docs array<long>, lengths array<long>, signature binary, text binary, text_ends array<long>, "
         "n_docs long, n_terms long, terms binary, holders binary")

#: Bytes between terms: ASCII that is no digit and no letter.
BETWEEN = np.array([i < 0x80 and not chr(i).isalnum() for i in range(256)])
_ROW_SALT = np.random.default_rng(12).integers(1, 1 << 63, (LEVELS, HASHES), dtype=np.uint64)


def term_hashes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms (A-Z lower-cased), and the row of each."""
    starts, ends, rows = words.word_spans(data, offs, BETWEEN)
    return words.span_hashes(words.LOWER[data], starts, ends), np.repeat(np.arange(len(offs) - 1), np.diff(rows))


def counted(hashes: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, term) with their number: row, term, count."""
    order = np.lexsort((hashes, row))
    h, r = hashes[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    at = np.flatnonzero(new)
    return r[at], h[at], np.diff(np.append(at, len(h)))


def signature_rows(terms: np.ndarray, level: int, rows: int) -> np.ndarray:
    """(terms, HASHES): the matrix rows of each term at a level."""
    return np.stack([words.mix(terms ^ s) % np.uint64(rows) for s in _ROW_SALT[level]], 1).astype(np.int64)


def _block(ids: list, texts: list[bytes], row: np.ndarray, term: np.ndarray, count: np.ndarray) -> dict:
    """One index row; ``row`` numbers the block's documents."""
    n = len(ids)
    entries = np.bincount(row, 1 + np.minimum(np.log2(count).astype(np.int64), LEVELS - 1), minlength=n)
    rows = max(64, BITS_PER_ENTRY * int(entries.max(initial=0)))
    bits = np.zeros((rows, n), bool)
    for level in range(LEVELS):
        has = count >= 1 << level
        for at in signature_rows(term[has], level, rows).T:
            bits[at, row[has]] = True
    lengths = np.bincount(row, count, minlength=n).astype(np.int64)
    terms, holders = np.unique(term, return_counts=True)
    return {"rows": rows, "docs": ids, "lengths": lengths.tolist(), "signature": np.packbits(bits, axis=1).tobytes(),
            "text": b"".join(texts), "text_ends": np.cumsum([len(t) for t in texts]).tolist(), "n_docs": int((lengths > 0).sum()),
            "n_terms": int(lengths.sum()), "terms": terms.tobytes(), "holders": holders.astype(np.int64).tobytes()}


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index of all documents, as a stored table of blocks."""
    runtime.prepare(docs.sparkSession)
    schema = pa.schema([("rows", pa.int32()), ("docs", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("signature", pa.binary()),
                        ("text", pa.binary()), ("text_ends", pa.list_(pa.int64())), ("n_docs", pa.int64()), ("n_terms", pa.int64()),
                        ("terms", pa.binary()), ("holders", pa.binary())])

    def run(batches):
        runtime.release_caches()
        for batch in batches:
            data, offs = words.text_bytes(batch.column(1))
            row, term, count = counted(*term_hashes(data, offs))
            ids = batch.column(0).to_pylist()
            edge = np.searchsorted(row, np.arange(len(ids) + 1))
            block: list[int] = []
            size = 0

            def cut():
                take = np.concatenate([np.arange(edge[i], edge[i + 1]) for i in block])
                own = np.repeat(np.arange(len(block)), [edge[i + 1] - edge[i] for i in block])
                texts = [data[offs[i]:offs[i + 1]].tobytes() for i in block]
                return pa.RecordBatch.from_pylist([_block([ids[i] for i in block], texts, own, term[take], count[take])], schema)

            # by length; a block ends where documents get twice as long
            for i in np.argsort(np.diff(edge), kind="stable").tolist():
                n = edge[i + 1] - edge[i]
                if n == 0:
                    continue
                if block and (len(block) == BLOCK_DOCS or size + offs[i + 1] - offs[i] > BLOCK_BYTES
                              or n > 2 * max(16, edge[block[0] + 1] - edge[block[0]])):
                    yield cut()
                    block, size = [], 0
                block.append(i)
                size += offs[i + 1] - offs[i]
            if block:
                yield cut()

    frame = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    # small row groups: a reader holds one at a time
    return runtime.stored(frame.mapInArrow(run, INDEX), "search-index", compression="zstd", **{"parquet.block.size": 16 << 20})


class Slice:
    """Some queries: their numbers and ids, their terms, and each term's weight
    once the corpus is known."""

    def __init__(self, ids: list, terms: list[np.ndarray]):
        self.ids = ids
        self.terms = np.unique(np.concatenate([np.empty(0, np.uint64), *terms]))
        self.of = [np.searchsorted(self.terms, t) for t in terms]
        self.weights = np.zeros(len(self.terms), np.int64)


def slices(queries: DataFrame, id_col: str, text_col: str, most: int) -> Iterator[Slice]:
    """The queries in slices of at most ``most`` distinct terms, or of one
    query. They pass through the driver partition by partition."""
    ids, terms, seen = [], [], set()
    for r in queries.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).toLocalIterator():
        own = np.unique(term_hashes(*words.text_bytes(pa.array([r["text"]], pa.string())))[0])
        both = seen | set(own.tolist())
        if ids and len(both) > most:
            yield Slice(ids, terms)
            ids, terms, both = [], [], set(own.tolist())
        ids.append(r["id"])
        terms.append(own)
        seen = both
    if ids:
        yield Slice(ids, terms)


def _frequencies(index: DataFrame, part: Slice) -> np.ndarray:
    """How many documents hold each term of the slice."""
    terms = part.terms

    def run(batches):
        total = np.zeros(len(terms), np.int64)
        for batch in batches:
            for t, h in zip(batch.column(0), batch.column(1)):
                own = np.frombuffer(t.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(own, terms), max(len(own) - 1, 0))
                total += np.where(own[at] == terms, np.frombuffer(h.as_buffer(), np.int64)[at], 0) if len(own) else 0
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "n"])

    out = np.zeros(len(terms), np.int64)
    found = index.select("terms", "holders").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    for r in found.collect():  # at most one row per term of the slice
        out[r["term"]] = r["n"]
    return out


def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """A term's score per weight at ``tf`` occurrences; grows with tf."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


class _Best:
    """The best (score, doc) of a query so far, in result order."""

    def __init__(self, top: int):
        self.top, self.rows = top, []

    @property
    def least(self) -> int:
        """Documents that cannot reach this need no exact score."""
        return self.rows[-1][0] if len(self.rows) == self.top else 1

    def add(self, scores: np.ndarray, docs: list) -> None:
        new = [(s, d) for s, d in zip(scores.tolist(), docs) if s > 0]
        self.rows = sorted(self.rows + new, key=lambda r: (-r[0], r[1] is None, r[1] or 0))[:self.top]


def search_block(block: dict, part: Slice, best: list[_Best], n_docs: int, n_terms: int) -> int:
    """Take a block's documents into ``best``; returns how many (query,
    document) pairs were scored exactly."""
    rows, lengths = block["rows"], np.array(block["lengths"], np.int64)
    n = len(lengths)
    matrix = np.frombuffer(block["signature"], np.uint8).reshape(rows, -1)
    m = 10 + 90 * lengths * n_docs // n_terms
    # bitmaps per level, and what a level adds to a score per weight
    held, adds, before = [], [], np.zeros(n, np.int64)
    bits = None
    for level in range(LEVELS):
        at = signature_rows(part.terms, level, rows)
        now = matrix[at[:, 0]]
        for j in range(1, HASHES):
            now = now & matrix[at[:, j]]
        bits = now if bits is None else bits & now
        held.append(np.unpackbits(bits, axis=1, count=n))
        most = lengths if level == LEVELS - 1 else np.minimum(lengths, 2 ** (level + 1) - 1)
        g = gain(most, m)
        adds.append((g - before).astype(np.float64))
        before = g
    bounds = [sum((part.weights[of].astype(np.float64) @ h[of]) * a for h, a in zip(held, adds)) for of in part.of]  # whole numbers below 2**53

    ends = np.array([0, *block["text_ends"]], np.int64)
    counts: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def exact(wanted: list[np.ndarray]) -> int:
        new = sorted({d for w in wanted for d in w.tolist()} - counts.keys())
        if new:
            text = b"".join(block["text"][ends[d]:ends[d + 1]] for d in new)
            r, t, c = counted(*term_hashes(np.frombuffer(text, np.uint8), np.concatenate([[0], np.cumsum([ends[d + 1] - ends[d] for d in new])])))
            at = np.minimum(np.searchsorted(part.terms, t), len(part.terms) - 1)
            ok = part.terms[at] == t
            r, at, c = r[ok], at[ok], c[ok]
            cut = np.searchsorted(r, np.arange(len(new) + 1))
            counts.update((d, (at[cut[i]:cut[i + 1]], c[cut[i]:cut[i + 1]])) for i, d in enumerate(new))
        tf = np.zeros(len(part.terms), np.int64)
        by_doc: dict[int, list[int]] = {}
        for q, w in enumerate(wanted):
            for d in w.tolist():
                by_doc.setdefault(d, []).append(q)
        found: dict[int, tuple[list, list]] = {}
        for d, qs in by_doc.items():
            at, c = counts[d]
            tf[at] = part.weights[at] * gain(c, m[d])
            for q in qs:
                s, ds = found.setdefault(q, ([], []))
                s.append(int(tf[part.of[q]].sum()))
                ds.append(block["docs"][d])
            tf[at] = 0
        for q, (s, ds) in found.items():
            best[q].add(np.array(s), ds)
        return sum(map(len, wanted))

    # the most promising first: they raise the bar for the others
    first = []
    for b, own in zip(bounds, best):
        some = np.flatnonzero(b >= own.least)
        first.append(some if len(some) <= own.top else some[np.argpartition(b[some], -own.top)[-own.top:]])
    done = exact(first)
    rest = [np.setdiff1d(np.flatnonzero(b >= own.least), f, assume_unique=True) for b, own, f in zip(bounds, best, first)]
    return done + exact(rest)


def search(index: DataFrame, queries: DataFrame, id_col: str = "item_id", text_col: str = "text", top: int = TOP, most: int = SLICE) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of each query."""
    spark = index.sparkSession
    n_docs, n_terms = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    found = _empty(spark)
    for number, part in enumerate(slices(queries, id_col, text_col, most) if n_terms else ()):
        if not len(part.terms):
            continue
        df = _frequencies(index, part)
        part.weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)

        def run(batches, part=part):
            best = [_Best(top) for _ in part.ids]
            for batch in batches:
                for block in batch.to_pylist():
                    search_block(block, part, best, n_docs, n_terms)
            rows = [(q, part.ids[q], d, s) for q, b in enumerate(best) for s, d in b.rows]
            cols = list(zip(*rows)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["q", "item_id", "doc_id", "score"])

        blocks = index.select("rows", "docs", "lengths", "signature", "text", "text_ends")
        kept = blocks.mapInArrow(run, "q long, item_id long, doc_id long, score long")
        order = Window.partitionBy("q").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        ranked = kept.select("*", F.row_number().over(order).alias("rank")).where(F.col("rank") <= top)
        found = found.unionByName(runtime.stored(ranked.select("item_id", "rank", "doc_id", "score"), f"found-{number}"))
    return found


def _empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")


def oracle_sql() -> str:
    """The same rows in DuckDB SQL, without an index."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    terms = lambda t: rf"regexp_extract_all(translate(coalesce({t}, ''), '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {terms('text')} AS ts FROM documents),
n AS (SELECT r, doc_id, len(ts)::BIGINT AS n FROM d WHERE len(ts) > 0),
c AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM n),
q AS (SELECT item_id, unnest(list_distinct({terms('text')})) AS t FROM benchmark),
tf AS (SELECT r, t, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ts) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY r, t),
w AS (SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, c GROUP BY t, docs),
s AS (SELECT q.item_id, n.doc_id, n.r, sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (100 - 90 + (90 * n.n * c.docs) // c.total))))::BIGINT AS score
      FROM q JOIN tf USING (t) JOIN w USING (t) JOIN n ON n.r = tf.r CROSS JOIN c GROUP BY q.item_id, n.doc_id, n.r),
k AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= 10"""
