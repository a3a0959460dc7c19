"""Operator 4: token counts of fields and sections by offset attribution.

A document is encoded once, as a whole. Its tokens are mapped to byte spans
(byte-level vocabulary: the tokens' bytes end to end are the text), its
sections to byte spans as well, and the two lists are joined as intervals.

Rule for a token that crosses a boundary: it counts for the section that holds
most of its bytes; of equal shares, for the first. Every token is counted
once, so the counts of a document add up to the tokens of its whole text.

Defined cases: a null or empty text has one empty section with no tokens; null
ids, repeated rows and extra columns do no harm; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.llm import runtime, tokens, words

SCHEMA = "doc_id long, section int, byte_start long, byte_end long, char_start long, char_end long, n_tokens long, doc_tokens long"


def token_bytes(tok: tokens.PieceTokenizer) -> np.ndarray:
    """Length in bytes of each id of a byte-level vocabulary."""
    if not tok.spaced:
        raise ValueError("attribution needs a byte-level vocabulary")
    out = np.zeros(tok.n_vocab, np.int64)
    added = {i: len(t.content.encode()) for i, t in tok.tokenizer.get_added_tokens_decoder().items()}
    for text, i in tok.tokenizer.get_vocab().items():
        out[i] = added.get(i, len(text))
    return out


def attribute(starts: np.ndarray, ends: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Index of the section [edges[i], edges[i+1]) each token counts for.

    Tokens and sections lie end to end over the same range.
    """
    first = np.searchsorted(edges, starts, "right") - 1
    last = np.searchsorted(edges, np.maximum(ends - 1, starts), "right") - 1
    best = first.copy()
    most = np.minimum(ends, edges[first + 1]) - starts
    at = np.flatnonzero(last > first)  # only tokens that cross
    section = first.copy()
    while len(at):
        section[at] += 1
        share = np.minimum(ends[at], edges[section[at] + 1]) - edges[section[at]]
        better = share > most[at]
        best[at[better]], most[at[better]] = section[at[better]], share[better]
        at = at[section[at] < last[at]]
    return best


def _line_edges(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of all sections of a batch, and for each row the number of
    sections before it. A section is a line with its line feed."""
    feeds = np.flatnonzero(data == 0x0A) + 1
    inner = feeds[~np.isin(feeds, offs)]
    starts = np.sort(np.concatenate([inner, offs[:-1]]))
    # an empty row has one section of its own; equal starts keep row order
    return np.concatenate([starts, offs[-1:]]), np.searchsorted(inner, offs[:-1]) + np.arange(len(offs) - 1)


def section_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per section (line) of each document, in whole texts."""
    runtime.prepare(docs.sparkSession)

    def run(batches):
        tok = tokens.tokenizer_for(tokenizer_path)
        cache = runtime.process_cache("token_bytes")
        if tokenizer_path not in cache:
            cache[tokenizer_path] = token_bytes(tok)
        width = cache[tokenizer_path]
        for batch in batches:
            ids, ioffs = tok.encode(batch.column(1))
            data, offs = words.text_bytes(batch.column(1))
            ends = np.cumsum(width[ids])
            starts = ends - width[ids]
            total = int(ends[-1]) if len(ends) else 0
            if total != len(data):
                raise ValueError("tokens do not cover the text")
            edges, base = _line_edges(data, offs)
            n = len(edges) - 1
            section = attribute(starts, ends, edges)
            count = np.bincount(section, minlength=n)
            doc_of = np.searchsorted(base, np.arange(n), "right") - 1
            chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            at = offs[:-1][doc_of]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0).take(pa.array(doc_of)),
                "section": pa.array((np.arange(n) - base[doc_of]).astype(np.int32)),
                "byte_start": pa.array(edges[:-1] - at), "byte_end": pa.array(edges[1:] - at),
                "char_start": pa.array(chars[edges[:-1]] - chars[at]), "char_end": pa.array(chars[edges[1:]] - chars[at]),
                "n_tokens": pa.array(count), "doc_tokens": pa.array(np.diff(ioffs)[doc_of]),
            })

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")).mapInArrow(run, SCHEMA)


def field_counts(docs: DataFrame, fields: list[str], tokenizer_path: str, separator: str = "\n",
                 id_col: str = "doc_id") -> DataFrame:
    """One row per document and field: the fields are joined by ``separator``
    (which belongs to the field before it), encoded as one text and attributed
    by the same rule. Null fields count as empty."""
    runtime.prepare(docs.sparkSession)
    last = len(fields) - 1
    parts = [F.concat(F.coalesce(docs[f].cast("string"), F.lit("")), F.lit(separator if i < last else "")) for i, f in enumerate(fields)]

    def run(batches):
        tok = tokens.tokenizer_for(tokenizer_path)
        width = token_bytes(tok)
        for batch in batches:
            ids, ioffs = tok.encode(batch.column(1))
            sizes = np.array(batch.column(2).to_pylist(), np.int64).reshape(batch.num_rows, len(fields))
            edges = np.concatenate([[0], np.cumsum(sizes.reshape(-1))])
            ends = np.cumsum(width[ids])
            section = attribute(ends - width[ids], ends, edges)
            count = np.bincount(section, minlength=sizes.size)
            rows = np.repeat(np.arange(batch.num_rows), len(fields))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0).take(pa.array(rows)),
                "field": pa.array(list(fields) * batch.num_rows, pa.string()),
                "n_tokens": pa.array(count), "doc_tokens": pa.array(np.diff(ioffs)[rows]),
            })

    frame = docs.select(docs[id_col].cast("long").alias("doc_id"), F.concat(*parts).alias("text"),
                        F.array(*[F.octet_length(p).cast("long") for p in parts]).alias("sizes"))
    return frame.mapInArrow(run, "doc_id long, field string, n_tokens long, doc_tokens long")
