"""Operators 2, 4 and 6, and the memo tokenizer under them."""

from __future__ import annotations

import zlib

import corpus
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tripspark.llm import packing, runtime, token_counts, token_output, tokens

WORD_BPE, BYTE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
TOKENIZERS = {p: tokens.PieceTokenizer(p) for p in (WORD_BPE, BYTE_BPE)}
ROWS = corpus.documents()


def direct(path: str, text: str | None) -> list[int]:
    return TOKENIZERS[path].tokenizer.encode(text or "", add_special_tokens=False).ids


PIECES = [*"aB1 \n\t.,'é\u0308ß\u0085\u00a0\x1c中İΣσ!?<|>", *[" "] * 6, "don't", "<|endoftext|>", " the", "The"]
TEXT = st.lists(st.sampled_from(PIECES), max_size=30).map("".join)


@pytest.mark.parametrize("path", [WORD_BPE, BYTE_BPE])
@settings(max_examples=150, deadline=None)
@given(texts=st.lists(TEXT, max_size=8))
def test_memo_gives_the_librarys_ids(path, texts):
    ids, offs = TOKENIZERS[path].encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(offs[:-1], offs[1:])] == [direct(path, t) for t in texts]


def test_memo_survives_resets(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_LIMIT", 5)
    tok = tokens.PieceTokenizer(BYTE_BPE)
    for _, text, *_ in ROWS[:20]:
        ids, _ = tok.encode(pa.array([text, text], pa.string()))
        assert ids.tolist() == direct(BYTE_BPE, text) * 2


@given(values=st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=60))
@settings(deadline=None)
def test_values_round_trip(values):
    v = np.array(values, np.uint32)
    control, data = token_output.pack_values(v)
    assert len(control) == -(-len(v) // 4)
    assert token_output.unpack_values(control, data, len(v)).tolist() == values


def test_block_round_trip_and_magic():
    blob = token_output.pack_block([5, None, 7], np.array([2, 0, 3], np.uint32), np.array([1, 70000, 3, 4, 5], np.uint32))
    docs, counts, ids = token_output.unpack_block(blob)
    assert docs == [5, None, 7] and counts.tolist() == [2, 0, 3] and ids.tolist() == [1, 70000, 3, 4, 5]
    with pytest.raises(ValueError):
        token_output.unpack_block(b"XXXX" + blob[4:])


def test_token_files_hold_every_document_in_order(spark, monkeypatch):
    monkeypatch.setattr(token_output, "BLOCK_IDS", 500)
    path = runtime.scratch(spark, "files")
    token_output.write(corpus.frame(spark, ROWS), path, WORD_BPE, 1, partitions=4)
    got = token_output.read(spark, path, with_ids=True).orderBy("start").collect()
    want = sorted(((r[0], r[1]) for r in ROWS), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    start = 0
    assert len(got) == len(want)
    for g, (doc, text) in zip(got, want):
        ids = direct(WORD_BPE, text) + [1]
        assert (g.doc_id, g.start, g.n_tokens, list(g.ids)) == (doc, start, len(ids), ids)
        assert g.ids_crc32 == zlib.crc32(np.array(ids, "<u4"))
        start += len(ids)
    ranks = spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()
    assert all(a.n >= b.n for a, b in zip(ranks, ranks[1:]))
    parts = spark.read.parquet(f"{path}/ids")
    assert parts.select("part").distinct().count() > 1


def test_token_files_of_an_empty_table(spark):
    path = runtime.scratch(spark, "files")
    token_output.write(corpus.empty(spark), path, WORD_BPE, 1)
    assert token_output.read(spark, path).count() == 0


def test_pieces_hold_every_token_once(spark, monkeypatch):
    monkeypatch.setattr(packing, "SEGMENT", 3000)  # several segments a partition
    got = packing.pack(corpus.frame(spark, ROWS), BYTE_BPE, size=256, with_ids=True).collect()
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
        assert r.length == len(r.ids) > 0 and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4"))
    want = sorted(tuple(direct(BYTE_BPE, t) + [0]) for _, t, *_ in ROWS)
    have = []
    for rows in by_doc.values():
        rows.sort(key=lambda r: (r.start, r.sequence_id))
        while rows:  # repeated rows share an id
            one, at = [], 0
            for r in list(rows):
                if r.start == at:
                    one += r.ids
                    at += r.length
                    rows.remove(r)
            have.append(tuple(one))
    assert sorted(have) == want
    padding = 0
    for rows in by_seq.values():
        rows.sort(key=lambda r: r.offset)
        at = 0
        for r in rows:
            assert r.offset == at
            at += r.length
        assert at <= 256
        padding += 0 if at & (at - 1) == 0 else 256 - at
    assert padding <= 0.03 * sum(r.length for r in got)
    assert packing.pack(corpus.empty(spark), BYTE_BPE).count() == 0
    with pytest.raises(ValueError):
        packing.pack(corpus.frame(spark, ROWS), BYTE_BPE, size=1000)


@settings(max_examples=60, deadline=None)
@given(gaps=st.lists(st.integers(1, 16), min_size=1, max_size=14), kinds=st.lists(st.booleans(), min_size=14, max_size=14))
def test_cuts_are_the_cheapest(gaps, kinds):
    """Against a plain quadratic search over the same moves."""
    size = 16
    nodes = np.cumsum(gaps)
    pen = np.array([0.0 if k else packing.SENTENCE_CUT for k in kinds[:len(gaps)]])
    total = int(nodes[-1])
    cuts = packing.choose_cuts(nodes, pen, size, total, True)
    pos, cost = [0, *nodes.tolist()], [0.0]
    for j in range(1, len(pos)):
        best = 1e9
        for i in range(j):
            length = pos[j] - pos[i]
            if length <= size:
                best = min(best, cost[i] + size - length + packing.WINDOW)
            elif length <= 2 * size:
                best = min(best, cost[i] + 2 * size - length + packing.INNER_CUT + 2 * packing.WINDOW)
        cost.append(best + pen[j - 1])

    def spent(cuts):
        at, s = 0, 0.0
        inside = dict(zip(nodes.tolist(), pen.tolist()))
        for c in cuts:
            s += size - (c - at) + packing.WINDOW + inside.get(c, packing.INNER_CUT)
            at = c
        return s

    low = [j for j in range(len(pos)) if pos[j] >= total - size]
    rest = lambda p: bin(total - p).count("1") * (packing.WINDOW + packing.INNER_CUT)
    want = min(cost[j] + rest(pos[j]) for j in low)
    best = min(low, key=lambda j: (cost[j] + rest(pos[j]), j))
    assert cuts[-1] == total and all(0 < b - a <= size for a, b in zip([0, *cuts], cuts))
    head = [c for c in cuts if c <= pos[best]]
    assert spent(head) + rest(pos[best]) <= want + 1e-6


def test_section_counts_against_a_plain_version(spark):
    rows = [r for r in ROWS if r[0] is not None]
    got = token_counts.section_counts(corpus.frame(spark, rows), BYTE_BPE).collect()
    width = token_counts.token_bytes(TOKENIZERS[BYTE_BPE])
    want = []
    for doc, text, *_ in rows:
        data = (text or "").encode()
        lines = [m for m in data.split(b"\n")]
        edges = [0]
        for line in lines[:-1]:
            edges.append(edges[-1] + len(line) + 1)
        if lines[-1] or len(edges) == 1:
            edges.append(edges[-1] + len(lines[-1]))
        ids = direct(BYTE_BPE, text)
        count = [0] * (len(edges) - 1)
        at = 0
        for i in ids:
            share = [min(at + width[i], b) - max(at, a) for a, b in zip(edges, edges[1:])]
            count[share.index(max(share))] += 1
            at += width[i]
        assert at == len(data)
        for k, (a, b) in enumerate(zip(edges, edges[1:])):
            want.append((doc, k, a, b, len(data[:a].decode()), len(data[:b].decode()), count[k], len(ids)))
    assert sorted(map(tuple, got)) == sorted(want)
    assert token_counts.section_counts(corpus.empty(spark), BYTE_BPE).count() == 0


def test_field_counts_add_up(spark):
    df = spark.createDataFrame([(1, "Title", "the body of it\n\nmore"), (2, None, "x"), (3, "", None), (None, "a", "b")], "doc_id long, title string, body string")
    got = token_counts.field_counts(df, ["title", "body"], BYTE_BPE, separator="\n\n").collect()
    for doc in (1, 2, 3, None):
        rows = [r for r in got if r.doc_id == doc]
        assert [r.field for r in rows] == ["title", "body"]
        assert sum(r.n_tokens for r in rows) == rows[0].doc_tokens
    with pytest.raises(ValueError):
        token_counts.token_bytes(TOKENIZERS[WORD_BPE])


def test_a_run_of_letters_is_looked_up_once():
    tok = tokens.PieceTokenizer(BYTE_BPE)
    asked, model = [], tok.model

    class Counting:
        def tokenize(self, text):
            asked.append(text)
            return model.tokenize(text)

    tok.model = Counting()
    texts = ["x qwertz qwertz, qwertz; (qwertz qwertz.", "y qwertz! qwertz qwertz"] * 3
    ids, offs = tok.encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(offs[:-1], offs[1:])] == [direct(BYTE_BPE, t) for t in texts]
    assert sum("qwertz" in a for a in asked) == 1


def test_many_new_pieces_at_once(monkeypatch):
    monkeypatch.setattr(tokens, "FRESH", 3)
    for path in (BYTE_BPE, WORD_BPE):
        tok = tokens.PieceTokenizer(path)
        texts = [None, "", " lead", *[t for _, t, *_ in ROWS[:40]], "one two, two two.\n", ""]
        for _ in range(2):
            ids, offs = tok.encode(pa.array(texts, pa.string()))
            assert [ids[a:b].tolist() for a, b in zip(offs[:-1], offs[1:])] == [direct(path, t) for t in texts]


def test_frequencies_do_not_grow_with_the_tasks(spark):
    tasks, vocabulary = 40, 500
    rows = [(list(range(0, 2 * vocabulary, 2)), [t + 1] * vocabulary) for t in range(tasks)]
    rows += [([], []), ([7, 100_000], [2, 3]), (None, None)]
    raw = spark.createDataFrame(rows, "freq_ids array<int>, freq array<long>").repartition(len(rows))
    made = spark.sparkContext.accumulator(0)

    def counted(batches, add_up=token_output._add_up):
        for batch in add_up(batches):
            made.add(batch.num_rows)
            yield batch

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(token_output, "_add_up", counted)
        got = {r["id"]: r["n"] for r in token_output.frequencies(raw).collect()}
    each = tasks * (tasks + 1) // 2
    assert got == {**{i: each for i in range(0, 2 * vocabulary, 2)}, 7: 2, 100_000: 3}
    assert made.value <= token_output.FOLDS * vocabulary + 2
