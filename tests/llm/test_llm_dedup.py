"""Operators 3 and 7 against brute force."""

from __future__ import annotations

import hashlib
import os
import random
import tempfile
from collections import Counter, defaultdict

import corpus
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tripspark.llm import graph, near_dedup, suffix_dedup, suffix_sort, words

ROWS = corpus.documents(3)


def shingles(text):
    w = corpus.words(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def groups(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def brute_components(rows):
    sets = [shingles(r[1]) for r in rows]
    links = [(i, j) for j in range(len(rows)) for i in range(j)
             if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]) and sets[i] & sets[j]]
    label = groups(len(rows), links)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[label[i]] = min(low.get(label[i], r[0]), r[0])
    return [(r[0], len(sets[i]), low.get(label[i]) if sets[i] else r[0]) for i, r in enumerate(rows)]


def key(t):
    return tuple((x is None, x) for x in t)


def test_components_equal_brute_force(spark):
    got = near_dedup.components(corpus.frame(spark, ROWS)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=key) == sorted(brute_components(ROWS), key=key)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_large_group_of_loose_copies(spark):
    """Copies with so many changes that most pairs are below the threshold:
    the pivots do not settle the group, the prefix filter has to."""
    rng = random.Random(8)
    base = corpus.prose(rng, 150).split()
    rows = []
    for i in range(220):
        copy = list(base)
        for _ in range(rng.randrange(0, 9)):
            copy[rng.randrange(len(copy))] = "y" + str(rng.randrange(10**6))
        rows.append((i, " ".join(copy), "en", "s", 1))
    got = near_dedup.components(corpus.frame(spark, rows, extra=False)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute_components(rows))
    assert len({r.component_id for r in got}) > 3


def test_quartets_of_short_texts(spark):
    """Four texts that share their buckets, of which two are linked: these
    may be the two that are no pivot."""
    rows = []
    for i in range(80):
        base = " ".join(f"q{i}w{j}" for j in range(7))
        rows += [(4 * i + j, base + "".join(f" q{i}{tail}{x}" for x in range(n)), "en", "s", 1) for j, (tail, n) in enumerate([("a", 3), ("b", 0), ("c", 1), ("d", 3)])]
    got = near_dedup.components(corpus.frame(spark, rows, extra=False)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute_components(rows))


def test_one_document_of_each_group_stays(spark):
    df = corpus.frame(spark, ROWS)
    kept = near_dedup.keep_one(df)
    assert kept.columns == df.columns
    want = {(r[0], r[1]) for r, c in zip(ROWS, brute_components(ROWS)) if r[0] == c[2]}
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(want)


def test_no_documents(spark):
    assert near_dedup.components(corpus.empty(spark)).count() == 0
    assert near_dedup.keep_one(corpus.empty(spark)).count() == 0
    assert suffix_dedup.removal(corpus.empty(spark)).count() == 0
    assert suffix_dedup.cut(corpus.empty(spark)).count() == 0


def test_registers_are_leading_zeros_and_mantissa():
    rng = np.random.default_rng(0)
    values = rng.integers(0, 2**63, 4000, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 4000, dtype=np.uint64)
    got = near_dedup.registers(values, np.zeros(4000, np.int64), 2)
    assert (got[1] == near_dedup.EMPTY).all()
    for bucket in range(0, 128, 17):
        low = min(int(v) >> 7 for v in values if int(v) & 127 == bucket)
        zeros = 57 - low.bit_length()
        rest = low - (1 << low.bit_length() - 1)
        mantissa = rest >> low.bit_length() - 11 if low.bit_length() > 11 else rest << 11 - low.bit_length()
        assert got[0, bucket] == zeros << 10 | mantissa & 1023


def test_estimate_is_close():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(40):
        both, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (750, 125, 125))
        regs = [near_dedup.registers(words.mix(np.concatenate([both, x])), np.zeros(875, np.int64), 1) for x in (a, b)]
        errors.append(float(near_dedup.estimate(*regs)[0]) - 0.75)
    assert abs(np.mean(errors)) < 0.03 and max(map(abs, errors)) < 0.25


def test_connected_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 560)] + [(700, i) for i in range(600, 690)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = groups(800, edges)
    assert got == {n: label[n] for a, b in edges if a != b for n in (a, b)}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_removal(rows):
    """By definition, over all windows in the order of documents."""
    first, out = {}, {}
    docs = sorted({(r[0] is None, r[0], r[1] or "") for r in rows}, key=lambda d: (d[0], d[1] or 0))
    for doc in docs:
        data = doc[2].encode()
        covered = bytearray(len(data))
        for s in range(len(data) - 99):
            if first.setdefault(data[s:s + 100], (doc, s)) != (doc, s):
                covered[s:s + 100] = b"\1" * 100
        kept = bytes(b for b, c in zip(data, covered) if not c)
        runs = sum(1 for i, c in enumerate(covered) if c and (i == 0 or not covered[i - 1]))
        out[doc] = (doc[1], len(data), sum(covered), runs, hashlib.sha256(kept).hexdigest())
    return [out[r[0] is None, r[0], r[1] or ""] for r in rows]


def distinct_null_ids(rows):
    """Rows with a null id are ordered by a hash of their text, so brute
    force takes one of them only."""
    seen, out = False, []
    for r in rows:
        if r[0] is None:
            if seen:
                continue
            seen = True
        out.append(r)
    return out


@pytest.mark.parametrize("seed", [3, 4])
def test_removal_equals_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 50)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 2000)
    monkeypatch.setattr(suffix_dedup, "SHARD", 3000)
    rng = random.Random(seed)
    rows = distinct_null_ids(corpus.documents(seed))
    blocks = [corpus.prose(rng, 30) for _ in range(6)]
    for i in range(30):  # texts woven from shared passages, also within one text
        rows.append((2000 + i, "".join(rng.choice(blocks)[rng.randrange(40):] + corpus.prose(rng, rng.randrange(3)) for _ in range(5)), "en", "s", 1))
    got = suffix_dedup.removal(corpus.frame(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=key) == sorted(brute_removal(rows), key=key)


def test_passage_in_many_documents(spark, monkeypatch):
    """One passage between texts of their own: its edges must not all be
    sorted in one piece."""
    rng = random.Random(6)
    passage = corpus.prose(rng, 40)
    rows = [(i, corpus.prose(rng, 12) + passage + corpus.prose(rng, 12), "en", "s", 1) for i in range(150)]
    rows += [(200 + i, corpus.prose(rng, 8) + passage[30:170] + corpus.prose(rng, 8), "en", "s", 1) for i in range(20)] + rows[:2]
    monkeypatch.setattr(suffix_dedup, "HOT", 10)
    sizes = []

    def measured(docs, segs, pieces=suffix_dedup.pieces):
        out = pieces(docs, segs)
        sizes.append(max([r["count"] for r in out.groupBy("key").count().collect()], default=0))
        return out

    monkeypatch.setattr(suffix_dedup, "pieces", measured)
    got = suffix_dedup.removal(corpus.frame(spark, rows, extra=False)).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute_removal(rows))
    assert sizes and max(sizes) <= 20


def test_cut_texts(spark):
    rows = distinct_null_ids(ROWS)
    df = corpus.frame(spark, rows)
    got = suffix_dedup.cut(df)
    assert got.columns == df.columns and got.count() == len(rows)
    removed = {(w[0], w[1]): w for w in brute_removal(rows)}
    for r in got.collect():
        before = [x for x in rows if x[0] == r.doc_id]
        if len(before) == 1 and before[0][1]:
            n = removed[r.doc_id, len(before[0][1].encode())][2]
            assert len((r.text or "").encode()) <= len(before[0][1].encode()) - n
            if not n:
                assert r.text == before[0][1]


@settings(max_examples=120, deadline=None)
@given(text=st.lists(st.integers(1, 4), min_size=1, max_size=80), repeat=st.integers(1, 3), wide=st.sampled_from([3, 4096]), memory=st.sampled_from([200, 1 << 20]))
def test_suffix_order_and_common_prefixes(text, repeat, wide, memory):
    old, suffix_sort.WIDE = suffix_sort.WIDE, wide
    try:
        t = np.array(text * repeat + [0])
        with tempfile.TemporaryDirectory() as folder:
            order, shared = suffix_sort.suffixes(t, 5, 1000, memory, folder)
            assert not os.listdir(folder)  # the queues' files are gone
    finally:
        suffix_sort.WIDE = old
    s = t.tolist()
    want = sorted(range(len(s)), key=lambda i: s[i:])
    assert order.tolist() == want
    for k in range(1, len(want)):
        a, b = s[want[k - 1]:], s[want[k]:]
        assert shared[k] == next(i for i in range(len(a) + 1) if i == min(len(a), len(b)) or a[i] != b[i])


def test_settling_batches_of_any_size():
    rng = np.random.default_rng(0)
    names = "key content did tkey start length place".split()
    for _ in range(150):
        n = int(rng.integers(0, 40))
        rows = sorted({(int(rng.integers(4)), int(rng.integers(3)), int(rng.integers(6)), 0, int(rng.integers(500)) * 200, 150 if rng.random() > 0.15 else -70, 5) for _ in range(n)})
        n = len(rows)
        batches, i = [], 0
        while i < n:
            j = min(n, i + int(rng.integers(0, 7)))
            batches.append(pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows[i:j]], pa.int64()) for c in range(7)], names))
            i = j
        out = [r for b in suffix_dedup._settle(iter(batches)) for r in b.to_pylist()]
        first, spans = [], set()
        by_key = defaultdict(lambda: defaultdict(list))
        for r in rows:
            if r[5] > 0:
                by_key[r[0]][r[1]].append(r)
            else:
                spans |= {(r[2], r[4] + z) for z in range(70)}
        for k, contents in by_key.items():
            for found in contents.values():
                if len(contents) > 1:
                    first.append((found[0][2], found[0][4], 150, k))
                for r in found[1:]:
                    spans |= {(r[2], r[4] + z) for z in range(150)}
        assert sorted((r["did"], r["start"], r["length"], r["key"]) for r in out if r["place"] >= 0) == sorted(first)
        assert {(r["did"], r["start"] + z) for r in out if r["place"] < 0 for z in range(r["length"])} == spans


def test_parities_never_rule_out_a_link():
    rng = np.random.default_rng(6)
    for n in (3, 40, 700, 5000):
        base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        for changed in (0, 1, n // 14, n // 8, n // 7):
            other = np.unique(np.concatenate([base[changed:], rng.integers(0, 1 << 63, changed, dtype=np.uint64)]))
            both = np.concatenate([base, other])
            x, y = near_dedup.parities(both, np.repeat([0, 1], [n, len(other)]), 2)
            differing = int(np.bitwise_count((x ^ y).view(np.uint64)).sum())
            common = len(np.intersect1d(base, other))
            assert differing <= n + len(other) - 2 * common
            if 4 * common >= 3 * (n + len(other) - common):
                assert near_dedup.can_link(n, len(other), differing)


def test_two_thousand_loose_copies(spark):
    """Most pairs of the crowd are near the threshold, on either side."""
    rng = random.Random(18)
    base = corpus.prose(rng, 120).split()
    rows = []
    for i in range(2000):
        copy = list(base)
        for _ in range(rng.randrange(2, 12)):
            copy[rng.randrange(len(copy))] = "y" + str(rng.randrange(10**6))
        rows.append((i, " ".join(copy), "en", "s", 1))
    got = {r.doc_id: r.component_id for r in near_dedup.components(corpus.frame(spark, rows, extra=False)).collect()}
    sets = [shingles(r[1]) for r in rows]
    number = {}
    m = np.zeros((len(rows), len(set().union(*sets))), np.float32)
    for i, s in enumerate(sets):
        m[i, [number.setdefault(x, len(number)) for x in s]] = 1
    common, n = m @ m.T, m.sum(1)
    a, b = np.nonzero(np.triu(4 * common >= 3 * (n[:, None] + n[None, :] - common), 1))
    want = groups(len(rows), zip(a.tolist(), b.tolist()))
    assert [got[i] for i in range(len(rows))] == want
    assert 100 < len(set(want)) < 1900


def test_no_link_of_tiny_sets_is_lost(spark):
    """Three of four shingles shared: few registers are filled."""
    rng = random.Random(28)
    rows = []
    for i in range(10_000):
        w = [f"w{rng.randrange(10**9)}" for _ in range(8)]
        rows += [(2 * i, " ".join(w[:7]), "en", "s", 1), (2 * i + 1, " ".join(w), "en", "s", 1)]
    got = near_dedup.components(corpus.frame(spark, rows, extra=False)).collect()
    assert len(got) == len(rows) and all(r.component_id == r.doc_id // 2 * 2 for r in got)
