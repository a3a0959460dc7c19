"""Operators 11 to 13 against brute force."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import corpus
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tripspark.llm import feast, ranked_search, simhash_dedup, whitening

ROWS = corpus.documents(11)


def key(t):
    return tuple((x is None, x) for x in t)


# ------------------------------------------------------------------ operator 11
def plain_fingerprint(text):
    w = corpus.words(text)
    if not w:
        return 0
    grams = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_simhash(rows):
    fps = [plain_fingerprint(r[1]) for r in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    low = {}
    for x, r in zip(label, rows):
        if r[0] is not None:
            low[x] = min(low.get(x, r[0]), r[0])
    return [(r[0], f"{f:016x}", low.get(x)) for r, f, x in zip(rows, fps, label)]


def test_simhash_components_equal_brute_force(spark):
    got = simhash_dedup.components(corpus.frame(spark, ROWS)).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute_simhash(ROWS), key=key)
    assert simhash_dedup.components(corpus.empty(spark)).count() == 0


def test_fingerprint_of_a_very_long_text():
    text = corpus.prose(random.Random(2), 40_000)
    assert simhash_dedup.fingerprint(text.encode()) == plain_fingerprint(text)
    line = "Ab" * 2_500_000  # one word of 5 MB
    assert simhash_dedup.fingerprint(line.encode()) == xxhash.xxh64_intdigest(line.lower().encode(), 42)


def _crowd(n, seed=0):
    """Random fingerprints, and a crowd within a few bits of one of them, in
    which links chain."""
    rng = random.Random(seed)
    out = {rng.getrandbits(64) for _ in range(n)}
    base = rng.getrandbits(64)
    for _ in range(n):
        f = base
        for _ in range(rng.randrange(0, 9)):
            f ^= 1 << rng.randrange(64)
        out.add(f)
    return sorted(out)


def _same_components(fps, links):
    low = {f: f for f in fps}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        low[max(a, b)] = min(a, b)
    return [find(f) for f in fps]


@pytest.mark.parametrize("values", [1 << 20, 2000])
def test_no_link_of_a_crowd_is_missed(spark, monkeypatch, values):
    """Also with so few values per bucket that crowded ones are split."""
    monkeypatch.setattr(simhash_dedup, "VALUES", values)
    fps = _crowd(150)
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    found = simhash_dedup.links(spark.createDataFrame([(f,) for f in signed], "fp long").repartition(3), len(fps) // 20).collect()
    unsigned = lambda x: int(np.int64(x).view(np.uint64))
    links = [(unsigned(r.a), unsigned(r.b)) for r in found]
    want = [(a, b) for i, a in enumerate(fps) for b in fps[:i] if (a ^ b).bit_count() <= 4]
    assert len(want) > 200
    assert _same_components(fps, links) == _same_components(fps, want)
    assert len(links) <= sum(1 for _ in fps) * 40  # stars, not all pairs


def test_every_ball_value_is_made_once_over_all_buckets():
    x, k, r = np.uint64(0x0123456789ABCDEF), 5, 2
    made = []
    for mask in simhash_dedup.flips(range(k), 2):
        left = np.array([2 - int(mask).bit_count()])
        for salt in range(1 << r):
            made += simhash_dedup.ball_part(np.array([x ^ mask]), left, k, r, salt)[0].tolist()
    assert len(made) == len(set(made)) == 2081
    assert all((int(x) ^ v).bit_count() <= 2 for v in made)


# ------------------------------------------------------------------ operator 12
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(corpus.UPPER))


def brute_search(rows, items):
    docs = [(r[0], Counter(terms(r[1]))) for r in rows]
    docs = [(d, c, c.total()) for d, c in docs if c]
    n, total = len(docs), sum(x for *_, x in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        found = []
        for d, c, size in docs:
            m = 10 + (90 * size * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                    for t in set(terms(text)) if c[t])
            if s > 0:
                found.append((-s, d is None, d, s))
        found.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, k + 1, d, s) for k, (_, _, d, s) in enumerate(found[:10])]
    return out


def _items(rows):
    rng = random.Random(4)
    texts = [r[1] for r in rows if r[1]]
    out = [(i, " ".join(rng.choice(texts).split()[:rng.randrange(1, 40)])) for i in range(12)]
    return out + [(90, None), (91, ""), (92, "?!"), (93, "zzzunknown"), (94, "the"), (95, "The THE the"), (None, "la que"), (7, out[7][1])]


@pytest.mark.parametrize("slice_terms", [ranked_search.SLICE, 5])
def test_search_equals_brute_force(spark, slice_terms):
    items = _items(ROWS)
    index = ranked_search.build(corpus.frame(spark, ROWS))
    queries = spark.createDataFrame(items, "item_id long, text string")
    got = ranked_search.search(index, queries, most=slice_terms).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute_search(ROWS, items), key=key)


def test_search_of_empty_tables(spark):
    queries = spark.createDataFrame([(1, "the")], "item_id long, text string")
    assert ranked_search.search(ranked_search.build(corpus.empty(spark)), queries).count() == 0
    assert ranked_search.search(ranked_search.build(corpus.frame(spark, ROWS[:5])), queries.limit(0)).count() == 0


def test_ties_go_to_the_smaller_id_and_long_texts_are_whole(spark):
    rows = [(i, "same words here", "en", "s", 1) for i in (30, 4, 17, 2, 9, 8, 40, 41, 42, 43, 44, 45)]
    rows.append((1, "filler " * 700_000 + "needle", "en", "s", 1))  # 5 MB
    items = [(1, "same words"), (2, "needle")]
    got = ranked_search.search(ranked_search.build(corpus.frame(spark, rows)), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted(map(tuple, got)) == sorted(brute_search(rows, items))
    assert [r.doc_id for r in sorted(got) if r.item_id == 2] == [1]


def test_bounds_are_never_below_scores_and_leave_documents_out():
    rng = random.Random(9)
    texts = [corpus.prose(rng, rng.randrange(50, 150)) for _ in range(150)]
    data = [t.encode() for t in texts]
    offs = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    row, term, count = ranked_search.counted(*ranked_search.term_hashes(np.frombuffer(b"".join(data), np.uint8), offs))
    block = ranked_search._block(list(range(150)), data, row, term, count)
    of = lambda t: np.unique(ranked_search.term_hashes(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0])
    part = ranked_search.Slice(list(range(20)), [of(t) for t in texts[:20]])
    df = Counter(term.tolist())
    part.weights = np.array([math.floor(1000 * math.log(302 / (2 * df[t] + 1))) for t in part.terms.tolist()])
    best = [ranked_search._Best(10) for _ in part.ids]
    scored = ranked_search.search_block(block, part, best, 150, int(count.sum()))
    assert scored < 20 * 150 / 2
    want = brute_search([(i, t) for i, t in enumerate(texts)], list(enumerate(texts[:20])))
    assert [(q, k + 1, d, s) for q, b in enumerate(best) for k, (s, d) in enumerate(b.rows)] == want


# ------------------------------------------------------------------ operator 13
@settings(max_examples=40, deadline=None)
@given(st.integers(1, 24), st.integers(1, 40), st.integers(0, 10**6), st.booleans())
def test_contour_finds_the_largest_eigenpairs(d, rank, seed, whole):
    rng = np.random.default_rng(seed)
    b = rng.standard_normal((d, rank))
    a = np.round(b * 3) @ np.round(b * 3).T if whole else b @ b.T  # whole numbers: repeated eigenvalues
    values, u = feast.largest(a, 16)
    want = np.linalg.eigvalsh(a)[::-1][:16]
    want = want[want > 1e-9 * max(want[0], 1e-300)]
    assert len(values) == len(want)
    scale = max(np.abs(a).max(), 1e-300)
    assert np.abs(values - want).max(initial=0) <= 1e-12 * scale * d
    assert np.abs(a @ u - u * values).max(initial=0) <= 1e-11 * scale * d
    assert np.abs(u.T @ u - np.eye(len(values))).max(initial=0) < 1e-12


def test_a_mixture_of_outer_vectors_inside_the_interval():
    b = np.random.default_rng(13001).standard_normal((12, 10))
    a = b @ b.T
    values, u = feast.largest(a, 16)
    assert len(values) == 10 and np.allclose(values, np.linalg.eigvalsh(a)[::-1][:10], rtol=1e-10)
    assert np.abs(a @ u - u * values).max() <= 1e-9


def test_inertia_counts():
    rng = np.random.default_rng(5)
    a = rng.standard_normal((30, 30))
    a += a.T
    t, values = feast.tridiagonal(a), np.linalg.eigvalsh(a)
    for shift in np.linspace(-12, 12, 25):
        assert feast.above(t, shift) == (values > shift).sum()


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'e' AS x", "1 AS size", "'c' AS component").repartition(3)


def test_whitening_equals_direct_calculation(spark):
    rng = np.random.default_rng(3)
    mix = rng.standard_normal((20, 20)) * np.linspace(0.1, 2, 20)
    good = [(i, [float(np.float32(v)) for v in rng.standard_normal(20) @ mix]) for i in range(120)]
    rows = good + [(5, good[4][1]), (200, good[0][1]), (None, good[7][1]), (300, None), (301, [float("nan")] * 20), (302, [float("inf")] + [0.0] * 19),
                   (303, [None] + [0.0] * 19), (304, []), (305, [1.0, 2.0])]
    got = whitening.whiten(_vectors(spark, rows)).collect()
    kept = rows[:123]
    x = np.floor(64 * np.array([v for _, v in kept], np.float64)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    centred = fit - s / n
    values, u = np.linalg.eigh(centred.T @ centred / n)
    values, u = values[::-1], u[:, ::-1]
    assert len(got) == 123 * 16 and {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1
    assert max(r.identity_error for r in got) < 1e-9
    deviation = ((n * x - s) ** 2).sum(1)
    assert Counter((r.vec_id, r.deviation) for r in got if r.component == 1) == Counter((v, int(d)) for (v, _), d in zip(kept, deviation))
    for k in range(16):
        mine = sorted((r.vec_id is None, r.vec_id or 0, r.deviation, r.whitened) for r in got if r.component == k + 1)
        for sign in (1, -1):
            ref = sorted((v is None, v or 0, int(d), float(w)) for (v, _), d, w in zip(kept, deviation, sign * ((x - s / n) @ u[:, k] / math.sqrt(values[k]))))
            if np.allclose([m[3] for m in mine], [r[3] for r in ref], atol=1e-8):
                break
        else:
            raise AssertionError(f"component {k + 1} differs")
        assert abs(next(r.explained for r in got if r.component == k + 1) / (values[k] / values.sum()) - 1) < 1e-9


def test_whitening_of_degenerate_tables(spark):
    assert whitening.whiten(_vectors(spark, [(1, None)])).count() == 0
    assert whitening.whiten(_vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # no variance
    line = whitening.whiten(_vectors(spark, [(i, [float(i), 2.0 * i, 1.0]) for i in range(5)])).collect()
    assert {r.component for r in line} == {1} and abs(sum(r.whitened ** 2 for r in line) / 5 - 1) < 1e-9
    huge = whitening.whiten(_vectors(spark, [(1, [3e38, 0.0]), (2, [0.0, 1.0]), (3, [0.0, -3e38])])).collect()
    assert len(huge) == 6 and all(r.deviation is None or r.deviation >= 0 for r in huge)
    assert whitening.whiten(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_deviations_beyond_a_word_are_exact():
    z = np.array([[1 << 30, 5], [1 << 40, 3]], np.int64)
    want = [(7 * (1 << 30) - 2) ** 2 + (35 - 1) ** 2, None]
    assert whitening.deviations(z[:1], 7, np.array([2, 1])) + whitening.deviations(z[1:], 7, np.array([2, 1])) == [want[0] if want[0] < 1 << 63 else None, want[1]]
