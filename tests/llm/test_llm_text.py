"""Operators 1, 5, 8, 9 and 10 against plain versions."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import corpus
import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from tripspark.llm import decontaminate, license_scan, lm_score, quality_rules, url_filter, words

ROWS = corpus.documents(11)


# ------------------------------------------------------------------ words
def test_words_and_shingles_as_in_python():
    texts = [r[1] for r in ROWS]
    hashes, rows = words.word_hashes(*words.text_bytes(pa.array(texts, pa.string())))
    seen = {}
    for i, t in enumerate(texts):
        own = corpus.words(t)
        assert rows[i + 1] - rows[i] == len(own)
        for w, h in zip(own, hashes[rows[i]:rows[i + 1]].tolist()):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)
    values, _, row = words.shingles(hashes, rows, 5)
    have, offs = words.distinct(values, row, len(texts))
    for i, t in enumerate(texts):
        w = corpus.words(t)
        want = {tuple(w[j:j + 5]) for j in range(len(w) - 4)} or ({tuple(w)} if w else set())
        assert offs[i + 1] - offs[i] == len(want)


def test_sliced_arrow_columns():
    column = pa.array(["skip", "a b", None, "c"], pa.string()).slice(1)
    data, offs = words.text_bytes(column)
    assert bytes(data) == b"a bc" and offs.tolist() == [0, 3, 3, 4]


# ------------------------------------------------------------------ 10
def test_quality_rules_equal_sql(spark):
    rows = [r for r in ROWS if r[1] is None or " " not in r[1]]
    df = corpus.frame(spark, rows, extra=False)
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"]))
    key = lambda t: tuple((x is None or x != x, x) for x in t)
    got = quality_rules.judge(df)
    want = con.sql(quality_rules.oracle_sql())
    have = sorted((tuple(r) for r in got.select(*want.columns).collect()), key=key)
    # the SQL joins by doc_id, so repeated ids are left out
    once = {d for d, n in Counter(r[0] for r in rows).items() if n == 1 and d is not None}
    assert [r for r in have if r[0] in once] == sorted((r for r in want.fetchall() if r[0] in once), key=key)
    assert "Python" not in got._jdf.queryExecution().toString()


def test_repeat_words_by_hand(spark):
    run = " ".join(f"w{i}" for i in range(9))
    text = f"{run} x {run} y z"
    got = quality_rules.judge(spark.createDataFrame([(1, text), (2, "a " * 30), (3, "\n".join(["same line", " ", "same line"]))], "doc_id long, text string"))
    by = {r.doc_id: r for r in got.collect()}
    assert by[1].n_repeat_words == 18 and by[2].n_repeat_words == 30 and by[3].n_dup_lines == 1
    assert by[2].base_failed and not by[2].kept


def test_quality_keep(spark):
    df = corpus.frame(spark, ROWS)
    kept = quality_rules.keep(df)
    assert kept.columns == df.columns
    want = quality_rules.judge(df).where("kept").count()
    assert 0 < kept.count() == want < len(ROWS)
    assert quality_rules.keep(corpus.empty(spark)).count() == 0 == quality_rules.judge(corpus.empty(spark)).count()


# ------------------------------------------------------------------ 1
def brute_licenses(text, min_coverage=0.75):
    """Templates whose words lie, in order and nearly together, in the text
    (longest common subsequence over every window of the right size)."""
    plain = lambda t: "".join(c.lower() if c.isalnum() or ord(c) > 127 else " " for c in t or "").split()
    own, out = plain(text), set()
    for name, t in license_scan.TEMPLATES.items():
        need = plain(t)
        for s in range(max(1, len(own) - len(need) + 4)):
            window = own[s:s + len(need) + 3]
            table = [[0] * (len(window) + 1) for _ in range(len(need) + 1)]
            for i, a in enumerate(need):
                for j, b in enumerate(window):
                    table[i + 1][j + 1] = table[i][j] + 1 if a == b else max(table[i][j + 1], table[i + 1][j])
            if table[-1][-1] >= min_coverage * len(need):
                out.add(name)
                break
    return out


def test_license_scan(spark):
    rng = random.Random(2)
    rows, want = [], set()
    for i, (name, t) in enumerate(license_scan.TEMPLATES.items()):
        for k in range(3):
            own = t.split()
            if k == 1:
                own.insert(rng.randrange(len(own)), "really")
            if k == 2 and len(own) > 20:
                own[rng.randrange(5, 15)] = "CHANGED"
            text = corpus.prose(rng, 30) + "\n" + " ".join(own).upper() + "\n" + corpus.prose(rng, 30)
            rows.append((10 * i + k, text, "en", "s", 1))
    rows += [(1000 + i, r[1], "en", "s", 1) for i, r in enumerate(ROWS)]
    got = license_scan.scan(corpus.frame(spark, rows)).collect()
    have = {(r.doc_id, r.template) for r in got}
    texts = {r[0]: r[1] for r in rows}
    for i, name in enumerate(license_scan.TEMPLATES):
        for k in range(3):
            assert (10 * i + k, name) in have
    for doc, name in have:
        want.add((doc, name))
        assert name in brute_licenses(texts[doc])
    for r in got:
        span = texts[r.doc_id][r.char_start:r.char_end]
        assert span.encode() == texts[r.doc_id].encode()[r.byte_start:r.byte_end]
        own = "".join(c if c.isalnum() else " " for c in span).split()
        assert r.matched_words <= len(own) and r.coverage == r.matched_words / r.template_words >= 0.75
    assert license_scan.scan(corpus.empty(spark)).count() == 0


def test_winnowing_meets_every_long_run():
    rng = np.random.default_rng(3)
    for _ in range(50):
        a = rng.integers(0, 30, 60, dtype=np.uint64)
        kept = license_scan.winnow(a, np.zeros(60, np.int64))
        assert all(((kept >= i) & (kept < i + license_scan.WINDOW)).any() for i in range(60 - license_scan.WINDOW + 1))
    assert license_scan.winnow(np.empty(0, np.uint64), np.empty(0, np.int64)).tolist() == []


def test_templates_have_a_size_bound(monkeypatch):
    monkeypatch.setattr(license_scan, "MAX_TEMPLATE_BYTES", 10)
    with pytest.raises(ValueError):
        license_scan.Index(license_scan.TEMPLATES)


# ------------------------------------------------------------------ 5
def shingle_bag(w):
    return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def brute_leaks(docs, items):
    split = lambda t: [w for w in corpus.WORD.findall((t or "").lower())]
    out = {}
    for item, text in items:
        need = split(text)
        bag = shingle_bag(need)
        for doc, text_, *_ in docs:
            own = split(text_)
            for s in range(1 - len(need), len(own)):
                have = shingle_bag(own[max(0, s):s + len(need)])
                c = sum((bag & have).values())
                if c and 4 * c >= 3 * (sum(bag.values()) + sum(have.values()) - c):
                    sim = c / (sum(bag.values()) + sum(have.values()) - c)
                    out[doc, item] = max(out.get((doc, item), 0), sim)
    return out


def planted():
    rng = random.Random(4)
    items = [(i, corpus.prose(rng, rng.randrange(6, 50))) for i in range(25)] + [(90, "tiny item"), (91, ""), (92, None), (93, "a a a a a a a a b b")]
    items.append((94, items[3][1]))  # a repeated item
    rows = [r for r in ROWS if r[0] is not None][:50]
    for i, (_, t) in enumerate(items[:25]):
        own = t.split()
        if i % 3 == 1:
            own[rng.randrange(len(own))] = "changed"
        if i % 5 == 2:
            own = own[2:]  # cut off
        rows.append((3000 + i, (corpus.prose(rng, 20) + " " if i % 4 else "") + " ".join(own).upper() + (" " + corpus.prose(rng, 20) if i % 2 else ""), "en", "s", 1))
    rows += [(4000, "some tiny item here", "en", "s", 1), (4001, "a a a a a a a a b b", "en", "s", 1)]
    return rows, items


def test_leaks_equal_brute_force(spark, monkeypatch):
    rows, items = planted()
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute_leaks(rows, items)
    for limit in (1_000_000, 40):  # one broadcast slice, and many
        monkeypatch.setattr(decontaminate, "SLICE", limit)
        got = decontaminate.leaks(corpus.frame(spark, rows), bench)
        assert {(r.doc_id, r.item_id): r.similarity for r in got.collect()} == pytest.approx(want)
    assert len(want) > 15
    kept = decontaminate.clean(corpus.frame(spark, rows), bench)
    assert kept.columns == corpus.frame(spark, rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in rows if r[0] not in {d for d, _ in want})


def test_leaks_run_without_python(spark):
    rows, items = planted()
    plan = decontaminate.leaks(corpus.frame(spark, rows, extra=False), spark.createDataFrame(items, "item_id long, text string"))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_leaks_of_empty_tables(spark):
    items = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    assert decontaminate.leaks(corpus.empty(spark), items).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    df = corpus.frame(spark, ROWS)
    assert decontaminate.leaks(df, none).count() == 0 and decontaminate.clean(df, none).count() == len(ROWS)


def test_radius_holds_for_similar_windows(spark):
    """Fingerprints of windows that reach the similarity lie far inside."""
    rng = random.Random(6)
    rows = []
    for i in range(150):
        w = corpus.prose(rng, rng.randrange(12, 60)).split()
        v = list(w)
        v[rng.choice([0, len(v) - 1, rng.randrange(len(v))])] = "zz" + str(i)
        a, b = shingle_bag(w), shingle_bag(v)
        c = sum((a & b).values())
        if 4 * c >= 3 * (sum(a.values()) + sum(b.values()) - c):
            rows.append((w, v))
    df = spark.createDataFrame(rows, "a array<string>, b array<string>")
    far = df.selectExpr("*").select(decontaminate.F.bit_count(decontaminate.simhash(df["a"]).bitwiseXOR(decontaminate.simhash(df["b"]))).alias("d")).collect()
    assert len(far) > 30 and max(r.d for r in far) <= decontaminate.RADIUS


# ------------------------------------------------------------------ 8
def test_scores_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "CELL_TOKENS", 700)
    monkeypatch.setattr(lm_score, "RANGE_KEYS", 1000)
    df, model = lm_score.score(corpus.frame(spark, ROWS))
    got = sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[6]))
    texts = [(r[0], corpus.words(r[1]) + ["\0"]) for r in ROWS]
    train = [t for d, t in texts if lm_score.fold(d)]
    uni, bi, context = Counter(), Counter(), Counter()
    for t in train:
        uni.update(t)
        bi.update(zip(["\1", *t], t))
        context.update(["\1", *t[:-1]])
    n, v = sum(uni.values()), len(uni)
    assert (model.tokens, model.words) == (n, v)
    want = []
    for d, t in texts:
        score = 0.0
        for h, w in zip(["\1", *t], t):
            low = model.unigram * uni[w] / n + (1 - model.unigram) / (v + 1)
            a = model.bigram[context[h].bit_length()] if context[h] else 0.0
            score += math.log10((a * bi[h, w] / context[h] if context[h] else 0.0) + (1 - a) * low)
        base = sum(math.log10((uni[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        want.append((d, not lm_score.fold(d), len(t), sum(uni[w] > 0 for w in t), n, base, score))
    want.sort(key=lambda r: (r[0] is None, r[0] or 0, r[6]))
    for g, w in zip(got, want):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:], abs=1e-8)
    assert len(got) == len(want)
    held = [(g[5], g[6]) for g in got if g[1]]
    assert sum(s for _, s in held) > sum(b for b, _ in held)  # better than the base on unseen texts


def test_em_finds_the_mixture():
    rng = np.random.default_rng(0)
    rows = pd.DataFrame({"bucket": [3] * 2000 + [5] * 2000, "two": np.where(rng.random(4000) < np.repeat([0.2, 0.8], 2000), 40, -9999), "one": [0] * 4000, "n": 1})
    m, a = lm_score.estimate_weights(rows)
    assert 0.1 < a[3] < 0.25 and 0.7 < a[5] < 0.85 and 0 < m < 1 and a[0] == 0.0


def test_em_fits_both_levels_together():
    """Tokens drawn from a known mixture: its weights come back, and no small
    step away from them is more likely."""
    rng = np.random.default_rng(4)
    size, m, a = 60_000, 0.7, {2: 0.25, 6: 0.6}
    b = rng.choice([2, 6], size)
    level = np.where(rng.random(size) < np.vectorize(a.get)(b), 2, np.where(rng.random(size) < m, 1, 0))
    # each level draws from a share 1/64 or 1/32 of the words; the others meet these as often
    two = np.where((level == 2) | (rng.random(size) < 1 / 64), 6 * lm_score.STEP, -9999)
    one = np.where((level == 1) | (rng.random(size) < 1 / 32), 5 * lm_score.STEP, -9999)
    rows = pd.DataFrame({"bucket": b, "two": two, "one": one, "n": 1}).groupby(["bucket", "two", "one"], as_index=False).sum()
    got_m, got_a = lm_score.estimate_weights(rows)

    def likelihood(m, a2, a6):
        share = np.where(rows["bucket"] == 2, a2, a6)
        x, y = (np.where(rows[c] == -9999, 0, 2.0 ** (rows[c] / lm_score.STEP)) for c in ("two", "one"))
        return float(rows["n"] @ np.log(share * x + (1 - share) * (m * y + 1 - m)))

    best = likelihood(got_m, got_a[2], got_a[6])
    for step in (-1e-3, 1e-3):
        assert best >= max(likelihood(got_m + step, got_a[2], got_a[6]), likelihood(got_m, got_a[2] + step, got_a[6]), likelihood(got_m, got_a[2], got_a[6] + step))
    assert got_a[2] == pytest.approx(0.25, abs=0.015) and got_a[6] == pytest.approx(0.6, abs=0.015) and got_m == pytest.approx(0.7, abs=0.015)
    assert got_a[3] == got_a[2] and got_a[0] == got_a[1] == 0.0  # buckets without tokens take the one below


def test_key_lists_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 500):
        keys = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
        assert lm_score._unpack_keys(lm_score._pack_keys(keys), len(keys)).tolist() == keys.tolist()


def test_scores_of_small_tables(spark):
    assert lm_score.score(corpus.empty(spark))[0].count() == 0
    one = lm_score.score(spark.createDataFrame([(None, None)], "doc_id long, text string"))[0].first()
    assert one.held_out and one.n_tokens == 1 and one.n_known == 0 and one.train_tokens == 0 and one.score == 0.0
    same = lm_score.score(spark.createDataFrame([(1, "a b")] * 3, "doc_id long, text string"))[0].collect()
    assert len(same) == 3 and len({r.score for r in same}) == 1


# ------------------------------------------------------------------ 9
URLS = ["http://Sub.Example.NET/en/1", "https://example.net/de/2?x=1", "https://a.example.com/de/3#y", "http://b.org/fr/", "http://b.org/fr", "http://net/",
        "http://x.net", "http://internet/a", "no scheme", None, "", "ftp://cheap-pills.example.org/buy/7?u=http://z.net/en/", "http://blog.example.org/en/9.html",
        "http://example.net/en", "://", "http://h.com?q#f", "http://casinowin.example.com/es/4"]


def brute_rule(url):
    if not url or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = ""
    for c in rest:
        if c in "/?#":
            break
        host += c
    path = ""
    for c in rest[len(host):]:
        if c in "?#":
            break
        path += c
    host = host.translate(corpus.UPPER)
    fits = [(len(h + p), h + p) for _, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1] if fits else None


def test_url_rules_and_verdicts(spark):
    rows = [(i if i else None, u, f"<p>spam casino win pills blog text{i}</p><script>ignored</script>") for i, u in enumerate(URLS * 2)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as host", "'y' as rule", "'z' as token").repartition(3)
    got = url_filter.judge(df).collect()
    assert len(got) == len(rows)
    want = Counter((r[0], *brute_rule(r[1])) for r in rows)
    assert Counter((r.page_id, r.host, r.path, r.rule) for r in got) == want
    verdict = {h + p: v for v, h, p in url_filter.RULES}
    for r in got:
        assert r.verdict == (verdict[r.rule] if r.rule else "block" if r.score > 0 else "allow")
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    free = url_filter.judge(spark.createDataFrame([(1, "http://a.b/c", None)], "page_id long, url string, html string")).first()
    assert (free.verdict, free.score) == ("allow", 0.0)


def _tokens(host, path):
    """Tokens of a url whose host words are not split, without the rules' own."""
    host_words, path_words = {"net", "example", "com", "org"}, {"en", "de", "fr"}
    out = ["h:" + w for w in re.findall(r"[a-z]+", host) if w not in host_words]
    words = re.findall(r"[a-z]+|[0-9]+", path)
    return out + ["p:" + ("<num>" if w.isdigit() else w) for w in words if w not in path_words]


def test_scores_equal_plain_bayes(spark):
    """Settings on the held-out hosts and scores of all urls."""
    rng = random.Random(9)
    hosts = [a + "-" + b for a in ("alpha", "beta", "gamma", "delta") for b in ("shop", "club", "news", "park", "bay")]
    rows = []
    for i in range(240):
        h = rng.choice(hosts)
        top = "net" if rng.random() < (0.8 if "shop" in h or "club" in h else 0.2) else "org"
        rows.append((i, f"http://{h}.example.{top}/{rng.choice(('en', 'de', 'fr'))}/{i}/{rng.choice(('one', 'two2three'))}", "words"))
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    judged = [(r.page_id, r.host, r.held) for r in url_filter.judge(frame).selectExpr("page_id", "host", "pmod(xxhash64(host), 5) = 0 held").collect()]
    held = {i for i, _, h in judged if h}
    verdicts = {h + q: v for v, h, q in url_filter.RULES}
    known = {i: (_tokens(*brute_rule(u)[:2]), verdicts.get(brute_rule(u)[2])) for i, u, _ in rows}
    assert any(known[i][1] for i in held)

    def model(ids):
        n, count = {"block": Counter(), "allow": Counter()}, Counter()
        for i in ids:
            tokens, v = known[i]
            if v:
                n[v].update(tokens)
                count[v] += 1
        vocab = set(n["block"]) | set(n["allow"])
        sums = {v: sum(c.values()) for v, c in n.items()}

        def odds(tokens, a, q):
            out = q * math.log((count["block"] + 1) / (count["allow"] + 1))
            for t in tokens:
                if t in vocab:
                    out += math.log((n["block"][t] + a) / (sums["block"] + a * len(vocab))) - math.log((n["allow"][t] + a) / (sums["allow"] + a * len(vocab)))
            return out
        return odds

    fit = model(i for i in known if i not in held)
    settings = url_filter.held_out(frame).collect()
    test = [known[i] for i in held if known[i][1]]
    for r in settings:
        scored = [(fit(t, r.smoothing, r.prior), v) for t, v in test]
        assert r.rows == len(test)
        assert r.loss == pytest.approx(sum(math.log1p(math.exp(-s if v == "block" else s)) for s, v in scored) / len(test))
        assert r.accuracy == pytest.approx(sum((s > 0) == (v == "block") for s, v in scored) / len(test))
    best = min(settings, key=lambda r: r.loss)
    assert settings[0].loss == pytest.approx(best.loss)
    whole = model(known)
    for r in url_filter.judge(frame).collect():
        assert r.score == pytest.approx(whole(known[r.page_id][0], settings[0].smoothing, settings[0].prior), abs=1e-6)


def test_long_host_label(spark):
    """A label of 10,000 letters is split like any other."""
    label = "freebets" * 1250
    counts = spark.createDataFrame([("free", 90), ("bets", 50), ("bet", 2)], "word string, n long")
    got = url_filter.split_labels(spark.createDataFrame([(label,), ("free",)], "label string"), counts).collect()
    assert {r.label: r.words for r in got} == {label: ["free", "bets"] * 1250, "free": ["free"]}


def test_words_of_any_length(spark):
    """A counted word longer than the prefix by which it is looked up, and an
    unseen string of that length, stay whole."""
    word = "donaudampfschifffahrtsgesellschaft"
    counts = spark.createDataFrame([(word, 3), ("free", 90), (word[:24] + "x", 5)], "word string, n long")
    labels = spark.createDataFrame([(word,), ("free" + word,), ("q" * 40,)], "label string")
    got = {r.label: r.words for r in url_filter.split_labels(labels, counts).collect()}
    assert got == {word: [word], "free" + word: ["free", word], "q" * 40: ["q" * 40]}


def test_viterbi_equals_all_splits():
    rng = random.Random(2)
    for _ in range(300):
        label = "".join(rng.choice("ab") for _ in range(rng.randrange(1, 9)))
        count = {"".join(rng.choice("ab") for _ in range(rng.randrange(1, 5))): rng.randrange(1, 60) for _ in range(5)}
        cost = lambda ws: sum(math.log(99) - math.log(count[w]) if w in count else math.log(99) + len(w) * math.log(10) for w in ws)
        every = [[label[a:b] for a, b in zip([0, *cuts], [*cuts, len(label)])] for m in range(1 << len(label) - 1)
                 for cuts in [[i + 1 for i in range(len(label) - 1) if m >> i & 1]]]
        assert abs(cost(url_filter.viterbi(label, count, 99)) - min(map(cost, every))) < 1e-9


def test_viterbi_splits_words():
    count = {"free": 50, "bets": 30, "be": 20, "ts": 1, "cheap": 9, "pills": 9}
    assert url_filter.viterbi("freebets", count, 200) == ["free", "bets"]
    assert url_filter.viterbi("cheappills", count, 200) == ["cheap", "pills"]
    assert url_filter.viterbi("qqq", count, 200) == ["qqq"]
    assert url_filter.viterbi("", count, 200) == []


def _found(spark, texts, **kw):
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    out = {}
    for r in license_scan.scan(corpus.frame(spark, rows, extra=False), **kw).collect():
        out.setdefault((r.doc_id, r.template), []).append((r.char_start, r.char_end))
    return out


def test_short_notices_with_one_edit_are_found_whatever_lies_around(spark):
    rng = random.Random(12)
    shapes = [("{w} under the MIT License.", "mit-line"), ("Released {w} the MIT License.", "mit-line"), ("Released under {w} MIT License.", "mit-line"),
              ("Released under the {w} MIT License.", "mit-line"), ("Released under the MIT {w}", "mit-line"), ("Released under {w} the MIT License.", "mit-line"),
              ("Licensed under CC {w} BY-NC 4.0.", "cc-by-nc-4.0-line"), ("Licensed under CC BY-NC {w}.0.", "cc-by-nc-4.0-line")]
    texts, want = [], []
    for _ in range(400):
        for shape, name in shapes:
            texts.append(f"{corpus.prose(rng, 6)} {shape.format(w='w' + str(rng.randrange(10**6)))} {corpus.prose(rng, 6)}")
            want.append(name)
    found = _found(spark, texts)
    assert [i for i, name in enumerate(want) if (i, name) not in found] == []


def test_copies_side_by_side_are_a_row_each(spark):
    mit, cc = "Released under the MIT License.", "Licensed under CC BY-NC 4.0."
    texts = [" ".join([mit] * 4), " ".join([cc] * 2), f"{mit} {cc} {mit}", f"Released under the new License. {mit}", " ".join([mit] * 300)]
    found = _found(spark, texts)
    for i, t in enumerate(texts[:3] + texts[4:]):
        i = i if i < 3 else 4
        for name, notice in (("mit-line", mit), ("cc-by-nc-4.0-line", cc)):
            spans = sorted(found.get((i, name), []))
            assert len(spans) == t.count(notice)
            assert all(t[a:b] == notice.rstrip(".") for a, b in spans)
    assert len(found[3, "mit-line"]) == 2


def test_license_templates_of_any_length(spark):
    templates = {"one": "Copyleft", "two": "public domain", "three": "all rights reserved", "nine": "a b c d e f g h i", "none": "..."}
    rng = random.Random(5)
    texts = ["Copyleft!", "in the Public Domain, really", "All rights, reserved; Copyleft", "public x domain", "a b X d e Y g h i", "a b c X d e f Y g h i", "none"]
    found = set(_found(spark, [corpus.prose(rng, 4) + " " + t for t in texts], templates=templates))
    assert {(0, "one"), (1, "two"), (2, "three"), (2, "one"), (4, "nine"), (5, "nine")} <= found and (6, "none") not in found


def test_license_scan_of_a_very_long_text(spark):
    notice = "Released under the MIT License."
    text = "filler " * 400_000 + notice + " word" * 400_000 + " " + notice
    assert _found(spark, [text])[0, "mit-line"] == [(2_800_000, 2_800_030), (len(text) - len(notice), len(text) - 1)]
