"""The corpus pipeline against a brute-force version, and the catalog."""

from __future__ import annotations

import random
from collections import Counter

import corpus
import corpus_pipeline
import public_tokenizers
from test_llm_dedup import brute_components, brute_removal
from test_llm_text import brute_leaks

from tripspark.llm import catalog, quality_rules, runtime, tokens

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def raw_documents():
    rng = random.Random(21)
    stop = lambda n: " ".join(rng.choice(["the", "of", "and", "to", "la", "der"]) if i % 3 == 0 else corpus.prose(rng, 1) or "x" for i in range(n))
    items = [(i, stop(30)) for i in range(6)]
    passage = stop(70)
    rows = [(i, stop(rng.randrange(25, 150))) for i in range(40)]
    rows += [(100 + i, rows[i][1]) for i in range(4)]  # exact copies
    rows += [(110 + i, rows[5 + i][1] + " more") for i in range(4)]  # near copies
    rows += [(120 + i, stop(30) + "\n" + passage + "\n" + stop(30)) for i in range(4)]
    rows += [(130 + i, stop(25) + " " + items[i][1] + " " + stop(25)) for i in range(4)]
    rows += [(140, "too short"), (141, None), (142, ""), (143, "### " * 40), (144, "same words here " * 30)]
    return [(d, t, "en", f"s{d % 3}", len(t or "")) for d, t in rows], items


def brute_quality(rows):
    stop = {w for line in quality_rules.STOP_WORDS for w in line.split()}
    out = []
    for r in rows:
        text = r[1] or ""
        w = corpus.WORD.findall(text)
        windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        again = set()
        for i in range(len(w) - 7):
            if windows[tuple(w[i:i + 8])] > 1:
                again |= set(range(i, i + 8))
        lines = [x for x in text.split("\n") if corpus.WORD.search(x)]
        n = max(len(w), 1)
        if len(w) >= 20 and 100 * len(again) <= 30 * len(w) and 2 <= sum(map(len, w)) / n <= 15 and sum(c in "#*$%&|<>" for c in text) / n <= 0.1 \
                and sum(x in stop for x in w) / n >= 0.02 and (len(lines) - len(set(lines))) / max(len(lines), 1) <= 0.45:
            out.append(r)
    return out


def test_stages_equal_brute_force(spark):
    rows, items = raw_documents()
    sf_dir = runtime.scratch(spark, "tables")
    spark.createDataFrame(rows, corpus.SCHEMA).repartition(3).write.parquet(f"{sf_dir}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{sf_dir}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")

    want = brute_quality(rows)
    expected = [want]
    want = [r for r, c in zip(want, brute_components(want)) if c[0] == c[2]]
    expected.append(want)
    cut = []
    seen = set()
    for r in sorted(want):
        data = r[1].encode()
        gone = bytearray(len(data))
        for s in range(len(data) - 99):
            if data[s:s + 100] in seen:
                gone[s:s + 100] = b"\1" * 100
            seen.add(data[s:s + 100])
        text = bytes(b for b, g in zip(data, gone) if not g).decode("utf-8", "ignore")
        cut.append((r[0], text, *r[2:4], len(text)))
    assert sum(w[2] for w in brute_removal(want)) == sum(len(r[1].encode()) for r in want) - sum(len(r[1].encode()) for r in cut)
    expected.append(cut)
    leaks = {d for d, _ in brute_leaks(cut, items)}
    expected.append([r for r in cut if r[0] not in leaks])
    assert len(leaks) >= 4 and all(len(a) >= len(b) for a, b in zip([rows, *expected], expected))

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeated_passages", "benchmark_leaks", "sequences"]
    for (name, stage), rows_after in zip(corpus_pipeline.STAGES, expected):
        docs = runtime.stored(stage(spark, docs, sf_dir), name)
        assert docs.columns == COLUMNS, name
        assert sorted(map(tuple, docs.collect())) == sorted(rows_after), name

    tok = tokens.PieceTokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    total = {r[0]: len(tok.tokenizer.encode(r[1], add_special_tokens=False).ids) + 1 for r in expected[-1]}
    got = corpus_pipeline.run(spark, sf_dir).collect()
    held = Counter()
    for r in got:
        held[r.doc_id] += r.length
        assert r.doc_tokens == total[r.doc_id]
    assert held == total


def test_every_operator_is_registered():
    numbers = sorted(int(k[2:].split("_")[0]) for k in catalog.QUERIES if k.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in catalog.QUERIES
    assert set(catalog.oracle_sql()) <= set(catalog.QUERIES)


def test_entry_works_without_the_subpackage(monkeypatch):
    import importlib.util

    import __spark_entry__ as entry

    assert "op1_license_scan" in entry.queries()
    find = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if name.startswith("tripspark.llm") else find(name, *a))
    assert "silver" in entry.queries() and not any(k.startswith("op") or k == "pipeline" for k in entry.queries())
    assert not any(k.startswith("op") for k in entry.oracle_sql())


def test_nothing_else_imports_the_subpackage():
    from pathlib import Path

    root = Path(__file__).resolve().parents[2]
    for path in [*root.glob("tripspark/**/*.py"), *root.glob("tests/*.py"), root / "bench.py"]:
        if "llm" not in path.relative_to(root).parts:
            assert "tripspark.llm" not in path.read_text(), path
