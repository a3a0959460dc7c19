"""Small corpora for the tests, and plain reimplementations of shared rules."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(UPPER))


def prose(rng: random.Random, n: int) -> str:
    syllables = ["th", "er", "on", "an", "re", "é", "tion", "ö", "la", "st"]
    common = ["the", "of", "and", "to", "in", "der", "la", "que"]
    out = []
    for i in range(n):
        w = rng.choice(common) if rng.random() < 0.4 else "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 5)))
        out.append(w + ("." if rng.random() < 0.1 else "") + ("\n" if rng.random() < 0.04 else " "))
    return "".join(out).strip()


def documents(seed: int = 0, n: int = 60) -> list[tuple]:
    """Documents with copies, near copies, shared passages, nulls, empty and
    very short texts, odd white space, a repeated row and a null id."""
    rng = random.Random(seed)
    texts: list[str | None] = [prose(rng, rng.randrange(20, 200)) for _ in range(n)]
    passage = prose(rng, 60)
    for i in range(5):
        texts.append(prose(rng, 30) + "\n" + passage + "\n" + prose(rng, 25))
    base = prose(rng, 120).split(" ")
    for _ in range(12):  # near copies with a few changed words
        copy = list(base)
        for _ in range(rng.randrange(0, 6)):
            copy[rng.randrange(len(copy))] = "x" + str(rng.randrange(1000))
        texts.append(" ".join(copy))
    texts += [texts[0], texts[0], texts[3].upper(), "", None, " ", "one", "One", "two words", "a b c d", "a b c d e", "a b c d e",
              "  double  spaces \t tab\x0bvertical ", "nbsp\u00a0and\u2003wide", "<|endoftext|> in text", "x" * 3000, "ab " * 400, "\n\n\n", "é" * 120 + " " + "é" * 130]
    rows = [(i * 7 % 1009, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    rows.append(rows[5])  # a repeated row
    rows.append((None, texts[6], "en", "src0", 1))  # a null id on a copy
    rows.append((None, prose(rng, 50), None, None, None))
    return rows


def frame(spark, rows, extra: bool = True):
    """A DataFrame over several partitions, with columns whose names the
    operators use themselves."""
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    if extra:
        for name in ("row", "found", "c", "words", "sid", "key", "start", "__counts", "d", "t"):
            df = df.selectExpr("*", f"'{name}' as `{name}`")
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
