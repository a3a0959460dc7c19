"""Operator 10: document quality rules as one Spark projection.

``RULES`` is a threshold table over length, symbol, stop-word and line ratios.
:func:`judge` computes the counts and compiles the table into column
expressions of one projection: no Python, no shuffle, one pass over the text.

Defined cases: a null text counts as empty (no words: ``base_failed``); rows
with a null id and repeated rows are judged one by one; extra columns of the
input are ignored, and an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8

# Common function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in a is that for it with as on by be are this from at or an was not",
    "le la les de des du et en un une est que qui dans pour sur pas au aux par il elle",
    "der die das und den von zu mit sich des auf für ist im dem nicht ein eine als auch",
    "el los las y por con para del se lo como más o una su al es no si sus",
)


@dataclass(frozen=True)
class Rule:
    """``metric`` must lie within [low, high] for a document to be kept."""

    metric: str
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("mean_word_chars", low=2.0, high=15.0),
    Rule("symbol_ratio", high=0.1),  # symbols per word
    Rule("stop_ratio", low=0.02),  # lower-case stop words of all words
    Rule("dup_line_ratio", high=0.45),  # repeated lines of lines with a word
)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def repeat_words(words: Column, k: int = WINDOW) -> Column:
    """Words covered by k-word windows that occur twice or more (k a power
    of two)."""

    def covered(windows: Column) -> Column:
        n = F.size(windows)
        ranked = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            hash_at = lambda j: F.get(s, j)["h"]
            twin = lambda j: F.coalesce(hash_at(j) == hash_at(j - 1), F.lit(False)) | F.coalesce(hash_at(j) == hash_at(j + 1), F.lit(False))
            return F.sort_array(F.array_compact(F.transform(F.sequence(F.lit(0), n - 1), lambda j: F.when(twin(j), F.get(s, j)["i"]))))

        def total(at: Column) -> Column:
            step = F.transform(at, lambda i, j: F.least(F.lit(k), F.coalesce(F.get(at, j + 1) - i, F.lit(k))))
            return F.aggregate(step, F.lit(0).cast("long"), lambda acc, x: acc + x)

        return F.when(F.size(F.array_distinct(windows)) == n, F.lit(0).cast("long")).otherwise(
            _let(_let(ranked, starts), total))

    def window_hashes(h: Column) -> Column:
        """Hash of each k words by doubling: pairs, pairs of pairs, ..."""

        def doubled(x: Column, step: int) -> Column:
            if step == k:
                return F.slice(x, F.lit(1), F.size(h) - (k - 1))
            joined = F.zip_with(x, F.slice(x, F.lit(step + 1), F.size(x)), lambda a, b: F.xxhash64(a, b))
            return _let(joined, lambda y: doubled(y, 2 * step))

        return doubled(h, 1)

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) <= k, F.lit(0).cast("long")).otherwise(_let(_let(hashes, window_hashes), covered))


def counts(text: Column) -> Column:
    """A struct of every count the rules use."""
    stop_list = sorted({w for line in STOP_WORDS for w in line.split()})

    def of(pieces: Column) -> Column:
        # pieces are what lies between two single white-space characters
        chars = F.length(text) - F.size(pieces) + 1
        return _let(F.array_remove(pieces, ""), lambda words: _let(lines, lambda found: F.struct(
            F.size(words).cast("long").alias("n_words"),
            chars.cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            (F.size(found) - F.size(F.array_distinct(found))).cast("long").alias("n_dup_lines"),
            repeat_words(words).alias("n_repeat_words"),
            F.size(found).cast("long").alias("n_lines"),
            F.size(F.filter(words, lambda w: w.isin(stop_list))).cast("long").alias("n_stop"),
        )))

    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return _let(F.split(text, GAP), of)


def metrics(c: Column) -> dict[str, Column]:
    per_word = lambda name: c[name] / F.greatest(c["n_words"], F.lit(1))
    return {
        "mean_word_chars": per_word("word_chars"),
        "symbol_ratio": per_word("n_symbols"),
        "stop_ratio": per_word("n_stop"),
        "dup_line_ratio": c["n_dup_lines"] / F.greatest(c["n_lines"], F.lit(1)),
    }


def passes(c: Column, rules=RULES) -> Column:
    """The threshold table as one boolean expression."""
    by_name, ok = metrics(c), F.lit(True)
    for rule in rules:
        if rule.low is not None:
            ok = ok & (by_name[rule.metric] >= rule.low)
        if rule.high is not None:
            ok = ok & (by_name[rule.metric] <= rule.high)
    return ok


def base_failed(c: Column) -> Column:
    """Fewer than 20 words, or more than 30 % of the words lie in repeated
    eight-word windows."""
    return (c["n_words"] < 20) | (100 * c["n_repeat_words"] > 30 * c["n_words"])


def judge(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` for each document."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    c = F.col("c")
    out = docs.select(docs[id_col].alias("doc_id"), counts(text).alias("c"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return out.select("doc_id", *[c[n].alias(n) for n in names], base_failed(c).alias("base_failed"),
                      (~base_failed(c) & passes(c, rules)).alias("kept"))


def keep(docs: DataFrame, rules=RULES, text_col: str = "text") -> DataFrame:
    """The documents that pass, with their own columns."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    return docs.where(_let(counts(text), lambda c: ~base_failed(c) & passes(c, rules)))


def oracle_sql(rules=RULES) -> str:
    """The same rows in DuckDB SQL over the view ``documents``."""
    stop = ", ".join(f"'{w}'" for w in sorted({w for line in STOP_WORDS for w in line.split()}))
    metric = {
        "mean_word_chars": "word_chars / greatest(n_words, 1)", "symbol_ratio": "n_symbols / greatest(n_words, 1)",
        "stop_ratio": "n_stop / greatest(n_words, 1)",
        "dup_line_ratio": "n_dup_lines / greatest(n_lines, 1)",
    }
    tests = [f"{metric[r.metric]} {op} {bound}" for r in rules for op, bound in ((">=", r.low), ("<=", r.high)) if bound is not None]
    return rf"""
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws,
                      list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls FROM documents),
    g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c
          FROM (SELECT doc_id, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS g
                FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM t WHERE len(ws) >= {WINDOW}))),
    r AS (SELECT doc_id, sum(least({WINDOW}, coalesce(nx - i, {WINDOW})))::BIGINT AS n_repeat_words
          FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nx FROM g WHERE c >= 2) GROUP BY doc_id),
    m AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
                 len(regexp_extract_all(text, '{SYMBOLS}'))::BIGINT AS n_symbols,
                 (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines,
                 len(list_filter(ws, lambda w: w IN ({stop}))) AS n_stop,
                 coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
          FROM t LEFT JOIN r USING (doc_id)),
    b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND {" AND ".join(tests)} AS kept FROM b"""
