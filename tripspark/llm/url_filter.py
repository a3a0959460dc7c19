"""Operator 9: URL filter. Rules first; urls without a rule are scored by
multinomial naive Bayes over the words of their host and path.

Host names are concatenated words. A unigram model (word counts over the
visible text of all pages) splits each label at the most probable words
(Viterbi); the classifier sees these words and the path's tokens.

The only labels are the rules' own verdicts, so the classifier learns from
every url that a rule judges. Host labels, host words and path tokens that a
rule itself names are no evidence: they would only repeat the rule. Nor is a
token that no judged url holds. Smoothing and the weight of the class prior are
those of ``SMOOTHING`` and ``PRIORS`` with the smallest log loss on held-out
hosts (a fifth, by hash); the counts of all judged urls then go into the final
weights. :func:`held_out` reports loss and accuracy of every setting.

Every step works on distinct values: labels are split once each, hosts and
path shapes scored once each, then joined back to the pages (AQE splits hot
hosts). Only one-row totals and the grid's losses are collected.

Defined cases: a null url, or one without ``://``, has an empty host and path,
no rule, and the verdict of an empty token list (the prior's); null ids and
repeated rows are judged one by one; with no url that a rule judges the score
is 0 and the verdict allow; an empty table gives no rows. Labels may have any
length: long ones travel as a digest, and one task holds one label with the
counted words in it.
"""

from __future__ import annotations

import math
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripspark.llm import runtime

# Verdict, host, path prefix.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
SMOOTHING = (0.1, 0.3, 1.0, 3.0, 10.0)  # added to a token's count in each class
PRIORS = (0.0, 0.5, 1.0)  # weights of the classes' log ratio
HELD_OUT = 5  # one host in so many tells the settings apart
PREFIX = 24  # letters by which longer words are looked up
MARKUP = r"(?s)<script.*?</script>|<style.*?</style>|<[^>]*>|&\w+;"


def host_and_path(url: Column) -> tuple[Column, Column]:
    found = url.contains("://")
    rest = F.regexp_replace(url, r"(?s)^.*?://", "")
    part = lambda pattern: F.regexp_extract(rest, pattern, 1)
    host = F.translate(part(r"(?s)^([^/?#]*)"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = part(r"(?s)^[^/?#]*([^?#]*)")
    empty = lambda c: F.when(found, c).otherwise("")
    return empty(host), empty(path)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule's text and verdict (null: none fits)."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is tested first
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, what).otherwise(verdict)
    return name, verdict


def word_counts(pages: DataFrame, html_col: str) -> DataFrame:
    """(word, n) over the visible text of all pages; words of letters only."""
    text = F.lower(F.regexp_replace(F.coalesce(pages[html_col], F.lit("")), MARKUP, " "))
    words = pages.select(F.explode(F.split(text, r"[^\p{L}]+")).alias("word")).where("word <> ''")
    return words.groupBy("word").agg(F.count("*").alias("n"))


def viterbi(label: str, count: dict[str, int], total: float) -> list[str]:
    """The most probable words of a label. A word seen n times costs
    -log(n / total); an unseen string of k letters -log(1 / (total * 10**k)).
    Ties go to the longer last word."""
    floor, letter = math.log(max(total, 1.0)), math.log(10)
    lengths = sorted({len(w) for w in count}, reverse=True)
    best, back = [0.0] + [math.inf] * len(label), [0] * (len(label) + 1)
    low = 0  # where the best unseen string starts
    for j in range(1, len(label) + 1):
        if best[j - 1] - (j - 1) * letter < best[low] - low * letter - 1e-12:
            low = j - 1
        best[j], back[j] = best[low] + floor + (j - low) * letter, low
        for k in lengths:
            n = count.get(label[j - k:j]) if k <= j else None
            if n:
                cost = best[j - k] + floor - math.log(n)
                if cost < best[j] - 1e-12 or (cost < best[j] + 1e-12 and j - k < back[j]):
                    best[j], back[j] = cost, j - k
    words, j = [], len(label)
    while j > 0:
        words.append(label[back[j]:j])
        j = back[j]
    return words[::-1]


def split_labels(labels: DataFrame, counts: DataFrame) -> DataFrame:
    """Distinct ``label`` -> ``words``."""
    total = float(counts.agg(F.sum("n")).first()[0] or 0)
    short = F.length("label") <= 2 * PREFIX
    keyed = labels.where("label <> ''").select("label", F.when(short, F.col("label")).otherwise(F.concat(F.lit("#"), F.sha2("label", 256))).alias("key"))
    # the PREFIX letters from each place on, then each start of these
    places = keyed.select("key", "label", F.explode(F.sequence(F.lit(1), F.length("label"))).alias("i"))
    pieces = places.select("key", F.substring(F.col("label"), F.col("i"), F.lit(PREFIX)).alias("piece"))
    spans = pieces.select("key", "piece", F.explode(F.sequence(F.lit(1), F.length("piece"))).alias("k"))
    parts = spans.select("key", F.substring(F.col("piece"), F.lit(1), F.col("k")).alias("word")).distinct()
    known = parts.join(counts, "word").select("key", "word", "n")
    long_words = counts.where(F.length("word") > PREFIX).select(F.substring("word", 1, PREFIX).alias("start"), F.col("word").alias("whole"), "n")
    longer = (parts.where(F.length("word") == PREFIX).join(long_words, F.col("word") == F.col("start")).select("key", "whole", "n")
              .join(keyed, "key").where(F.contains("label", "whole")).select("key", F.col("whole").alias("word"), "n").distinct())
    found = known.unionByName(longer).groupBy("key").agg(F.collect_list("word").alias("found"), F.collect_list("n").alias("seen"))

    def split(frames):
        for frame in frames:
            words = [viterbi(label, {} if found is None else dict(zip(found, seen)), total)
                     for label, found, seen in zip(frame["label"], frame["found"], frame["seen"])]
            yield pd.DataFrame({"label": frame["label"], "words": words})

    rows = keyed.join(found, "key", "left").select("label", "found", "seen")
    return rows.mapInPandas(split, "label string, words array<string>")


def _path_tokens(path: Column) -> Column:
    shape = F.regexp_replace(F.lower(path), r"[0-9]+", " <num> ")
    return F.filter(F.split(shape, r"[^\p{L}<>]+"), lambda t: t != "")


def _own_tokens(rules) -> tuple[list[str], list[str]]:
    """Host words and path tokens that the rules name."""
    letters = lambda texts: sorted({w for t in texts for w in re.findall(r"[^\W\d_]+", t.lower())})
    return letters(r[1] for r in rules), letters(r[2] for r in rules)


class _Model:
    """Urls as (host, shape) with their tokens, and the classes of the tokens
    in the urls that rules judge."""

    def __init__(self, pages: DataFrame, rules, id_col: str, url_col: str, html_col: str):
        host, path = host_and_path(pages[url_col].cast("string"))
        base = pages.select(pages[id_col].alias("page_id"), F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
        rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
        own_host, own_path = _own_tokens(rules)
        shape = F.array_join(F.filter(_path_tokens(F.col("path")), lambda t: ~t.isin(own_path)), " ")
        self.base = base.select("*", rule.alias("rule"), verdict.alias("ruled"), shape.alias("shape"))

        pieces = self.base.select("host").distinct().select("host", F.explode(F.split("host", r"[^\p{L}]+")).alias("label"))
        pieces = pieces.where((F.col("label") != "") & ~F.col("label").isin(own_host))
        split = runtime.stored(split_labels(pieces.select("label").distinct(), runtime.stored(word_counts(pages, html_col), "word-counts")), "labels")
        host_tokens = pieces.join(split, "label").select("host", F.explode("words").alias("w")).where(~F.col("w").isin(own_host))
        host_tokens = runtime.stored(host_tokens.select("host", F.concat(F.lit("h:"), "w").alias("token")), "host-tokens")
        shape_tokens = self.base.select("shape").distinct().select("shape", F.explode(F.split("shape", " ")).alias("w")).where("w <> ''")
        self.tokens = {"host": host_tokens, "shape": shape_tokens.select("shape", F.concat(F.lit("p:"), "w").alias("token"))}

        # per token and class: in all judged urls, and in those not held out
        held = F.pmod(F.xxhash64("host"), F.lit(HELD_OUT)) == 0
        counts = [F.count_if((F.col("ruled") == v) & part).alias(f"{v}{x}") for v in ("block", "allow") for x, part in (("", F.lit(True)), ("_fit", ~held))]
        self.names = ["block", "block_fit", "allow", "allow_fit"]
        self.judged = runtime.stored(self.base.where("rule IS NOT NULL").groupBy("host", "shape").agg(*counts), "judged")
        sums = [F.sum(c).alias(c) for c in self.names]
        per = [self.judged.groupBy(key).agg(*sums).join(self.tokens[key], key).select("token", *self.names) for key in self.tokens]
        self.seen = runtime.stored(per[0].unionByName(per[1]).groupBy("token").agg(*sums), "token-classes")
        none = {c: 0 for c in self.names}
        self.rows = {c: n or 0 for c, n in (self.judged.agg(*sums).first() or none).asDict().items()}
        self.total = {c: n or 0 for c, n in self.seen.agg(*sums).first().asDict().items()}

    def prior(self, suffix: str) -> float:
        return math.log((self.rows["block" + suffix] + 1) / (self.rows["allow" + suffix] + 1))

    def scores(self, key: str, alphas, suffix: str = "") -> DataFrame:
        """``key`` -> log odds of its tokens, a column per smoothing."""
        block, allow = "block" + suffix, "allow" + suffix
        seen = self.seen.where(F.col(block) + F.col(allow) > 0)
        size = seen.count()
        odds = [(F.log((F.col(block) + a) / (self.total[block] + a * size)) - F.log((F.col(allow) + a) / (self.total[allow] + a * size))).alias(f"{key}{i}")
                for i, a in enumerate(alphas)]
        return self.tokens[key].join(seen.select("token", *odds), "token").groupBy(key).agg(*[F.sum(f"{key}{i}").alias(f"{key}{i}") for i in range(len(alphas))])

    def score(self, frame: DataFrame, alphas, suffix: str = "") -> tuple[DataFrame, list[Column]]:
        """``frame`` (host, shape) with its log odds by tokens, per smoothing."""
        for key in self.tokens:
            frame = frame.join(self.scores(key, alphas, suffix), key, "left")
        zero = F.lit(0.0)
        return frame, [F.coalesce(f"host{i}", zero) + F.coalesce(f"shape{i}", zero) for i in range(len(alphas))]

    def settings(self) -> list[dict]:
        """smoothing, prior, rows, loss (mean log loss) and accuracy on the
        held-out hosts, best setting first; without held-out urls the middle
        smoothing and the whole prior come first."""
        held = self.judged.where("block + allow > block_fit + allow_fit")
        frame, odds = self.score(held, SMOOTHING, "_fit")
        grid = [(a, q, s + q * self.prior("_fit")) for a, s in zip(SMOOTHING, odds) for q in PRIORS]
        n = F.sum(F.col("block") + F.col("allow"))
        loss = [F.sum(F.col("block") * _softplus(-s) + F.col("allow") * _softplus(s)) / n for _, _, s in grid]
        right = [F.sum(F.when(s > 0, F.col("block")).otherwise(F.col("allow"))) / n for _, _, s in grid]
        got = frame.agg(n.alias("n"), F.array(*loss).alias("loss"), F.array(*right).alias("right")).first()
        usual = lambda a, q: (abs(a - SMOOTHING[len(SMOOTHING) // 2]), -q)
        out = [{"smoothing": a, "prior": q, "rows": got["n"] or 0, "loss": got["loss"][i], "accuracy": got["right"][i]} for i, (a, q, _) in enumerate(grid)]
        return sorted(out, key=lambda r: (round(r["loss"], 9) if r["rows"] else 0.0, *usual(r["smoothing"], r["prior"])))


def _softplus(x: Column) -> Column:
    """log(1 + exp(x)) without overflow."""
    return F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))


def held_out(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """smoothing, prior, rows, loss, accuracy of each setting on the held-out
    hosts, the chosen one first."""
    runtime.prepare(pages.sparkSession)
    rows = [tuple(r.values()) for r in _Model(pages, rules, id_col, url_col, html_col).settings()]
    return pages.sparkSession.createDataFrame(rows, "smoothing double, prior double, rows long, loss double, accuracy double")


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, host, path, rule, verdict, score (log odds of block) for
    every url."""
    runtime.prepare(pages.sparkSession)
    model = _Model(pages, rules, id_col, url_col, html_col)
    best = model.settings()[0]
    frame, odds = model.score(model.base, (best["smoothing"],))
    score = F.round(odds[0] + best["prior"] * model.prior(""), 9)
    return frame.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.when(score > 0, "block").otherwise("allow")).alias("verdict"),
                        score.alias("score"))
