"""Operator 5: benchmark decontamination in DataFrame operations only.

1. The benchmark's word shingles form an index. A window of a document that
   shares no shingle with an item has similarity 0, so only places with an
   indexed shingle are looked at: a shingle at word p of the document and word
   q of an item of n words aligns the item-sized window [p - q, p - q + n).
2. Windows and items get 64-bit SimHashes of their words. The bits are cut
   into ``RADIUS + 1`` blocks: fingerprints within the radius agree in at
   least one block, so joining on (size, block, value) finds all of them.
3. Candidates within the radius are compared exactly: weighted Jaccard
   similarity of their shingle multisets, kept from ``NUM / DEN`` on.

The radius is far above what the similarity allows (it bounds the changed
words of a window to a few percent), see the tests. The index is broadcast in
slices of at most ``SLICE`` rows, one map-side pass each, so the documents are
never shuffled; a larger benchmark takes more passes, not more memory.

Defined cases: null or empty texts match nothing; items of fewer than five
words are one shingle; a window at a text's edge is cut off there; null ids,
repeated rows, extra columns do no harm; empty tables give no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripspark.llm import runtime

SHINGLE = 5
NUM, DEN = 3, 4
BITS, RADIUS = 64, 19
SLICE = 1_000_000
GAP = r"[\x20\x09-\x0D]"


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def word_list(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), GAP), "")


def shingle_hashes(words: Column, k: int) -> Column:
    """Hash of each k consecutive words; empty for fewer than k words."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def grown(h: Column) -> Column:
        out = h
        for j in range(1, k):
            out = F.zip_with(out, F.slice(h, F.lit(j + 1), F.size(h)), lambda a, b: F.xxhash64(a, b))
        return F.slice(out, F.lit(1), F.greatest(F.size(h) - (k - 1), F.lit(0)))

    def halves(h: Column) -> Column:
        """Five words as (2 + 2) + 1: three passes instead of four."""
        two = F.zip_with(h, F.slice(h, F.lit(2), F.size(h)), lambda a, b: F.xxhash64(a, b))
        return _let(two, lambda t: F.slice(F.zip_with(
            F.zip_with(t, F.slice(t, F.lit(3), F.size(t)), lambda a, b: F.xxhash64(a, b)),
            F.slice(h, F.lit(5), F.size(h)), lambda a, b: F.xxhash64(a, b)), F.lit(1), F.greatest(F.size(h) - 4, F.lit(0))))

    return F.when(F.size(words) < k, F.expr("array()").cast("array<bigint>")).otherwise(_let(hashes, halves if k == 5 else grown))


def own_shingles(words: Column) -> Column:
    """Shingles of an item or a window: fewer than five words are one."""
    out = shingle_hashes(words, SHINGLE)
    for k in range(1, SHINGLE):
        out = F.when(F.size(words) == k, shingle_hashes(words, k)).otherwise(out)
    return out


def simhash(words: Column) -> Column:
    """64-bit SimHash of the words, each weighted by its count."""

    def of(hashes: Column) -> Column:
        def bit(b: Column) -> Column:
            ones = F.aggregate(hashes, F.lit(0), lambda acc, h: acc + F.call_function("getbit", h, b).cast("int"))
            return F.when(2 * ones > F.size(hashes), F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))

        return F.aggregate(F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), bit), F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))

    return _let(F.transform(words, lambda w: F.xxhash64(w)), of)


def blocks(print_: Column, radius: int = RADIUS) -> Column:
    """array<struct<block, value>>: the fingerprint's radius + 1 blocks."""
    edges = [round(i * BITS / (radius + 1)) for i in range(radius + 2)]
    return F.array(*[F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(print_, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("value"))
                     for i, (a, b) in enumerate(zip(edges, edges[1:]))])


def common(a: Column, b: Column) -> Column:
    """Size of the intersection of two multisets."""
    plain = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    times = lambda xs, x: F.size(F.filter(xs, lambda y: y == x))
    weighted = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda acc, x: acc + F.least(times(a, x), times(b, x)))
    return F.when(plain, F.size(F.array_intersect(a, b))).otherwise(weighted)


def _items(benchmark: DataFrame, item_id: str, item_text: str) -> DataFrame:
    words = word_list(benchmark[item_text])
    items = benchmark.select(benchmark[item_id].alias("item_id"), words.alias("words"))
    return items.where(F.size("words") > 0).select("item_id", F.size("words").alias("n"), F.least(F.size("words"), F.lit(SHINGLE)).alias("k"),
                                                   "words", own_shingles(F.col("words")).alias("shingles"))


def windows(docs: DataFrame, items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_key, n, start, window (its words, joined by spaces): the
    item-sized windows that share a shingle with an item of that size."""
    index = items.select("k", "n", F.posexplode("shingles").alias("q", "h")).distinct()
    sizes = index.groupBy("k").agg(F.count("*").alias("c"))
    counts = {r["k"]: r["c"] for r in sizes.collect()}  # at most five rows
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    base = docs.select(docs[id_col].cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), word_list(text).alias("words"))
    found = []
    for k, c in sorted(counts.items()):
        hashed = base.select("*", shingle_hashes(F.col("words"), k).alias("hashes"))
        slices = -(-c // SLICE)
        for s in range(slices):
            part = index.where((F.col("k") == k) & (F.pmod(F.col("h"), F.lit(slices)) == s)).select("n", "q", "h")
            at = hashed.select("doc_id", "text_key", "words", F.posexplode("hashes").alias("p", "h"))
            start = F.col("p") - F.col("q")
            first = F.greatest(start, F.lit(0))
            window = F.slice("words", first + 1, F.col("n") - (first - start))
            found.append(at.join(F.broadcast(part), "h").select("doc_id", "text_key", "n", start.alias("start"), F.array_join(window, " ").alias("window")))
    if not found:
        return docs.sparkSession.createDataFrame([], "doc_id long, text_key long, n int, start int, window string")
    return reduce(DataFrame.unionByName, found).distinct()


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
          item_text: str = "text") -> DataFrame:
    """doc_id, item_id, similarity, start_word, n_words, hamming, text_key:
    the best window of each document and benchmark item it repeats."""
    runtime.prepare(docs.sparkSession)
    items = runtime.stored(_items(benchmark, item_id, item_text), "items")
    some = runtime.stored(windows(docs, items, id_col, text_col), "windows")
    words = F.split("window", " ")
    marked = some.select("*", simhash(words).alias("print"))
    marked = runtime.stored(marked.select("*", own_shingles(words).alias("shingles")), "marked-windows")
    inner = lambda frame: frame.select("*", F.explode(blocks(F.col("print"))).alias("b")).select("*", "b.block", "b.value").drop("b")
    wanted = items.select("item_id", "n", simhash(F.col("words")).alias("item_print"), F.col("shingles").alias("item_shingles"), simhash(F.col("words")).alias("print"))
    distance = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print")))
    pairs = (inner(marked.select("doc_id", "text_key", "n", "start", "print")).join(inner(wanted.drop("item_shingles")).drop("print"), ["n", "block", "value"])
             .where(distance <= RADIUS).select("doc_id", "text_key", "n", "start", "item_id", distance.alias("hamming")).distinct())
    same = marked.select(F.col("doc_id").alias("d"), F.col("text_key").alias("t"), F.col("n").alias("wn"), F.col("start").alias("ws"), "shingles")
    pairs = (pairs.join(same, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t")) & (F.col("n") == F.col("wn")) & (F.col("start") == F.col("ws")))
             .join(wanted.select(F.col("item_id").alias("i"), F.col("n").alias("m"), "item_shingles"), F.col("item_id").eqNullSafe(F.col("i")) & (F.col("n") == F.col("m"))))
    shared = common(F.col("shingles"), F.col("item_shingles"))
    total = F.size("shingles") + F.size("item_shingles")
    exact = pairs.select("doc_id", "text_key", "item_id", "start", "n", "hamming", shared.alias("c"), total.alias("t"))
    exact = exact.where(F.col("c") * DEN >= (F.col("t") - F.col("c")) * NUM).where("c > 0")
    similarity = F.col("c") / (F.col("t") - F.col("c"))
    best = exact.groupBy("doc_id", "text_key", "item_id").agg(F.max(F.struct(similarity.alias("similarity"), (-F.col("start")).alias("start"), "n", (-F.col("hamming")).alias("h"))).alias("best"))
    return best.select("doc_id", "item_id", F.col("best.similarity").alias("similarity"), (-F.col("best.start")).cast("long").alias("start_word"),
                       F.col("best.n").cast("long").alias("n_words"), (-F.col("best.h")).cast("long").alias("hamming"), "text_key")


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **names) -> DataFrame:
    """The documents that repeat no benchmark item, with their own columns."""
    found = leaks(docs, benchmark, id_col, text_col, **names).select("doc_id", "text_key").distinct()
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[id_col].cast("long").alias("d"), F.xxhash64(text).alias("t"))
    clean_rows = rows.join(found, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("t") == F.col("text_key")), "left_anti")
    return clean_rows.select("row.*")
