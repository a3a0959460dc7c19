"""Operator 3: near-duplicate documents by HyperMinHash and exact checks.

Sketch. A document's distinct word shingles are dealt to ``REGISTERS`` buckets
by their hash; a bucket keeps its smallest hash as a 16-bit register: the
count of leading zeros (6 bits) and the ten bits after the leading one.

Beside them a set has the parities of its hashes in ``PARITY`` bins. Two sets
differ in at least as many shingles as their parities differ in bins, so these
rule pairs out for certain; they cost two bits or less per shingle.

Candidates. Documents with equal shingle sets are one class from the start.
Bands of ``ROWS`` compressed registers are bucket keys. A link of similarity
0.75 between sets that fill the registers shares none of the 32 bands with a
probability of about 5e-6. A bucket gives stars (one pivot, or three in small
buckets, with each other member), never all its pairs. Pairs that the parities
rule out are dropped, and so are those of sets of ``TINY`` shingles and more
whose collision-corrected register estimate is below ``SURE_BELOW`` (over six
standard deviations under the threshold); all others are checked on their full
sets.

Rest. Where the other members of a bucket are not in one component, a second
round of stars uses the best linked of them as pivot. Those that are not in
one component even then, and all sets that could be linked with one of fewer
than ``TINY`` shingles, go through a prefix filter, which is exact: sets of the
wanted similarity share one of the rarest shingles of each. Only pairs that are
not in one component and that the parities leave open are compared, so a group
of copies is not multiplied out.

Defined cases: null or empty text: no shingles, linked with nothing, its own
component. A null id counts as larger than any id; a group of null ids has a
null component. Repeated rows are in one component. An empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripspark.llm import graph, runtime, words

SHINGLE = 5
REGISTERS, MANTISSA = 128, 10
ROWS = 4  # registers per band
SURE_BELOW = 0.5
SMALL = 6  # members of a bucket that gets three pivots; a larger one gets one
PARITY = 1024  # bins, a multiple of 64
TINY = 16  # sets below this do not fill the registers
NUM, DEN = 3, 4  # the similarity threshold as a fraction
EMPTY = np.uint16(0xFFFF)


def registers(values: np.ndarray, row: np.ndarray, n_rows: int) -> np.ndarray:
    """(n_rows, REGISTERS) HyperMinHash registers of hash values."""
    low = np.full(n_rows * REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    bits = REGISTERS.bit_length() - 1
    np.minimum.at(low, row * REGISTERS + (values & np.uint64(REGISTERS - 1)).astype(np.int64), values >> np.uint64(bits))
    none = low == np.iinfo(np.uint64).max
    low[none] = 1
    width = 64 - bits
    # position of the leading one; exact for values below 2**53, so split
    high = (low >> np.uint64(32)).astype(np.float64)
    top = np.where(high > 0, np.frexp(high)[1] + 32, np.frexp((low & np.uint64(0xFFFFFFFF)).astype(np.float64))[1])
    zeros = width - top
    shift = top - 1 - MANTISSA
    mantissa = np.where(shift >= 0, low >> np.maximum(shift, 0).astype(np.uint64), low << np.maximum(-shift, 0).astype(np.uint64))
    out = (zeros.astype(np.uint16) << np.uint16(MANTISSA)) | (mantissa & np.uint64((1 << MANTISSA) - 1)).astype(np.uint16)
    out[none] = EMPTY
    return out.reshape(n_rows, REGISTERS)


def parities(values: np.ndarray, row: np.ndarray, n_rows: int) -> np.ndarray:
    """(n_rows, PARITY / 64) longs: whether an odd number of a row's values
    falls into each bin."""
    if not n_rows:
        return np.empty((0, PARITY // 64), np.int64)
    bins = row * PARITY + (words.mix(values ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(PARITY)).astype(np.int64)
    odd = np.bincount(bins, minlength=n_rows * PARITY) & 1
    return np.packbits(odd.astype(bool).reshape(n_rows, PARITY), axis=1, bitorder="little").view(np.int64)


def can_link(na, nb, differing):
    """Whether sets of these sizes that differ in at least so many shingles can
    reach the similarity; for columns and arrays alike."""
    return (NUM + DEN) * differing <= (DEN - NUM) * (na + nb)


def estimate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Similarity of paired register rows, corrected for registers that agree
    by chance: two different minima share their leading zeros with a
    probability of about a third and then all mantissa bits with 2**-10."""
    filled = (x != EMPTY) | (y != EMPTY)
    n = np.maximum(filled.sum(1), 1)
    raw = ((x == y) & filled).sum(1) / n
    chance = 1 / 3 / (1 << MANTISSA)
    return np.clip((raw - chance) / (1 - chance), 0.0, 1.0)


def _sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offs = words.text_bytes(column)
    hashes, rows = words.word_hashes(data, offs)
    values, _, row = words.shingles(hashes, rows, SHINGLE)
    return words.distinct(values, row, len(offs) - 1)


def set_ids(values: np.ndarray, offs: np.ndarray) -> list[bytes | None]:
    """128-bit identity of each set (None: empty)."""
    n = np.diff(offs)
    out: list[bytes | None] = [None] * len(n)
    some = np.flatnonzero(n > 0)
    if len(some):
        a = words.mix(np.add.reduceat(words.mix(values), offs[:-1][some]) + n[some].astype(np.uint64))
        b = words.mix(np.add.reduceat(words.mix(values ^ np.uint64(0x5851F42D4C957F2D)), offs[:-1][some]))
        both = np.stack([a, b], 1).tobytes()
        for j, i in enumerate(some.tolist()):
            out[i] = both[16 * j:16 * j + 16]
    return out


def sketch(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key, n_shingles, sid (identity of the set), regs, par."""

    def run(batches):
        runtime.release_caches()
        for batch in batches:
            values, offs = _sets(batch.column(2))
            row = np.repeat(np.arange(batch.num_rows), np.diff(offs))
            regs = registers(values, row, batch.num_rows)
            par = parities(values, row, batch.num_rows)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "text_key": batch.column(1), "n_shingles": pa.array(np.diff(offs)),
                "sid": pa.array(set_ids(values, offs), pa.binary()), "regs": pa.array([r.tobytes() for r in regs], pa.binary()),
                "par": pa.array(list(par), pa.list_(pa.int64())),
            })

    text = docs[text_col].cast("string")
    frame = docs.select(docs[id_col].cast("long").alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_key"), text.alias("text"))
    return frame.mapInArrow(run, "doc_id long, text_key long, n_shingles long, sid binary, regs binary, par array<long>")


def _bands(classes: DataFrame) -> DataFrame:
    """(band, cid, n): one row per band that is not empty."""
    width = 2 * ROWS
    i = F.explode(F.sequence(F.lit(0), F.lit(REGISTERS // ROWS - 1))).alias("i")
    rows = classes.select("cid", "n", "regs", i).select("cid", "n", "i", F.substring(F.col("regs"), F.col("i") * width + 1, F.lit(width)).alias("key"))
    return rows.where(F.col("key") != F.lit(b"\xff" * width)).select(F.xxhash64("i", "key").alias("band"), "cid", "n")


def _sizes_fit(a: Column, b: Column) -> Column:
    """Necessary for the similarity: the smaller set is large enough."""
    return F.least(a, b) * DEN >= F.greatest(a, b) * NUM


def _pairs(frame: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) of ``cid`` and ``pivot`` with fitting sizes."""
    found = frame.where((F.col("cid") != F.col("pivot")) & _sizes_fit(F.col("n"), F.col("np")))
    return found.select(F.least("cid", "pivot").alias("a"), F.greatest("cid", "pivot").alias("b")).distinct()


def _estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) that neither parities nor registers rule out."""
    of = lambda x: classes.select(F.col("cid").alias(x), *[F.col(c).alias(f"{c}{x}") for c in ("n", "regs", "par")])
    joined = pairs.join(of("a"), "a").join(of("b"), "b").where(can_link(F.col("na"), F.col("nb"), _differing("para", "parb")))

    def run(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, REGISTERS) for i in (2, 3))
            tiny = np.array(batch.column(4)) < TINY
            yield batch.select([0, 1]).filter(pa.array((estimate(x, y) >= SURE_BELOW) | tiny))

    return joined.select("a", "b", "regsa", "regsb", F.least("na", "nb").alias("n")).mapInArrow(run, "a long, b long")


def _differing(x: str, y: str) -> Column:
    """In how many bins two parity columns differ."""
    counts = [F.bit_count(F.col(x)[i].bitwiseXOR(F.col(y)[i])) for i in range(PARITY // 64)]
    return sum(counts[1:], counts[0])


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) whose full sets reach the similarity."""
    joined = (pairs.join(texts.withColumnsRenamed({"cid": "b", "text": "tb"}), "b")
              .join(texts.withColumnsRenamed({"cid": "a", "text": "ta"}), "a").select("a", "b", "ta", "tb"))

    def run(batches):
        for batch in batches:
            a = np.array(batch.column(0))
            new = np.ones(len(a), bool)  # rows come sorted by a: its set is made once
            new[1:] = a[1:] != a[:-1]
            va, oa = _sets(batch.column(2).filter(pa.array(new)))
            vb, ob = _sets(batch.column(3))
            ok = np.zeros(len(a), bool)
            for i, j in enumerate((np.cumsum(new) - 1).tolist()):
                x, y = va[oa[j]:oa[j + 1]], vb[ob[i]:ob[i + 1]]
                if len(x) and len(y):  # both sorted
                    at = np.searchsorted(x, y)
                    common = int((x[np.minimum(at, len(x) - 1)] == y).sum())
                    ok[i] = common > 0 and common * DEN >= NUM * (len(x) + len(y) - common)
            yield batch.select([0, 1]).filter(pa.array(ok))

    return joined.mapInArrow(run, "a long, b long")


def _prefix_pairs(texts: DataFrame, labels: DataFrame, classes: DataFrame) -> DataFrame:
    """All pairs (a, b) with different labels that can reach the similarity,
    by the prefix filter with the rarest shingles first.

    Two sets of n and m shingles need ``need = ceil(3/7 (n + m))`` in common.
    In any one order of all shingles the first that they share is therefore
    among the first n - need + 1 of one and m - need + 1 of the other.
    """

    def explode(batches):
        for batch in batches:
            values, offs = _sets(batch.column(1))
            n = np.diff(offs)
            yield pa.RecordBatch.from_pydict({"cid": batch.column(0).take(pa.array(np.repeat(np.arange(len(n)), n))),
                                              "n": pa.array(np.repeat(n, n)), "s": pa.array(values.view(np.int64))})

    items = runtime.stored(texts.select("cid", "text").mapInArrow(explode, "cid long, n long, s long"), "shingles")
    freq = items.groupBy("s").agg(F.count("*").alias("f"))
    order = Window.partitionBy("cid").orderBy("f", "s")
    prefix = (items.join(freq, "s").withColumn("r", F.row_number().over(order))
              .where(F.col("r") <= F.col("n") - F.ceil(F.col("n") * NUM / DEN) + 1).where("f > 1")
              .select("s", "cid", "n", "r").join(labels, "cid").join(classes.select("cid", "par"), "cid"))
    prefix = runtime.stored(prefix, "prefixes")
    per = prefix.groupBy("s", "label").agg(F.count("*").alias("c"))
    main = per.groupBy("s").agg(F.max_by("label", F.struct("c", "label")).alias("main"), F.count("*").alias("k")).where("k > 1")
    here = prefix.join(main, "s").withColumn("is_main", F.col("label") == F.col("main"))
    side = lambda x: [F.col(c).alias(f"{c}{x}") for c in ("cid", "n", "r", "label", "is_main", "par")]
    small = here.where("NOT is_main").select("s", *side("a"))
    other = here.select("s", *side("b"))
    need = F.ceil((F.col("na") + F.col("nb")) * NUM / (NUM + DEN))
    early = (F.col("ra") <= F.col("na") - need + 1) & (F.col("rb") <= F.col("nb") - need + 1)
    once = F.col("is_mainb") | (F.col("cida") < F.col("cidb"))
    open_ = can_link(F.col("na"), F.col("nb"), _differing("para", "parb"))
    found = small.join(other, ["s"]).where((F.col("labela") != F.col("labelb")) & early & once & _sizes_fit(F.col("na"), F.col("nb")) & open_)
    return found.select(F.least("cida", "cidb").alias("a"), F.greatest("cida", "cidb").alias("b")).distinct()


def _labels(cids: DataFrame, links: DataFrame) -> DataFrame:
    """(cid, label): equal labels mean one component of the links."""
    known = graph.components(links).select(F.col("node").alias("cid"), F.col("component").alias("label"))
    return runtime.stored(cids.join(known, "cid", "left").select("cid", F.coalesce("label", "cid").alias("label")), "labels")


def links(docs: DataFrame, classes: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Verified links (a, b) between classes (by cid); every link of the
    similarity joins the same components as these do."""
    bands = _bands(classes)
    shared = bands.groupBy("band").agg(F.min("cid").alias("p0"), F.min_by("n", "cid").alias("n0"), F.max("cid").alias("p1"), F.max_by("n", "cid").alias("n1"),
                                       F.min_by("cid", F.xxhash64("cid")).alias("p2"), F.min_by("n", F.xxhash64("cid")).alias("n2"), F.count("*").alias("k"))
    members = runtime.stored(bands.join(shared.where("k > 1"), "band"), "buckets")

    # texts of the members and of all sets near the tiny ones' size
    tiny = classes.where(F.col("n") * NUM < TINY * DEN).select("cid")
    cids = runtime.stored(members.select("cid").unionByName(tiny).distinct(), "members")
    wanted = cids.join(classes.select("cid", "one.doc_id", "one.text_key"), "cid")
    text = docs[text_col].cast("string")
    source = docs.select(docs[id_col].cast("long").alias("d"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("t"), text.alias("text"))
    texts = runtime.stored(source.join(wanted, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("t") == F.col("text_key")))
                           .select("cid", "text").dropDuplicates(["cid"]), "texts", compression="zstd")

    # the pivots may coincide: of four members, two that are no pivot may be left
    pivots = F.array(*[F.struct(F.col(f"p{i}").alias("pivot"), F.col(f"n{i}").alias("np")) for i in range(3)])
    used = F.explode(F.slice(pivots, 1, F.when(F.col("k") <= SMALL, 3).otherwise(1))).alias("p")
    star = members.select("cid", "n", used).select("cid", "n", "p.pivot", "p.np")
    tried = runtime.stored(_pairs(star), "pairs")
    first = runtime.stored(_verified(_estimated(tried, classes), texts), "links")

    def still_open(frame: DataFrame, labels: DataFrame) -> DataFrame:
        """Members that were no pivot, of buckets where these carry several
        labels."""
        at = frame.join(labels, "cid")
        several = at.groupBy("band").agg(F.min("label").alias("c0"), F.max("label").alias("c1")).where("c0 <> c1").select("band")
        return at.join(several, "band", "left_semi")

    rest = members.where(f"cid <> p0 AND (k > {SMALL} OR k > 3 AND cid <> p1 AND cid <> p2)").select("band", "cid", "n")
    left = runtime.stored(still_open(rest, _labels(cids, first)), "open")
    degree = first.select(F.col("a").alias("cid")).unionByName(first.select(F.col("b").alias("cid"))).groupBy("cid").agg(F.count("*").alias("deg"))
    ranked = left.join(degree, "cid", "left").select("*", F.struct(F.coalesce("deg", F.lit(0)), "cid").alias("rank"))
    best = ranked.groupBy("band").agg(F.max_by("cid", "rank").alias("pivot"), F.max_by("n", "rank").alias("np"), F.max_by("label", "rank").alias("lp"))
    again = left.join(best, "band")
    more = runtime.stored(_pairs(again.where("label <> lp")).join(tried, ["a", "b"], "left_anti"), "pairs")
    tried = tried.unionByName(more)
    second = runtime.stored(first.unionByName(_verified(_estimated(more, classes), texts)), "links")

    labels = _labels(cids, second)
    last = still_open(again.where("cid <> pivot").select("band", "cid", "n"), labels).select("cid", "label")
    last = runtime.stored(last.unionByName(labels.join(tiny, "cid", "left_semi")).distinct(), "rest")
    last_texts = runtime.stored(texts.join(last.select("cid"), "cid", "left_semi"), "open-texts", compression="zstd")
    # these pairs are alike enough for the estimate to rule out next to none
    third = _verified(_prefix_pairs(last_texts, last, classes).join(tried, ["a", "b"], "left_anti"), last_texts)
    return runtime.stored(second.unionByName(third), "links")


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable), kept, and
    text_key (xxhash64 of the text), one row per input row."""
    runtime.prepare(docs.sparkSession)
    rows = runtime.stored(sketch(docs, id_col, text_col), "sketch")
    some = rows.where("sid IS NOT NULL")
    # one class per set; its number is fixed by writing the table
    classes = some.groupBy("sid").agg(F.max("n_shingles").alias("n"), F.max("regs").alias("regs"), F.first("par").alias("par"), F.min("doc_id").alias("low"),
                                      F.min(F.struct("doc_id", "text_key")).alias("one"))
    classes = runtime.stored(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    found = graph.components(links(docs, classes, id_col, text_col)).withColumnRenamed("node", "cid")
    one = classes.select("sid", "cid", "low").join(found, "cid", "left").select("sid", "low", F.coalesce("component", "cid").alias("component"))
    lowest = one.groupBy("component").agg(F.min("low").alias("component_id"))
    by_set = one.join(lowest, "component").select("sid", "component_id")
    out = rows.join(by_set, "sid", "left")
    component = F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "text_key")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with their own columns: one of each group
    (of repeated rows, too)."""
    found = components(docs, id_col, text_col).where("kept").select("doc_id", "text_key").distinct()
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[id_col].cast("long").alias("d"), F.xxhash64(text).alias("t"))
    kept = rows.join(found, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("t") == F.col("text_key")))
    first = F.row_number().over(Window.partitionBy("d", "t").orderBy(F.lit(1)))
    return kept.select("row", first.alias("r")).where("r = 1").select("row.*")
