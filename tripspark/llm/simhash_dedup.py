"""Operator 11: near-duplicate documents by SimHash and ball hashing.

Fingerprint. The 64 bits of each four-word shingle's XXH64 (seed 42; repeats
count) vote; a bit is 1 where more than half of the shingles have it.

Search. Two fingerprints differ in at most four bits if and only if some
64-bit value lies within two bits of both. So every distinct fingerprint
emits the 2,081 values of its ball of radius two, values are shuffled to
where equal ones meet, and what meets is linked. No link is missed, whatever
the input.

Shuffle. A value belongs to the bucket of its lowest ``k`` bits. A ball touches
only ``1 + k + k(k-1)/2`` buckets, so a fingerprint is sent to each of these
once, and the bucket's task emits the part of the ball that is its own: the
same values meet as if each one were a row, for a fiftieth of the bytes. ``k``
grows with the number of fingerprints. A crowded bucket is split by parities
of the values (each split gets an even share of every ball), and a task takes
its values in slices of bounded size.

Meeting. In a bucket each holder of a value is paired with the smallest
holder; pairs are deduplicated and verified by counting differing bits, and a
bucket's verified pairs leave as one row per fingerprint (with the smallest
one they connect it to). At most 2,081 fingerprints can hold a value, equal
fingerprints are one from the start, and no group's pairs are multiplied out.

Defined cases: null or empty text, or one without words: fingerprint zero,
linked like any other. Fewer than four words: the whole sequence is the one
shingle. A null id counts as larger than any id; a group of null ids has a
null component. Repeated rows are in one component. An empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tripspark.llm import graph, runtime

SHINGLE, SEED = 4, 42
BITS, RADIUS = 64, 4
HALF = RADIUS // 2
BLOCK = 1 << 16  # shingle hashes whose bits are counted at a time
VALUES = 1 << 20  # ball values that a bucket should hold, and that a task sorts at a time
#: Independent parities of a value's bits; the first r of them split a bucket.
PARITIES = np.random.default_rng(11).integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def fingerprint(text: bytes) -> int:
    """SimHash of a text's UTF-8 bytes, unsigned."""
    words = text.lower().split()  # on bytes: A-Z alone, and runs of 0x20 and 0x09-0x0D
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(SHINGLE, len(words))
    spans = zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist())
    hashes = np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in spans), "<u8", len(words) - k + 1)
    votes = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), BLOCK):
        part = hashes[i:i + BLOCK].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a signed long), per input row."""
    runtime.prepare(docs.sparkSession)

    def run(batches):
        runtime.release_caches()
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            fps = np.fromiter((fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in texts), "<u8", batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    frame = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return frame.mapInArrow(run, "doc_id long, fp long")


def flips(bits: range, most: int) -> np.ndarray:
    """The masks of at most ``most`` (0 to 2) of the given bits."""
    one = [1 << i for i in bits]
    two = [a | b for i, a in enumerate(one) for b in one[:i]]
    return np.array(sum(([0], one, two)[:most + 1], []), np.uint64)


def parity(values: np.ndarray, r: int) -> np.ndarray:
    """The first ``r`` parities of each value as one number."""
    out = np.zeros(len(values), np.int64)
    for i in range(r):
        out |= (np.bitwise_count(values & PARITIES[i]).astype(np.int64) & 1) << i
    return out


def ball_part(fps: np.ndarray, left: np.ndarray, k: int, r: int, salt: int):
    """Values of the balls in this bucket whose first ``r`` parities are
    ``salt``, and the index of each one's fingerprint. ``fps`` hold the
    bucket's low ``k`` bits already; ``left`` flips remain to each."""
    values, owner = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    have = parity(fps, r)
    for most in range(HALF + 1):
        masks = flips(range(k, BITS), most)
        want = parity(masks, r) ^ salt
        mine = np.flatnonzero(left == most)
        for c in np.unique(have[mine]).tolist():
            at, m = mine[have[mine] == c], masks[want == c]
            values.append((fps[at][:, None] ^ m[None, :]).ravel())
            owner.append(np.repeat(at, len(m)))
    return np.concatenate(values), np.concatenate(owner)


def meet(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs (a > b) of owners of equal values, each with the smallest
    owner of that value."""
    order = np.lexsort((owner, values))
    v, o = values[order], owner[order]
    new = np.ones(len(v), bool)
    new[1:] = v[1:] != v[:-1]
    first = o[np.flatnonzero(new)][np.cumsum(new) - 1] if len(v) else o
    more = np.flatnonzero(o != first)
    pairs = np.unique(np.stack([o[more], first[more]], 1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def connect(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest of 0..n-1 that the pairs connect each one to."""
    low = np.arange(n)
    while True:
        m = np.minimum(low[a], low[b])
        after = low.copy()
        for x in (a, b, low[a], low[b]):
            np.minimum.at(after, x, m)
        after = after[after]
        if (after == low).all():
            return low
        low = after


def bucket_links(fps: np.ndarray, left: np.ndarray, source: np.ndarray, k: int, r: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, smallest one that this bucket's pairs connect it to)."""
    order = np.argsort(source, kind="stable")
    fps, left, source = fps[order], left[order], source[order]
    size = sum(int((left == m).sum()) * len(flips(range(k, BITS), m)) for m in range(HALF + 1)) >> r
    more = min(len(PARITIES) - r, max(0, math.ceil(math.log2(max(size, 1) / VALUES))))
    low = np.arange(len(fps))
    for extra in range(1 << more):  # one slice of the values after the other
        a, b = meet(*ball_part(fps, left, k, r + more, salt | extra << r))
        near = np.bitwise_count(source[a] ^ source[b]) <= RADIUS
        ra, rb = low[a[near]], low[b[near]]
        low = connect(len(fps), np.concatenate([ra, np.arange(len(fps))]), np.concatenate([rb, low]))
    some = np.flatnonzero(low != np.arange(len(fps)))
    return source[some], source[low[some]]


def links(classes: DataFrame, count: int) -> DataFrame:
    """(a, b): pairs of distinct fingerprints ``fp`` that connect the same ones
    as all pairs within ``RADIUS`` bits."""
    whole = len(flips(range(BITS), HALF))
    k = max(4, math.ceil(math.log2(max(1, count) * whole / VALUES)))
    low = flips(range(k), HALF)
    used = [int(x).bit_count() for x in low]
    touch = F.array(*[F.struct(F.lit(int(m)).cast("long").alias("mask"), F.lit(HALF - u).alias("left"),
                               F.lit(len(flips(range(k, BITS), HALF - u))).cast("long").alias("size")) for m, u in zip(low, used)])
    routed = classes.select("fp", F.explode(touch).alias("t")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("t.mask")).alias("moved"), "t.left", "t.size")
    routed = routed.withColumn("bucket", F.col("moved").bitwiseAND(F.lit((1 << k) - 1)))
    # crowded buckets: r parities split them
    split = F.ceil(F.log2(F.col("s") / VALUES)).cast("int")
    crowded = runtime.stored(routed.groupBy("bucket").agg(F.sum("size").alias("s")).where(F.col("s") > 8 * VALUES)
                             .select("bucket", F.least(split, F.lit(len(PARITIES) - 4)).alias("r")), "crowded")
    routed = routed.join(crowded, "bucket", "left").withColumn("r", F.coalesce("r", F.lit(0)))
    salts = F.explode(F.sequence(F.lit(0), F.pow(F.lit(2), F.col("r")).cast("int") - 1)).alias("salt")
    routed = routed.select("bucket", "fp", "moved", "left", "r", salts)

    def run(table: pa.Table) -> pa.Table:
        get = lambda c: table.column(c).to_numpy()
        order = np.argsort(get("fp"), kind="stable")
        a, b = bucket_links(get("moved")[order].view(np.uint64), get("left")[order], get("fp")[order].view(np.uint64), k,
                            int(table.column("r")[0].as_py()), int(table.column("salt")[0].as_py()))
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return routed.groupBy("bucket", "salt").applyInArrow(run, "a long, b long").distinct()


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest id
    reachable), one row per input row."""
    rows = runtime.stored(fingerprints(docs, id_col, text_col), "fingerprints")
    classes = runtime.stored(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "classes")
    found = graph.components(links(classes, classes.count())).select(F.col("node").alias("fp"), "component")
    one = classes.join(found, "fp", "left").select("fp", "low", F.coalesce("component", "fp").alias("component"))
    lowest = one.groupBy("component").agg(F.min("low").alias("component_id"))
    by_fp = one.join(lowest, "component").select("fp", "component_id")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(by_fp, "fp").select("doc_id", digits.alias("fingerprint"), "component_id")
