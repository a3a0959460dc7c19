"""Operator 7: exact substring deduplication by suffix arrays.

Every byte is removed that lies in a ``SPAN``-byte string which also starts
earlier (smaller document, or earlier in the same one). Strings are judged on
the input, so overlaps count and the order of removal does not.

1. Each SPAN-byte window is assigned to an anchor: the K-gram in it with the
   smallest hash, the leftmost of equals. The choice depends on the window's
   content alone, so equal windows have equal anchors at equal places.
   Neighbouring windows with the same anchor make one segment.
2. Segments meet by their anchor. Equal segments are settled at once: all but
   the earliest are repeats as a whole. Each task drops its own repeats before
   the shuffle, so a passage costs one row per task and context, however many
   documents hold it. An anchor with one segment left is unique and leaves.
3. For anchors with different segments (the edges of copied passages) the
   segments' bytes are fetched, split by the bytes next to the anchor, dealt
   to shards by anchor and context, and sorted into a suffix array with common
   prefixes by external induced sorting (:mod:`suffix_sort`). Suffixes that
   share SPAN bytes are one string; all but the earliest are repeats.
4. The spans of a document are merged and cut out.

A document is known by its id and a hash of its text. Defined cases: a null
text counts as empty; null ids count as larger than any id; rows with the same
id and text are one document (each gets that document's result); rows with the
same id and different texts are ordered by the hash; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.llm import runtime, suffix_sort, words

SPAN, K = 100, 32
LEFT = 16  # bytes before an anchor that split its segments
RIGHT = SPAN - K - LEFT + 1  # and bytes behind it
BLOCK = 2 << 20  # bytes anchored at a time
CHUNK = 400_000  # segments a task compares before it sends them
SHARD = 48 << 20  # bytes sorted at a time
HOT = 4096  # segments of one anchor that are sorted together at most
NULL_ID = (1 << 63) - 1
OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_KEYS = [("did", pa.int64()), ("tkey", pa.int64())]

_rng = np.random.default_rng(77)
_TABLE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_STEP = _rng.integers(1, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _gram_hashes(data: np.ndarray) -> dict[int, np.ndarray]:
    """Hashes of all byte strings of 16, 32, 48 and 64 bytes, by start."""
    h, size, out = _TABLE[data], 1, {}
    while size < 64:
        n = len(h) - size
        h = (h[:n] * _STEP[size.bit_length() - 1] + h[size:]) if n > 0 else h[:0]
        size *= 2
        out[size] = h
    return out


def segments(data: np.ndarray, offs: np.ndarray):
    """Segments of all rows: row, start, length (bytes, relative to the row),
    place of the anchor in the segment, anchor hash, hash of the content."""
    n = len(data)
    count = n - SPAN + 1
    if count <= 0:
        return None
    grams = _gram_hashes(data)
    g32, g64 = words.mix(grams[32]), grams[64]
    # the smallest 40-bit hash, then the leftmost place
    key = (g32 >> np.uint64(24) << np.uint64(24)) | np.arange(len(g32), dtype=np.uint64)
    width, low = 1, key
    need = SPAN - K + 1
    while 2 * width <= need:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[:count], low[need - width:need - width + count])
    anchor = (low & np.uint64(0xFFFFFF)).astype(np.int64)
    at = np.arange(count)
    valid = np.zeros(n + 1, np.int8)  # windows inside one row
    sizes = np.diff(offs)
    long_ = sizes >= SPAN
    np.add.at(valid, offs[:-1][long_], 1)
    np.add.at(valid, offs[1:][long_] - SPAN + 1, -1)
    valid = np.cumsum(valid[:count], dtype=np.int8) > 0
    new = valid.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1]
    new[offs[:-1][long_]] = True
    first = at[new]
    if not len(first):
        return None
    edge = valid & np.concatenate([new[1:] | ~valid[1:], [True]])
    last = at[edge]
    a = anchor[first]
    length = last - first + SPAN
    # three 64-byte hashes cover a segment of at most 168 bytes
    mid = first + (length - 64) // 2
    content = words.mix(words.mix(g64[first] + length.astype(np.uint64)) + g64[first + length - 64] * _STEP[6] + words.mix(g64[mid] + (a - first).astype(np.uint64)))
    row = np.searchsorted(offs, first, "right") - 1
    return row, first - offs[row], length, a - first, g32[a], content


def _blocks(batches):
    """Arrow batches -> (did, tkey, data, offs, shift): texts of at most about
    BLOCK bytes together; a longer text comes in parts that overlap."""
    for batch in batches:
        data, offs = words.text_bytes(batch.column(2))
        did, tkey = (np.array(batch.column(i)) for i in (0, 1))
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(offs, offs[i] + BLOCK, "right")) - 1)
            if j == i + 1 and offs[j] - offs[i] > BLOCK:
                for a in range(int(offs[i]), int(offs[j]) - SPAN + 1, BLOCK):
                    part = data[a:min(a + BLOCK + SPAN - 1, int(offs[j]))]
                    yield did[i:j], tkey[i:j], part, np.array([0, len(part)]), a - int(offs[i])
            else:
                yield did[i:j], tkey[i:j], data[offs[i]:offs[j]], offs[i:j + 1] - offs[i], 0
            i = j


def _merged(did, tkey, start, length):
    """Union of spans per document, as arrays sorted by document and start."""
    order = np.lexsort((start, tkey, did))
    did, tkey, start, length = did[order], tkey[order], start[order], length[order]
    same = np.zeros(len(did), bool)
    same[1:] = (did[1:] == did[:-1]) & (tkey[1:] == tkey[:-1])
    group = np.cumsum(~same)
    wide = np.int64(1) << 33  # texts are shorter than this
    reach = np.maximum.accumulate(group * wide + start + length) - group * wide
    new = ~same
    new[1:] |= start[1:] > reach[:-1]
    first = np.flatnonzero(new)
    if not len(first):
        return did, tkey, start, length
    last = np.append(first[1:], len(did)) - 1
    return did[first], tkey[first], start[first], reach[last] - start[first]


_CANDIDATES = "key long, content long, did long, tkey long, start long, length int, place int"


def _without_repeats(held: list[tuple]) -> pa.RecordBatch:
    """Candidates without those that repeat an earlier one of ``held``. Such a
    repeat is sent as a span (length < 0), under a key that spreads spans
    evenly."""
    did, tkey, start, length, place, key, content = (np.concatenate(c) for c in zip(*held))
    order = np.lexsort((start, tkey, did, content, key))
    k, c, d, t, s = (x[order] for x in (key, content, did, tkey, start))
    same = (k[1:] == k[:-1]) & (c[1:] == c[:-1])
    twin = np.concatenate([[False], same & (d[1:] == d[:-1]) & (t[1:] == t[:-1]) & (s[1:] == s[:-1])])
    again = np.concatenate([[False], same])[~twin]  # a twin is the same place, in a repeated row
    order = order[~twin]
    keep, drop = order[~again], order[again]
    d, t, s, n = _merged(did[drop], tkey[drop], start[drop], length[drop])
    spread = words.mix(d.view(np.uint64) * np.uint64(31) + s.view(np.uint64)) >> np.uint64(1)
    return pa.RecordBatch.from_pydict({
        "key": pa.array(np.concatenate([key[keep], spread]).view(np.int64)), "content": pa.array(np.concatenate([content[keep].view(np.int64), np.zeros(len(d), np.int64)])),
        "did": pa.array(np.concatenate([did[keep], d])), "tkey": pa.array(np.concatenate([tkey[keep], t])),
        "start": pa.array(np.concatenate([start[keep], s])), "length": pa.array(np.concatenate([length[keep], -n]).astype(np.int32)),
        "place": pa.array(np.concatenate([place[keep], np.zeros(len(d), np.int64)]).astype(np.int32))})


def _find_segments(batches):
    """Documents -> segments, without those that repeat an earlier one of the
    same task."""
    runtime.release_caches()
    held: list[tuple] = []
    count = 0
    for did, tkey, data, offs, shift in _blocks(batches):
        got = segments(data, offs)
        if got is None:
            continue
        row, start, length, place, key, content = got
        held.append((did[row], tkey[row], start + shift, length, place, key, content))
        count += len(row)
        if count >= CHUNK:
            yield _without_repeats(held)
            held, count = [], 0
    if held:
        yield _without_repeats(held)


_FOUND = "did long, tkey long, start long, length int, key long, place int"


def _settle(batches):
    """Segments sorted by anchor, content and origin -> spans (place -1) and,
    where an anchor has several contents, the earliest segment of each.

    One row is carried from batch to batch: the last content's first segment,
    and whether it has been sent.
    """
    schema = pa.schema([*_KEYS, ("start", pa.int64()), ("length", pa.int32()), ("key", pa.int64()), ("place", pa.int32())])
    carry, sent, last = None, False, None
    for batch in batches:
        table = np.array([np.asarray(batch.column(i)).astype(np.int64) for i in range(7)]).reshape(7, -1)
        if table.shape[1]:  # the same place twice is a repeated row of the documents
            twin = np.zeros(table.shape[1], bool)
            twin[1:] = (table[:5, 1:] == table[:5, :-1]).all(0)
            twin[0] = last is not None and bool((table[:5, 0] == last).all())
            last, table = table[:5, -1], table[:, ~twin]
        is_span = table[5] < 0
        ready, table = table[:, is_span], table[:, ~is_span]
        begun = carry is not None
        if begun:
            table = np.concatenate([carry, table], 1)
        key, content, did, tkey, start, length, place = table
        if not len(key):
            send = covered = np.empty(0, np.int64)
        else:
            new_key = np.concatenate([[True], key[1:] != key[:-1]])
            new = new_key | np.concatenate([[True], content[1:] != content[:-1]])
            covered, firsts = np.flatnonzero(~new), np.flatnonzero(new)
            group = (np.cumsum(new_key) - 1)[firsts]
            several = np.bincount(group) > 1
            several[0] |= begun and sent
            send = firsts[several[group]]
            if begun and sent:
                send = send[send > 0]
            carry, sent = table[:, firsts[-1:]], bool(several[-1])
        d, t, s, n = _merged(*(np.concatenate([ready[i] * sign, table[i][covered]]) for i, sign in ((2, 1), (3, 1), (4, 1), (5, -1))))
        none = np.full(len(d), -1)
        out = [np.concatenate([x, y]) for x, y in ((d, did[send]), (t, tkey[send]), (s, start[send]), (n, length[send]), (none, key[send]), (none, place[send]))]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(f.type.to_pandas_dtype())) for c, f in zip(out, schema)], schema=schema)


_PIECES = "key long, did long, tkey long, start long, bytes binary"


def _fetch(batches):
    """Documents with their segments -> the segments' bytes, split by what
    stands next to the anchor: a window that reaches LEFT bytes before it is
    dealt by those, any other by the RIGHT bytes behind it."""
    schema = pa.schema([("key", pa.int64()), *_KEYS, ("start", pa.int64()), ("bytes", pa.binary())])
    for batch in batches:
        keys, dids, tkeys, starts, pieces = [], [], [], [], []
        for did, tkey, text, found in zip(*(batch.column(i).to_pylist() for i in range(4))):
            data = (text or "").encode()
            for seg in found:
                a, n, place, key = seg["start"], seg["length"], seg["place"], seg["key"]
                anchor, end = a + place, a + n
                # windows start in [a, end - SPAN]; those at or before the cut reach far enough left
                cut = anchor - LEFT
                for side, low, high in ((1, a, min(cut, end - SPAN)), (2, max(a, cut + 1), end - SPAN)):
                    if low <= high:
                        near = data[cut:anchor] if side == 1 else data[anchor + K:anchor + K + RIGHT]
                        mark = int.from_bytes(hashlib.blake2b(near + bytes([side]), digest_size=8, key=key.to_bytes(8, "little", signed=True)).digest(), "little", signed=True)
                        keys.append(mark)
                        dids.append(did)
                        tkeys.append(tkey)
                        starts.append(low)
                        pieces.append(data[low:high + SPAN])
        if keys:
            yield pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.int64()), "did": pa.array(dids, pa.int64()), "tkey": pa.array(tkeys, pa.int64()),
                                              "start": pa.array(starts, pa.int64()), "bytes": pa.array(pieces, pa.binary())}, schema=schema)


def _fetch_windows(batches):
    """Documents with segments of common anchors -> each window of these as a
    candidate of its own, known by a 128-bit hash, without those that repeat
    an earlier one of the same task."""
    held: list[tuple] = []
    count = 0
    for batch in batches:
        for did, tkey, text, found in zip(*(batch.column(i).to_pylist() for i in range(4))):
            data = (text or "").encode()
            for seg in found:
                start = np.arange(seg["start"], seg["start"] + seg["length"] - SPAN + 1)
                n = len(start)
                marks = b"".join(hashlib.blake2b(data[a:a + SPAN], digest_size=16).digest() for a in start.tolist())
                key, content = np.frombuffer(marks, np.uint64).reshape(n, 2).T
                held.append((np.full(n, did), np.full(n, tkey), start, np.full(n, SPAN), np.zeros(n, np.int64), key, content))
                count += n
                if count >= CHUNK:
                    yield _without_repeats(held)
                    held, count = [], 0
    if held:
        yield _without_repeats(held)


def repeated_windows(pieces: list[bytes], did: np.ndarray, tkey: np.ndarray, start: np.ndarray, folder: str | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(piece, place) of each SPAN-byte window of the pieces that also starts
    earlier, by document and place, in a piece. Of the suffixes only those
    that share SPAN bytes with a neighbour are held; the sort's queues spill
    to the folder."""
    size = np.array([len(p) for p in pieces], np.int64)
    joined = np.frombuffer(b"\0".join(pieces) + b"\0\0", np.uint8).astype(np.int16) + 2
    offs = np.concatenate([[0], np.cumsum(size + 1)])
    joined[offs[1:] - 1] = 1
    joined[-1] = 0
    held, above = [], False  # blocks come from the last suffixes to the first
    for order, shared in suffix_sort.blocks(joined, 258, SPAN, folder=folder):
        piece = np.minimum(np.searchsorted(offs, order, "right") - 1, len(pieces) - 1)
        # what shares SPAN bytes with a whole window is a whole window
        same = (shared >= SPAN) & (order - offs[piece] + SPAN <= size[piece])
        inside = same | np.append(same[1:], above)
        above = bool(same[0])
        held.append((piece[inside], order[inside], same[inside]))
    piece, order, same = (np.concatenate(c) for c in zip(*held[::-1]))
    if not len(order):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    group = np.cumsum(~same)
    p, w = piece, order - offs[piece]
    by = np.lexsort((start[p] + w, tkey[p], did[p], group))
    p, w, group = p[by], w[by], group[by]
    d, t, s = did[p], tkey[p], start[p] + w
    later = np.zeros(len(p), bool)
    later[1:] = group[1:] == group[:-1]
    # the earliest window may be in two pieces; its twins are the same place
    lead = np.maximum.accumulate(np.where(later, 0, np.arange(len(p))))
    later &= (d != d[lead]) | (t != t[lead]) | (s != s[lead])
    return p[later], w[later]


def _sort_shards(batches, folder: str):
    """Pieces sorted by key -> spans found by the suffix array. Keys are
    never torn: a shard ends between two keys."""
    schema = pa.schema([*_KEYS, ("start", pa.int64()), ("length", pa.int32())])
    held: list[tuple] = []
    total = 0

    def flush():
        key = np.concatenate([h[0] for h in held])
        did, tkey, start = (np.concatenate([h[i] for h in held]) for i in (1, 2, 3))
        pieces = [b for h in held for b in h[4]]
        held.clear()
        alone = np.ones(len(key), bool)
        alone[1:] &= key[1:] != key[:-1]
        alone[:-1] &= key[1:] != key[:-1]
        live = np.flatnonzero(~alone)
        if not len(live):
            return None
        p, w = repeated_windows([pieces[i] for i in live], did[live], tkey[live], start[live], folder)
        p = live[p]
        d, t, s, n = _merged(did[p], tkey[p], start[p] + w, np.full(len(p), SPAN))
        return pa.RecordBatch.from_arrays([pa.array(d), pa.array(t), pa.array(s), pa.array(n.astype(np.int32))], schema=schema)

    for batch in batches:
        if not batch.num_rows:
            continue
        key, did, tkey, start = (np.array(batch.column(i)) for i in range(4))
        pieces = batch.column(4).to_pylist()
        size = sum(map(len, pieces))
        if total + size > SHARD and held:
            cut = int(np.searchsorted(key != held[-1][0][-1], True))  # rows of the open key stay with it
            held.append((key[:cut], did[:cut], tkey[:cut], start[:cut], pieces[:cut]))
            if cut < len(key):
                if (out := flush()) is not None:
                    yield out
                total = 0
                size = sum(map(len, pieces[cut:]))
            key, did, tkey, start, pieces = key[cut:], did[cut:], tkey[cut:], start[cut:], pieces[cut:]
        if len(key):
            held.append((key, did, tkey, start, pieces))
        total += size
    if held and (out := flush()) is not None:
        yield out


def _at_documents(docs: DataFrame, segs: DataFrame) -> DataFrame:
    several = segs.groupBy("did", "tkey").agg(F.collect_list(F.struct("start", "length", "place", "key")).alias("found"))
    return docs.join(several, ["did", "tkey"]).select("did", "tkey", "text", "found")


def pieces(docs: DataFrame, segs: DataFrame) -> DataFrame:
    """The segments' bytes, keyed for :func:`_sort_shards`."""
    return _at_documents(docs, segs).mapInArrow(_fetch, _PIECES)


def _hot_spans(docs: DataFrame, segs: DataFrame) -> DataFrame:
    """Spans of segments whose anchor has too many for one task: their windows
    meet by content, so a task gets a common one once from each task and no
    key has more rows than that."""
    n = runtime.shuffle_partitions(docs.sparkSession)
    windows = _at_documents(docs, segs).mapInArrow(_fetch_windows, _CANDIDATES)
    return (windows.repartition(n, "key").sortWithinPartitions("key", "content", "did", "tkey", "start").mapInArrow(_settle, _FOUND)
            .where("place < 0").select("did", "tkey", "start", "length"))


def spans(docs: DataFrame) -> DataFrame:
    """(did, tkey, start, length): what repeats, as spans that may overlap.
    ``docs`` has did, tkey, text."""
    spark = docs.sparkSession
    n = runtime.shuffle_partitions(spark)
    found = (docs.mapInArrow(_find_segments, _CANDIDATES).repartition(n, "key")
             .sortWithinPartitions("key", "content", "did", "tkey", "start").mapInArrow(_settle, _FOUND))
    found = runtime.stored(found, "segments")
    segs = found.where("place >= 0")
    hot = runtime.stored(segs.groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") > HOT).select("key"), "hot-anchors")
    out = found.where("place < 0").select("did", "tkey", "start", "length")
    if not hot.isEmpty():  # joined by size: the list grows with the input
        out = out.unionByName(_hot_spans(docs, segs.join(hot, "key", "left_semi")))
        segs = segs.join(hot, "key", "left_anti")
    folder = runtime.scratch(spark, "suffix-queues")
    edges = (pieces(docs, segs).repartition(n, "key").sortWithinPartitions("key")
             .mapInArrow(lambda batches: _sort_shards(batches, folder), "did long, tkey long, start long, length int"))
    return out.unionByName(edges)


def _keyed(docs: DataFrame, id_col: str, text_col: str):
    text = docs[text_col].cast("string")
    return F.coalesce(docs[id_col].cast("long"), F.lit(NULL_ID)), F.xxhash64(F.coalesce(text, F.lit(""))), text


def _union(found) -> tuple[np.ndarray, np.ndarray]:
    if found is None or not len(found):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    start, length = (np.array([f[c] for f in found], np.int64) for c in ("start", "length"))
    zero = np.zeros(len(start), np.int64)
    _, _, s, n = _merged(zero, zero, start, length)
    touch = np.concatenate([[True], s[1:] > (s + n)[:-1]])
    first = np.flatnonzero(touch)
    last = np.append(first[1:], len(s)) - 1
    return s[first], (s + n)[last] - s[first]


def kept_bytes(data: bytes, found) -> tuple[bytes, int, int]:
    """The bytes outside the spans, the number of removed bytes and of
    maximal removed runs."""
    s, n = _union(found)
    out, at = [], 0
    for a, k in zip(s.tolist(), n.tolist()):
        out.append(data[at:a])
        at = a + k
    out.append(data[at:])
    return b"".join(out), int(n.sum()), len(s)


def _with_spans(docs: DataFrame, id_col: str, text_col: str, *columns: str) -> DataFrame:
    did, tkey, text = _keyed(docs, id_col, text_col)
    plain = docs.select(did.alias("did"), tkey.alias("tkey"), text.alias("text"))
    by_doc = spans(plain).groupBy("did", "tkey").agg(F.collect_list(F.struct("start", "length")).alias("found"))
    rows = docs.select(did.alias("did"), tkey.alias("tkey"), text.alias("text"), *columns) if columns else plain
    return rows.join(by_doc, ["did", "tkey"], "left")


def removal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each document."""
    runtime.prepare(docs.sparkSession)

    def run(batches):
        for batch in batches:
            rows = []
            for did, text, found in zip(*(batch.column(i).to_pylist() for i in range(3))):
                data = (text or "").encode()
                kept, removed, n = kept_bytes(data, found)
                rows.append((None if did == NULL_ID else did, len(data), removed, n, hashlib.sha256(kept).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return _with_spans(docs, id_col, text_col).select("did", "text", "found").mapInArrow(run, OUT)


def cut(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without what repeats, with their own columns. A
    character that loses some of its bytes is lost whole."""
    runtime.prepare(docs.sparkSession)
    names = [f for f in docs.schema.fieldNames() if f != text_col]
    rows = docs.select(F.struct(*[docs[f"`{f}`"] for f in names]).alias("__rest"), docs[f"`{id_col}`"].alias("__id"), docs[f"`{text_col}`"].alias("__text"))
    joined = _with_spans(rows, "__id", "__text", "__rest")

    @F.pandas_udf("string")
    def keep(text, found):
        return text.combine(found, lambda t, f: t if f is None or t is None else kept_bytes(t.encode(), f)[0].decode("utf-8", "ignore"))

    cut_text = F.when(F.col("found").isNull(), F.col("text")).otherwise(keep("text", "found"))
    return joined.select(*[cut_text.alias(f) if f == text_col else F.col("__rest")[f].alias(f) for f in docs.schema.fieldNames()])
