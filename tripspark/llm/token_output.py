"""Operator 2: token ids in a compact binary file format.

Ids are replaced by their frequency rank (0 is the most frequent id of the
corpus) and written in groups of four: one control byte holds four 2-bit
lengths, the ranks follow as 1 to 4 little-endian bytes in a separate stream
(the layout known as Stream VByte). Blocks of whole documents are decoded
with numpy: a 256-entry table maps a control byte to its four lengths.

Files: ``<path>/ids/part=<n>/`` hold the blocks as Parquet rows, so that any
store Spark writes to will do and a task that is run twice commits once. Parts
ascend by doc_id, blocks within a part by ``block``. ``<path>/ranks`` holds
the rank table (one row per id that occurs).

Defined cases: a null text counts as empty and gives the end id alone; null
ids sort first; documents with equal ids follow each other, ordered by text;
an empty table gives no blocks.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripspark.llm import runtime, tokens

MAGIC = b"FRVB"
BLOCK_IDS = 1 << 18  # a block closes once it holds this many ids
FOLDS = 8  # tasks that add up the frequencies of all others

#: lengths (1-4) of the four values behind each control byte
LENGTHS = np.array([[1 + (c >> (2 * k) & 3) for k in range(4)] for c in range(256)], np.uint8)
_USED = np.array([[j < n for j in range(4)] for n in range(1, 5)])


def pack_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    v = np.ascontiguousarray(values, "<u4")
    size = (v >= 1 << 8).astype(np.uint8) + (v >= 1 << 16) + (v >= 1 << 24)
    padded = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    padded[:len(v)] = size
    quads = padded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    return control.tobytes(), v.view(np.uint8).reshape(-1, 4)[_USED[size]].tobytes()


def unpack_values(control: bytes | memoryview, data: bytes | memoryview, n: int) -> np.ndarray:
    """Inverse of :func:`pack_values` by table lookup."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    end = np.cumsum(size, dtype=np.int64)
    raw = np.zeros(len(data) + 3, np.uint8)
    raw[:len(data)] = np.frombuffer(data, np.uint8)
    at = end - size
    out = raw[at].astype(np.uint32)
    for j in range(1, 4):
        more = np.flatnonzero(size > j)
        if not len(more):
            break
        out[more] |= raw[at[more] + j].astype(np.uint32) << np.uint32(8 * j)
    return out


def pack_block(doc_ids: list, counts: np.ndarray, ranks: np.ndarray) -> bytes:
    """One block: header, ids of the documents, their token counts, ranks."""
    ids = np.array([0 if d is None else d for d in doc_ids], "<i8")
    null = np.packbits(np.array([d is None for d in doc_ids], bool))
    c1, d1 = pack_values(counts)
    c2, d2 = pack_values(ranks)
    head = struct.pack("<4sHIQIIQQ", MAGIC, 1, len(ids), len(ranks), len(c1), len(d1), len(c2), len(d2))
    return b"".join([head, ids.tobytes(), null.tobytes(), c1, d1, c2, d2])


def unpack_block(blob: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    head = struct.calcsize("<4sHIQIIQQ")
    magic, version, n, n_ids, lc1, ld1, lc2, ld2 = struct.unpack_from("<4sHIQIIQQ", blob)
    if magic != MAGIC or version != 1:
        raise ValueError("not a token block")
    view, at = memoryview(blob), head
    parts = []
    for size in (8 * n, -(-n // 8), lc1, ld1, lc2, ld2):
        parts.append(view[at:at + size])
        at += size
    null = np.unpackbits(np.frombuffer(parts[1], np.uint8), count=n).astype(bool)
    ids = [None if z else d for d, z in zip(np.frombuffer(parts[0], "<i8").tolist(), null.tolist())]
    return ids, unpack_values(parts[2], parts[3], n), unpack_values(parts[4], parts[5], n_ids)


def _planes(ids: np.ndarray) -> bytes:
    """Low bytes, then high bytes (, ...): compresses better than whole ids."""
    return np.ascontiguousarray(ids.view(np.uint8).reshape(len(ids), ids.itemsize).T).tobytes()


def _from_planes(blob: bytes, n: int, dtype: np.dtype) -> np.ndarray:
    if n == 0:
        return np.empty(0, dtype)
    planes = np.frombuffer(blob, np.uint8).reshape(-1, n)
    return np.ascontiguousarray(planes.T).view(dtype).reshape(-1)


_RAW_SCHEMA = "part int, block int, start_in_part long, doc_ids array<long>, counts array<int>, n_ids long, ids binary, freq_ids array<int>, freq array<long>"


def _encode(tokenizer_path: str, end_id: int):
    """Sorted documents -> blocks of raw ids; the last row of a task holds
    the frequency of each id that occurs in it."""

    def run(batches):
        tok = tokens.tokenizer_for(tokenizer_path)
        part = TaskContext.get().partitionId()
        freq = np.zeros(max(tok.n_vocab, end_id + 1), np.int64)
        block = start = 0
        docs, counts, ids = [], [], []

        def row(last: bool):
            flat = np.concatenate(ids) if ids else np.empty(0, tok.dtype)
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "block": pa.array([block], pa.int32()),
                "start_in_part": pa.array([start], pa.int64()), "doc_ids": pa.array([docs], pa.list_(pa.int64())),
                "counts": pa.array([[int(c) for c in counts]], pa.list_(pa.int32())),
                "n_ids": pa.array([len(flat)], pa.int64()), "ids": pa.array([_planes(flat)], pa.binary()),
                "freq_ids": pa.array([np.flatnonzero(freq) if last else None], pa.list_(pa.int32())),
                "freq": pa.array([freq[freq > 0] if last else None], pa.list_(pa.int64())),
            }), len(flat)

        for batch in batches:
            flat, offs = tok.encode(batch.column(1))
            flat, offs = tokens.with_end(flat, offs, end_id)
            freq += np.bincount(flat, minlength=len(freq))
            names = batch.column(0).to_pylist()
            i = 0
            while i < len(names):
                room = BLOCK_IDS - sum(map(len, ids))
                j = min(len(names), max(i + 1, int(np.searchsorted(offs, offs[i] + room, "right"))))
                docs += names[i:j]
                counts += np.diff(offs[i:j + 1]).tolist()
                ids.append(flat[offs[i]:offs[j]].copy())
                i = j
                if sum(map(len, ids)) >= BLOCK_IDS:
                    out, n = row(False)
                    yield out
                    block, start = block + 1, start + n
                    docs, counts, ids = [], [], []
        if block or docs:
            yield row(True)[0]

    return run


def _add_up(batches):
    """Frequencies of several tasks -> their sums, one row per id."""
    total = np.zeros(1, np.int64)
    for batch in batches:
        for ids, n in zip(batch.column(0), batch.column(1)):
            ids = ids.values.to_numpy(zero_copy_only=False)  # distinct and ascending
            if len(ids) and ids[-1] >= len(total):
                total = np.concatenate([total, np.zeros(int(ids[-1]) + 1 - len(total), np.int64)])
            total[ids] += n.values.to_numpy(zero_copy_only=False)
    ids = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"id": pa.array(ids, pa.int32()), "n": pa.array(total[ids])})


def frequencies(raw: DataFrame) -> DataFrame:
    """(id, n) of all ids. The tasks' arrays are added up in at most ``FOLDS``
    tasks first, so that the rows to shuffle grow with the vocabulary and not
    with the number of tasks."""
    arrays = raw.where("freq IS NOT NULL").select("freq_ids", "freq").coalesce(FOLDS)
    return arrays.mapInArrow(_add_up, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))


_FILE_SCHEMA = "part int, block int, start_in_part long, n_docs int, n_ids long, data binary"


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id",
          text_col: str = "text", partitions: int | None = None) -> None:
    """Encode every document and write the files under ``path``."""
    spark = docs.sparkSession
    runtime.prepare(spark)
    n = partitions or runtime.shuffle_partitions(spark)
    ordered = (docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
               .repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text"))
    raw_path = runtime.scratch(spark, "token-ids")
    ordered.mapInArrow(_encode(tokenizer_path, end_id), _RAW_SCHEMA).write.option("compression", "zstd").parquet(raw_path)
    raw = spark.read.schema(_RAW_SCHEMA).parquet(raw_path)

    # at most one row per vocabulary id
    ranked = sorted(((-r["n"], r["id"]) for r in frequencies(raw).collect()))
    rank_of = np.zeros(max((i for _, i in ranked), default=0) + 1, np.uint32)
    for rank, (_, i) in enumerate(ranked):
        rank_of[i] = rank
    table = [(rank, i, -n_) for rank, (n_, i) in enumerate(ranked)]
    spark.createDataFrame(table, "rank int, id int, n long").coalesce(1).write.parquet(f"{path}/ranks")

    def recode(batches):
        dtype = tokens.tokenizer_for(tokenizer_path).dtype
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                ids = _from_planes(r["ids"], r["n_ids"], np.dtype(dtype))
                blob = pack_block(r["doc_ids"], np.array(r["counts"], np.uint32), rank_of[ids])
                rows.append({"part": r["part"], "block": r["block"], "start_in_part": r["start_in_part"],
                             "n_docs": len(r["doc_ids"]), "n_ids": r["n_ids"], "data": blob})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("part", pa.int32()), ("block", pa.int32()), ("start_in_part", pa.int64()),
                                                              ("n_docs", pa.int32()), ("n_ids", pa.int64()), ("data", pa.binary())]))

    blocks = raw.drop("freq", "freq_ids").where("n_ids > 0").mapInArrow(recode, _FILE_SCHEMA)
    blocks.write.option("compression", "zstd").partitionBy("part").parquet(f"{path}/ids")
    runtime.remove(spark, raw_path)


def read(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Documents from the files: doc_id, start (ids of all documents
    before it), n_tokens, ids_crc32 (, ids)."""
    runtime.prepare(spark)
    files = spark.read.schema(_FILE_SCHEMA).parquet(f"{path}/ids")
    # one row per vocabulary id, and one per file
    id_of = np.array([r["id"] for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()], np.uint32)
    sizes = {r["part"]: r["n"] for r in files.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    before, total = {}, 0
    for part in sorted(sizes):
        before[part] = total
        total += sizes[part]

    def decode(batches):
        for batch in batches:
            for r in batch.to_pylist():
                docs, counts, ranks = unpack_block(r["data"])
                ids = id_of[ranks]
                ends = np.cumsum(counts, dtype=np.int64)
                starts = ends - counts
                raw = ids.astype("<u4")
                out = {
                    "doc_id": pa.array(docs, pa.int64()),
                    "start": pa.array(starts + before[r["part"]] + r["start_in_part"], pa.int64()),
                    "n_tokens": pa.array(counts.astype(np.int64)),
                    "ids_crc32": pa.array([zlib.crc32(raw[a:b]) for a, b in zip(starts.tolist(), ends.tolist())], pa.int64()),
                }
                if with_ids:
                    out["ids"] = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_pydict(out)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    return files.select("part", "start_in_part", "data").mapInArrow(decode, schema)
