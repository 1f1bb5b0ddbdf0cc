"""Token ids in patched frame-of-reference blocks.

A segment holds whole documents. Its ids are cut into blocks of ``BLOCK``; of each the minimum is subtracted, the rest
is packed at the width that fits a percentile of it, and the others are listed as exceptions. An index holds where each
block starts, so that any range can be read without the rest.

Layout, little-endian: ``PFR1``, ids u64, block size u32, blocks u32; starts u64 each, from the first block; then per
block: minimum u32, width u8, exceptions u16, packed offsets, positions u16, offsets u32.

Documents are dealt out by ranges of their ids and written in order, so partition, segment and document follow the
global order; only one total per partition is needed to know where each starts. Segments are rows of a Parquet table
in the shared folder, so any file system that Spark reads will do.

Defined results: null and empty texts hold the end id only; null document ids come first; ties are ordered by text.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common, tokens

BLOCK = 512
PERCENTILE = 90
#: Ids after which a segment is closed at the end of a document.
SEGMENT = 1 << 18
END = 1
_HEAD = struct.Struct("<4sQII")
_BLOCK = struct.Struct("<IBH")


def _narrow(values: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bits of values, side by side from the lowest bit; eight of them fill ``width`` bytes."""
    v = np.ascontiguousarray(values.reshape(-1, 8).T) & np.uint32((1 << width) - 1)
    out = np.zeros((width, v.shape[1]), np.uint8)
    for k in range(width):
        for i in range(8 * k // width, (8 * k + 7) // width + 1):
            shift = i * width - 8 * k
            out[k] |= (v[i] << np.uint32(shift) if shift >= 0 else v[i] >> np.uint32(-shift)).astype(np.uint8)
    return out.T.tobytes()


def _widen(data: bytes, width: int) -> np.ndarray:
    """The values that ``_narrow`` put side by side."""
    raw = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(-1, width).T)
    out = np.zeros((8, raw.shape[1]), np.uint32)
    for i in range(8):
        for k in range(i * width // 8, (i * width + width - 1) // 8 + 1):
            shift = 8 * k - i * width
            part = raw[k].astype(np.uint32)
            out[i] |= part << np.uint32(shift) if shift >= 0 else part >> np.uint32(-shift)
    out &= np.uint32((1 << width) - 1)
    return out.T.reshape(-1)


def pack(ids: np.ndarray, block: int = BLOCK, percentile: int = PERCENTILE) -> bytes:
    """A segment of unsigned 32-bit ids."""
    n = len(ids)
    count = -(-n // block)
    grid = np.empty(count * block, np.uint32)
    grid[:n] = ids
    grid[n:] = ids[-1] if n else 0
    grid = grid.reshape(count, block)
    least = grid.min(axis=1) if count else np.zeros(0, np.uint32)
    grid = grid - least[:, None]
    rank = min(block - 1, -(-block * percentile // 100) - 1)
    fits = np.partition(grid, rank, axis=1)[:, rank] if count else np.zeros(0, np.uint32)
    widths = np.array([int(x).bit_length() for x in fits], np.uint8)
    packed: list[bytes] = [b""] * count
    for w in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == w)
        if w:
            body, size = _narrow(grid[rows], w), block * w // 8
            for i, r in enumerate(rows.tolist()):
                packed[r] = body[i * size : (i + 1) * size]
    over = (grid >> widths[:, None].astype(np.uint32)) > 0 if count else np.zeros((0, block), bool)
    over[widths == 32] = False
    made, starts, at = [], [], 0
    for r in range(count):
        places = np.flatnonzero(over[r])
        b = _BLOCK.pack(int(least[r]), int(widths[r]), len(places)) + packed[r] + places.astype("<u2").tobytes() + grid[r][places].astype("<u4").tobytes()
        starts.append(at)
        at += len(b)
        made.append(b)
    return _HEAD.pack(b"PFR1", n, block, count) + np.array(starts, "<u8").tobytes() + b"".join(made)


def unpack(data: bytes, start: int = 0, stop: int | None = None) -> np.ndarray:
    """The ids from ``start`` to before ``stop``; only the blocks that hold them are read."""
    magic, n, block, count = _HEAD.unpack_from(data)
    if magic != b"PFR1":
        raise ValueError("not a segment of token ids")
    stop = n if stop is None else min(stop, n)
    if start >= stop:
        return np.zeros(0, np.uint32)
    starts = np.frombuffer(data, "<u8", count, _HEAD.size)
    base = _HEAD.size + 8 * count
    first, last = start // block, -(-stop // block)
    heads = [_BLOCK.unpack_from(data, base + int(starts[r])) for r in range(first, last)]
    out = np.empty((last - first, block), np.uint32)
    by_width: dict[int, list[int]] = {}
    for i, (_, w, _) in enumerate(heads):
        by_width.setdefault(w, []).append(i)
    for w, rows in by_width.items():
        if not w:
            out[rows] = 0
            continue
        size = block * w // 8
        at = [base + int(starts[first + i]) + _BLOCK.size for i in rows]
        out[rows] = _widen(b"".join([data[x : x + size] for x in at]), w).reshape(-1, block)
    for i, (least, w, extra) in enumerate(heads):
        if extra:
            at = base + int(starts[first + i]) + _BLOCK.size + block * w // 8
            out[i, np.frombuffer(data, "<u2", extra, at)] = np.frombuffer(data, "<u4", extra, at + 2 * extra)
        out[i] += np.uint32(least)
    return out.reshape(-1)[start - first * block : stop - first * block]


def write_tokens(documents: DataFrame, vocabulary: str, end: int = END, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Write the token ids of every whole text, each followed by ``end``, in ascending order of the key; return the
    table of segments (part, segment, start, keys, lengths, data) as read from the shared folder."""
    spark = documents.sparkSession
    source = documents.select(F.col(key).alias("key"), F.encode(common.text_or_empty(text), "UTF-8").alias("text"))
    ordered = source.repartitionByRange(common.partitions(spark), F.col("key").asc_nulls_first()).sortWithinPartitions(F.col("key").asc_nulls_first(), "text")
    kind = source.schema["key"].dataType.simpleString()
    last = np.array([end], "<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokens.encoder(vocabulary)
        part, segment, start = TaskContext.get().partitionId(), 0, 0
        keys: list = []
        lengths: list[int] = []
        held: list[bytes] = []
        total = 0
        key_type = pa.int64()

        def close() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), "<u4")
            columns = [pa.array([part], pa.int32()), pa.array([segment], pa.int64()), pa.array([start], pa.int64()), pa.array([keys], pa.list_(key_type)), pa.array([lengths], pa.list_(pa.int64())), pa.array([pack(ids)], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["part", "segment", "start", "keys", "lengths", "data"])

        for run in common.together(batches, 1, tokens.TEXT_BYTES):
            key_type = run[0].schema.field(0).type
            named = [k for batch in run for k in batch.column(0).to_pylist()]
            for k, ids in zip(named, own.packed([t for batch in run for t in batch.column(1).to_pylist()]), strict=True):
                keys.append(k)
                lengths.append(len(ids) // 4 + 1)
                held += (ids, last)
                total += lengths[-1]
                if total >= SEGMENT:
                    yield close()
                    segment, start, total = segment + 1, start + total, 0
                    keys, lengths, held = [], [], []
        if keys:
            yield close()

    made = common.in_arrow(ordered, work, f"part int, segment long, start long, keys array<{kind}>, lengths array<long>, data binary")
    return common.stage(made, "tokens", path)


def read_tokens(segments: DataFrame, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """(key, start, n_tokens, ids_crc32[, ids]) of every document in a table of segments."""
    totals = segments.select("part", (F.col("start") + F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n")).groupBy("part").agg(F.max("n").alias("n"))
    offsets = totals.select("part", F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    placed = segments.join(F.broadcast(offsets), "part").select((F.col("before") + F.col("start")).alias("start"), "keys", "lengths", "data")  # one row per partition
    kind = segments.schema["keys"].dataType.elementType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, keys, lengths, data in zip(*(batch.column(i) for i in range(4)), strict=True):
                ids = unpack(data.as_buffer().to_pybytes()).astype("<u4", copy=False)
                n = np.array(lengths.as_py(), np.int64)
                ends = np.cumsum(n)
                raw = memoryview(ids.tobytes())
                cuts = [raw[4 * (e - k) : 4 * e] for e, k in zip(ends.tolist(), n.tolist(), strict=True)]
                columns = [keys.values, pa.array(start.as_py() + ends - n), pa.array(n), pa.array([zlib.crc32(c) for c in cuts], pa.int64())]
                names = [key, "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array([bytes(c) for c in cuts], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return common.in_arrow(placed, work, f"{key} {kind}, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)


def op9_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = common.table(spark, sf_dir, "documents")
    return read_tokens(write_tokens(documents, tokens.default_vocabulary()))
