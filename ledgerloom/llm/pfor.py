"""Token ids in patched frame-of-reference segments.

A segment holds the ids of consecutive documents. It is cut into blocks of 512 ids. A block keeps its
minimum; the differences are packed at the width that holds the given percentile of them, and the few
that need more are stored as (position, high bits) exceptions. The segment lists the byte where each
block starts, so any block can be read on its own.

Segments travel as binary values of a Parquet table in ascending document order, so they can be kept
in any store that Spark writes to, and Spark's commit protocol covers lost tasks.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ledgerloom.llm import tokens
from ledgerloom.llm.common import arrow_map, prepare, record_batch, text_or_empty
from ledgerloom.session import new_path

MAGIC = b"PFOR"
BLOCK = 512
#: Share of a block's differences that its width must hold.
PERCENTILE = 98
#: A segment is closed with the document that brings it to this many ids.
SEGMENT_IDS = 1 << 18
END_ID = 0
_HEAD = struct.Struct("<4sHHQQ")  # magic, block size, unused, ids, blocks


_WIDTH_OF = np.array([n.bit_length() for n in range(1 << 16)], np.uint8)


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits that each value (uint32) needs, 0 for 0."""
    low = _WIDTH_OF[values & np.uint32(0xFFFF)]
    high = values >> np.uint32(16)
    return np.where(high > 0, 16 + _WIDTH_OF[high], low).astype(np.uint8) if high.any() else low


def encode_segment(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """Ids (uint32) as one segment."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not n:
        return _HEAD.pack(MAGIC, BLOCK, 0, 0, 0)
    grid = np.full(blocks * BLOCK, ids[-1], np.uint32)
    grid[:n] = ids
    grid = grid.reshape(blocks, BLOCK)
    minima = grid.min(axis=1)
    rest = grid - minima[:, None]
    need = _bits(rest)
    cut = max(0, min(BLOCK - 1, int(np.ceil(BLOCK * percentile / 100)) - 1))
    widths = np.partition(need, cut, axis=1)[:, cut].astype(np.uint8)
    high = need > widths[:, None]
    counts = high.sum(axis=1).astype(np.uint16)
    sizes = widths.astype(np.int64) * (BLOCK // 8)
    starts = np.zeros(blocks, np.int64)
    starts[1:] = np.cumsum(sizes)[:-1]
    payload = np.zeros(int(sizes.sum()), np.uint8)
    for w in np.unique(widths):
        w = int(w)
        if not w:
            continue
        rows = np.flatnonzero(widths == w)
        low = (rest[rows] & np.uint32((1 << w) - 1)).astype(np.uint64).reshape(len(rows), BLOCK // 8, 8)
        packed = np.zeros((len(rows), BLOCK // 8, w), np.uint8)  # eight values fill w bytes
        for k in range(8):
            first, shift = divmod(k * w, 8)
            moved = low[:, :, k] << np.uint64(shift)
            for j in range(-(-(w + shift) // 8)):
                packed[:, :, first + j] |= (moved >> np.uint64(8 * j)).astype(np.uint8)
        packed = packed.reshape(len(rows), -1)
        payload[starts[rows][:, None] + np.arange(packed.shape[1])] = packed
    where = np.nonzero(high)
    spots = where[1].astype("<u2")
    over = (rest[where] >> widths[where[0]]).astype("<u4")
    return b"".join(
        [
            _HEAD.pack(MAGIC, BLOCK, 0, n, blocks),
            minima.astype("<u4").tobytes(),
            widths.tobytes(),
            counts.astype("<u2").tobytes(),
            starts.astype("<u8").tobytes(),
            struct.pack("<Q", len(payload)),
            payload.tobytes(),
            spots.tobytes(),
            over.tobytes(),
        ]
    )


def decode_segment(segment: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids of blocks first to last (end exclusive, default all) of a segment."""
    magic, size, _, n, blocks = _HEAD.unpack_from(segment)
    if magic != MAGIC or size != BLOCK:
        raise ValueError("not a segment of this format")
    last = blocks if last is None else min(last, blocks)
    if not n or first >= last:
        return np.empty(0, np.uint32)
    at = _HEAD.size

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(segment, kind, count, at)
        at += out.nbytes
        return out

    minima, widths, counts, starts = take("<u4", blocks), take("u1", blocks), take("<u2", blocks), take("<u8", blocks)
    payload = take("u1", int(take("<u8", 1)[0]))
    ends = np.cumsum(counts.astype(np.int64))
    spots, over = take("<u2", int(ends[-1])), take("<u4", int(ends[-1]))
    out = np.zeros((last - first, BLOCK), np.uint32)
    own, begins = widths[first:last], starts[first:last].astype(np.int64)
    # eight bytes from any byte on hold a value of up to 32 bits that begins in it
    padded = np.concatenate([payload, np.zeros(8, np.uint8)])
    window = np.ndarray(len(payload) + 1, "<u8", padded, strides=(1,))
    for w in np.unique(own):
        w = int(w)
        if not w:
            continue
        rows = np.flatnonzero(own == w)
        bit = np.arange(BLOCK) * w
        read = window[begins[rows][:, None] + (bit >> 3)]
        out[rows] = (read >> (bit & 7).astype(np.uint64)) & np.uint64((1 << w) - 1)
    lo, hi = int(ends[first] - counts[first]), int(ends[last - 1])
    block_of = np.repeat(np.arange(last - first), counts[first:last])
    out[block_of, spots[lo:hi]] |= over[lo:hi] << own[block_of].astype(np.uint32)
    out += minima[first:last, None]
    return out.reshape(-1)[: min(n, last * BLOCK) - first * BLOCK]


def write_segments(
    docs: DataFrame,
    path: str,
    vocabulary: str = tokens.BYTE_BPE,
    end_id: int = END_ID,
    percentile: float = PERCENTILE,
    segment_ids: int = SEGMENT_IDS,
) -> None:
    """Write the ids of all documents, in ascending order of doc_id, as a table of segments at `path`.

    Columns: part, seq (order of segments), first (ids before it in its part), n_ids, doc_ids and
    doc_ends (per document: its id, and the end of its ids in the segment), segment (binary). Each
    document is its ids followed by `end_id`; a null or empty text is `end_id` alone. A null doc_id
    sorts first; rows with the same doc_id are ordered by a hash of their text.
    """
    ending = int(end_id).to_bytes(4, "little")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = tokens.id_encoder(vocabulary), TaskContext.get().partitionId()
        seq, first = 0, 0
        names: list = []
        parts: list[bytes] = []
        size = 0
        ends: list[int] = []

        def close() -> pa.RecordBatch:
            nonlocal seq, first, names, parts, size, ends
            blob = encode_segment(np.frombuffer(b"".join(parts), "<u4"), percentile)
            out = record_batch(
                part=([part], pa.int32()),
                seq=([seq], pa.int32()),
                first=([first], pa.int64()),
                n_ids=([size], pa.int64()),
                doc_ids=([names], pa.list_(pa.int64())),
                doc_ends=([ends], pa.list_(pa.int64())),
                segment=([blob], pa.binary()),
            )
            seq, first, names, parts, size, ends = seq + 1, first + size, [], [], 0, []
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                packed = encoder.encode(text) + ending
                parts.append(packed)
                size += len(packed) // 4
                names.append(doc_id)
                ends.append(size)
                if size >= segment_ids:
                    yield close()
        if names:
            yield close()

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    ordered = source.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    schema = (
        "part int, seq int, first long, n_ids long, doc_ids array<long>, doc_ends array<long>, segment binary"
    )
    # packed bits do not compress, so Parquet stores them as they are
    arrow_map(ordered, pack, schema).write.option("compression", "none").parquet(path)


def read_segments(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids, if asked) of every document in such a table.

    `start` counts the ids of all documents before it, over all parts. Only one row for each part, of
    which there are as many as tasks that wrote, is put in order by one task.
    """
    prepare(spark)
    table = spark.read.parquet(path)
    totals = table.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = totals.select(
        "part", F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base")
    )

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("part", "first", "doc_ids", "doc_ends", "segment")]
            for part, first, names, ends, segment in zip(*columns):
                ids = decode_segment(segment).astype("<u4", copy=False)
                starts = [0, *ends[:-1]]
                own = [ids[s:e].tobytes() for s, e in zip(starts, ends)]
                extra = {"ids": (own, pa.binary())} if with_ids else {}
                yield record_batch(
                    part=([part] * len(names), pa.int32()),
                    doc_id=(names, pa.int64()),
                    own_start=([first + s for s in starts], pa.int64()),
                    n_tokens=([e - s for s, e in zip(starts, ends)], pa.int64()),
                    ids_crc32=([zlib.crc32(b) for b in own], pa.int64()),
                    **extra,
                )

    schema = "part int, doc_id long, own_start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    rows = arrow_map(table.select("part", "first", "doc_ids", "doc_ends", "segment"), unpack, schema)
    out = rows.join(before, "part").withColumn("start", F.col("own_start") + F.col("base"))
    return out.select("doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def round_trip(docs: DataFrame, **options) -> DataFrame:
    """Write the documents as segments to the shared folder, and what is read back from there."""
    spark = docs.sparkSession
    path = new_path(spark, "token-segments")
    write_segments(docs, path, **options)
    return read_segments(spark, path)
