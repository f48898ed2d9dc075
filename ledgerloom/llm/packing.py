"""Packing of token sequences by the sum-of-squares rule.

A bin is a sequence of fixed capacity, its gap the room that is left. A piece goes where the sum of
the squared numbers of open bins per gap becomes smallest: moving a bin from gap g to gap g - s changes
it by 2 (N(g - s) - N(g)) + 2, filling it up by 1 - 2 N(g). Bins thus stay spread over all gaps, so that
later pieces find one that fits. As all pieces are known, a bin is opened only where no open one has room.

Pieces as long as a sequence fill one alone. Only the one short piece of each document is placed:
groups of about `per_group` pieces are dealt out by a hash and each group is packed, longest piece
first, by one task that holds counts and open bins, never a text. Bins that are left badly filled are opened
again and their pieces packed once more in groups that are as many times larger.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import tokens
from ledgerloom.llm.common import RowIds, arrow_map, record_batch, text_or_empty
from ledgerloom.session import materialise

CAPACITY = 1024
END_ID = 2
PER_GROUP = 200_000


def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: the first takes the remainder, the others are full."""
    short = n % capacity
    bounds = [(0, short)] if short else []
    return bounds + [(s, capacity) for s in range(short, n, capacity)]


class SumOfSquares:
    """Open bins by gap; `place` gives (bin, offset) of a piece."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.counts = np.zeros(capacity + 1, np.int64)
        self.bins = 0

    def place(self, size: int) -> tuple[int, int]:
        c, counts = self.capacity, self.counts
        # change of the sum for each gap g >= size; closing a bin (g == size) frees its square
        change = 2 * (counts[: c + 1 - size] - counts[size:]) + 2
        change[0] = 1 - 2 * counts[size]
        change[counts[size:] == 0] = np.iinfo(np.int64).max
        best = int(np.argmin(change))
        if counts[best + size]:
            gap = best + size
            number = self.open[gap].pop()
            counts[gap] -= 1
        else:
            number, gap = self.bins, c
            self.bins += 1
        rest = gap - size
        if rest:
            self.open[rest].append(number)
            counts[rest] += 1
        return number, c - gap


def pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int, with_ids: bool) -> DataFrame:
    """Every document's pieces: uid, doc_id, piece, start, length, ids_crc32 and, if asked, the ids."""
    ending = int(end_id).to_bytes(4, "little")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, ids_of = tokens.id_encoder(vocabulary), RowIds()
        for batch in batches:
            rows, number, start, length, crc, ids = [], [], [], [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                packed = encoder.encode(text) + ending
                for k, (s, n) in enumerate(piece_bounds(len(packed) // 4, capacity)):
                    own = packed[4 * s : 4 * (s + n)]
                    rows.append(row)
                    number.append(k)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(own))
                    if with_ids:
                        ids.append(own)
            extra = {"ids": (ids, pa.binary())} if with_ids else {}
            yield record_batch(
                uid=(list(ids_of.take(len(rows))), pa.int64()),
                doc_id=(batch.column("doc_id").take(pa.array(rows, pa.int32())), None),
                piece=(number, pa.int32()),
                start=(start, pa.int64()),
                length=(length, pa.int64()),
                ids_crc32=(crc, pa.int64()),
                **extra,
            )

    schema = f"uid long, doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return arrow_map(docs.select("doc_id", text_or_empty().alias("text")), cut, schema)


def place_groups(short: DataFrame, groups: int, capacity: int, level: int) -> DataFrame:
    """uid, bin, place of pieces (uid, length), packed in that many groups."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = SumOfSquares(capacity)
        base = (level << 60) | (TaskContext.get().partitionId() << 36)
        for batch in batches:
            spots = [packer.place(n) for n in batch.column("length").to_pylist()]
            yield record_batch(
                uid=(batch.column("uid"), None),
                bin=([base | s[0] for s in spots], pa.int64()),
                place=([s[1] for s in spots], pa.int64()),
                length=(batch.column("length"), None),
            )

    # long pieces first: short ones then find the gaps; the same order after a lost task
    dealt = short.select("uid", "length").repartition(groups, F.xxhash64("uid")).sortWithinPartitions(F.desc("length"), "uid")
    return arrow_map(dealt, pack, "uid long, bin long, place long, length long")


def pack_documents(
    docs: DataFrame,
    vocabulary: str = tokens.BYTE_BPE,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    per_group: int = PER_GROUP,
    with_ids: bool = False,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids, if asked) of every piece.

    A document is its ids followed by `end_id`; a null or empty text is `end_id` alone. Only documents
    longer than `capacity` are cut: the first piece takes the remainder, the others are full. A
    sequence's pieces lie without gaps from 0. Repeated rows and ids are packed each on its own; other
    columns are not read; an empty table gives no pieces.
    """
    cut = materialise(pieces(docs, vocabulary, capacity, end_id, with_ids), "pieces")
    short = cut.filter(F.col("length") < capacity)
    n = short.count()
    placed = materialise(place_groups(short, max(1, -(-n // per_group)), capacity, 0), "placed")
    fill = placed.groupBy("bin").agg(F.sum("length").alias("fill"))
    poor = fill.filter(F.col("fill") < 0.9 * capacity).select("bin")
    again = placed.join(poor, "bin", "left_semi").select("uid", "length")
    m = again.count()
    if m:
        second = place_groups(again, max(1, -(-m // per_group)), capacity, 1)
        placed = placed.join(poor, "bin", "left_anti").unionByName(materialise(second, "placed again"))
    full = cut.filter(F.col("length") == capacity).withColumns(
        {"sequence_id": -1 - F.col("uid"), "offset": F.lit(0).cast("long")}
    )
    spots = placed.select("uid", F.col("bin").alias("sequence_id"), F.col("place").alias("offset"))
    out = short.join(spots, "uid").unionByName(full)
    return out.drop("uid")
