"""Exact deduplication by Grace hash partitioning.

Texts are equal when they agree after deleting blanks. Each task first folds equal texts of its own
rows, so a group of copies that holds a third of all rows reaches the shuffle as one row per task.
Those rows are partitioned by the hash of their content. A task reads its partition into an
open-addressing table that compares complete contents; if the partition outgrows the table's bytes it
is partitioned again, by other bits of the hash, into spill files that only this task reads and
removes, until each bucket fits.
"""

from __future__ import annotations

import hashlib
import os
import shutil
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerloom.llm.common import BLANKS, RowIds, arrow_map, prepare
from ledgerloom.session import materialise

#: Bytes of distinct contents that a table holds before its bucket is partitioned further.
TABLE_BYTES = 64 << 20
#: Spill files that a bucket is partitioned into.
FANOUT = 16
_DELETED = BLANKS.encode()


class ContentTable:
    """Open addressing with linear probing; a slot names an entry, entries hold complete contents."""

    def __init__(self, slots: int = 1024) -> None:
        self.slots = np.full(slots, -1, np.int64)
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.bytes = 0

    def find(self, digest: int, content: bytes) -> tuple[int, bool]:
        """(entry, whether it is new) of a content."""
        mask = len(self.slots) - 1
        at = digest & mask
        while (entry := int(self.slots[at])) >= 0:
            if self.hashes[entry] == digest and self.contents[entry] == content:
                return entry, False
            at = (at + 1) & mask
        entry = len(self.hashes)
        self.slots[at] = entry
        self.hashes.append(digest)
        self.contents.append(content)
        self.bytes += len(content)
        if 3 * len(self.hashes) > 2 * len(self.slots):
            self._grow()
        return entry, True

    def _grow(self) -> None:
        self.slots = np.full(2 * len(self.slots), -1, np.int64)
        mask = len(self.slots) - 1
        for entry, digest in enumerate(self.hashes):
            at = digest & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = entry


def normalised(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(None, _DELETED)


def number_of(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little") >> 1


def fold_task(batches: Iterator[pa.RecordBatch], schema: pa.Schema, members: bool, table_bytes: int) -> Iterator[pa.RecordBatch]:
    """Fold equal texts of a task: the best row of each carries its `row` and the group's count.

    With `members` every row comes out, copies without their `row`; without, best rows only.
    """
    ids = RowIds()
    table, kept = ContentTable(), []  # kept: per entry [count, best chars, best doc_id, best uid, row, digest]
    rows_of: list[list[tuple]] = []

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal table, kept, rows_of
        out: list[dict] = []
        for entry, best in enumerate(kept):
            base = {"digest": best[5], "rep": best[3], "count": best[0], "chars": best[1], "best_id": best[2]}
            if members:
                out += [base | {"doc_id": d, "uid": u, "row": best[4] if u == best[3] else None} for d, u in rows_of[entry]]
            else:
                out.append(base | {"doc_id": best[2], "uid": best[3], "row": best[4]})
        for i in range(0, len(out), 1000):
            yield pa.RecordBatch.from_pylist(out[i : i + 1000], schema=schema)
        table, kept, rows_of = ContentTable(), [], []

    for batch in batches:
        texts, names, rows = (batch.column(c) for c in ("text", "doc_id", "row"))
        for k, (text, doc_id, uid) in enumerate(zip(texts.to_pylist(), names.to_pylist(), ids.take(len(batch)))):
            content = normalised(text)
            digest = hashlib.sha256(content).digest()
            entry, new = table.find(number_of(digest), content)
            chars = len(text or "")
            if new:
                row = rows[k].as_py()
                kept.append([1, chars, doc_id, uid, row, digest])
                rows_of.append([(doc_id, uid)])
                continue
            best = kept[entry]
            best[0] += 1
            if members:
                rows_of[entry].append((doc_id, uid))
            if rank(chars, doc_id, uid) < rank(*best[1:4]):
                best[1:5] = [chars, doc_id, uid, rows[k].as_py()]
        if table.bytes > table_bytes:
            yield from flush()
    yield from flush()


def rank(chars: int, doc_id: int | None, uid: int) -> tuple:
    """Order of the rows of a group: most code points, then smallest doc_id (null last), then row."""
    return (-chars, doc_id is None, doc_id or 0, uid)


def grace(
    batches: Iterator[pa.RecordBatch],
    emit: Callable[[list[dict]], Iterator[pa.RecordBatch]],
    table_bytes: int,
    depth: int = 0,
) -> Iterator[pa.RecordBatch]:
    """Groups of equal content of a bucket: `emit` gets each bucket's records with their group settled.

    A record has digest, row (with its text), rep, count, chars and best_id. The hash's bits that the
    shuffle and earlier levels used are left out when a bucket is partitioned again. A bucket whose
    records all have one digest is one group (or a hash collision), and is not partitioned further.
    """
    table, records, groups = ContentTable(), [], []
    source = iter(batches)
    spilled = None
    for batch in source:
        for record in batch.to_pylist():
            content = normalised(record["row"]["text"])
            entry, new = table.find(number_of(record["digest"]), content)
            mine = rank(record["chars"], record["best_id"], record["rep"])
            if new:
                groups.append([record["count"], mine, record])
                records.append((record["rep"], entry))
            else:
                group = groups[entry]
                group[0] += record["count"]
                if mine < group[1]:
                    group[1], group[2] = mine, record
                records.append((record["rep"], entry))
        if table.bytes > table_bytes and len(table.hashes) > 1 and depth < 8:
            spilled = _spill(groups, records, source, batch.schema, depth)
            break
    if spilled is None:
        yield from emit([{"rep": rep, "group": groups[entry]} for rep, entry in records])
        return
    folder, files, aliases = spilled
    try:
        del table, records, groups
        for path in files:
            with pa.OSFile(path) as f, pa.ipc.open_stream(f) as reader:

                def again(found: list[dict], own=aliases) -> Iterator[pa.RecordBatch]:
                    more = [{"rep": r, "group": x["group"]} for x in found for r in own.get(x["rep"], ())]
                    yield from emit(found + more)

                yield from grace(reader, again, table_bytes, depth + 1)
            os.remove(path)
    finally:
        shutil.rmtree(folder, ignore_errors=True)


def _spill(groups: list, records: list, rest: Iterator[pa.RecordBatch], schema: pa.Schema, depth: int):
    """Partition what the table holds and what is still to come into FANOUT files of this task."""
    folder = tempfile.mkdtemp(prefix="grace-")
    shift = 8 + depth
    paths = [os.path.join(folder, f"bucket-{k}") for k in range(FANOUT)]
    try:
        sinks = [pa.OSFile(p, "wb") for p in paths]
        writers = [pa.ipc.new_stream(s, schema) for s in sinks]

        def put(rows: list[dict]) -> None:
            dealt: dict[int, list[dict]] = {}
            for row in rows:
                dealt.setdefault(row["digest"][shift] % FANOUT, []).append(row)
            for k, own in dealt.items():
                writers[k].write_batch(pa.RecordBatch.from_pylist(own, schema=schema))

        # a group already folded goes on as its best record with the whole count
        put([best | {"count": count} for count, _, best in groups])
        aliases: dict[int, list[int]] = {}
        for rep, entry in records:
            best = groups[entry][2]["rep"]
            if rep != best:
                aliases.setdefault(best, []).append(rep)
        for batch in rest:
            put(batch.to_pylist())
        for w, s in zip(writers, sinks):
            w.close()
            s.close()
    except BaseException:
        shutil.rmtree(folder, ignore_errors=True)
        raise
    return folder, paths, aliases


def _folded(docs: DataFrame, members: bool, table_bytes: int, wide: bool) -> DataFrame:
    """Rows folded by task; `row` is the whole row if `wide`, else its text."""
    prepare(docs.sparkSession)
    columns = [F.col(f"`{c}`") for c in docs.columns] if wide else [F.col("text")]
    kind = docs.schema["doc_id"].dataType.simpleString()
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.struct(*columns).alias("row"))
    row = source.schema["row"].dataType.simpleString()
    schema = f"doc_id {kind}, uid long, digest binary, rep long, count long, chars long, best_id {kind}, row {row}"
    empty = docs.sparkSession.createDataFrame([], schema)
    arrow = to_arrow_schema(empty.schema)
    return arrow_map(source, lambda b: fold_task(b, arrow, members, table_bytes), schema)


def surviving_rows(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row of `docs` (all its columns) per distinct text.

    Equal texts: identical after deleting blanks; null counts as empty. The row with the most code
    points stays, then the smallest doc_id (null last); of rows that agree in that too, any one. An
    empty table gives an empty result. Columns may have any names.
    """
    folded = _folded(docs, False, table_bytes, True)
    schema = docs.schema
    arrow = to_arrow_schema(schema)

    def winners(found: list[dict]) -> Iterator[pa.RecordBatch]:
        rows = [x["group"][2]["row"] for x in found if x["rep"] == x["group"][2]["rep"]]
        for i in range(0, len(rows), 500):
            yield pa.RecordBatch.from_pylist(rows[i : i + 500], schema=arrow)

    dealt = folded.drop("doc_id", "uid").repartition("digest")
    return arrow_map(dealt, lambda b: grace(b, winners, table_bytes), schema)


def exact_groups(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row, dropped ones too.

    Which row stays: see `surviving_rows`; of rows repeated as a whole exactly one is kept. The
    membership of a row travels as two numbers; texts are shuffled once, folded.
    """
    folded = materialise(_folded(docs, True, table_bytes, False), "folded")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"rep long, keep_id {kind}, keep_uid long, group_size long"
    arrow = to_arrow_schema(docs.sparkSession.createDataFrame([], schema).schema)

    def settled(found: list[dict]) -> Iterator[pa.RecordBatch]:
        out = [
            {"rep": x["rep"], "keep_id": g[2]["best_id"], "keep_uid": g[2]["rep"], "group_size": g[0]}
            for x in found
            for g in [x["group"]]
        ]
        yield pa.RecordBatch.from_pylist(out, schema=arrow)

    firsts = folded.filter(F.col("row").isNotNull()).drop("doc_id", "uid")
    groups = arrow_map(firsts.repartition("digest"), lambda b: grace(b, settled, table_bytes), schema)
    joined = folded.select("doc_id", "uid", "rep", "digest").join(groups, "rep")
    return joined.select(
        "doc_id", "keep_id", "group_size",
        (F.col("uid") == F.col("keep_uid")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
