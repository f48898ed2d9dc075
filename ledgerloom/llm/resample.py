"""Importance resampling of documents towards a target collection, on hashed word windows.

A text's words come with offsets from the tokenizers library: an untrained pre-tokenizer, one regular
expression split over the ASCII-lowered text. Each pair (first word, last word) of a window of one or two
words is a feature; its bucket is the CRC-32 of the window's words joined by one blank. Histograms of all
documents and of all target texts give every bucket a gain; a document's weight is the mean gain of its
features, and Gumbel noise from a hash of its doc_id turns the weights into a draw without replacement.

The library splits each blank-separated chunk once per worker and remembers it, with its words' offsets
inside the chunk. CRC-32 is linear, so a window's value follows from those of its two words and the
length of the second, by table lookups on whole arrays.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import RowIds, arrow_map, prepare, record_batch
from ledgerloom.operators.sequence import ordered_scan, range_chunks
from ledgerloom.session import materialise

#: What a word is made of: no ASCII character but digits and lower-case letters, any other character.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
SEED = 7
#: Documents with fewer words are never drawn.
LEAST_WORDS = 20
#: Documents of 100 eligible ones that are drawn.
DRAWN = 25
#: Chunks that a worker remembers before it starts anew.
MEMORY_CHUNKS = 500_000
#: Longer chunks are split each time, in stretches of about this many bytes, and not remembered.
CHUNK_BYTES = 1 << 12
#: Words up to this many bytes are joined to windows by tables, longer ones one by one.
TABLE_BYTES = 64

_BREAK = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
_splitter = None


def splitter():
    """The untrained pre-tokenizer: words are kept, what lies between is removed."""
    global _splitter
    if _splitter is None:
        from tokenizers import Regex, pre_tokenizers

        _splitter = pre_tokenizers.Split(Regex(WORD), "removed", invert=True)
    return _splitter


def words_with_offsets(lowered: str) -> list[tuple[str, tuple[int, int]]]:
    """Words of an ASCII-lowered text, each with the code points where it starts and ends."""
    return splitter().pre_tokenize_str(lowered)


def _shift_tables() -> np.ndarray:
    """[bytes appended, byte of the value, its 256 states]: what zero bytes behind a text do to its CRC-32."""
    one = np.array([zlib.crc32(bytes([b]), 0xFFFFFFFF) ^ 0xFFFFFFFF for b in range(256)], np.uint32)
    # `one` is the register after a byte; a zero byte moves value v to (v >> 8) ^ one[v & 255]
    tables = np.zeros((TABLE_BYTES + 1, 4, 256), np.uint32)
    values = np.arange(256, dtype=np.uint32)
    for k in range(4):
        moved = values << np.uint32(8 * k)
        tables[0, k] = moved
        for n in range(1, TABLE_BYTES + 1):
            moved = (moved >> np.uint32(8)) ^ one[moved & np.uint32(255)]
            tables[n, k] = moved
    return tables


class Windows:
    """This worker's memory of chunks and their words; turns texts into the buckets of their windows."""

    def __init__(self, buckets: int) -> None:
        self.buckets = buckets
        self.shift = _shift_tables()
        self.clear()

    def clear(self) -> None:
        self.chunk_ids: dict[bytes, int] = {b"": 0}
        self.first, self.count = [0], [0]  # words of each chunk, in the arrays below
        self.words: list[bytes] = []
        self.sums: list[int] = []
        self.stored = (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint32),) * 2 + (np.zeros(0, np.int64),)

    def _learn(self, chunks: list[bytes]) -> None:
        """Split new chunks in one call of the library; its offsets tell which chunk a word is from."""
        decoded = [c.decode("utf-8", "replace") for c in chunks]
        ends = np.cumsum([len(d) + 1 for d in decoded])
        found = words_with_offsets(" ".join(decoded))
        owner = np.searchsorted(ends, [start for _, (start, _) in found], side="right")
        counts = np.bincount(owner, minlength=len(chunks)).tolist()
        at = len(self.words)
        words = [w.encode() for w, _ in found]
        self.words += words
        self.sums += map(zlib.crc32, words)
        for chunk, n in zip(chunks, counts):
            self.chunk_ids[chunk] = len(self.first)
            self.first.append(at)
            self.count.append(n)
            at += n

    def _arrays(self) -> tuple[np.ndarray, ...]:
        """(first, count, sum of the word, sum of the word and a blank, bytes) as arrays that follow the lists."""
        first, count, own, blank, size = self.stored
        if len(first) < len(self.first):
            first = np.append(first, self.first[len(first) :])
            count = np.append(count, self.count[len(count) :])
            new = slice(len(own), None)
            own = np.append(own, np.array(self.sums[new], np.uint32))
            blank = np.append(blank, np.array([zlib.crc32(b" ", s) for s in self.sums[new]], np.uint32))
            size = np.append(size, np.array([len(w) for w in self.words[new]], np.int64))
            self.stored = first, count, own, blank, size
        return self.stored

    def word_ids(self, lowered: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Words of all texts in a row, and how many each text has."""
        if len(self.first) > MEMORY_CHUNKS:
            self.clear()
        known, listed, sizes = self.chunk_ids, [], []
        for text in lowered:
            chunks = text.split(b" ")
            if len(text) > CHUNK_BYTES and max(map(len, chunks)) > CHUNK_BYTES:
                chunks = [part for c in chunks for part in _stretches(c)]
            listed += chunks
            sizes.append(len(chunks))
        new = [c for c in dict.fromkeys(listed) if c not in known]
        start, size = 0, 0
        for i, chunk in enumerate(new):
            size += len(chunk)
            if size > 1 << 20 or i == len(new) - 1:
                self._learn(new[start : i + 1])
                start, size = i + 1, 0
        ids = np.fromiter(map(known.__getitem__, listed), np.int64, len(listed))
        first, count, *_ = self._arrays()
        for chunk in new:  # long chunks are not worth their room
            if len(chunk) > CHUNK_BYTES:
                del known[chunk]
        per_chunk = count[ids]
        before = np.cumsum(per_chunk) - per_chunk
        words = np.repeat(first[ids] - before, per_chunk) + np.arange(int(per_chunk.sum()))
        text_ends = np.cumsum(sizes)
        running = np.concatenate([[0], np.cumsum(per_chunk)])[np.concatenate([[0], text_ends])]
        return words, np.diff(running)

    def buckets_of(self, lowered: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text of each feature, its bucket, words per text) of ASCII-lowered texts."""
        words, counts = self.word_ids(lowered)
        *_, own, blank, size = self._arrays()
        text = np.repeat(np.arange(len(counts)), counts)
        left, right = words[:-1], words[1:]
        inside = text[:-1] == text[1:] if len(words) else np.zeros(0, bool)
        left, right = left[inside], right[inside]
        lengths = size[right]
        long = np.flatnonzero(lengths > TABLE_BYTES)
        rows = np.minimum(lengths, TABLE_BYTES)
        value = blank[left]
        joined = own[right]
        for k in range(4):
            joined = joined ^ self.shift[rows, k, (value >> np.uint32(8 * k)) & np.uint32(255)]
        for i in long.tolist():
            joined[i] = zlib.crc32(self.words[right[i]], int(value[i]))
        texts = np.concatenate([text, text[:-1][inside]])
        return texts, np.concatenate([own[words], joined]) % np.uint32(self.buckets), counts


def _stretches(chunk: bytes) -> Iterator[bytes]:
    """A chunk in pieces of about CHUNK_BYTES that are cut where no word is."""
    start = 0
    while len(chunk) - start > CHUNK_BYTES:
        cut = _BREAK.search(chunk, start + CHUNK_BYTES)
        if not cut:
            break
        yield chunk[start : cut.start()]
        start = cut.end()
    yield chunk[start:]


_memories: dict[int, Windows] = {}


def windows(buckets: int) -> Windows:
    if buckets not in _memories:
        _memories[buckets] = Windows(buckets)
    return _memories[buckets]


def _lowered(values: pa.Array) -> list[bytes]:
    # bytes.lower changes A to Z only
    return [v.lower() for v in values.to_pylist()]


def _text() -> F.Column:
    return F.coalesce(F.col("text").cast("string").cast("binary"), F.lit(b"")).alias("text")


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all features of all texts; every task adds up its own before they are shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            _, found, _ = windows(buckets).buckets_of(_lowered(batch.column("text")))
            total += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(total)
        yield record_batch(bucket=(held.tolist(), pa.int32()), n=(total[held].tolist(), pa.int64()))

    return arrow_map(texts.select(_text()), count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def learn_gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Gain of every bucket, from all documents and all target texts: one small number each."""
    both = (
        bucket_counts(docs, buckets).withColumn("side", F.lit(0))
        .unionByName(bucket_counts(target, buckets).withColumn("side", F.lit(1)))
    )
    counts = [[0] * buckets, [0] * buckets]
    for row in both.collect():
        counts[row["side"]][row["bucket"]] = row["n"]
    source, aim = sum(counts[0]), sum(counts[1])
    return [
        math.floor(1000 * math.log((t + 1) * (source + buckets) / ((s + 1) * (aim + buckets))))
        for s, t in zip(*counts)
    ]


def weigh(docs: DataFrame, gains: list[int], seed: int = SEED) -> DataFrame:
    """uid, doc_id, n_words, n_features, weight, score of every document; written, so that uid holds."""
    kind, buckets = docs.schema["doc_id"].dataType.simpleString(), len(gains)
    table = np.array(gains, np.float64)

    def noise(name: str | None) -> int:
        h = int(hashlib.sha256(f"{seed}:{'' if name is None else name}".encode()).hexdigest()[:8], 16)
        return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = RowIds()
        for batch in batches:
            text, found, n_words = windows(buckets).buckets_of(_lowered(batch.column("text")))
            rows = len(n_words)
            features = np.bincount(text, minlength=rows)
            # sums of whole numbers far below 2 to the 53rd, so doubles hold them exactly
            total = np.bincount(text, weights=table[found], minlength=rows).astype(np.int64)
            weight = np.where(features > 0, total // np.maximum(features, 1), 0)
            score = weight + np.array([noise(d) for d in batch.column("name").to_pylist()], np.int64)
            yield record_batch(
                uid=(list(ids.take(rows)), pa.int64()),
                doc_id=(batch.column("doc_id"), None),
                n_words=(n_words.tolist(), pa.int64()),
                n_features=(features.tolist(), pa.int64()),
                weight=(weight.tolist(), pa.int64()),
                score=(score.tolist(), pa.int64()),
            )

    source = docs.select("doc_id", F.col("doc_id").cast("string").alias("name"), _text())
    schema = f"uid long, doc_id {kind}, n_words long, n_features long, weight long, score long"
    return materialise(arrow_map(source, work, schema), "weights")


def draw(weighed: DataFrame, least_words: int = LEAST_WORDS, drawn: int = DRAWN) -> DataFrame:
    """All rows with their rank, null where not drawn.

    A histogram of scores, whose values a bounded range holds at any size, tells the score of the last row
    that is drawn. Only rows from there on are put in order, by ranges of (score, doc_id) and not in one task.
    """
    eligible = F.col("n_words") >= least_words
    scores = weighed.filter(eligible).groupBy("score").count().orderBy(F.desc("score")).collect()
    wanted = drawn * sum(r["count"] for r in scores) // 100
    seen, last = 0, None
    for r in scores:
        if seen >= wanted:
            break
        seen, last = seen + r["count"], r["score"]
    none = weighed.withColumn("rank", F.lit(None).cast("long"))
    if last is None:
        return none
    near = eligible & (F.col("score") >= last)
    ordered = weighed.filter(near).withColumn("_down", -F.col("score"))
    order = ["_down", "doc_id", "uid"]
    ranked = ordered_scan(range_chunks(ordered, [], order), [], order, number="rank").select(*weighed.columns, "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    return ranked.unionByName(none.filter(~near))


def resample(
    docs: DataFrame,
    target: DataFrame,
    buckets: int = BUCKETS,
    seed: int = SEED,
    least_words: int = LEAST_WORDS,
    drawn: int = DRAWN,
) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document; drawn ones are ranked 1, 2, 3...

    `docs` needs doc_id and text, `target` text; other columns are left out. A null text has no words; a text
    without words has weight 0. Ties go to the smaller doc_id, a null one first; rows that repeat a doc_id
    count each and take ranks in a row. An empty target or an empty table of documents works.
    """
    prepare(docs.sparkSession)
    gains = learn_gains(docs, target, buckets)
    out = draw(weigh(docs, gains, seed), least_words, drawn)
    return out.select("doc_id", "n_features", "weight", "score", "rank")
