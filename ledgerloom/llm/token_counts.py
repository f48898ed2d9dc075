"""Token counts by overlap resynchronisation.

A long document is encoded in chunks that overlap. Every chunk yields the first characters of its
tokens. Two neighbouring chunks are spliced at a place inside their overlap where both start a token
and a blank stands before: the vocabulary drops white space and begins anew after it, so what follows
such a place is encoded alike in either chunk and in the whole text. If an overlap holds no such
place it is widened, in the end over the whole left chunk, which then grows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import tokens
from ledgerloom.llm.common import arrow_map, record_batch, text_or_empty

CHUNK = 16_384
OVERLAP = 256
LIMIT = 2048


def token_starts(encoder: tokens.WordEncoder, text: str, start: int, end: int) -> np.ndarray:
    """First characters (in the document) of the tokens of text[start:end], encoded on its own."""
    piece = text[start:end]
    words = encoder.word_bytes(piece)
    counts = np.fromiter(map(len, words), np.int64, len(words)) // 4
    lengths = np.fromiter(map(len, piece.split(" ")), np.int64, len(words))
    firsts = np.cumsum(lengths + 1) - lengths - 1 + start
    return np.repeat(firsts, counts) + np.frombuffer(b"".join(words), "<u4")


def stable_boundary(text: str, left: np.ndarray, right: np.ndarray, start: int, end: int) -> int | None:
    """Last place in text[start:end] where both encodings start a token after a blank."""
    both = np.intersect1d(left[(left > start) & (left < end)], right[(right > start) & (right < end)])
    return next((int(p) for p in both[::-1] if text[p - 1] == " "), None)


def count_text(encoder: tokens.WordEncoder, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of the text, encoded in chunks where it is longer than one."""
    n = len(text)
    if n <= chunk:
        return len(encoder.encode(text)) // 4
    total, counted = 0, 0  # tokens that start before `counted` are in the total
    start, end = 0, chunk
    left = token_starts(encoder, text, start, end)
    while end < n:
        width, place = min(overlap, end - start), None
        while place is None:
            begin, stop = end - width, min(n, end - width + chunk)
            stop = max(stop, min(n, end + 1))
            right = token_starts(encoder, text, begin, stop)
            place = stable_boundary(text, left, right, begin, end)
            if place is not None and place > counted:
                break
            place = None
            if begin <= start:  # no stable place in the whole left chunk: it takes in the next one
                break
            width = min(2 * width, end - start)
        if place is None:
            end = min(n, end + max(chunk, end - start))
            left = token_starts(encoder, text, start, end)
            continue
        total += int(np.count_nonzero((left >= counted) & (left < place)))
        counted, start, end, left = place, begin, stop, right
    return total + int(np.count_nonzero(left >= counted))


def token_counts(
    docs: DataFrame, vocabulary: str = tokens.WORD_BPE, chunk: int = CHUNK, overlap: int = OVERLAP, limit: int = LIMIT
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row.

    A null text counts as empty (0 bytes, 0 tokens). Repeated rows and repeated or null ids give a row
    each; other columns are not read. The vocabulary must drop white space. Nothing is shuffled.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.start_encoder(vocabulary)
        for batch in batches:
            counts = [count_text(encoder, t, chunk, overlap) for t in batch.column("text").to_pylist()]
            yield record_batch(
                doc_id=(batch.column("doc_id"), None),
                n_bytes=(batch.column("n_bytes"), None),
                n_tokens=(counts, pa.int64()),
                over_limit=([c > limit for c in counts], pa.bool_()),
            )

    text = text_or_empty()
    source = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(source, count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
