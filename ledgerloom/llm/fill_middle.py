"""Fill-in-the-middle transformation over a learned rank index.

A text is a row of tokens, runs of ASCII letters or single other characters; cuts are given as token
ranks. The places of all token boundaries grow almost evenly with their rank, so the index keeps a few
straight segments instead of all places: each is as long as some line stays within `error` characters of
every boundary it covers. What the line misses is kept as one small number per boundary, so a place is
predicted from its rank and then corrected to the exact one.

Which form a document takes and where it is cut depends on a hash of its doc_id alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import arrow_map, record_batch, text_or_empty

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: A line may miss a boundary by this many characters; what it misses fits one signed byte.
ERROR = 64
#: Boundaries that a segment is first tried on; the window doubles while the line holds.
WINDOW = 256
#: Documents of 100 that are transformed, and those of 100 transformed that put the suffix first.
TRANSFORMED, SUFFIX_FIRST = 90, 20
SEED = 1


def boundaries(text: str) -> np.ndarray:
    """Places of all token boundaries in code points: 0, the end of each token in order."""
    if not text:
        return np.zeros(1, np.int64)
    if text.isascii():
        points = np.frombuffer(text.encode("ascii"), np.uint8)
    else:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = ((points | 0x20) - points.dtype.type(97)) < 26  # wraps below "a"
    ends = np.flatnonzero(~(letter[1:] & letter[:-1])) + 1
    return np.concatenate([[0], ends, [len(points)]])


class RankIndex:
    """Boundary places by rank: line segments within `error`, and residuals that make them exact."""

    def __init__(self, places: np.ndarray, error: int = ERROR) -> None:
        places = np.asarray(places, np.int64)
        self.error = error
        starts, slopes, bases = [], [], []
        n, s = len(places), 0
        while s < n:
            size, slope = self._longest(places, s)
            starts.append(s)
            slopes.append(slope)
            bases.append(places[s])
            s += size
        self.starts = np.array(starts, np.int64)
        self.slopes = np.array(slopes, np.float64)
        self.bases = np.array(bases, np.int64)
        lengths = np.diff(np.append(self.starts, n))
        rank = np.arange(n) - np.repeat(self.starts, lengths)
        missed = places - self._line(np.repeat(self.slopes, lengths), np.repeat(self.bases, lengths), rank)
        self.residuals = missed.astype(np.int8 if error < 127 else np.int32)

    def _longest(self, places: np.ndarray, s: int) -> tuple[int, float]:
        """How many boundaries from s on one line through the first of them holds, and its slope."""
        window = WINDOW
        while True:
            part = places[s + 1 : s + window]
            if not len(part):
                return 1, 0.0
            steps = np.arange(1, len(part) + 1)
            rise = part - places[s]
            # the slopes that hold for all boundaries so far shrink to an interval, at last an empty one
            low = np.maximum.accumulate((rise - self.error) / steps)
            high = np.minimum.accumulate((rise + self.error) / steps)
            broken = low > high
            if broken[-1]:
                held = int(np.argmax(broken))
            elif s + window >= len(places):
                held = len(part)
            else:
                window *= 2
                continue
            # a step of at most `error` characters always holds; a longer one is a token of its own line
            if not held:
                return 1, 0.0
            return held + 1, float(low[held - 1] + high[held - 1]) / 2

    @staticmethod
    def _line(slope: np.ndarray, base: np.ndarray, rank: np.ndarray) -> np.ndarray:
        return base + np.floor(slope * rank + 0.5).astype(np.int64)

    def predict(self, ranks: np.ndarray) -> np.ndarray:
        ranks = np.asarray(ranks, np.int64)
        own = np.searchsorted(self.starts, ranks, side="right") - 1
        return self._line(self.slopes[own], self.bases[own], ranks - self.starts[own])

    def places(self, ranks: np.ndarray) -> np.ndarray:
        """Exact places of these boundaries."""
        ranks = np.asarray(ranks, np.int64)
        return self.predict(ranks) + self.residuals[ranks]


def draws(doc_id: str | None, seed: int = SEED) -> list[int]:
    """Four numbers that decide over a document: two cuts, whether and how it is transformed."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]


def fill_in_middle(
    docs: DataFrame,
    seed: int = SEED,
    transformed: int = TRANSFORMED,
    suffix_first: int = SUFFIX_FIRST,
    error: int = ERROR,
) -> DataFrame:
    """Every document's training text: doc_id, n, form, prefix_chars, middle_chars, output, segments.

    n counts tokens; `segments` is the size of the document's rank index. A null text counts as empty, an
    empty text or one that holds a marker stays plain. A null doc_id hashes like an empty one. Rows that
    repeat a doc_id get the same draws, and equal rows equal results. Other columns of `docs` are left out.
    Every row is worked on by itself: nothing shuffles, and a long text costs memory for itself alone.
    """
    markers = (PREFIX, SUFFIX, MIDDLE)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, forms, before, between, outputs, sizes = [], [], [], [], [], []
            for name, text in zip(batch.column("name").to_pylist(), batch.column("text").to_pylist()):
                index = RankIndex(boundaries(text), error)
                n = len(index.residuals) - 1
                h1, h2, h3, h4 = draws(name, seed)
                counts.append(n)
                sizes.append(len(index.starts))
                if not text or h3 % 100 >= transformed or any(m in text for m in markers):
                    forms.append("plain")
                    before.append(None)
                    between.append(None)
                    outputs.append(text)
                    continue
                a, b = index.places(np.sort([h1 % (n + 1), h2 % (n + 1)])).tolist()
                prefix, middle, suffix = text[:a], text[a:b], text[b:]
                if h4 % 100 < suffix_first:
                    forms.append("spm")
                    outputs.append(f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}")
                else:
                    forms.append("psm")
                    outputs.append(f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}")
                before.append(a)
                between.append(b - a)
            yield record_batch(
                doc_id=(batch.column("doc_id"), None),
                n=(counts, pa.int64()),
                form=(forms, pa.string()),
                prefix_chars=(before, pa.int64()),
                middle_chars=(between, pa.int64()),
                output=(outputs, pa.string()),
                segments=(sizes, pa.int64()),
            )

    source = docs.select("doc_id", F.col("doc_id").cast("string").alias("name"), text_or_empty().alias("text"))
    return arrow_map(
        source,
        work,
        f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string, segments long",
    )


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from. Each marker stands in it once, also across part borders."""
    rest = F.substring_index(output, MIDDLE, 1)
    middle = F.substring_index(output, MIDDLE, -1)

    def inner(first: str) -> Column:  # rest is <one marker>first part<other marker>second part
        return F.substr(F.substring_index(rest, first, 1), F.lit(len(first) + 1))

    psm = F.concat(inner(SUFFIX), middle, F.substring_index(rest, SUFFIX, -1))
    spm = F.concat(F.substring_index(rest, PREFIX, -1), middle, inner(PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digest(outputs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    output = F.col("output")
    return outputs.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(output.cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(output, F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )
