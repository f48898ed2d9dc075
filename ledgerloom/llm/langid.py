"""Language identification by nearest centroids.

A text becomes a vector of character n-gram counts (bytes of the lower-case letters, anything else as
one blank; n = 1 to 3, hashed), damped, weighted by inverse document frequency and normalised. Each
language has several centroids, found by spherical k-means over a bounded sample of labelled rows. A
text gets the language of the most similar centroid. One whose similarity is far below that of texts of
its length, measured on learning texts and their stretches against centroids that did not learn from
them, is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import arrow_map, prepare, record_batch

#: Labelled rows per language that are learned from, about.
SAMPLE_ROWS = 400
CENTROIDS = 3
DIMENSIONS = 8192
UNKNOWN = "und"
#: Parts of the learning texts; the similarities of one part are measured on centroids of the others.
FOLDS = 5
#: A text is rejected below SLACK of the similarity that all but this share of the measured ones reach.
QUANTILE = 0.002
SLACK = 0.5


_BLANK_OR_LETTER = np.array([c if c >= 128 or chr(c).isalpha() else 32 for c in range(256)], np.uint8)


def vector(text: str, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Damped n-gram counts of a whole text, as float32 of length `dimensions`."""
    out = np.zeros(dimensions, np.float32)
    data = _BLANK_OR_LETTER[np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)]
    blank = data == 32
    data = data[np.append(True, ~(blank[1:] & blank[:-1]))]
    step = 1 << 20
    total = np.zeros(dimensions, np.int64)
    for s in range(0, len(data), step):
        piece = data[max(0, s - 2) : s + step].astype(np.uint32)
        fresh = min(s, 2)
        for n in (1, 2, 3):
            first = max(0, fresh - n + 1)  # n-grams that end in this stretch
            if len(piece) - first < n:
                continue
            gram = np.full(len(piece) - first - n + 1, n, np.uint32)
            for k in range(n):
                gram = (gram << np.uint32(8)) | piece[first + k : len(piece) - n + 1 + k]
            slots = (gram * np.uint32(2654435761)) >> np.uint32(32 - dimensions.bit_length() + 1)
            total += np.bincount(slots, minlength=dimensions)
    np.log1p(total, out=out, casting="unsafe")
    return out


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=-1, keepdims=True), 1e-12)


def length_class(n: int) -> int:
    """Lengths (characters) that share a rejection threshold: powers of four."""
    return min(7, max(0, (n.bit_length() - 1) // 2))


@dataclass
class Model:
    languages: list[str]
    owner: np.ndarray  # language of each centroid
    centroids: np.ndarray
    idf: np.ndarray
    least: np.ndarray  # smallest accepted similarity per length class

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        """(language, similarity, rejected) of whole texts; without a letter: und, 0, rejected."""
        known = [i for i, t in enumerate(texts) if has_letter(t)]
        names, scores, rejected = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
        for i in range(0, len(known), 64) if len(self.owner) else ():
            own = known[i : i + 64]
            near = unit(np.stack([vector(texts[k], len(self.idf)) for k in own]) * self.idf) @ self.centroids.T
            best = near.argmax(axis=1)
            for k, b, s in zip(own, best, near.max(axis=1)):
                names[k] = self.languages[self.owner[b]]
                scores[k] = float(min(1.0, max(0.0, s)))
                rejected[k] = bool(s < self.least[length_class(len(texts[k]))])
        return names, scores, rejected


def cluster(rows: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids of unit vectors by spherical k-means, started far apart."""
    centres = [rows.mean(axis=0)]
    while len(centres) < min(k, len(rows)):
        near = np.max(rows @ unit(np.stack(centres)).T, axis=1)
        centres.append(rows[int(near.argmin())])
    centroids = unit(np.stack(centres))
    for _ in range(rounds):
        owner = (rows @ centroids.T).argmax(axis=1)
        centroids = unit(np.stack([rows[owner == c].mean(axis=0) if (owner == c).any() else centroids[c] for c in range(len(centroids))]))
    return centroids


def fit(rows: list[tuple[str, str]], centroids: int = CENTROIDS, dimensions: int = DIMENSIONS, slack: float = SLACK) -> Model:
    """Model of (text, language) rows; texts without a letter teach nothing."""
    known = sorted({r for r in rows if has_letter(r[0])})
    return fit_vectors([(lang, *piece) for t, lang in known for piece in pieces(t, dimensions)], centroids, dimensions, slack)


def pieces(text: str, dimensions: int = DIMENSIONS) -> list[tuple[int, int, bool, bytes, bytes]]:
    """(fold, length, whole, slots, values) of a text and of one stretch per shorter length class.

    A stretch has the least length of its class and begins where a hash of the text says; stretches
    without a letter are left out. They only measure similarities.
    """
    key = crc32(text.encode("utf-8", "replace"))
    out = [(key % FOLDS, len(text), True, *sparse(vector(text, dimensions)))]
    for n in (4**k for k in range(length_class(len(text)))):
        start = key % (len(text) - n + 1)
        cut = text[start : start + n]
        if has_letter(cut):
            out.append((key % FOLDS, n, False, *sparse(vector(cut, dimensions))))
    return out


def sparse(counts: np.ndarray) -> tuple[bytes, bytes]:
    """(slots, values) of the counts that are not 0."""
    slots = np.flatnonzero(counts)
    return slots.astype("<u4").tobytes(), counts[slots].astype("<f4").tobytes()


def dense(rows: list[tuple], dimensions: int) -> np.ndarray:
    """Counts of rows that end in (slots, values)."""
    counts = np.zeros((len(rows), dimensions), np.float32)
    for own, row in zip(counts, rows):
        own[np.frombuffer(row[-2], "<u4")] = np.frombuffer(row[-1], "<f4")
    return counts


def fit_vectors(
    rows: list[tuple[str, int, int, bool, bytes, bytes]], centroids: int = CENTROIDS, dimensions: int = DIMENSIONS, slack: float = SLACK
) -> Model:
    """Model of (language, fold, length, whole, slots, values), as from `pieces`; equal rows count once."""
    rows = sorted(set(rows))
    whole = [r for r in rows if r[3]]
    languages = sorted({r[0] for r in whole})
    if not whole:
        return Model([], np.empty(0, int), np.empty((0, dimensions), np.float32), np.ones(dimensions, np.float32), np.zeros(8))
    counts = dense(whole, dimensions)
    idf = (np.log((1 + len(whole)) / (1 + (counts > 0).sum(axis=0))) + 0.05).astype(np.float32)
    points = unit(counts * idf)
    labels = np.array([languages.index(r[0]) for r in whole])
    found = [cluster(points[labels == k], centroids) for k in range(len(languages))]
    owner = np.repeat(np.arange(len(found)), [len(f) for f in found])
    centres = np.concatenate(found).astype(np.float32)
    return Model(languages, owner, centres, idf, slack * usual_least(rows, points, labels, idf, languages, centroids))


def usual_least(rows: list[tuple], points: np.ndarray, labels: np.ndarray, idf: np.ndarray, languages: list[str], centroids: int) -> np.ndarray:
    """Per length class the similarity that all but QUANTILE of the measured pieces reach, not falling with length.

    A piece is measured against centroids of the other folds; where they hold no text of its language it
    is not. Without a measured piece of some class the next longer one counts, without any, 0.
    """
    folds = np.array([r[1] for r in rows if r[3]])
    near: list[list[float]] = [[] for _ in range(8)]
    for fold in range(FOLDS):
        known = [k for k in range(len(languages)) if ((folds != fold) & (labels == k)).any()]
        tested = [r for r in rows if r[1] == fold and languages.index(r[0]) in known]
        if not tested:
            continue
        centres = np.concatenate([cluster(points[(folds != fold) & (labels == k)], centroids) for k in known])
        for i in range(0, len(tested), 512):
            part = tested[i : i + 512]
            best = (unit(dense(part, len(idf)) * idf) @ centres.T).max(axis=1)
            for row, similarity in zip(part, best):
                near[length_class(row[2])].append(float(similarity))
    own = np.array([np.quantile(n, QUANTILE) if n else np.inf for n in near])
    least = np.minimum.accumulate(own[::-1])[::-1]
    # classes longer than all that was measured: as the longest measured one
    longest = own[np.isfinite(own)][-1:]
    return np.where(np.isfinite(least), least, longest[0] if len(longest) else 0.0)


def learn(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, dimensions: int = DIMENSIONS, **options) -> Model:
    """Fit on about `sample_rows` rows per language of (doc_id, text, lang), spread by a hash of the id.

    Rows per language are counted over the whole table; languages with fewer rows are taken whole. Only
    the n-grams of the sampled rows and of up to seven stretches of each reach the driver, at most eight
    bytes a dimension and row, however long the texts are. Rows without a text or language teach nothing.
    """
    known = labelled.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = known.groupBy("lang").count().collect()
    if not sizes:
        return fit_vectors([], dimensions=dimensions, **options)
    # the hash is uniform over 2^31, so a language's threshold sets how many of its rows are taken
    share = {r["lang"]: min(1.0, sample_rows / r["count"]) for r in sizes}
    shares = F.create_map(*[F.lit(x) for lang, part in sorted(share.items()) for x in (lang, int((1 << 31) * part))])
    spread = F.abs(F.xxhash64(F.col("doc_id").cast("string"), F.lit(5))) % F.lit(1 << 31)
    sample = known.filter(spread < F.element_at(shares, F.col("lang"))).select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [(lang, t) for lang, t in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()) if has_letter(t)]
            found = [(lang, *piece) for lang, t in own for piece in pieces(t, dimensions)]
            kinds = {"lang": pa.string(), "fold": pa.int32(), "n": pa.int64(), "whole": pa.bool_(), "slots": pa.binary(), "counts": pa.binary()}
            yield record_batch(**{name: ([f[k] for f in found], kind) for k, (name, kind) in enumerate(kinds.items())})

    prepare(labelled.sparkSession)
    found = arrow_map(sample, count, "lang string, fold int, n long, whole boolean, slots binary, counts binary")
    rows = [(*r[:4], bytes(r["slots"]), bytes(r["counts"])) for r in found.toLocalIterator()]
    return fit_vectors(rows, dimensions=dimensions, **options)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, rejected of every row; only the text is looked at.

    A null text or one without a letter gets `und`, score 0 and is rejected. Repeated rows get a row
    each; other columns are not read.
    """
    shared = prepare(docs.sparkSession).sparkContext.broadcast(model)

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores, rejected = shared.value.predict(batch.column("text").to_pylist())
            yield record_batch(
                doc_id=(batch.column("doc_id"), None), lang_pred=(names, pa.string()), score=(scores, pa.float64()), rejected=(rejected, pa.bool_())
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", F.col("text").cast("string").alias("text")), classify, f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def accepted_rows(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs`, all columns as they are, whose language the model does not reject."""
    shared = prepare(docs.sparkSession).sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rejected = shared.value.predict(batch.column(at).to_pylist())[2]
            yield batch.filter(pa.array([not r for r in rejected], pa.bool_()))

    return arrow_map(docs, keep, docs.schema)
