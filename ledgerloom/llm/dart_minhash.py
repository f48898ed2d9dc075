"""Near-duplicate documents by DartMinHash.

Each distinct shingle (five words in a row) is an element with a weight. Hashed darts are thrown at its
region: they arrive at times that form a Poisson process with the region's weight as rate, from random
numbers that depend only on the element and the dart, so all documents see the same darts. A dart
belongs to one of `coordinates` coordinates; a document keeps the earliest dart of each. Two documents
keep the same dart at a coordinate with a probability that is their (weighted) Jaccard similarity.
Only darts up to a time are thrown, about as many in all as the coordinates need, so the cost does not
grow with shingles times coordinates; the time is doubled while a coordinate is empty.

Coordinates are banded: 32 bands of 6 miss a pair of similarity 0.8 with a probability of 6e-5.
Documents with the same word sequence are one class from the start. Classes that share a band are
linked to the smallest of the band first, and the linked ones become components. Bands that still hold
several components are compared in full, but no pairs are listed for it: a band's classes are dealt to
blocks, each two blocks meet in one task, and only pairs between components whose long signatures
agree enough come out, once, in the first band they share. Pairs are decided by their similarity over exact
shingle sets, except where the estimate is further than four deviations from the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import RowIds, arrow_map, record_batch, text_or_empty
from ledgerloom.llm.components import components
from ledgerloom.session import materialise

WORDS = 5
SIMILARITY = 0.8
BANDS = 32
BAND_ROWS = 6
#: Coordinates of the long signature, whose low bytes estimate the similarity of candidates.
LONG = 1024
#: Classes of a band in a block, about.
BLOCK = 1024
#: Deviations of the estimate from the threshold beyond which it decides alone.
SURE = 4.0
#: Words that a worker remembers the hash of.
MEMORY_WORDS = 300_000

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_S33 = np.uint64(33)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of uint64 values."""
    x = (x ^ (x >> _S33)) * _M1
    x = (x ^ (x >> _S33)) * _M2
    return x ^ (x >> _S33)


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= MEMORY_WORDS:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(word) <= 64:
            self[word] = value
        return value


_words = _WordHashes()


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the lower-case words of a text, in order."""
    words = text.lower().split()
    return np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))


def shingles(words: np.ndarray, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted, with counts; fewer words than n make one shingle."""
    if not len(words):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    n = min(n, len(words))
    out = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        out = mix(out * _GOLD + words[k : len(words) - n + 1 + k])
    return np.unique(out, return_counts=True)


def throw(elements: np.ndarray, rates: np.ndarray, time: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(names, arrival times, places of their elements) of the darts that hit each element's region up to `time`.

    The n-th dart of an element follows the one before after an exponential waiting time.
    """
    names, times, places = [], [], []
    live, clock, rate, place = elements, np.zeros(len(elements)), rates, np.arange(len(elements))
    n = 0
    # the longest region first decides how many waiting times are drawn at once
    width = int(min(4096, max(1, 1.2 * time * rates.max() + 4))) if len(elements) else 1
    if time * rates.max(initial=0) < 4:
        width = 1
    while len(live):
        steps = np.arange(n + 1, n + width + 1, dtype=np.uint64)
        name = mix(live[:, None] + _GOLD * steps)
        uniform = ((mix(name ^ _M1) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        if width == 1:  # most elements of a long text get no dart: no logarithm for them
            hit = np.flatnonzero(uniform[:, 0] > np.exp(-(time - clock) * rate))
            live, clock, rate, place, name, uniform = live[hit], clock[hit], rate[hit], place[hit], name[hit], uniform[hit]
        arrivals = clock[:, None] - np.cumsum(np.log(uniform), axis=1) / rate[:, None]
        inside = arrivals <= time
        names.append(name[inside])
        times.append(arrivals[inside])
        places.append(np.repeat(place, inside.sum(axis=1)))
        more = inside[:, -1]
        live, clock, rate, place = live[more], arrivals[more, -1], rate[more], place[more]
        n += width
    if not names:
        return np.empty(0, np.uint64), np.empty(0), np.empty(0, np.int64)
    return np.concatenate(names), np.concatenate(times), np.concatenate(places)


def weighted_regions(elements: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(names, heights, covered heights) of the slabs [0,1), [1,2), [2,4), ... below each weight.

    A slab's darts are the same for all weights; a weight inside a slab keeps those below it.
    """
    names, heights, covered = [elements], [np.ones(len(elements))], [np.minimum(weights, 1.0)]
    low, height = 1.0, 1.0
    while (weights > low).any():
        on = weights > low
        names.append(mix(elements[on] ^ np.uint64(int(low) * int(_M2) % 2**64)))
        heights.append(np.full(int(on.sum()), height))
        covered.append(np.minimum(weights[on] - low, height))
        low, height = low + height, 2 * height
    return np.concatenate(names), np.concatenate(heights), np.concatenate(covered)


def signature(elements: np.ndarray, weights: np.ndarray | None, coordinates: int) -> np.ndarray:
    """The earliest dart of each coordinate. Weights None: all 1 (plain Jaccard)."""
    if weights is None:
        names, heights, covered = elements, np.ones(len(elements)), None
    else:
        names, heights, covered = weighted_regions(elements, weights.astype(np.float64))
    total = float(len(elements) if covered is None else covered.sum())
    time = coordinates * (np.log(coordinates) + 2) / total
    while True:
        darts, times = throw(names, heights, time)[:2] if covered is None else _below(names, heights, covered, time)
        order = np.argsort(-times, kind="stable")
        spot = ((mix(darts[order] ^ _GOLD) >> np.uint64(32)) * np.uint64(coordinates)) >> np.uint64(32)
        out = np.zeros(coordinates, np.uint64)
        filled = np.zeros(coordinates, bool)
        out[spot] = darts[order]
        filled[spot] = True
        if filled.all():
            return out
        time *= 2


def _below(names: np.ndarray, heights: np.ndarray, covered: np.ndarray, time: float) -> tuple[np.ndarray, np.ndarray]:
    """Darts of each slab that land below the weight; slabs of one height are thrown at together."""
    found = []
    for height in np.unique(heights):
        at = heights == height
        darts, times, places = throw(names[at], heights[at], time)
        if height > 1 or (covered[at] < 1).any():
            level = (mix(darts ^ _M2) >> np.uint64(11)).astype(np.float64) * 2.0**-53 * height
            under = level < covered[at][places]
            darts, times = darts[under], times[under]
        found.append((darts, times))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One hash per band, over its coordinates and its number."""
    grid = sig.reshape(bands, rows)
    out = mix(np.arange(1, bands + 1, dtype=np.uint64) * _GOLD)
    for k in range(rows):
        out = mix(out * _GOLD + grid[:, k])
    return out


def sketches(docs: DataFrame, bands: int, rows: int, weighting: str) -> DataFrame:
    """Per row: uid, doc_id, text_hash, key (of its word sequence), and its band keys if it is the first
    row of a key in a task."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, seen = RowIds(), set()
        for batch in batches:
            keys, found = [], []
            for text in batch.column("text").to_pylist():
                words = word_hashes(text)
                key = xxhash.xxh3_128_digest(words.tobytes()) if len(words) else None
                keys.append(key)
                if key is None or key in seen:
                    found.append(None)
                    continue
                if len(seen) > 500_000:  # a key met again later only sends its sketch once more
                    seen.clear()
                seen.add(key)
                elements, counts = shingles(words)
                sig = signature(elements, counts if weighting == "count" else None, bands * rows)
                found.append(band_keys(sig, bands, rows).view(np.int64).tolist())
            yield record_batch(
                uid=(list(ids.take(len(keys))), pa.int64()),
                doc_id=(batch.column("doc_id"), None),
                text_hash=(batch.column("text_hash"), None),
                key=(keys, pa.binary()),
                bands=(found, pa.list_(pa.int64())),
            )

    source = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), text_or_empty().alias("text"))
    schema = f"uid long, doc_id {kind}, text_hash long, key binary, bands array<long>"
    return arrow_map(source, sketch, schema)


def _verdicts(x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(may reach the threshold, surely does) of long signatures, row by row."""
    spread = SURE * (threshold * (1 - threshold) / LONG) ** 0.5
    # low bytes also agree by chance
    near = ((x == y).mean(axis=-1) - 1 / 256) / (1 - 1 / 256)
    return near > threshold - spread, near > threshold + spread


def _long(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), LONG)


def _estimated(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) that may reach the threshold; `sure` where the estimate leaves no doubt."""

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            may, sure = _verdicts(_long(batch.column("long_a")), _long(batch.column("long_b")), threshold)
            out = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(sure)], names=["a", "b", "sure"])
            yield out.filter(pa.array(may))

    both = pairs.join(sets.select(F.col("uid").alias("a"), F.col("long").alias("long_a")), "a").join(
        sets.select(F.col("uid").alias("b"), F.col("long").alias("long_b")), "b"
    )
    return arrow_map(both.select("a", "b", "long_a", "long_b"), estimate, "a long, b long, sure boolean")


def _across(placed: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs as from `_estimated`, between components of the same band, for placed (band, n, rep, component, bands).

    A band of n classes has n / BLOCK blocks; a class goes to each task that compares its block with
    another, so rows grow as n times blocks, and comparing is array work on two blocks.
    """
    blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    own = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    dealt = placed.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select("band", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "rep", "component", "bands")
    dealt = dealt.join(sets.select(F.col("uid").alias("rep"), "long"), "rep")
    columns = ("band", "lo", "hi", "own", "rep", "component", "bands", "long")
    dealt = dealt.select(*columns).repartition("band", "lo", "hi").sortWithinPartitions("band", "lo", "hi", "rep")

    def compare(key: tuple, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        band, lo, hi = key
        kinds = (np.int32, np.int64, np.int64)
        own, reps, parts = (np.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds))
        bands = np.array([r[3] for r in rows], np.int64)
        low = np.frombuffer(b"".join(r[4] for r in rows), np.uint8).reshape(len(rows), LONG)
        for i in np.flatnonzero(own == lo):
            others = (own == hi) & (parts != parts[i])
            if lo == hi:
                others[: i + 1] = False
            others = np.flatnonzero(others)
            if not len(others):
                continue
            may, sure = _verdicts(low[others], low[i], threshold)
            others, sure = others[may], sure[may]
            # the first band that the two share reports them
            first = (bands[others] == bands[i]).argmax(axis=1)
            here = bands[i][first] == band
            others, sure = others[here], sure[here]
            if len(others):
                a, b = np.maximum(reps[others], reps[i]), np.minimum(reps[others], reps[i])
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(sure)], names=["a", "b", "sure"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in columns)):
                if row[:3] != key:
                    if len(rows) > 1:
                        yield from compare(key, rows)
                    key, rows = row[:3], []
                rows.append(row[3:])
        if len(rows) > 1:
            yield from compare(key, rows)

    return arrow_map(dealt, walk, "a long, b long, sure boolean")


def _shingle_sets(docs: DataFrame, nodes: DataFrame, weighting: str) -> DataFrame:
    """uid, elements (sorted shingle hashes as bytes), counts and long signature of nodes (uid, doc_id, text_hash)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(word_hashes(t)) for t in batch.column("text").to_pylist()]
            sigs = [signature(e, c if weighting == "count" else None, LONG) for e, c in sets]
            yield record_batch(
                uid=(batch.column("uid"), None),
                elements=([e.tobytes() for e, _ in sets], pa.binary()),
                counts=([c.astype("<u4").tobytes() for _, c in sets], pa.binary()),
                long=([(s & np.uint64(255)).astype(np.uint8).tobytes() for s in sigs], pa.binary()),
            )

    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), text_or_empty().alias("text"))
    own = texts.join(nodes, texts["doc_id"].eqNullSafe(nodes["doc_id"]) & (texts["text_hash"] == nodes["text_hash"]))
    return arrow_map(own.select("uid", "text"), cut, "uid long, elements binary, counts binary, long binary")


def _similar(pairs: DataFrame, sets: DataFrame, threshold: float, weighting: str) -> DataFrame:
    """Pairs whose exact similarity reaches the threshold."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for ea, ca, eb, cb in zip(*(batch.column(c).to_pylist() for c in ("ea", "ca", "eb", "cb"))):
                x, y = np.frombuffer(ea, np.uint64), np.frombuffer(eb, np.uint64)
                _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
                if weighting == "count":
                    p, q = np.frombuffer(ca, "<u4").astype(np.int64), np.frombuffer(cb, "<u4").astype(np.int64)
                    common = int(np.minimum(p[i], q[j]).sum())
                    union = int(p.sum() + q.sum()) - common
                else:
                    common, union = len(i), len(x) + len(y) - len(i)
                keep.append(common >= threshold * union - 1e-9)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("uid").alias("a"), F.col("elements").alias("ea"), F.col("counts").alias("ca"))
    right = sets.select(F.col("uid").alias("b"), F.col("elements").alias("eb"), F.col("counts").alias("cb"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "ea", "ca", "eb", "cb")
    return arrow_map(both, compare, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    band_rows: int = BAND_ROWS,
    weighting: str = "count",
) -> DataFrame:
    """doc_id, text_hash, class_id, class_size, kept of every row.

    Rows are in one class if a chain of pairs of the given similarity (Jaccard over shingles of five
    lower-case words, weighted by their counts, or not with weighting="set") joins them; class_id is the smallest
    doc_id of the class, and the one row that is kept has it (of rows repeated as a whole, one). A text
    of fewer than five words is one shingle. A null text or one without words is alone in its class.
    A null doc_id sorts last. Other columns are not read.
    """
    rows = materialise(sketches(docs, bands, band_rows, weighting), "sketches")
    with_words = rows.filter(F.col("key").isNotNull())
    classes = with_words.groupBy("key").agg(
        F.min("uid").alias("rep"), F.min_by(F.struct("doc_id", "text_hash", "bands"), "uid").alias("first")
    )
    classes = materialise(classes.select("key", "rep", "first.*"), "classes")

    banded = classes.select("rep", F.explode("bands").alias("band"))
    # written down, as `mixed` below, so that the join with it may split a large band
    shared = materialise(banded.groupBy("band").agg(F.count("*").alias("n"), F.min("rep").alias("least")).filter("n > 1"), "shared")
    members = materialise(banded.join(shared, "band"), "bands")
    names = classes.select(F.col("rep").alias("uid"), "doc_id", "text_hash")
    nodes = names.join(members.select(F.col("rep").alias("uid")).distinct(), "uid", "left_semi")
    sets = materialise(_shingle_sets(docs, nodes, weighting).dropDuplicates(["uid"]), "shingles")

    def linked(near: DataFrame) -> DataFrame:
        doubt = near.filter(~F.col("sure")).select("a", "b")
        return near.filter("sure").select("a", "b").union(_similar(doubt, sets, similarity, weighting)).toDF("u", "v")

    stars = members.filter("rep <> least").select(F.col("rep").alias("a"), F.col("least").alias("b")).distinct()
    links = materialise(linked(materialise(_estimated(stars, sets, similarity), "near")), "stars")
    parts = materialise(components(links), "components")

    placed = members.join(parts.withColumnRenamed("node", "rep"), "rep", "left").select(
        "band", "n", "rep", F.coalesce("component", "rep").alias("component")
    )
    mixed = placed.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi")
    mixed = materialise(mixed.select("band"), "mixed")
    placed = placed.join(mixed, "band", "left_semi").join(classes.select("rep", "bands"), "rep")
    more = materialise(linked(materialise(_across(placed, sets, similarity), "across")), "more")
    if not more.isEmpty():
        parts = components(links.unionByName(more))

    by_key = classes.select("key", "rep").join(parts.withColumnRenamed("node", "rep"), "rep", "left")
    by_key = by_key.select("key", F.coalesce("component", "rep").alias("component"))
    named = rows.select("uid", "doc_id", "text_hash", "key").join(by_key, "key", "left")
    named = materialise(named.select("uid", "doc_id", "text_hash", F.coalesce("component", "uid").alias("component")), "classes of rows")
    best = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")
    # written down, so that the join with it may split a large class
    heads = materialise(named.groupBy("component").agg(F.count("*").alias("class_size"), F.min(best).alias("best")), "heads")
    return named.join(heads, "component").select(
        "doc_id", "text_hash", F.col("best.doc_id").alias("class_id"), "class_size", (F.col("uid") == F.col("best.uid")).alias("kept")
    )


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs`, all columns as they are, that `near_duplicates` keeps.

    Rows are told apart by doc_id and text; rows repeated as a whole stay or go together.
    """
    found = near_duplicates(docs.select("doc_id", "text"), **options).filter("kept").select("doc_id", "text_hash").distinct()
    key: Column = docs["doc_id"].eqNullSafe(found["doc_id"]) & (F.xxhash64(docs["text"]) == found["text_hash"])
    return docs.join(found, key, "left_semi")
