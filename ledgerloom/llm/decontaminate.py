"""Benchmark decontamination by CGK embedding and bit sampling.

The CGK random walk reads a string with one pointer: at step t it writes the character under the
pointer and moves on or stays, by a random bit that depends on t and the character. Strings at a small
edit distance get embeddings at a small Hamming distance, because the two walks fall into step again
after an edit. A repetition fixes the random bits and samples positions of the embedding; windows whose
samples agree are candidates.

Windows begin at every word of a document and at every word of a benchmark item, so an item gives as
many chances as it has words, in each of `repetitions` walks; edits near the item's start do not hide
it. The walk is the same for windows of all item sizes as far as it is read here. A short first part
of the samples is looked up in a bitmap and drops most windows; the walk goes on only for the rest.
The walks read about 20 characters, so items with few words or many edits may have no clean window. Items
under PIECES_BELOW characters are also looked up by pigeonhole: cut into one piece more than edits are
allowed, one piece at least stands unchanged in the document, at any place. A candidate fixes which stretch
of the document, as long as the item, to compare; a bound by shared grams, taken for all candidates at once,
rules most of them out, and the smallest edit distance between the item and any part of the stretch decides.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import arrow_map, prepare, record_batch

#: An item is found where a part of a document is at most this share of the item's length away.
MAX_DISTANCE = 0.1
#: Wanted chance to see an item of TYPICAL_CHARS that was edited that much at random places.
RECALL = 0.999
TYPICAL_CHARS = 200
#: Steps of the walk behind the first lookup and behind the whole key, and how many are sampled.
SHORT_STEPS, SHORT_SAMPLES = 16, 8
STEPS, SAMPLES = 40, 16
#: Items with fewer characters are looked up by pieces too, of at most so many characters.
PIECES_BELOW, PIECE = TYPICAL_CHARS, 12
#: From this code on, scripts are written without blanks: every character begins a window.
NO_BLANKS = 0x2E80
#: Characters of benchmark text that one pass over the documents holds in each task.
BLOCK_CHARS = 4 << 20
#: Characters of document text, and windows, that are walked at once.
STRETCH = 1 << 19
WINDOWS = 1 << 16
#: Places whose piece keys are looked up at once, so that they stay in a core's cache.
PLACES = 1 << 14
#: Characters of the grams whose number bounds the edit distance from below, and the slots they are hashed to.
GRAM = 4
_GRAM_BITS = 12
#: Candidates whose grams are compared at once.
CANDIDATES = 256
_SEED = 20_240_601
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _letters() -> np.ndarray:
    """Per code point of the basic plane: its lower-case form if letter or digit, else blank."""
    table = np.full(1 << 16, 32, np.uint32)
    for code in range(1 << 16):
        char = chr(code)
        if char.isalnum():
            low = char.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


_table: np.ndarray | None = None


def normalise(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(characters, their places in the text): lower-case letters and digits, other runs as one blank.

    A blank stands at either end. Characters beyond the basic plane count as letters and stay as they are.
    """
    global _table
    if _table is None:
        _table = _letters()
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    chars = _table[np.minimum(codes, 0xFFFF)]
    beyond = codes > 0xFFFF
    if beyond.any():
        chars[beyond] = codes[beyond]
    chars = np.concatenate([[np.uint32(32)], chars, [np.uint32(32)]])
    keep = np.ones(len(chars), bool)
    keep[1:] = (chars[1:] != 32) | (chars[:-1] != 32)
    return chars[keep], np.flatnonzero(keep) - 1


def word_starts(chars: np.ndarray) -> np.ndarray:
    return np.flatnonzero((chars[1:] != 32) & ((chars[:-1] == 32) | (chars[1:] >= NO_BLANKS))) + 1


def piece_keys(chars: np.ndarray, width: int) -> np.ndarray:
    """A number for the `width` characters from each place on, put together from halves."""
    if len(chars) < width:
        return np.empty(0, np.uint64)
    if width == 1:
        return chars.astype(np.uint64)
    half = width // 2
    key = piece_keys(chars, half)
    n = len(chars) - width + 1
    out = key[:n] * _power(half) + key[half : half + n]
    return out if width == 2 * half else out * _GOLD + chars[width - 1 :]


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_GOLD), n, 1 << 64))


def cut(size: int, allowed: int) -> tuple[list[int], int]:
    """(starts, width) of one piece more than allowed edits."""
    return [size * k // (allowed + 1) for k in range(allowed + 1)], min(PIECE, size // (allowed + 1))


def repetitions(max_distance: float, recall: float) -> int:
    """Walks needed: a window is sure to match where no edit falls among the characters it reads."""
    clean = (1 - max_distance) ** (STEPS / 2)
    windows = (TYPICAL_CHARS - STEPS / 2) / 6
    return max(1, math.ceil(math.log(1 - recall) / (windows * math.log(1 - clean))))


class Walk:
    """One repetition: random bits of the walk and sampled steps."""

    def __init__(self, number: int) -> None:
        rng = np.random.default_rng(_SEED + number)
        self.moves = rng.integers(0, 2, (STEPS, 256), dtype=np.uint8)
        first = rng.choice(SHORT_STEPS, SHORT_SAMPLES, replace=False)
        later = SHORT_STEPS + rng.choice(STEPS - SHORT_STEPS, SAMPLES - SHORT_SAMPLES, replace=False)
        self.sampled = set(first.tolist()) | set(later.tolist())

    def advance(self, symbols: np.ndarray, at: np.ndarray, key: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """Pointers and keys after steps first to last."""
        for t in range(first, last):
            read = np.take(symbols, at, mode="clip")
            if t in self.sampled:
                key = key * _GOLD + read
            at = at + np.take(self.moves[t], read, mode="clip")
        return at, key


def symbols_of(chars: np.ndarray) -> np.ndarray:
    """Eight bits per character, with blanks behind the end for walks that run past it."""
    low = (chars ^ (chars >> np.uint32(8)) ^ (chars >> np.uint32(16))).astype(np.uint8)
    return np.concatenate([low, np.full(STEPS + 1, 32, np.uint8)])


class KeySet:
    """Sorted keys with their targets, behind a bitmap that is as large as their number asks for."""

    def __init__(self, keys: np.ndarray, targets: np.ndarray) -> None:
        order = np.argsort(keys, kind="stable")
        keys, targets = keys[order], targets[order].reshape(-1, 2)
        # every key once, with the row where its targets begin
        self.keys, first = np.unique(keys, return_index=True)
        self.first, self.targets = np.append(first, len(keys)), targets
        self.bitmap = self.bitmap_of(keys)

    @staticmethod
    def bitmap_of(keys: np.ndarray) -> np.ndarray:
        bitmap = np.zeros(1 << max(12, min(22, (64 * len(keys)).bit_length())), bool)
        bitmap[spots(keys, bitmap)] = True
        return bitmap

    def lookup(self, keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, place where it would begin) of all targets that the keys have."""
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = np.flatnonzero(self.keys[at] == keys)
        at = at[hit]
        rows, owner = ranges(self.first[at], self.first[at + 1])
        found = self.targets[rows]
        return found[:, 0], places[hit][owner] - found[:, 1]


def spots(keys: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    return ((keys ^ (keys >> np.uint64(29))) * _GOLD) >> np.uint64(65 - len(bitmap).bit_length())


def ranges(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges in a row, and which range each is from."""
    sizes = last - first
    owner = np.repeat(np.arange(len(first)), sizes)
    return np.arange(int(sizes.sum())) + np.repeat(first - (np.cumsum(sizes) - sizes), sizes), owner


def edit_distance_in(item: np.ndarray, stretch: np.ndarray) -> tuple[int, int]:
    """(smallest edit distance of the item to any part of the stretch, end of that part), bit-parallel."""
    m = len(item)
    places: dict[int, int] = {}
    for i, c in enumerate(item.tolist()):
        places[c] = places.get(c, 0) | (1 << i)
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(stretch.tolist()):
        match = places.get(c, 0)
        zero = (((match & plus) + plus) ^ plus) | match | minus
        up = minus | (full & ~(zero | plus))
        down = plus & zero
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = (up << 1) & full  # any place may be the start
        down = (down << 1) & full
        plus = down | (full & ~(zero | up))
        minus = up & zero
        if score < best:
            best, end = score, j + 1
    return best, end


def _stands_alone(chars: np.ndarray, begin: int, size: int) -> bool:
    """Whether no word goes on over either end; scripts without blanks have no such ends."""
    if begin < 1 or begin + size >= len(chars):
        return False
    pairs = ((chars[begin - 1], chars[begin]), (chars[begin + size - 1], chars[begin + size]))
    return all(32 in pair or max(pair) >= NO_BLANKS for pair in pairs)


class Index:
    """Windows and pieces of a block of benchmark items, by key."""

    def __init__(self, items: list[tuple[object, str]], max_distance: float, walks: int) -> None:
        self.max_distance = max_distance
        self.names, self.items = [], []
        for name, text in items:
            chars = normalise(text)[0][1:-1] if text else np.empty(0, np.uint32)
            if len(chars):
                self.names.append(name)
                self.items.append(chars)
        self.sizes = np.array([len(c) for c in self.items], np.int64)
        self.allowed = (max_distance * self.sizes).astype(np.int64)
        grams = [gram_slots(c) for c in self.items]
        self.gram_ends = np.cumsum([0, *map(len, grams)])
        self.grams = np.concatenate([np.empty(0, np.int64), *grams])
        self.pieces = self._piece_sets()
        self.walks = [Walk(k) for k in range(walks)]
        self.windows: list[tuple[np.ndarray, KeySet]] = []
        for walk in self.walks:
            short, keys, targets = [], [], []
            for n, chars in enumerate(self.items):
                # a walk reads half as many characters as it has steps, on average; pieces see shorter items
                starts = np.concatenate([[0], word_starts(chars)])
                starts = starts[(starts == 0) | (starts <= len(chars) - STEPS // 2)]
                symbols = symbols_of(chars)
                at, key = walk.advance(symbols, starts, np.zeros(len(starts), np.uint64), 0, SHORT_STEPS)
                short.append(key)
                _, key = walk.advance(symbols, at, key, SHORT_STEPS, STEPS)
                keys.append(key)
                targets += [(n, int(s)) for s in starts]
            if keys:
                found = KeySet(np.concatenate(keys), np.array(targets, np.int64))
                self.windows.append((KeySet.bitmap_of(np.concatenate(short)), found))

    def _piece_sets(self) -> list[tuple[int, KeySet]]:
        """One key width, the least of the pieces, serves all but items so short that it would match anything."""
        cuts = {}
        for n in np.flatnonzero(self.sizes < PIECES_BELOW).tolist():
            starts, width = cut(int(self.sizes[n]), int(self.allowed[n]))
            cuts[n] = starts, width
        usual = min((w for _, w in cuts.values() if w >= PIECE // 2), default=0)
        sets: dict[int, list[tuple[int, int, int]]] = {}
        for n, (starts, width) in cuts.items():
            width = usual if width >= PIECE // 2 else width
            for start in starts:
                key = piece_keys(self.items[n][start : start + width], width)
                sets.setdefault(width, []).append((int(key[0]), n, start))
        return [
            (width, KeySet(np.array([k for k, _, _ in own], np.uint64), np.array([x[1:] for x in own], np.int64)))
            for width, own in sorted(sets.items())
        ]

    def candidates(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, place where it would begin) for windows and pieces of the characters that share a key."""
        items, places = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        symbols, all_starts = symbols_of(chars), word_starts(chars)
        for walk, (bitmap, found) in zip(self.walks, self.windows):
            for s in range(0, len(all_starts), WINDOWS):
                starts = all_starts[s : s + WINDOWS]
                at, key = walk.advance(symbols, starts, np.zeros(len(starts), np.uint64), 0, SHORT_STEPS)
                on = np.flatnonzero(bitmap[spots(key, bitmap)])
                _, key = walk.advance(symbols, at[on], key[on], SHORT_STEPS, STEPS)
                n, place = found.lookup(key, starts[on])
                items.append(n)
                places.append(place)
        for width, found in self.pieces:
            for s in range(0, len(chars) - width + 1, PLACES):
                key = piece_keys(chars[s : s + PLACES + width - 1], width)
                on = np.flatnonzero(found.bitmap[spots(key, found.bitmap)])
                n, place = found.lookup(key[on], s + on)
                items.append(n)
                places.append(place)
        return np.concatenate(items), np.concatenate(places)

    def _near(self, n: np.ndarray, lo: np.ndarray, hi: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """Which candidates the grams leave: an edit destroys at most GRAM of an item's grams.

        Grams that share a slot can only make a candidate look nearer.
        """
        out = np.zeros(len(n), bool)
        for s in range(0, len(n), CANDIDATES):
            part = slice(s, s + CANDIDATES)
            there = np.zeros((len(n[part]), 1 << _GRAM_BITS), bool)
            rows, owner = ranges(lo[part], np.maximum(hi[part] - GRAM + 1, lo[part]))
            there[owner, slots[rows]] = True
            rows, owner = ranges(self.gram_ends[n[part]], self.gram_ends[n[part] + 1])
            missing = np.bincount(owner[~there[owner, self.grams[rows]]], minlength=len(there))
            out[part] = missing <= GRAM * self.allowed[n[part]]
        return out

    def matches(self, texts: list[str]) -> list[list[tuple[object, int, int, int]]]:
        """Per text (item name, distance, start, end) of each item it holds, best place each.

        The texts are walked in a row; a blank stands at either end of each.
        """
        normal = [normalise(t) for t in texts]
        begins = np.zeros(len(texts) + 1, np.int64)
        begins[1:] = np.cumsum([len(c) for c, _ in normal])
        chars = np.concatenate([c for c, _ in normal])
        n, begin = self.candidates(chars)
        size, allowed = self.sizes[n], self.allowed[n]
        middle = np.searchsorted(begins, np.clip(begin + size // 2, 0, len(chars) - 1), "right") - 1
        spans = []
        for side in (-1, 0, 1):  # the middle may lie in a neighbour if the item is cut off by the text's end
            doc = middle + side
            inside = (doc >= 0) & (doc < len(texts))
            doc = np.clip(doc, 0, len(texts) - 1)
            lo, hi = np.maximum(begins[doc], begin - 3 * allowed - 1), np.minimum(begins[doc + 1], begin + size + 3 * allowed + 1)
            keep = inside & (hi - lo >= size - allowed)
            spans.append(np.stack([n, doc, begin // (allowed + 1), begin, lo, hi])[:, keep])
        spans = np.concatenate(spans, axis=1)
        # candidates that begin about the same place look at the same stretch; they are tried once
        spans = spans[:, np.lexsort(spans[3::-1])]
        new = np.ones(spans.shape[1], bool)
        new[1:] = (spans[:3, 1:] != spans[:3, :-1]).any(axis=0)
        # where no edit is allowed, every place counts
        spans = spans[:, new | (self.allowed[spans[0]] == 0)]
        if spans.shape[1]:
            spans = spans[:, self._near(spans[0], spans[4], spans[5], gram_slots(chars))]
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for n, d, _, begin, lo, hi in spans.T.tolist():
            size, allowed = int(self.sizes[n]), int(self.allowed[n])
            if best.get((d, n), (1,))[0] == 0 or (not allowed and not _stands_alone(chars, begin, size)):
                continue
            distance, end = edit_distance_in(self.items[n], chars[lo:hi])
            if distance >= best.get((d, n), (allowed + 1,))[0]:
                continue
            end += lo - int(begins[d])
            places = normal[d][1]
            first, last = int(places[max(end - size, 0)]), int(places[max(end - 1, 0)]) + 1
            best[d, n] = (distance, max(0, first), min(last, len(texts[d])))
        out: list[list] = [[] for _ in texts]
        for (d, n), found in sorted(best.items()):
            out[d].append((self.names[n], *found))
        return out


def gram_slots(chars: np.ndarray) -> np.ndarray:
    """Slot of the GRAM characters from each place on."""
    return ((piece_keys(chars, GRAM) * _GOLD) >> np.uint64(64 - _GRAM_BITS)).astype(np.int64)


def batch_matches(index: Index, texts: list[str | None]) -> list[list[tuple[object, int, int, int]]]:
    """`Index.matches` of each text, about STRETCH characters at once."""
    out: list[list] = [[] for _ in texts]
    if not index.items:
        return out
    group: list[int] = []
    size = 0
    for i, text in enumerate(texts):
        if text:
            group.append(i)
            size += len(text)
        if group and (size >= STRETCH or i == len(texts) - 1):
            for k, found in zip(group, index.matches([texts[g] for g in group])):
                out[k] = found
            group, size = [], 0
    return out


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[object, str]]]:
    """Items in blocks of at most BLOCK_CHARS, or of one longer item."""
    block, size = [], 0
    for row in benchmark.select("item_id", F.col("text").cast("string").alias("text")).toLocalIterator():
        text = row["text"] or ""
        if block and size + len(text) > BLOCK_CHARS:
            yield block
            block, size = [], 0
        block.append((row["item_id"], text))
        size += len(text)
    if block:
        yield block


def find_leaks(docs: DataFrame, benchmark: DataFrame, max_distance: float = MAX_DISTANCE, recall: float = RECALL) -> DataFrame:
    """doc_id, item_id, distance, start, end of every item that a row holds, at its best place.

    Distances count characters of the normalised texts (lower-case letters and digits, other runs as
    one blank); start and end are code points of the document, approximate by the distance at the
    start. Null and empty texts hold and match nothing. Items so short that no edit is allowed match only
    where no word goes on over their ends.
    Repeated rows are reported each; several items with the same text likewise. Every block of at most
    BLOCK_CHARS of benchmark text is one pass over the documents.
    """
    spark = prepare(docs.sparkSession)
    kinds = [docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, distance int, start int, end int"
    walks = repetitions(max_distance, recall)
    out = None
    for block in _blocks(benchmark):
        shared = spark.sparkContext.broadcast(Index(block, max_distance, walks))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows, names, found = [], [], []
                for k, own in enumerate(batch_matches(shared.value, batch.column("text").to_pylist())):
                    for name, *rest in own:
                        rows.append(k)
                        names.append(name)
                        found.append(rest)
                yield record_batch(
                    doc_id=(batch.column("doc_id").take(pa.array(rows, pa.int32())), None),
                    item_id=(names, pa.int64() if kinds[1] == "bigint" else None),
                    distance=([f[0] for f in found], pa.int32()),
                    start=([f[1] for f in found], pa.int32()),
                    end=([f[2] for f in found], pa.int32()),
                )

        found = arrow_map(docs.select("doc_id", F.col("text").cast("string").alias("text")), search, schema)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], schema) if out is None else out


def clean_rows(docs: DataFrame, benchmark: DataFrame, max_distance: float = MAX_DISTANCE, recall: float = RECALL) -> DataFrame:
    """The rows of `docs`, all columns as they are, that hold no item (see `find_leaks`)."""
    spark = prepare(docs.sparkSession)
    at, walks = docs.columns.index("text"), repetitions(max_distance, recall)
    for block in _blocks(benchmark):
        shared = spark.sparkContext.broadcast(Index(block, max_distance, walks))

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = batch_matches(shared.value, batch.column(at).to_pylist())
                yield batch.filter(pa.array([not f for f in found], pa.bool_()))

        docs = arrow_map(docs, keep, docs.schema)
    return docs
