"""Language-model scoring with a hidden Markov model, learned by Baum-Welch over the whole corpus.

Tokens are ASCII-lowered words between white space, and one end per text. All training tokens are counted
on Spark. The most frequent words are symbols of the model; every other word falls by its last bytes into one
of a fixed number of classes, which are symbols too, and its share of the class comes from the full counts.
So the probability of a text is that of its symbols, summed over all ways through the latent states, times
the shares of its rarer words: an exact likelihood over all words, known or not.

Baum-Welch: each task runs forward and backward over its texts and adds up the expected counts of starts,
transitions and emissions; Spark sums them over tasks, and the driver turns a table of states times symbols,
whose size is fixed, into the next parameters. The first rounds read one part of the training texts each and add
its counts to those of the parts before, until all texts are in; the last one reads all of them at once. All texts of
a batch step forward together, as one matrix product per place in the text.

Words beyond the dictionary, which grows to a fixed size only, are joined with the table of all counts.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import RowIds, arrow_map, prepare, record_batch
from ledgerloom.session import materialise

STATES = 8
#: Most frequent words with emissions of their own, and classes for all others.
SYMBOLS, CLASSES = 20_000, 4096
#: Most frequent words that tasks know the count of; rarer ones are joined. Words above WORD_BYTES are joined too.
DICTIONARY, WORD_BYTES = 200_000, 64
#: Share of the training texts that each round of Baum-Welch reads: five parts that make up all of them, then all at once.
ROUNDS = (1 / 5, 1 / 5, 1 / 5, 1 / 5, 1 / 5, 1)
#: Numbers that the texts are dealt to; a part of the texts is a range of them.
MARKS = 1 << 20
#: An emission leans on the symbol's overall share as if on this many more tokens.
LEAN = 50.0
#: First guess of the chance to stay in a state.
STAY = 0.9
#: Baum-Welch takes stretches of this many tokens of longer texts as texts of their own.
STRETCH = 4096
#: Tokens that Baum-Welch holds at once, and words that a task counts before it hands them on.
GROUP, FLUSH = 300_000, 500_000
#: Words that are looked up at once.
LOOKED_UP = 100_000
#: The end of a text; no word is empty.
END = b""


def words(text: bytes) -> list[bytes]:
    """Tokens of a text but its end: bytes.lower and bytes.split know ASCII letters and white space only."""
    return text.lower().split()


def class_of(word: bytes) -> int:
    """Class of a word that is no symbol, by its last three bytes."""
    return zlib.crc32(word[-3:]) % CLASSES


def held_out_key(modulus: int = 7, value: int = 2) -> Column:
    """Whether a document is kept from learning; a null doc_id counts as an empty one."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(name.cast("binary")) % modulus == value


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string").cast("binary"), F.lit(b"")).alias("text")


@dataclass(frozen=True)
class Lexicon:
    """What is known of words: `counts` holds all of them on Spark, the rest is of fixed size."""

    counts: DataFrame  # word binary, c long
    train_tokens: int
    distinct: int
    ids: dict[bytes, int]  # dictionary word -> row; the first rows are symbols
    c: np.ndarray  # count of each dictionary word
    symbol_of: np.ndarray  # symbol of each dictionary word
    symbol_counts: np.ndarray  # training tokens of every symbol
    class_log: np.ndarray  # log10 of what a class's words share

    @property
    def symbols(self) -> int:
        return len(self.symbol_counts)


def count_words(docs: DataFrame) -> DataFrame:
    """(word, c) over all texts, with the end of a text as the empty word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def rows() -> pa.RecordBatch:
            return record_batch(word=(list(total), pa.binary()), n=(list(total.values()), pa.int64()))

        for batch in batches:
            for text in batch.column("text").to_pylist():
                total.update(words(text))
                total[END] += 1
                if len(total) > FLUSH:
                    yield rows()
                    total.clear()
        if total:
            yield rows()

    return arrow_map(docs.select(_text()), count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


def learn_lexicon(docs: DataFrame) -> Lexicon:
    counts = materialise(count_words(docs), "word-counts")
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    short = counts.filter(F.octet_length("word") <= WORD_BYTES)
    # the end of a text is always a symbol, whatever its rank
    ends = counts.filter(F.col("word") == F.lit(END)).select("c").first()
    top = (
        short.filter(F.col("word") != F.lit(END)).orderBy(F.desc("c"), "word").limit(DICTIONARY).toArrow()
    )
    names, c = [END, *top.column("word").to_pylist()], [ends["c"] if ends else 0, *top.column("c").to_pylist()]
    known = np.array(c, np.int64)
    own = min(SYMBOLS, len(names))
    symbol_of = np.arange(len(names))
    symbol_of[own:] = [own + class_of(w) for w in names[own:]]
    # classes of all words but the symbols: their tokens and their distinct words, summed on Spark
    head = docs.sparkSession.createDataFrame([(bytearray(w),) for w in names[:own]], "word binary")
    last = F.when(F.octet_length("word") > 3, F.expr("substring(word, -3, 3)")).otherwise(F.col("word"))
    classes = (
        counts.join(F.broadcast(head), "word", "left_anti")
        .groupBy((F.crc32(last) % CLASSES).alias("k"))
        .agg(F.sum("c").alias("n"), F.count("*").alias("v"))
        .collect()
    )
    tokens, distinct = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in classes:
        tokens[r["k"]], distinct[r["k"]] = r["n"], r["v"]
    return Lexicon(
        counts,
        int(total["n"] or 0),
        int(total["v"]),
        {w: i for i, w in enumerate(names)},
        known,
        symbol_of,
        np.concatenate([known[:own], tokens]),
        np.log10(tokens + distinct + 1),
    )


@dataclass(frozen=True)
class Model:
    start: np.ndarray  # states
    move: np.ndarray  # states x states
    emit: np.ndarray  # symbols x states

    @staticmethod
    def first(symbol_counts: np.ndarray, states: int = STATES) -> Model:
        """Every state near the overall shares, shaken by fixed noise so that rounds can pull them apart."""
        noise = np.exp(np.random.default_rng(0).normal(size=(len(symbol_counts), states)))
        emit = (symbol_counts + 1)[:, None] * noise
        move = np.full((states, states), (1 - STAY) / max(states - 1, 1))
        np.fill_diagonal(move, STAY if states > 1 else 1.0)
        return Model(np.full(states, 1 / states), move, emit / emit.sum(axis=0))

    def next(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray, symbol_counts: np.ndarray) -> Model:
        """Parameters from expected counts."""
        share = (symbol_counts + 1) / (symbol_counts + 1).sum()
        emit = emit + LEAN * share[:, None]
        start, move = start + 1.0, move + 1.0
        return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


class Steps:
    """Symbols of several texts laid out by place: all first ones, all second ones, and so on."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray) -> None:
        self.order = np.argsort(-lengths, kind="stable")
        ranked = lengths[self.order]
        longest = int(ranked[0]) if len(ranked) else 0
        # how many texts reach each place; they are the first ones in `order`
        self.active = np.searchsorted(-ranked, -np.arange(longest), side="left")
        self.begin = np.concatenate([[0], np.cumsum(self.active)])
        starts = np.cumsum(lengths) - lengths
        place = np.arange(len(symbols)) - np.repeat(starts, lengths)
        rank = np.empty(len(lengths), np.int64)
        rank[self.order] = np.arange(len(lengths))
        self.text = np.empty(len(symbols), np.int64)
        target = self.begin[place] + np.repeat(rank, lengths)
        self.symbols = np.empty(len(symbols), np.int64)
        self.symbols[target] = symbols
        self.text[target] = np.repeat(np.arange(len(lengths)), lengths)

    def __len__(self) -> int:
        return len(self.active)


def log10_likelihood(model: Model, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Of each text, by the scaled forward recursion; every text has a symbol at least, its end."""
    steps = Steps(symbols, lengths)
    scale = np.empty(len(symbols))
    alpha = np.tile(model.start, (len(lengths), 1))
    for t in range(len(steps)):
        a, b = steps.begin[t], steps.begin[t + 1]
        if t:
            alpha = alpha[: b - a] @ model.move
        alpha = alpha * model.emit[steps.symbols[a:b]]
        total = alpha.sum(axis=1)
        scale[a:b] = total
        alpha /= total[:, None]
    return np.bincount(steps.text, weights=np.log10(scale), minlength=len(lengths))


def expected_counts(model: Model, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected starts, transitions and emissions of these texts under the model."""
    steps, states = Steps(symbols, lengths), len(model.start)
    emit = model.emit[steps.symbols]
    alpha = np.empty_like(emit)
    scale = np.empty(len(symbols))
    before = np.tile(model.start, (len(lengths), 1))
    for t in range(len(steps)):
        a, b = steps.begin[t], steps.begin[t + 1]
        now = before[: b - a] * emit[a:b]
        total = now.sum(axis=1)
        scale[a:b] = total
        now /= total[:, None]
        alpha[a:b] = now
        before = now @ model.move
    moves = np.zeros((states, states))
    beta = np.ones((len(lengths), states))
    for t in range(len(steps) - 1, 0, -1):
        a, b, p = steps.begin[t], steps.begin[t + 1], steps.begin[t - 1]
        ahead = emit[a:b] * beta[: b - a] / scale[a:b, None]
        moves += alpha[p : p + b - a].T @ ahead
        alpha[a:b] *= beta[: b - a]  # now the chance of each state, given the whole text
        beta[: b - a] = ahead @ model.move.T
    if len(steps):
        alpha[: steps.begin[1]] *= beta
    out = np.stack([np.bincount(steps.symbols, alpha[:, k], len(model.emit)) for k in range(states)], axis=1)
    return alpha[: steps.begin[1]].sum(axis=0) if len(steps) else np.zeros(states), moves * model.move, out


def read_tokens(texts: list[bytes], ids: dict[bytes, int], symbol_of: np.ndarray, own: int) -> tuple[np.ndarray, ...]:
    """(dictionary row or -1, symbol) of all tokens of the texts in a row, tokens per text, and the missing words."""
    places, symbols, lengths, missing = [], [], [], []
    held: list[bytes] = []

    def look_up() -> None:
        place = np.fromiter(map(ids.get, held, repeat(-1)), np.int64, len(held))
        symbol = symbol_of[place]
        at = np.flatnonzero(place < 0)
        lost = [held[i] for i in at.tolist()]
        symbol[at] = [own + class_of(w) for w in lost]
        places.append(place)
        symbols.append(symbol)
        missing.extend(lost)
        held.clear()

    for text in texts:
        before = len(held)
        held += words(text)
        held.append(END)
        lengths.append(len(held) - before)
        if len(held) > LOOKED_UP:
            look_up()
    look_up()
    return np.concatenate(places), np.concatenate(symbols), np.array(lengths, np.int64), missing


def baum_welch_round(docs: DataFrame, lexicon, model: Model, symbol_counts: np.ndarray) -> list[np.ndarray]:
    """Expected starts, transitions and emissions over all of `docs`; `lexicon` is a broadcast (ids, symbol_of)."""
    known, states, own = docs.sparkSession.sparkContext.broadcast(model), len(model.start), len(symbol_counts) - CLASSES

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (ids, symbol_of), model = lexicon.value, known.value
        total = None
        for batch in batches:
            _, flat, sizes, _ = read_tokens(batch.column("text").to_pylist(), ids, symbol_of, own)
            lengths = [n for size in sizes.tolist() for n in [STRETCH] * (size // STRETCH) + [size % STRETCH] if n]
            lengths = np.array(lengths, np.int64)
            starts = np.cumsum(lengths) - lengths
            # stretches of like length step together, so that few groups have many places
            order = np.argsort(-lengths, kind="stable")
            group = np.cumsum(lengths[order]) // GROUP
            for part in np.split(order, np.flatnonzero(np.diff(group)) + 1):
                symbols = np.concatenate([flat[starts[i] : starts[i] + lengths[i]] for i in part.tolist()])
                counts = expected_counts(model, symbols, lengths[part])
                total = counts if total is None else [x + y for x, y in zip(total, counts)]
        if total is None:
            return
        start, move, emit = total
        seen = np.flatnonzero(emit.any(axis=1))
        rows = np.concatenate([start[None], move, emit[seen]])
        names = [-1, *range(-2, -2 - states, -1), *seen.tolist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.int32()), *[pa.array(rows[:, k]) for k in range(states)]],
            names=["symbol", *[f"e{k}" for k in range(states)]],
        )

    columns = [f"e{k}" for k in range(states)]
    sums = arrow_map(docs.select(_text()), work, "symbol int, " + ", ".join(f"{c} double" for c in columns))
    table = sums.groupBy("symbol").agg(*[F.sum(c).alias(c) for c in columns]).toArrow()
    known.destroy()
    emit = np.zeros((len(symbol_counts) + states + 1, states))  # negative rows count from the end
    emit[table.column("symbol").to_numpy()] = np.stack([table.column(c).to_numpy() for c in columns], axis=1)
    return [emit[-1], emit[[-2 - k for k in range(states)]], emit[: len(symbol_counts)]]


def learn(docs: DataFrame, states: int = STATES, rounds: tuple[float, ...] = ROUNDS) -> tuple[Lexicon, Model]:
    """Lexicon and model of these texts.

    Rounds with a share below 1 read the texts part by part, by a hash, and the parameters after each come from
    the counts of all parts so far; once all texts are in, or after a round over all of them, the next part is the
    first one again.
    """
    prepare(docs.sparkSession)
    lexicon = learn_lexicon(docs)
    model = Model.first(lexicon.symbol_counts, states)
    shared = docs.sparkSession.sparkContext.broadcast((lexicon.ids, lexicon.symbol_of))
    mark = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.octet_length("text")), F.lit(MARKS))
    read, counts = 0.0, None
    for share in rounds:
        begin, read = round(read * MARKS), read + share
        end = round(read * MARKS)
        if share >= 1 or begin == 0:
            counts = None
        part = docs if share >= 1 else docs.filter((mark >= begin) & (mark < end))
        found = baum_welch_round(part, shared, model, lexicon.symbol_counts)
        counts = found if counts is None else [a + b for a, b in zip(counts, found)]
        model = model.next(*counts, lexicon.symbol_counts)
        if end >= MARKS:
            read = 0.0
    return lexicon, model


def score(docs: DataFrame, lexicon: Lexicon, model: Model) -> DataFrame:
    """doc_id, held_out (as the column of `docs`), n_tokens, n_known, train_tokens, base_score, score.

    base_score adds log10((c + 1) / (N + V + 1)) over the tokens, score is the model's log10 probability.
    """
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast(
        (lexicon.ids, lexicon.c, lexicon.symbol_of, lexicon.symbols - CLASSES, lexicon.class_log, model)
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, c, symbol_of, own, class_log, model = shared.value
        uids, log_c = RowIds(), np.log10(c + 1.0)
        for batch in batches:
            place, symbols, lengths, missing = read_tokens(batch.column("text").to_pylist(), ids, symbol_of, own)
            text = np.repeat(np.arange(len(lengths)), lengths)

            def added(where: np.ndarray, values: np.ndarray, text=text, n=len(lengths)) -> np.ndarray:
                return np.bincount(text[where], weights=values, minlength=n)

            inside, classed = place >= 0, symbols >= own
            n_known = np.bincount(text[inside][c[place[inside]] > 0], minlength=len(lengths))
            base = added(inside, log_c[place[inside]])
            # a word of a class takes its share of it; the counts of the missing ones come later
            both = inside & classed
            shares = added(both, log_c[place[both]]) - added(classed, class_log[symbols[classed] - own])
            others = Counter(zip(text[~inside].tolist(), missing))
            ends = np.concatenate([[0], np.cumsum(np.bincount([t for t, _ in others], minlength=len(lengths)))])
            states = log10_likelihood(model, symbols, lengths)
            lists = pa.array(ends, pa.int32())
            yield record_batch(
                uid=(list(uids.take(len(lengths))), pa.int64()),
                doc_id=(batch.column("doc_id"), None),
                held_out=(batch.column("held_out"), None),
                n_tokens=(lengths.tolist(), pa.int64()),
                n_known=(n_known.tolist(), pa.int64()),
                base=(base.tolist(), pa.float64()),
                score=((states + shares).tolist(), pa.float64()),
                rare=(pa.ListArray.from_arrays(lists, pa.array([w for _, w in others], pa.binary())), None),
                times=(pa.ListArray.from_arrays(lists, pa.array(list(others.values()), pa.int64())), None),
            )

    schema = (
        f"uid long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, score double,"
        " rare array<binary>, times array<long>"
    )
    written = materialise(arrow_map(docs.select("doc_id", "held_out", _text()), work, schema), "forward")
    missing = written.select("uid", F.explode(F.arrays_zip("rare", "times")).alias("r")).select(
        "uid", F.col("r.rare").alias("word"), F.col("r.times").alias("n")
    )
    found = missing.join(lexicon.counts, "word").groupBy("uid").agg(
        F.sum("n").alias("n_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("more")
    )
    narrow = written.select("uid", "doc_id", "held_out", "n_tokens", "n_known", "base", "score")
    both = narrow.withColumn("more", F.lit(0.0)).unionByName(found, allowMissingColumns=True)
    rest = float(np.log10(lexicon.train_tokens + lexicon.distinct + 1.0))
    return (
        both.groupBy("uid")
        .agg(
            # a row of the text itself and at most one of its rarer words
            *[F.max(c).alias(c) for c in ("doc_id", "held_out", "n_tokens", "base", "score")],
            F.sum("n_known").alias("n_known"),
            F.sum("more").alias("more"),
        )
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            "n_known",
            F.lit(lexicon.train_tokens).cast("long").alias("train_tokens"),
            (F.col("base") + F.col("more") - F.col("n_tokens") * rest).alias("base_score"),
            (F.col("score") + F.col("more")).alias("score"),
        )
    )


def learn_and_score(docs: DataFrame, states: int = STATES, rounds: tuple[float, ...] = ROUNDS) -> DataFrame:
    """Scores of all documents by a model of those that are not held out.

    A null or empty text is its end alone; repeated rows count and are scored each; a null doc_id is
    no held-out one. With nothing to learn from, every token is unknown. Other columns are left out.
    """
    marked = docs.select("doc_id", held_out_key().alias("held_out"), "text")
    lexicon, model = learn(marked.filter(~F.col("held_out")), states, rounds)
    return score(marked, lexicon, model)
