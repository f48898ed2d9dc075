"""Hidden Markov scoring: recursions against sums over all paths, counts and scores against a plain model."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerloom.llm import hidden_markov as hm


def small_model(states, symbols, seed=0):
    rng = np.random.default_rng(seed)
    one = lambda *shape: rng.dirichlet(np.ones(shape[-1]), shape[:-1])
    return hm.Model(one(states), one(states, states), one(states, symbols).T)


def paths(model, text):
    """Probability of every way through the states."""
    for way in itertools.product(range(len(model.start)), repeat=len(text)):
        p = model.start[way[0]] * model.emit[text[0], way[0]]
        for a, b, s in zip(way, way[1:], text[1:]):
            p *= model.move[a, b] * model.emit[s, b]
        yield way, p


def test_recursions_against_all_paths():
    model = small_model(3, 4)
    rng = random.Random(1)
    texts = [[rng.randrange(4) for _ in range(n)] for n in (1, 5, 2, 6, 1, 3)]
    flat, lengths = np.array(sum(texts, [])), np.array([len(t) for t in texts])
    got = hm.log10_likelihood(model, flat, lengths)
    assert np.allclose(got, [math.log10(sum(p for _, p in paths(model, t))) for t in texts])
    start, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((4, 3))
    for t in texts:
        total = sum(p for _, p in paths(model, t))
        for way, p in paths(model, t):
            start[way[0]] += p / total
            for a, b in zip(way, way[1:]):
                move[a, b] += p / total
            for s, k in zip(t, way):
                emit[s, k] += p / total
    for a, b in zip(hm.expected_counts(model, flat, lengths), (start, move, emit)):
        assert np.allclose(a, b)


def test_rounds_raise_the_likelihood():
    true = small_model(2, 6, seed=3)
    rng = np.random.default_rng(4)
    texts = []
    for _ in range(60):
        k, text = rng.choice(2, p=true.start), []
        for _ in range(30):
            text.append(rng.choice(6, p=true.emit[:, k]))
            k = rng.choice(2, p=true.move[k])
        texts.append(text)
    flat, lengths = np.array(texts).ravel(), np.full(60, 30)
    model, last = small_model(2, 6, seed=9), -np.inf
    for _ in range(8):
        now = hm.log10_likelihood(model, flat, lengths).sum()
        assert now >= last
        last = now
        start, move, emit = hm.expected_counts(model, flat, lengths)
        model = hm.Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def test_a_long_text_does_not_underflow():
    model = small_model(4, 5)
    text = np.random.default_rng(0).integers(0, 5, 50_000)
    got = hm.log10_likelihood(model, text, np.array([len(text)]))[0]
    alpha, total = model.start * model.emit[text[0]], 0.0
    for s in text[1:]:
        total += math.log10(alpha.sum())
        alpha = (alpha / alpha.sum()) @ model.move * model.emit[s]
    assert got == pytest.approx(total + math.log10(alpha.sum()), abs=1e-6)


def corpus():
    rng = random.Random(6)
    languages = [["The", "cat", "sat", "on", "mat,"], ["der", "Hund", "läuft", "über", "das"]]
    rows = []
    for i in range(260):
        own = rng.choice(languages)
        text = [rng.choice(own) for _ in range(rng.randint(0, 40))] + [f"Rare{rng.randrange(400)}ung"] * rng.randint(0, 2)
        rows.append((i, rng.choice([" ", "\n", "\x0b", "  "]).join(text)))
    return rows + [(None, "the cat"), (500, None), (501, ""), (502, "x" * 300), (503, "x" * 300), (7, rows[7][1]), (7, rows[7][1])]


def held(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 7 == 2


def tokens(text):
    return (text or "").encode().lower().split() + [b""]


@pytest.mark.parametrize("symbols,dictionary", [(20_000, 200_000), (5, 8)])
def test_scores_against_a_plain_model(spark, documents_of, monkeypatch, symbols, dictionary):
    monkeypatch.setattr(hm, "SYMBOLS", symbols)
    monkeypatch.setattr(hm, "DICTIONARY", dictionary)
    rows = corpus()
    docs = documents_of(rows).select("*", hm.held_out_key().alias("held_out"))
    lexicon, model = hm.learn(docs.filter("not held_out"), 3, (0.5, 1))
    got = sorted(map(tuple, hm.score(docs, lexicon, model).collect()), key=repr)
    c = Counter(w for d, t in rows if not held(d) for w in tokens(t))
    N, V = sum(c.values()), len(c)
    names = sorted((w for w in c if w and len(w) <= 64), key=lambda w: (-c[w], w))[:dictionary]
    own = [b"", *names][:symbols]
    number = {w: i for i, w in enumerate(own)}
    classes = {}
    for w in c:
        if w not in number:
            classes.setdefault(hm.class_of(w), []).append(c[w])
    want = []
    for d, t in rows:
        text = tokens(t)
        symbol = [number.get(w, len(own) + hm.class_of(w)) for w in text]
        alpha, total = model.start, 0.0
        for i, (s, w) in enumerate(zip(symbol, text)):
            alpha = (alpha if i == 0 else alpha @ model.move) * model.emit[s]
            total += math.log10(alpha.sum())
            alpha = alpha / alpha.sum()
            if w not in number:
                in_class = classes.get(hm.class_of(w), [])
                total += math.log10((c[w] + 1) / (sum(in_class) + len(in_class) + 1))
        base = sum(math.log10((c[w] + 1) / (N + V + 1)) for w in text)
        want.append((d, held(d), len(text), sum(c[w] > 0 for w in text), N, base, total))
    want.sort(key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], atol=1e-8)


def test_every_state_and_class_sums_to_one(spark, documents_of, monkeypatch):
    monkeypatch.setattr(hm, "SYMBOLS", 6)
    lexicon, model = hm.learn(documents_of(corpus()), 3, (1,))
    assert np.allclose(model.emit.sum(axis=0), 1) and np.allclose(model.move.sum(axis=1), 1)
    assert lexicon.symbol_counts.sum() == lexicon.train_tokens
    counts = {bytes(r["word"]): r["c"] for r in lexicon.counts.collect()}
    for k in range(hm.CLASSES):
        own = [c for w, c in counts.items() if hm.class_of(w) == k and lexicon.ids.get(w, 9) >= 6]
        assert 10 ** lexicon.class_log[k] == pytest.approx(sum(own) + len(own) + 1)


def test_states_beat_the_base_on_held_out_texts(spark, documents_of):
    scores = hm.learn_and_score(documents_of(corpus()), 4).filter("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert scores["sum(score)"] > scores["sum(base_score)"]


def test_nothing_to_learn_from(spark, documents_of):
    assert hm.learn_and_score(documents_of([])).collect() == []
    only = next(i for i in range(100) if held(i))
    row = hm.learn_and_score(documents_of([(only, "a b")])).collect()[0]
    assert (row["held_out"], row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"]) == (True, 3, 0, 0, 0.0)
    assert math.isfinite(row["score"]) and row["score"] <= 0


def test_partial_rounds_read_every_text_once(spark, documents_of, monkeypatch):
    seen, one_round = [], hm.baum_welch_round

    def noted(docs, *rest):
        seen.append(Counter(r["doc_id"] for r in docs.select("doc_id").collect()))
        return one_round(docs, *rest)

    monkeypatch.setattr(hm, "baum_welch_round", noted)
    hm.learn(documents_of(corpus()), 2)
    every = Counter(i for i, _ in corpus())
    assert seen[-1] == every
    assert sum(seen[:-1], Counter()) == every
