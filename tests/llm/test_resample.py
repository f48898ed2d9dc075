"""Importance resampling: features against brute force, the whole draw against a plain model."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import resample

WORD = re.compile(resample.WORD)


def lowered(text):
    return (text or "").encode().lower()


def features(text):
    words = WORD.findall(lowered(text).decode())
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def buckets(text):
    return sorted(zlib.crc32(f.encode()) % resample.BUCKETS for f in features(text)[1])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abZ09 _\n,é日😀{\x00", max_size=60), min_size=1, max_size=5))
def test_buckets(texts):
    memory = resample.Windows(resample.BUCKETS)
    for _ in range(2):  # the second time from memory
        owner, found, words = memory.buckets_of([lowered(t) for t in texts])
        assert words.tolist() == [len(features(t)[0]) for t in texts]
        assert [sorted(found[owner == i].tolist()) for i in range(len(texts))] == [buckets(t) for t in texts]


def test_offsets_are_those_of_the_words():
    text = lowered("One, two\nÜber_three 日本😀 x").decode()
    assert resample.words_with_offsets(text) == [(m.group(), m.span()) for m in WORD.finditer(text)]


def test_long_words_chunks_and_a_full_memory(monkeypatch):
    rng = random.Random(1)
    texts = ["w" * 500 + " a " + "é" * 100, "x-" * 9000 + "y" * 9000 + " z", "v" * 100_000]
    texts += [" ".join(rng.choice("abc") * rng.randint(1, 90) for _ in range(200)) for _ in range(5)]
    memory = resample.Windows(resample.BUCKETS)
    monkeypatch.setattr(resample, "MEMORY_CHUNKS", 10)
    for t in texts * 2:
        _, found, _ = memory.buckets_of([lowered(t)])
        assert sorted(found.tolist()) == buckets(t)


def brute(docs, target):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(buckets(text))
    for text in target:
        t.update(buckets(text))
    S, T, B = sum(s.values()), sum(t.values()), resample.BUCKETS
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + B) / ((s[b] + 1) * (T + B))))
    rows = []
    for k, (doc_id, text) in enumerate(docs):
        own = buckets(text)
        weight = sum(map(gain, own)) // len(own) if own else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(own), weight, score, None, len(features(text)[0])])
    eligible = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for i, r in enumerate(eligible[: 25 * len(eligible) // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def run(spark, documents_of, docs, target):
    aim = spark.createDataFrame([(t, 1) for t in target], "text string, uid int")
    return sorted(map(tuple, resample.resample(documents_of(docs), aim).collect()), key=repr)


def test_draw_against_brute_force(spark, documents_of):
    rng = random.Random(2)
    vocabulary = ["alpha", "Beta", "gamma", "délta", "x1", "日本", "the", "of"]
    text = lambda: " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60)))
    docs = [(i, text()) for i in range(300)]
    docs += [(1000 + i // 4, "same words again " * 10) for i in range(80)]
    docs += [(None, "word " * 40), (2000, None), (2001, ""), (2002, ",;"), (2003, "big " * 100_000)]
    target = ["gamma délta gamma", None, "", "the of x1"]
    assert run(spark, documents_of, docs, target) == brute(docs, target)


def test_empty_tables(spark, documents_of):
    assert run(spark, documents_of, [], []) == []
    docs = [(1, "word " * 30), (2, None)]
    assert run(spark, documents_of, docs, []) == brute(docs, [])
    assert run(spark, documents_of, [], ["a b"]) == []


def test_tables_shift_sums():
    table = resample._shift_tables()
    for n in (0, 1, 5, 64):
        value = zlib.crc32(b"left ")
        moved = np.uint32(0)
        for k in range(4):
            moved ^= table[n, k, (value >> (8 * k)) & 255]
        assert int(moved) ^ zlib.crc32(b"r" * n) == zlib.crc32(b"left " + b"r" * n)
