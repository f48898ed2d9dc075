import random
import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest

from ledgerloom.llm import packing, pfor, token_counts, tokens

TEXTS = [
    None,
    "",
    " ",
    "\n\n \n",
    "plain words, and more.",
    "two  spaces   three \n line\n\n tab\tend ",
    "don't we'll 'tis it's ''s O'Neil",
    "a <|endoftext|> b<|endoftext|>c  <|endoftext|>\n <|endoftext|>",
    "<|startoftext|> x <|endoftext|>",
    "É́tè café ́mark  nbsp  em \x1csep",
    "漢字 かな 12345 ½ ² Ⅷ x²y",
    "ÄTZ,!! ENCHEN!!%%% *** & &amp; _under_score_",
    "🙂 🙂🙂 emoji퟿x",
    "x" * 3000,
    "ab " * 4000,
    "the cat " * 3000 + "!" * 700 + " end",
]


def library(name):
    return tokens.load(tokens.vocabulary(name))


def random_texts(n, seed):
    rng = random.Random(seed)
    alphabet = ["a", "b", "the", "É", "'s", "1", ".", ",", "!", " ", " ", "  ", "\n", "\t", " ", "<|endoftext|>", "語", "²", "_"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize("name,make", [(tokens.BYTE_BPE, tokens.id_encoder), (tokens.WORD_BPE, tokens.start_encoder)])
def test_words_give_what_the_library_gives(name, make):
    whole, encoder = library(name), make(name)
    for text in [t or "" for t in TEXTS] + random_texts(1500, 7):
        want = whole.encode(text, add_special_tokens=False)
        got = encoder.encode(text)
        if name == tokens.BYTE_BPE:
            assert got == struct.pack(f"<{len(want.ids)}I", *want.ids), repr(text)
        else:
            assert len(got) // 4 == len(want.ids), repr(text)


def test_full_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "MEMORY_WORDS", 8)
    monkeypatch.setattr(tokens, "STRETCH", 16)
    encoder, whole = tokens.WordEncoder(tokens.vocabulary(tokens.BYTE_BPE), True, tokens.pack_ids), library(tokens.BYTE_BPE)
    for text in random_texts(300, 11) + ["one, two, three. four! five? six; seven, eight. nine, ten!" * 3]:
        ids = whole.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == struct.pack(f"<{len(ids)}I", *ids), repr(text)
    assert len(encoder.later) <= 8


def test_stretches_put_together_are_the_text():
    for text in ["a b  c \n d" * 50, "x" * 200, "", " " * 99]:
        assert "".join(tokens.stretches(text, 7)) == text


@pytest.mark.parametrize("chunk,overlap", [(40, 8), (64, 63), (33, 1)])
def test_chunks_count_like_the_whole(chunk, overlap):
    whole, encoder = library(tokens.WORD_BPE), tokens.start_encoder()
    for text in [t or "" for t in TEXTS if len(t or "") < 4000] + random_texts(200, 3) + ["word " * 60 + "y" * 300 + " end of it" * 9]:
        want = len(whole.encode(text, add_special_tokens=False).ids)
        assert token_counts.count_text(encoder, text, chunk, overlap) == want, repr(text)


def test_token_counts(documents_of, spark):
    whole = library(tokens.WORD_BPE)
    rows = list(enumerate(TEXTS)) + [(4, TEXTS[4])]
    out = token_counts.token_counts(documents_of(rows), limit=100).collect()
    assert len(out) == len(rows)
    for r in out:
        text = TEXTS[r.doc_id] or ""
        n = len(whole.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 100)
    assert token_counts.token_counts(documents_of([])).count() == 0


def check_packing(rows, texts, capacity):
    whole = library(tokens.BYTE_BPE)
    seqs, docs = defaultdict(list), defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
        docs[r.doc_id].append(r)
    for spans in seqs.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    assert set(docs) == set(texts)
    for doc_id, own in docs.items():
        ids = whole.encode(texts[doc_id] or "", add_special_tokens=False).ids + [2]
        at = 0
        for k, r in enumerate(sorted(own, key=lambda r: r.piece)):
            piece = ids[at : at + r.length]
            assert (r.piece, r.start) == (k, at)
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(piece)}I", *piece))
            assert r.length == capacity or k == 0
            at += r.length
        assert at == len(ids)
    return len(seqs)


def test_packing(documents_of):
    texts = dict(enumerate(TEXTS))
    out = packing.pack_documents(documents_of(texts.items()), capacity=64, per_group=10).collect()
    check_packing(out, texts, 64)
    assert packing.pack_documents(documents_of([])).count() == 0
    ids = packing.pack_documents(documents_of([(1, "some words")]), with_ids=True).first().ids
    assert np.frombuffer(ids, "<u4").tolist() == library(tokens.BYTE_BPE).encode("some words").ids + [2]


def test_sum_of_squares_takes_the_smallest_sum():
    rng = random.Random(5)
    capacity = 12
    packer = packing.SumOfSquares(capacity)
    gaps = {}
    for _ in range(300):
        size = rng.randrange(1, capacity)

        def total(bins):
            counts = defaultdict(int)
            for g in bins.values():
                counts[g] += g > 0
            return sum(c * c for c in counts.values())

        options = [total(gaps | {b: g - size}) for b, g in gaps.items() if g >= size]
        options = options or [total(gaps | {len(gaps): capacity - size})]
        number, offset = packer.place(size)
        assert offset == capacity - gaps.get(number, capacity)
        gaps[number] = gaps.get(number, capacity) - size
        assert gaps[number] >= 0 and total(gaps) == min(options)


def test_packing_wastes_little(documents_of):
    rng = random.Random(1)
    texts = {k: "a" + " a" * rng.randrange(120) for k in range(800)}
    out = packing.pack_documents(documents_of(texts.items()), capacity=128).collect()
    used = check_packing(out, texts, 128)
    assert used <= 1.03 * -(-sum(r.length for r in out) // 128) + 1


def test_segments_hold_any_ids():
    rng = np.random.default_rng(3)
    for ids in [
        np.empty(0, np.uint32),
        np.array([7], np.uint32),
        np.zeros(500, np.uint32),
        rng.integers(0, 50257, 5000).astype(np.uint32),
        rng.integers(0, 2**32, 1000, dtype=np.uint64).astype(np.uint32),
        np.where(rng.random(4096) < 0.05, 49000, rng.integers(0, 300, 4096)).astype(np.uint32),
    ]:
        for percentile in (1, 50, 90, 100):
            segment = pfor.encode_segment(ids, percentile)
            assert pfor.decode_segment(segment).tolist() == ids.tolist()
            for first, last in [(0, 1), (1, 3), (3, 99)]:
                assert pfor.decode_segment(segment, first, last).tolist() == ids[first * pfor.BLOCK : last * pfor.BLOCK].tolist()
    skewed = np.where(rng.random(1 << 16) < 0.05, 49000, rng.integers(0, 300, 1 << 16)).astype(np.uint32)
    assert len(pfor.encode_segment(skewed, 90)) < 2 * len(skewed)
    with pytest.raises(ValueError):
        pfor.decode_segment(b"x" * 64)


def test_token_files(documents_of):
    whole = library(tokens.BYTE_BPE)
    rows = [(len(TEXTS) - k, t) for k, t in enumerate(TEXTS)] + [(None, "no id"), (3, TEXTS[-3])]
    out = pfor.round_trip(documents_of(rows), segment_ids=50).collect()
    assert len(out) == len(rows)
    at = 0
    for r in sorted(out, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    wanted = defaultdict(list)
    for doc_id, text in rows:
        ids = whole.encode(text or "", add_special_tokens=False).ids + [0]
        wanted[doc_id].append((len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
    got = defaultdict(list)
    for r in out:
        got[r.doc_id].append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in wanted.items()} == {k: sorted(v) for k, v in got.items()}
    order = [r.doc_id for r in sorted(out, key=lambda r: r.start)]
    assert order[0] is None and order[1:] == sorted(order[1:])
    assert pfor.round_trip(documents_of([])).count() == 0
