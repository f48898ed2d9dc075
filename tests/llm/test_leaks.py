import random
import re
from functools import lru_cache

import numpy as np

from ledgerloom.llm import decontaminate


def plain(text):
    return re.sub(r"[\W_]+", " ", (text or "").lower()).strip()


def distance_in(item, stretch):
    """Smallest edit distance of the item to any part of the stretch, cell by cell."""
    row = [0] * (len(stretch) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(stretch, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def codes(text):
    return np.array([ord(c) for c in text], np.uint16)


def test_edit_distance_matches_the_table():
    rng = random.Random(1)
    for _ in range(300):
        item = "".join(rng.choice("abc ") for _ in range(rng.randrange(1, 90)))
        stretch = "".join(rng.choice("abc ") for _ in range(rng.randrange(90)))
        assert decontaminate.edit_distance_in(codes(item), codes(stretch))[0] == distance_in(item, stretch)


def test_walk_maps_edits_to_few_differences():
    """Embeddings of near strings differ in few places, those of far strings in many."""
    rng = random.Random(2)
    walk = decontaminate.Walk(0)
    near, far = [], []
    for _ in range(200):
        a = "".join(rng.choice("abcdefgh ") for _ in range(200))
        k = rng.randrange(20)
        b = a[:k] + rng.choice("abcdefgh ") + a[k + 1 :]
        c = "".join(rng.choice("abcdefgh ") for _ in range(200))

        def embedded(text):
            at, out = 0, []
            symbols = decontaminate.symbols_of(codes(text))
            for t in range(decontaminate.STEPS):
                out.append(symbols[at])
                at += walk.moves[t][symbols[at]]
            return out

        e = embedded(a)
        near.append(sum(x != y for x, y in zip(e, embedded(b))))
        far.append(sum(x != y for x, y in zip(e, embedded(c))))
    assert np.mean(near) < 0.6 * np.mean(far)


def cases(seed=3):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice(["th", "an", "er", "in", "on", "re"]) for _ in range(rng.randrange(1, 5))) for _ in range(500)]

    def words(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    items = [(k, " ".join(words(rng.randrange(18, 60)))) for k in range(40)]
    docs, planted = [], set()
    for d in range(200):
        text = words(rng.randrange(20, 300))
        if d % 2:
            n = rng.randrange(len(items))
            own = items[n][1]
            for _ in range(int(0.05 * len(own)) * (d % 3)):  # up to a tenth of the characters
                k = rng.randrange(len(own))
                own = own[:k] + rng.choice(["", "x", own[k] + "q"]) + own[k + 1 :]
            if d % 5 == 0:
                own = own.upper().replace(" ", ",\n ")
            at = rng.randrange(len(text) + 1)
            text[at:at] = [own]
            planted.add((d, n))
        docs.append((d, " ".join(text)))
    return items, docs, planted


def test_leaks_match_brute_force(spark, documents_of):
    items, docs, planted = cases()
    docs += [(900, None), (901, ""), (902, items[3][1]), (902, items[3][1]), (903, "Z " * 40_000 + items[4][1])]
    extra = [(50, None), (51, ""), (52, "too short"), (53, items[0][1])]
    benchmark = spark.createDataFrame(items + extra, "item_id long, text string")
    out = decontaminate.find_leaks(documents_of(docs).repartition(5), benchmark).collect()
    found = {(r.doc_id, r.item_id): r for r in out}

    @lru_cache(None)
    def want(d, n):
        item, text = plain(dict(items + extra)[n]), plain(dict(docs)[d])
        return distance_in(item, text)

    text_of, item_of = dict(docs), dict(items + extra)
    for (d, n), r in found.items():
        assert r.distance == want(d, n) if d != 903 else r.distance == 0
        assert r.distance <= 0.1 * len(plain(item_of[n]))
        assert distance_in(plain(item_of[n]), plain(text_of[d][r.start : r.end])) <= 2 * r.distance + 1
    near = {(d, n) for d, n in planted if want(d, n) <= int(0.1 * len(plain(item_of[n])))}
    missed = near - found.keys()
    assert len(missed) <= 0.01 * len(near)
    exact = {(d, n) for d, t in docs if d != 903 for n, i in items + extra if i and len(plain(i)) > 23 and f" {plain(i)} " in f" {plain(t)} "}
    assert exact <= found.keys() and (903, 4) in found and (1, 50) not in found
    assert {d for d, _ in found} <= {d for d, _ in planted} | {902, 903}
    assert [r.doc_id for r in out].count(902) == 2 * (1 + (53 in {n for d, n in found if d == 902}))

    frame = documents_of(docs)
    left = decontaminate.clean_rows(frame, benchmark)
    assert left.schema == frame.schema
    assert sorted(r.doc_id for r in left.collect()) == sorted(d for d, _ in docs if d not in {d for d, _ in found})


def test_blocks_and_empty_tables(spark, documents_of, monkeypatch):
    items, docs, _ = cases()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(documents_of(docs), benchmark).collect()}
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 3000)
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(documents_of(docs), benchmark).collect()} == whole
    assert decontaminate.find_leaks(documents_of([]), benchmark).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_leaks(documents_of(docs), none).count() == 0
    assert decontaminate.clean_rows(documents_of(docs), none).count() == len(docs)


def edited(rng, item, edits):
    for _ in range(edits):
        k = rng.randrange(len(item))
        item = item[:k] + rng.choice(["", "x", item[k] + "q"]) + item[k + 1 :]
    return item


def test_short_items_are_found_by_length():
    """Mixed edits up to the allowed distance hide no item of any length, nor does a script without blanks."""
    rng = random.Random(4)
    for size in (26, 36, 50, 70, 110, 150, 220):
        items = [" ".join("".join(rng.choice("etaoinshr") for _ in range(rng.randrange(2, 8))) for _ in range(size))[:size].strip() for _ in range(60)]
        texts = ["some words " + edited(rng, i, int(0.1 * len(i))) + " and more" for i in items]
        index = decontaminate.Index(list(enumerate(items)), decontaminate.MAX_DISTANCE, decontaminate.repetitions(0.1, 0.999))
        for n, found in enumerate(index.matches(texts)):
            if len(plain(items[n])) >= 24 and distance_in(plain(items[n]), plain(texts[n])) <= int(0.1 * len(plain(items[n]))):
                assert n in {f[0] for f in found}, size
    signs = ["".join(chr(rng.randrange(0x4E00, 0x5E00)) for _ in range(n)) for n in (30, 90, 600)]
    items = [*signs, "Forty two", signs[0][:9]]
    index = decontaminate.Index(list(enumerate(items)), 0.1, 2)
    texts = ["字" * 7 + items[1] + "字" * 5, "字" * 7 + items[2] + "字", "so: FORTY, two!", "forty twofold", "字" + items[4] + "字", "x"]
    assert [{f[0] for f in found} for found in index.matches(texts)] == [{1}, {2}, {3}, set(), {4}, set()]


def test_characters_beyond_the_basic_plane_stay_apart():
    chinese = "".join(chr(0x4E00 + 7 * k) for k in range(30))
    emoji = "".join(chr(0x1F300 + (0x4E00 + 7 * k - 0x1F300) % 0x4000) for k in range(30))
    index = decontaminate.Index([(0, chinese), (1, emoji)], 0.1, 2)
    assert [{f[0] for f in found} for found in index.matches([f"x {emoji} y", f"x {chinese} y"])] == [{1}, {0}]


def test_short_items_keep_their_edits_and_common_phrases_stay_cheap():
    index = decontaminate.Index([(0, "a dozen tiny eggs"), (1, "ninesigns"), (2, "a")], 0.1, 2)
    texts = ["he ate a dozen tinyy eggs today", "ninesignss", "nine signs ninesigns.", "b a b", "ab"]
    assert [{f[0] for f in found} for found in index.matches(texts)] == [{0, 2}, set(), {1}, {2}, set()]
    phrase = "it is a truth universally acknowledged that "
    items = [(k, phrase + f"number {k} is {k * 7919} " * 3) for k in range(400)]
    index = decontaminate.Index(items, 0.1, 2)
    found = index.matches([phrase * 200, "so " + items[17][1]])
    assert found[0] == [] and {f[0] for f in found[1]} >= {17}
