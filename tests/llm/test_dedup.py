import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerloom.llm import components, dart_minhash, exact_dedup

EDGE = [(1, "a b"), (2, "ab"), (3, " a\tb\n"), (4, None), (5, ""), (6, " \n"), (7, "A b"), (7, "A b"), (None, "ab"), (8, "a b"), (9, "z" * 200_000)]


def stripped(text):
    return "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")


def expected(rows):
    groups = defaultdict(list)
    for k, (doc_id, text) in enumerate(rows):
        groups[stripped(text)].append((-len(text or ""), doc_id is None, doc_id or 0, k, doc_id))
    return {text: (min(g)[4], len(g)) for text, g in groups.items()}


def check_groups(rows, out):
    want = expected(rows)
    texts = defaultdict(set)
    for doc_id, text in rows:
        texts[hashlib.sha256(stripped(text).encode()).hexdigest()].add(stripped(text))
    assert len(out) == len(rows)
    kept = Counter()
    for r in out:
        (text,) = texts[r.text_sha256]
        assert (r.keep_id, r.group_size) == want[text]
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) <= {1}
    assert Counter((d, hashlib.sha256(stripped(t).encode()).hexdigest()) for d, t in rows) == Counter((r.doc_id, r.text_sha256) for r in out)


def test_exact_groups(documents_of):
    check_groups(EDGE, exact_dedup.exact_groups(documents_of(EDGE)).collect())
    assert exact_dedup.exact_groups(documents_of([])).count() == 0


@pytest.mark.parametrize("table_bytes", [1, 300, 1 << 20])
def test_buckets_that_spill_give_the_same(documents_of, table_bytes):
    rng = random.Random(2)
    rows = [(k, rng.choice(["hot copy", "ho t copy", f"text {rng.randrange(60)}", f"long {k} " * 30])) for k in range(700)]
    frame = documents_of(rows).repartition(9)
    check_groups(rows, exact_dedup.exact_groups(frame, table_bytes=table_bytes).collect())
    left = exact_dedup.surviving_rows(frame, table_bytes=table_bytes).collect()
    assert sorted(r.doc_id for r in left) == sorted(i for i, _ in expected(rows).values())


def test_surviving_rows_keep_their_columns(documents_of):
    frame = documents_of(EDGE)
    left = exact_dedup.surviving_rows(frame)
    assert left.schema == frame.schema
    rows = left.collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in expected(EDGE).values())
    assert {(r.uid, r.row, bytes(r.digest)) for r in rows} == {("x", 1, b"y")}
    assert exact_dedup.surviving_rows(documents_of([])).count() == 0


def test_content_table_compares_contents():
    table = exact_dedup.ContentTable(4)
    names = [table.find(5, f"{k}".encode()) for k in range(50)]
    assert names == [(k, True) for k in range(50)]
    assert [table.find(5, f"{k}".encode()) for k in range(50)] == [(k, False) for k in range(50)]


def words(text):
    return text.lower().split()


def shingle_counts(text, n=5):
    w = words(text or "")
    n = min(n, len(w))
    return Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else Counter()


def brute_classes(rows, threshold=0.8, weighting="count"):
    sets = [shingle_counts(t) for _, t in rows]
    if weighting == "set":
        sets = [Counter(set(s)) for s in sets]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and (sets[i] & sets[j]).total() >= threshold * (sets[i] | sets[j]).total() - 1e-9:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(rows))]


def near_rows(seed=4):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(3000)]
    rows, passage = [], [rng.choice(vocabulary) for _ in range(60)]
    for _ in range(60):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(80, 250))]
        rows.append(" ".join(base))
        for _ in range(rng.randrange(4)):
            copy = list(base)
            for _ in range(rng.randrange(1, 5)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append(" ".join(copy))
        rows.append(" ".join(passage + [rng.choice(vocabulary) for _ in range(120)]))
    chain = [rng.choice(vocabulary) for _ in range(200)]
    for k in range(12):  # each like the next, the ends unlike
        chain = chain[6:] + [rng.choice(vocabulary) for _ in range(6)]
        rows.append(" ".join(chain))
    refrain = [rng.choice(vocabulary) for _ in range(12)]
    verse = [rng.choice(vocabulary) for _ in range(60)]
    # alike as sets, unlike by counts, and the reverse
    rows += [" ".join(verse + refrain * k) for k in (1, 2, 9, 10, 40, 42, 45)]
    rows += [" ".join(verse[k : k + 12] + refrain * 30) for k in (0, 12, 24, 36)]
    rows += [rows[0]] * 5 + [None, "", "one two", "One  two", "alone"]
    return list(enumerate(rows))


@pytest.mark.parametrize("weighting", ["count", "set"])
def test_near_duplicates_match_brute_force(documents_of, weighting):
    rows = near_rows()
    found = dart_minhash.near_duplicates(documents_of(rows).repartition(7), weighting=weighting)
    out = {r.doc_id: r for r in found.collect()}
    assert len(out) == len(rows)
    classes = brute_classes(rows, weighting=weighting)
    assert classes != brute_classes(rows, weighting="set" if weighting == "count" else "count")
    groups = defaultdict(set)
    for (doc_id, _), c in zip(rows, classes):
        groups[c].add(doc_id)
    for group in groups.values():
        for doc_id in group:
            assert (out[doc_id].class_id, out[doc_id].class_size, out[doc_id].kept) == (min(group), len(group), doc_id == min(group))


def test_near_duplicates_edges(documents_of):
    assert dart_minhash.near_duplicates(documents_of([])).count() == 0
    rows = [(5, "same words here again and again"), (5, "same words here again and again"), (None, "same words here again and again"), (1, None), (2, None)]
    out = dart_minhash.near_duplicates(documents_of(rows)).collect()
    assert Counter((r.doc_id, r.class_id, r.class_size, r.kept) for r in out) == Counter(
        [(5, 5, 3, True), (5, 5, 3, False), (None, 5, 3, False), (1, 1, 1, True), (2, 2, 1, True)]
    )
    frame = documents_of(rows)
    left = dart_minhash.one_of_each(frame)
    assert left.schema == frame.schema and {r.doc_id for r in left.collect()} == {5, 1, 2}


@pytest.mark.parametrize("weighting", ["set", "count"])
def test_signatures_estimate_the_similarity(weighting):
    rng = np.random.default_rng(6)
    for share in (0.2, 0.5, 0.9):
        names = rng.integers(0, 2**63, 400).astype(np.uint64)
        weights = rng.integers(1, 9, 400)
        common = int(400 * share)
        other = np.concatenate([names[:common], rng.integers(0, 2**63, 400 - common).astype(np.uint64)])
        changed = weights.copy()
        changed[: common // 2] = rng.integers(1, 9, common // 2)
        if weighting == "count":
            a, b = (dart_minhash.signature(n, w, 1024) for n, w in ((names, weights), (other, changed)))
            shared = np.minimum(weights[:common], changed[:common]).sum()
            want = shared / (weights.sum() + changed.sum() - shared)
        else:
            a, b = (dart_minhash.signature(n, None, 1024) for n in (names, other))
            want = common / (800 - common)
        assert abs((a == b).mean() - want) < 4 * (want * (1 - want) / 1024) ** 0.5


def test_weights_of_a_million_are_thrown_at_by_slab():
    names = np.arange(1, 2001, dtype=np.uint64)
    weights = np.ones(2000, np.int64)
    plain = dart_minhash.signature(names, None, 256)
    assert (dart_minhash.signature(names, weights, 256) == plain).all()
    weights[0] = 1_000_000
    heavy = dart_minhash.signature(names, weights, 256)
    alone = dart_minhash.signature(names[:1], weights[:1], 256)
    assert (heavy == alone).mean() > 0.97


def test_signature_of_few_elements_is_full():
    for n in (1, 2, 30):
        sig = dart_minhash.signature(np.arange(1, n + 1, dtype=np.uint64), None, 192)
        assert len(sig) == 192 and len(set(sig.tolist())) > 150


def test_components(spark):
    rng = random.Random(8)
    links = [(rng.randrange(150), rng.randrange(150)) for _ in range(90)] + [(1000, k) for k in range(200, 260)] + [(k, k + 1) for k in range(300, 340)]
    parent = {x: x for link in links for x in link}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in links:
        a, b = sorted((find(u), find(v)))
        parent[b] = a
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {x: find(x) for x in {y for link in links for y in link if link[0] != link[1]}}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0
