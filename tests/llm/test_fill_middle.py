"""Fill-in-the-middle: the learned index against plain boundaries, the operator against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import fill_middle as fm

TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def plain_places(text):
    return [0] + [m.end() for m in TOKEN.finditer(text)]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abZ é\n1,日😀", max_size=80))
def test_boundaries(text):
    assert fm.boundaries(text).tolist() == plain_places(text)


@pytest.mark.parametrize("error", [0, 1, 64, 500])
def test_index_is_exact_and_its_lines_are_bounded(error):
    rng = random.Random(5)
    text = "".join(rng.choice(["word", "a", "Longerword" * 9, " ", " ", "é", "1"]) for _ in range(20_000))
    places = np.array(plain_places(text))
    index = fm.RankIndex(places, error)
    ranks = np.arange(len(places))
    assert (index.places(ranks) == places).all()
    assert np.abs(places - index.predict(ranks)).max() <= error + 1
    if error == 500:
        assert len(index.starts) < len(places) / 100


def test_index_of_one_huge_token():
    for text in ("", "x", "y" * 300_000, "y" * 300_000 + " z" * 700 + "q" * 5000):
        places = plain_places(text)
        index = fm.RankIndex(np.array(places))
        assert index.places(np.arange(len(places))).tolist() == places


def brute(doc_id, text):
    text = text or ""
    hexed = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(hexed[i : i + 8], 16) for i in (0, 8, 16, 24))
    tokens = TOKEN.findall(text)
    n = len(tokens)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    if not text or any(k in text for k in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (doc_id, n, "plain", None, None, sha(text), sha(text))
    out = f"<S>{s}<P>{p}<M>{m}" if h4 % 100 < 20 else f"<P>{p}<S>{s}<M>{m}"
    return (doc_id, n, "spm" if h4 % 100 < 20 else "psm", len(p), len(m), sha(out), sha(text))


def test_operator_against_brute_force(spark, documents_of):
    rng = random.Random(3)
    pieces = ["one", "Two", " ", "\n", "é", "日本", "😀", "<", "S>", "<P", ">", "<M", "9"]
    rows = [(i, "".join(rng.choice(pieces) for _ in range(rng.randint(0, 60)))) for i in range(300)]
    rows += [(None, "no id at all"), (7, None), (8, ""), (9, "again and again"), (9, "again and again")]
    rows += [(400, "a <P> marker"), (401, "word " * 200_000), (402, "z" * 1_000_000)]
    got = sorted(map(tuple, fm.digest(fm.fill_in_middle(documents_of(rows))).collect()), key=repr)
    assert got == sorted((brute(d, t) for d, t in rows), key=repr)
    forms = {r[2] for r in got}
    assert forms == {"plain", "psm", "spm"}


def test_no_rows(spark, documents_of):
    assert fm.digest(fm.fill_in_middle(documents_of([]))).collect() == []
