import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from corpus_cases import docs_frame, text_of
from hypothesis import given, settings
from hypothesis import strategies as st

from tallymart.llm import periodic
from tallymart.llm.periodic import Periodic


def brute(w, least=6, times=4):
    n, found = len(w), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, times * q) and j > i:
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def some_words(r):
    letters, w = "abcdefgh"[: r.choice([1, 2, 2, 3, 5])], []
    for _ in range(r.randint(0, 6)):
        w += [r.choice(letters) for _ in range(r.randint(1, 9))] * r.randint(1, 9)
        if r.random() < 0.4:
            w += [r.choice("abcxyz") for _ in range(r.randint(0, 5))]
    return [x.encode() for x in w * r.choice([1, 1, 1, r.randint(1, 6)])]


def test_runs_match_brute_force():
    r = random.Random(7)
    for _ in range(250):
        texts = [some_words(r) for _ in range(r.choice([1, 4, 20]))]
        for w, rows in zip(texts, periodic.runs_of(texts), strict=True):
            assert [tuple(map(int, x)) for x in rows] == brute(w)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b"]), max_size=120))
def test_two_words(words):
    assert [tuple(map(int, x)) for x in periodic.runs_of([words])[0]] == brute(words)


def test_other_bounds():
    w = [c.encode() for c in "abababababxyxyxyxyxyxy"]
    assert [tuple(map(int, x)) for x in periodic.runs_of([w], Periodic(2, 5))[0]] == brute(w, 2, 5)
    with pytest.raises(ValueError, match="block"):
        Periodic(times=3)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 199), min_size=1, max_size=200, unique=True), st.data())
def test_successors(values, data):
    order = np.random.default_rng(len(values)).permutation(200)
    tree = periodic.Wavelet(order)
    low = np.array([data.draw(st.integers(0, 199)) for _ in range(5)])
    high = np.array([data.draw(st.integers(int(a), 200)) for a in low])
    least = np.array([data.draw(st.integers(0, 300)) for _ in range(5)])
    want = [min([v for v in order[a:b] if v >= x], default=-1) for a, b, x in zip(low, high, least, strict=True)]
    assert tree.successor(low, high, least).tolist() == want


def test_a_long_text_is_one_group():
    unit = text_of(1, 700, 10**6).encode().split()
    w = text_of(2, 999, 10**6).encode().split() + unit * 200 + unit[:77]
    assert periodic.runs_of([w])[0].tolist() == [[999, 140_077, 700]]


def expected(i, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if i is not None and n:
        h = zlib.crc32(str(i).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
    runs = brute(w)
    gone = {k for s, m, q in runs for k in range(s + q, s + m)}
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    best = max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=(None, None, None))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    short = " ".join(x for k, x in enumerate(w) if k not in gone)
    return (i, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha(lines), sha(short))


def test_report_matches_brute_force(spark, edges):
    r = random.Random(5)
    odd = ["", None, " \t", "a", "x " * 9, "é\x1cb é\x1cb " * 6, "a b\n" * 8 + "a", "\x85 " * 7]
    texts = odd + [text_of(k, r.randint(1, 150), 60) for k in range(300)] + [b" ".join(some_words(r)).decode() for _ in range(100)]
    rows = [(k, t, "en", "a") for k, t in enumerate(texts)]
    for frame in (docs_frame(spark, rows).repartition(3), edges):
        want = sorted((expected(x["doc_id"], x["text"]) for x in frame.collect()), key=repr)
        found = periodic.run_report(periodic.planted(frame)).collect()
        assert sorted(map(tuple, found), key=repr) == want


def test_empty_table(nothing):
    assert periodic.run_report(periodic.planted(nothing)).collect() == []
