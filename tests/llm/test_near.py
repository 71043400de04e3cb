import random

import numpy as np
import pytest
from corpus_cases import docs_frame, text_of

from tallymart.llm import near
from tallymart.llm.near import Near


def brute(rows, k=4, percent=80):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = {}
    for i, t, *_ in rows:
        w = (t or "").translate(lower).encode().split()
        found[i] = {tuple(w[a : a + k]) for a in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    root = {i: i for i in found}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(found)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = found[a], found[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                lo, hi = sorted((top(a), top(b)))
                root[hi] = lo
    return {i: (len(found[i]), top(i)) for i in ids}


def family(seed, copies, words, edits):
    """Copies of a base text, each with its own edits, so many pairs lie around the threshold."""
    r, base = random.Random(seed), text_of(seed, words).split()
    out = []
    for _ in range(copies):
        w = list(base)
        for _ in range(r.randint(0, edits)):
            w[r.randrange(len(w))] = f"new{r.random()}"
        out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def rows():
    texts = [t for s in range(12) for t in family(s, 6, 60 + 40 * s, 6)]
    texts += family(77, 90, 120, 7) + family(78, 40, 150, 0)
    shared = text_of(500, 55)
    texts += [f"{text_of(600 + i, 30 + 10 * i)} {shared}" for i in range(12)]
    texts += ["", None, "A b", "a  B\n", "a b c d", "A B C D", "a b c"]
    random.Random(1).shuffle(texts)
    return [(i, t, "en", "a") for i, t in enumerate(texts)]


@pytest.mark.parametrize("how", [Near(), Near(small=2, block=16)])
def test_matches_brute_force(spark, rows, how):
    want = brute(rows)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near.near_report(docs_frame(spark, rows), how).collect()}
    assert found == want


def test_large_group_leaves_as_a_forest(spark):
    """3,000 copies of one text with their own edits: five-word shingles, many pairs below and above the threshold."""
    r, base = random.Random(5), text_of(90, 60, 10**6).split()
    texts = []
    for _ in range(3000):
        w = list(base)
        for _ in range(r.choice([0, 1, 1, 2])):
            w[r.randrange(len(w))] = f"new{r.random()}"
        texts.append(" ".join(w))
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)]
    how = Near(shingle=5, block=256)
    docs = docs_frame(spark, rows)
    signed = docs.selectExpr("doc_id", "xxhash64(text) text_key", "text").mapInArrow(
        near.signer(how), "doc_id bigint, text_key bigint, n_shingles bigint, node binary, signature binary"
    )
    classes = near.classes_of(near.stable(signed))
    held = near.buckets(classes, how)
    alone = classes.selectExpr("node", "node AS root").limit(0)
    links = near.split_links(held, alone, classes, docs, how)
    assert links.count() <= held.where("members > 16").count()
    want = brute_groups(texts, 5)
    found = {x["doc_id"]: x["component_id"] for x in near.near_report(docs, how).collect()}
    assert found == want


def brute_groups(texts, k):
    """Least index reachable, by full comparison over an incidence matrix."""
    sets = [frozenset(zip(*[t.split()[j:] for j in range(k)], strict=False)) for t in texts]
    columns = {s: c for c, s in enumerate({x for s in sets for x in s})}
    grid = np.zeros((len(sets), len(columns)), np.float32)
    for n, s in enumerate(sets):
        grid[n, [columns[x] for x in s]] = 1
    shared = grid @ grid.T
    size = np.array([len(s) for s in sets])
    linked = 100 * shared >= 80 * (size[:, None] + size[None, :] - shared)
    label = np.arange(len(sets))
    while True:
        low = np.array([label[row].min() for row in linked])
        if (low == label).all():
            return dict(enumerate(label.tolist()))
        label = low


def test_repeated_rows_leave_one_whatever_the_layout(spark):
    text = text_of(3, 80)
    rows = [(1, text, "en", s) for s in "cab"] + [(2, text_of(4, 80), "en", "z"), (None, None, "en", "q"), (None, None, "de", "q")]
    frame = docs_frame(spark, rows)
    found = {tuple(sorted(map(str, near.deduplicated(frame.repartition(n, "source")).collect()))) for n in (1, 5)}
    assert len(found) == 1 and len(next(iter(found))) == 3


def test_filter_keeps_one_of_each(spark, rows):
    kept = {r["doc_id"] for r in near.deduplicated(docs_frame(spark, rows), Near(shingle=5)).collect()}
    assert kept == {root for _, root in brute(rows, 5).values()}


def test_pruning_hardly_ever_loses_a_similar_pair():
    r = np.random.default_rng(4)
    steps = near.least_matches(Near(), 180, 30)
    left = np.zeros((20_000, 180), np.uint32)
    right = (r.random(left.shape) > 0.8).astype(np.uint32)
    assert len(near.plausible(left, right, steps)) >= 19_995
    right = (r.random(left.shape) > 0.4).astype(np.uint32)
    assert len(near.plausible(left, right, steps)) < 20


def test_signature_estimates_similarity():
    memo = near.Words()
    a = near.shingle_set(text_of(1, 3000, 10**6), 4, memo)
    b = np.union1d(a[: len(a) * 3 // 4], near.shingle_set(text_of(2, 700, 10**6), 4, memo))
    truth = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((near.signature(a, 180) == near.signature(b, 180)).mean() - truth) < 0.12


def test_components_of_a_chain(spark):
    names = [bytes([k]) for k in range(40)]
    order = random.Random(2).sample(names, 40)
    links = spark.createDataFrame([(min(p), max(p)) for p in zip(order, order[1:], strict=False)], "a binary, b binary")
    assert {(bytes(r["node"]), bytes(r["root"])) for r in near.components(links).collect()} == {(n, names[0]) for n in names}
