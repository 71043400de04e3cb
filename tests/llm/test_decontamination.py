from corpus_cases import docs_frame, text_of

from tallymart.llm import decontamination
from tallymart.llm.decontamination import Leaks


def sets(text, k=5):
    w = (text or "").lower().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def test_matches_brute_force(spark):
    items = [(i, text_of(1000 + i, 3 + i * 2, 90)) for i in range(40)] + [(90, "two words"), (91, None), (92, "")]
    docs = []
    for i in range(120):
        text = text_of(i, 400, 90)
        if i % 3 == 0:
            w = (items[i % 40][1] or "").upper().split()
            if i % 2 and len(w) > 12:
                w[len(w) // 2] = "changed"
            text = f"{text}\n{' '.join(w)}\n{text_of(5000 + i, 60, 90)}"
        docs.append((i, text, "en", "a"))
    docs += [(200, "Two  WORDS", "en", "a"), (201, None, "en", "a"), (202, "two words more", "en", "a")]
    want = {}
    for d, text, *_ in docs:
        for b, item in items:
            s = sets(item)
            if s and len(s & sets(text)) * 1000 >= 800 * len(s):
                want[(d, b)] = len(s & sets(text))
    frame = docs_frame(spark, docs)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = {(r["doc_id"], r["item_id"]): r["shared_shingles"] for r in decontamination.leak_report(frame, bench).collect()}
    assert found == want
    assert (200, 90) in found
    left = {r["doc_id"] for r in decontamination.without_leaks(frame, bench).collect()}
    assert left == {d for d, *_ in docs} - {d for d, _ in want}


def test_sketches_hold_what_a_match_may_lack_and_more(spark):
    items = spark.createDataFrame([(i, text_of(i, 5 + 11 * i, 10**6)) for i in range(12)], "item_id bigint, text string")
    rows = decontamination.index(items, Leaks()).collect()
    for i in range(12):
        own = [r for r in rows if r["item_id"] == i]
        n = own[0]["item_shingles"]
        need = -(-n * 4 // 5)
        assert (own[0]["part"], own[0]["wanted"]) == (n.bit_length() - 1, min(2, need))
        assert len({r["hash"] for r in own}) == len(own) == n - need + min(2, need)


def test_documents_ask_only_partitions_they_can_contain(spark):
    """Fails if partitions are ignored: a small document would ask with the bound of the large items."""
    items = [(i, text_of(i, 14, 10**6)) for i in range(3)] + [(50 + i, text_of(50 + i, 12, 10**6)) for i in range(40)]
    items += [(100 + i, text_of(900 + i, 400, 10**6)) for i in range(6)]
    index = decontamination.index(spark.createDataFrame(items, "item_id bigint, text string"), Leaks())
    parts = decontamination.partitions(index)
    bound = {p: b for p, _, b in parts}
    assert sorted(bound) == [3, 8]
    low, high = sorted(bound.values())
    docs = docs_frame(spark, [(i, text_of(3000 + i, 100 if i % 2 else 1000, 10**6), "en", "a") for i in range(60)] + [(99, "a b c", "en", "a")])
    asked = decontamination.probes(docs, parts, Leaks()).collect()
    small, large = ([r["hash"] for r in asked if (r["doc_shingles"] > 200) == big] for big in (False, True))
    assert max(small) <= bound[3] and max(large) <= max(bound.values())
    assert not any(r["doc_id"] == 99 for r in asked)
    every = 30 * 96 + 30 * 996
    assert len(asked) < 0.8 * every
    only_large = [p for p in parts if p[0] == 8]
    assert {r["doc_shingles"] > 200 for r in decontamination.probes(docs, only_large, Leaks()).collect()} == {True}


def test_a_match_at_the_threshold_is_never_lost(spark):
    """Whichever fifth of an item's shingles is missing."""
    items = [(i, text_of(i, 4 + s, 10**6)) for i, s in enumerate([1, 2, 3, 4, 5, 6, 9, 10, 11, 15, 20, 25, 30, 55] * 6)]
    docs = []
    for i, text in items:
        w, lost = text.split(), (len(text.split()) - 4) // 5
        # Words left out at one end remove one shingle each.
        docs.append((i, " ".join([*text_of(5000 + i, 30, 10**6).split(), *w[lost:]]) if i % 2 else " ".join(w[: len(w) - lost]), "en", "a"))
    found = decontamination.leak_report(docs_frame(spark, docs), spark.createDataFrame(items, "item_id bigint, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} >= {(i, i) for i, _ in items}
