import pytest
from corpus_cases import docs_frame

from tallymart.llm import mixing
from tallymart.llm.mixing import Mix


def poured(sizes: list[int], weights, share: float, most: float) -> list[float]:
    """Targets by repeated resharing."""
    goal, left = [0.0] * len(sizes), share * sum(sizes)
    open_ = set(range(len(sizes)))
    while open_:
        total = sum(weights[i % len(weights)] for i in open_)
        want = {i: left * weights[i % len(weights)] / total for i in open_}
        full = {i for i in open_ if want[i] > most * sizes[i]}
        if not full:
            for i in open_:
                goal[i] = want[i]
            break
        for i in full:
            goal[i] = most * sizes[i]
            left -= goal[i]
        open_ -= full
    return goal


@pytest.fixture(scope="module")
def docs(spark):
    sources = [None, "b", "a", "ü", "z", "hot", "hot", "hot", "hot"]
    rows = [(i, "w " * (1 + (i * 37) % 400), "en", sources[i % len(sources)]) for i in range(1800)]
    return docs_frame(spark, rows)


def test_targets_and_words(docs):
    rows = mixing.mix_report(docs).collect()
    by: dict = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    names = sorted((s for s in by if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    sizes = [sum(r["size"] for r in by[s]) for s in names]
    goal = poured(sizes, (5, 2, 1), 1.5, 2.0)
    assert sum(goal) == pytest.approx(1.5 * sum(sizes))
    for s, size, want in zip(names, sizes, goal, strict=True):
        assert {r["source_size"] for r in by[s]} == {size}
        assert by[s][0]["target"] == pytest.approx(want)
        assert abs(sum(r["taken"] for r in by[s]) - want) <= max(r["size"] for r in by[s])
    assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in rows)


def test_reruns_and_partitions_agree(docs):
    one = {r["doc_id"]: r["taken"] for r in mixing.mix_report(docs).collect()}
    two = {r["doc_id"]: r["taken"] for r in mixing.mix_report(docs.repartition(7)).collect()}
    assert one == two
    other = {r["doc_id"]: r["taken"] for r in mixing.mix_report(docs, Mix(seed="other")).collect()}
    assert one != other


def test_mixed_rows_are_the_report(docs):
    wanted = {r["doc_id"]: r["copies"] for r in mixing.mix_report(docs).collect() if r["copies"]}
    found: dict = {}
    for r in mixing.mixed(docs).collect():
        found[r["doc_id"]] = found.get(r["doc_id"], 0) + 1
    assert found == wanted


def test_longer_documents_are_likelier(docs):
    """Where a source gives only a part, inclusion follows the length class."""
    rows = [r for r in mixing.mix_report(docs, Mix(share=0.5, weights=(1.0,))).collect()]
    long = [r["copies"] for r in rows if r["size"] >= 200]
    short = [r["copies"] for r in rows if r["size"] < 20]
    assert sum(long) / len(long) > sum(short) / len(short)
