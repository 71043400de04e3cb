import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from corpus_cases import EDGES, docs_frame

from tallymart.llm import rules
from tallymart.llm.rules import UNIT, Rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    w = WORD.findall(text)
    runs = list(zip(w, w[1:], w[2:], strict=False))
    seen = Counter(runs)
    covered = {p + k for p, run in enumerate(runs) if seen[run] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_base_counts(spark):
    r = random.Random(5)
    odd = ["".join(r.choice("ab \n\t#|é\x0b \x1c") for _ in range(r.randint(0, 200))) for _ in range(300)]
    odd += [" " * 40 + "a" + " " * 33 + "b", "a b c a b c a b c", "same\nsame\n same\n\n\nsame", "x " * 3000]
    texts = odd + [t for _, t, _, _ in EDGES]
    frame = docs_frame(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    found = {x["doc_id"]: tuple(x[n] for n in names) for x in rules.base_counts(frame).collect()}
    for i, t in enumerate(texts):
        assert found[i] == counts(t), repr(t)


def numpy_distances(x: np.ndarray, how: Rules) -> np.ndarray:
    """The same estimates for one group, by plain sorting and numpy."""
    noise = np.diag(np.square(how.noise))
    step = UNIT // 64
    cell = np.sort(x // step, axis=0)
    q1, q2, q3 = (cell[math.ceil(len(x) * q) - 1] for q in (0.25, 0.5, 0.75))
    v = x / UNIT
    spread = (q3 - q1) / 64 / 1.349
    d2 = (((v - (q2 + 0.5) / 64) ** 2) / (spread**2 + np.square(how.noise))).sum(axis=1)
    was = None
    for step_number in range(how.steps + 1):
        cells = np.floor(np.log(d2 + 1e-6) * rules.FINE)
        if was is None or step_number < how.steps:
            order = np.sort(cells)
            last = order[math.ceil(len(x) * how.core) - 1]
            near, share = cells <= last, how.core
        part = v[near]
        cov = (part.T @ part / len(part) - np.outer(part.mean(axis=0), part.mean(axis=0))) * rules.consistency(share) + noise
        d = v - part.mean(axis=0)
        d2 = np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d)
        now = np.linalg.slogdet(cov)[1]
        if was is not None and abs(now - was) < 1e-3:
            break
        was = now
    near = np.floor(np.log(d2 + 1e-6) * rules.FINE) <= math.floor(math.log(rules.chi2_quantile(0.975, rules.DIMS)) * rules.FINE)
    part = v[near]
    cov = (part.T @ part / len(part) - np.outer(part.mean(axis=0), part.mean(axis=0))) * rules.consistency(0.975) + noise
    d = v - part.mean(axis=0)
    return np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d)


@pytest.fixture(scope="module")
def planted(spark):
    r = random.Random(9)
    rows = []
    for i in range(400):
        text = " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(r.randint(60, 500)))
        if i % 40 == 0:
            text = text.replace(" ", " #$|& ")
        rows.append((i, text, "en", "a"))
    return docs_frame(spark, rows), {i for i in range(0, 400, 40)}


def test_planted_outliers_go_and_clean_stay(planted):
    frame, bad = planted
    assert {x["doc_id"] for x in rules.quality_report(frame).collect() if not x["kept"]} == bad
    assert rules.without_rejects(frame).count() == 400 - len(bad)


def test_symbols_on_every_second_word_are_outlying(spark):
    r = random.Random(4)
    rows = []
    for i in range(300):
        w = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(r.randint(100, 400))]
        rows.append((i, " ".join(f"{x}|" if i % 30 == 0 and k % 2 else x for k, x in enumerate(w)), "en", "a"))
    found = rules.quality_report(docs_frame(spark, rows)).collect()
    assert {x["doc_id"] for x in found if not x["kept"]} == set(range(0, 300, 30))
    assert all(x["distance"] < rules.chi2_quantile(1 - 1e-9, rules.DIMS) for x in found)


def test_estimates_match_numpy(planted):
    frame, _ = planted
    how = Rules()
    counted = rules.base_counts(frame).select("doc_id", *rules.vector(how)).toPandas().sort_values("doc_id")
    want = numpy_distances(counted.iloc[:, 1:].to_numpy(np.int64), how)
    got = {x["doc_id"]: x["distance"] for x in rules.quality_report(frame).collect()}
    assert np.allclose([got[i] for i in counted["doc_id"]], want, rtol=1e-6)


def test_chi2():
    assert rules.chi2_quantile(0.95, 5) == pytest.approx(11.0705, abs=1e-3)
    assert rules.chi2_cdf(4.3515, 5) == pytest.approx(0.5, abs=1e-4)


def test_small_groups_reject_nothing(spark):
    frame = docs_frame(spark, [(i, "word " + "a b " * (30 + i) if i else "# " * 10 + " ".join(map(str, range(90))), f"l{i}", "a") for i in range(5)])
    assert {x["doc_id"] for x in rules.quality_report(frame, Rules(most_repeated=100)).collect() if x["kept"]} == set(range(5))


def test_small_groups_are_judged_by_wider_ones(spark):
    r = random.Random(3)
    clean = lambda: " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(r.randint(60, 500)))
    rows = [(i, clean(), "en", "large") for i in range(200)]
    rows += [(200, clean(), "en", "small"), (201, clean().replace(" ", " #$|& "), "en", "small")]
    rows += [(202, clean(), "xx", "small"), (203, clean().replace(" ", " #$|& "), "xx", None), (204, clean().replace(" ", " #$|& "), None, None)]
    found = {x["doc_id"]: x for x in rules.quality_report(docs_frame(spark, rows)).collect()}
    assert {i for i, x in found.items() if not x["kept"]} == {201, 203, 204}
    assert all(x["distance"] is not None for x in found.values())
