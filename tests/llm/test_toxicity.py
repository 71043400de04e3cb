import random
import zlib

import numpy as np
import pytest
from corpus_cases import docs_frame

from tallymart.llm import toxicity
from tallymart.llm.toxicity import Toxicity


@pytest.fixture(scope="module")
def scored(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    return toxicity.toxic_report(docs, labels).toPandas(), labels.toPandas()


def test_held_out_accuracy(scored):
    found, labels = scored
    rows = found.merge(labels, on="doc_id")
    rows = rows[rows.held_out]
    clean, bad = rows[rows.toxic == 0], rows[rows.toxic == 1]
    assert clean.predicted.mean() <= 0.02
    assert bad.predicted.mean() >= 0.6  # some toxic labels stand on texts whose words were replaced
    assert bad.score.mean() > clean.score.mean() + 0.5


def test_fold_and_threshold(scored):
    found, _ = scored
    assert all((zlib.crc32(str(i).encode()) % 3 == 1) == h for i, h in zip(found.doc_id, found.held_out, strict=True))
    assert ((found.score >= 0.7).astype(int) == found.predicted).all()
    assert found.score.between(0, 1).all()


def test_planted_words_raise_the_score(spark):
    r = random.Random(2)
    plain = lambda n: " ".join("".join(r.choice(["er", "on", "th", "in", "ble"]) for _ in range(r.randint(1, 4))) for _ in range(n))
    rows, labels = [], []
    for i in range(500):
        words = plain(80).split()
        if i % 4 == 0:
            for w in ("vilesome", "grubface", "muckhead"):
                words[r.randrange(80)] = w
        rows.append((i, " ".join(words), "en", "a"))
        labels.append((i, 1, int(i % 4 == 0)))
    rows += [(1000, f"{plain(40)} grubface {plain(20)} vilesome {plain(20)} muckhead {plain(9)}", "en", "a"), (1001, plain(80), "en", "a"), (1002, None, "en", "a")]
    frame = docs_frame(spark, rows)
    label = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    score = {x["doc_id"]: x["score"] for x in toxicity.toxic_report(frame, label, Toxicity(sample=400)).collect()}
    assert score[1000] > 0.7 > score[1001]
    assert score[1002] < 0.7


def test_stems_and_rare_insults_are_telling():
    r = random.Random(3)
    plain = lambda n: ["".join(r.choice(["er", "on", "th", "in", "ble"]) for _ in range(r.randint(1, 4))) for _ in range(n)]
    toxic, ordinary = [plain(60) for _ in range(400)], [plain(60) for _ in range(1200)]
    for k, words in enumerate(toxic):
        if k < 200:
            words[r.randrange(60)] = "vilesome"
        if k % 13 == 0:
            words[r.randrange(60)] = "grubface"  # rare beside the other
        if k >= 200:  # never the same form
            words[r.randrange(60)] = "muckish" + "".join(r.choice("abcdefgh") for _ in range(6))
    found = toxicity.telling(toxic, ordinary, 0.01)
    assert {"vilesome", "grubface", "muckish"} <= found
    assert all(p[:4] in ("vile", "grub", "muck") for p in found)
    # Copies of one text are one context.
    copies = [*toxic, *[["lonely", *toxic[0]]] * 300]
    assert "lonely" not in toxicity.telling(copies, ordinary, 0.01)


def test_features_of_windows():
    """Lengths are the library's own, window by window."""
    front, plain = b" vilesome grubface ", b" the thing on the other "
    ordinary, toxic = (toxicity.compressor(f + plain, 12) for f in (bytes(len(front)), front))
    words = ("the thing vilesome on the other " * 3 + "thing on the other the the " * 5).split()
    saved = [len(ordinary(w)) - len(toxic(w)) for w in toxicity.windows(words, 6)]
    found = toxicity.gains(words, ordinary, toxic, 6)
    assert sum(x >= 3 for x in saved) == 3
    assert found[1] == 3 / (len(saved) + 3) and found[4:] == [float(min(x, 5)) for x in sorted(saved)[:-4:-1]]
    assert toxicity.gains([], ordinary, toxic, 6)[:3] == [0.0, 0.0, 0.0]


def test_one_class_only_scores_nothing(spark):
    frame = docs_frame(spark, [(i, "some text", "en", "a") for i in range(9)])
    label = spark.createDataFrame([(i, 1, 0) for i in range(9)], "doc_id bigint, quality int, toxic int")
    assert {x["predicted"] for x in toxicity.toxic_report(frame, label).collect()} == {0}


def test_logistic_fit():
    x = np.linspace(-3, 3, 400)[:, None]
    y = (1 / (1 + np.exp(-(2 * x[:, 0] - 1))) > 0.5).astype(float)
    w = toxicity.logistic(x, y, ridge=1e-2)
    assert 0.3 < -w[0] / w[1] < 0.7
