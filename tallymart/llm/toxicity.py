"""Toxicity by compression distance: windows are compressed under a toxic and an ordinary zstandard dictionary.

The ordinary dictionary is trained on the windows of ordinary documents. The toxic one is trained on the passages of
toxic documents that set them apart: the words that begin with a piece, a whole word or a stem of four letters or
more, whose share of toxic documents the ordinary sample cannot explain by chance. Stems matter where insults are
inflected, so that no single form is frequent. Trained on whole toxic windows, the dictionary is mostly everyday
words, and their chance matches drown the difference (see README). At scoring the toxic content stands in front of
the ordinary one: everyday words then cost the same under both, and a window is shorter under the toxic one only by
what it shares with toxic passages.

The bytes that windows save, summed, averaged over the text's windows and the largest of them, are calibrated to a
probability by a logistic fit; the number of windows is one of its inputs, so thresholds follow the text's length.
Each half of the sample is compressed under dictionaries of the other half for that, so no document is judged by a
dictionary that has seen it; the dictionaries used afterwards are trained on both.

Scale: the fit uses a bounded sample of labelled rows (``sample`` documents and ``characters`` per class, chosen by
hash); what is sent to the workers are two dictionaries of fixed size and a few numbers. Scoring is a map over the scan.
Texts are compressed window by window, so memory is bounded by the text itself.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import nlargest
from math import log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


NO_LETTERS = re.compile(r"[\W\d_]+")
#: Inputs of the calibration: see ``gains``.
FEATURES = 7
#: A window that saves this much holds toxic text; more says no more.
ENOUGH = 5
#: Letters of the shortest and of the longest stem.
STEM = (4, 10)
SLICE = 256


@dataclass(frozen=True)
class Toxicity:
    """``sample`` bounds the labelled documents per class and ``characters`` their length together; documents over
    ``longest`` characters are not sampled. ``chance`` bounds the probability that any piece at all is found telling
    by chance."""

    sample: int = 4000
    characters: int = 10_000_000
    longest: int = 50_000
    window: int = 6
    level: int = 12
    ordinary_bytes: int = 16_384
    toxic_bytes: int = 2048
    chance: float = 0.01
    threshold: float = 0.7


@dataclass(frozen=True)
class Model:
    """Two dictionary contents and the calibration: intercept and a weight per feature."""

    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]


def bare(text: str | None) -> list[str]:
    """Lower-case words of letters only."""
    return NO_LETTERS.sub(" ", (text or "").lower()).split()


def windows(words: list[str], n: int) -> list[bytes]:
    return [f" {' '.join(words[i : i + n])} ".encode() for i in range(0, len(words), n)]


def compressor(content: bytes, level: int):
    import zstandard

    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(level=level)
    return zstandard.ZstdCompressor(
        level=level, dict_data=dictionary, write_checksum=False, write_content_size=False, write_dict_id=False
    ).compress


def trained(size: int, samples: list[bytes]) -> bytes:
    """Content of a zstandard dictionary; too little text for training is used as it is."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


def pieces(word: str) -> set[str]:
    """A word and the stems it may have."""
    return {word, *(word[:k] for k in range(STEM[0], min(len(word), STEM[1] + 1)))}


def documents_with(texts: list[list[str]]) -> Counter:
    """In how many texts each piece occurs."""
    return Counter(p for words in texts for p in {p for w in set(words) for p in pieces(w)})


def contexts_of(texts: list[list[str]]) -> Counter:
    """Between how many different pairs of neighbours the words of each piece stand.

    Near copies repeat neighbours, so a word of one much copied text has few.
    """
    seen: set[int] = set()
    of_word, found = Counter(), Counter()
    for words in texts:
        for triple in zip(["", *words], words, [*words[1:], ""], strict=False):
            if (key := hash(triple)) not in seen:
                seen.add(key)
                of_word[triple[1]] += 1
    for word, n in of_word.items():
        for p in pieces(word):
            found[p] += n
    return found


def surprise(n: int, usual: int, share: float) -> float:
    """Log-likelihood ratio of n toxic among n + usual documents against the share of all; 0 if they are no more."""
    rate = n / (n + usual)
    if rate <= share:
        return 0.0
    return 2 * (n * log(rate / share) + (usual * log((1 - rate) / (1 - share)) if usual else 0.0))


def telling(toxic: list[list[str]], ordinary: list[list[str]], chance: float) -> set[str]:
    """The pieces that set toxic texts apart; counted is each by its texts or its contexts, whichever are fewer.

    A ratio of 2 log(m / chance) is reached by chance by less than a ``chance`` of all m pieces together.
    """
    share = len(toxic) / max(1, len(toxic) + len(ordinary))
    contexts, usual, found = contexts_of(toxic), documents_with(ordinary), documents_with(toxic)
    least = 2 * log(max(2, len(found)) / chance)
    return {p for p, n in found.items() if surprise(min(n, contexts[p]), usual[p], share) >= least}


def dictionaries(toxic: list[str], ordinary: list[str], how: Toxicity) -> tuple[bytes, bytes]:
    """The ordinary and the toxic content from whole sampled texts."""
    everyday = [bare(t) for t in sorted(set(ordinary))]
    marked = [bare(t) for t in sorted(set(toxic))]
    found = telling(marked, everyday, how.chance)
    passages = [w for words in marked for w in words if not found.isdisjoint(pieces(w))]
    plain = trained(how.ordinary_bytes, [x for words in everyday for x in windows(words, how.window)])
    return plain, trained(how.toxic_bytes, windows(passages, 4)) if passages else b""


def gains(words: list[str], ordinary, toxic, n: int) -> list[float]:
    """What windows save under the toxic dictionary: the bytes beyond the first per window, the share of windows that
    save three or more, those bytes in all and the windows as logarithms, and the three largest numbers of bytes."""
    saved = [len(ordinary(w)) - len(toxic(w)) for w in windows(words, n)]
    beyond = sum(min(x - 1, ENOUGH - 1) for x in saved if x > 1)
    strong = sum(x >= 3 for x in saved)
    several = len(saved) + 3
    most = [float(min(max(x, 0), ENOUGH)) for x in nlargest(3, saved)]
    return [beyond / several, strong / several, log1p(beyond), log(several), *most, *[0.0] * (3 - len(most))]


def feature_map(ordinary: bytes, toxic: bytes, how: Toxicity):
    """A map of Arrow batches whose last column is the text: the other columns and the features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Zeros in the place of the toxic content: the library picks its parameters by the dictionary's size.
        plain, marked = (compressor(front + ordinary, how.level) for front in (bytes(len(toxic)), toxic))
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                found = [gains(bare(t), plain, marked, how.window) for t in part.column(part.num_columns - 1).to_pylist()]
                columns = [pa.array([f[k] for f in found], pa.float64()) for k in range(FEATURES)]
                names = part.schema.names[:-1] + [f"f{k}" for k in range(FEATURES)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *columns], names)

    return run


def features(rows: DataFrame, ordinary: bytes, toxic: bytes, how: Toxicity) -> DataFrame:
    """``rows`` (any columns, then text) with the features in place of the text."""
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(feature_map(ordinary, toxic, how), ", ".join([kept, *[f"f{k} double" for k in range(FEATURES)]]))


def held_out():
    """Every third document by checksum of its id is kept for tests."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1


def sampled(docs: DataFrame, labels: DataFrame, how: Toxicity) -> list[tuple[int, bool, str]]:
    """(label, half, text) of the sample: per class the ids first by hash, one text per id."""
    wanted = labels.where(~held_out() & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    wanted = wanted.groupBy("doc_id").agg(F.max("toxic").alias("label")).withColumn("h", F.xxhash64("doc_id", F.lit("sample")))
    bound = how.sample
    ids = [wanted.where(F.col("label") == k).orderBy("h", "doc_id").limit(bound) for k in (0, 1)]
    few = ids[0].unionByName(ids[1]).withColumnRenamed("doc_id", "id")
    texts = docs.where(F.length("text") <= how.longest).select("doc_id", "text").join(F.broadcast(few), F.col("doc_id") == F.col("id"))
    texts = texts.groupBy("doc_id", "label", "h").agg(F.min("text").alias("text"))
    # A window over at most ``sample`` rows per class.
    before = F.sum(F.length("text")).over(Window.partitionBy("label").orderBy("h", "doc_id"))
    rows = texts.withColumn("upto", before).where(F.col("upto") <= how.characters).collect()
    return sorted((int(r["label"]), r["h"] % 2 == 0, r["text"]) for r in rows)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 60) -> tuple[float, ...]:
    """Weights (intercept first) of a ridge logistic fit by Newton steps; classes weigh as they occur."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        slope = a.T @ (p - y) / len(y) + ridge * w
        curve = (a * (p * (1 - p))[:, None]).T @ a / len(y) + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def fit(docs: DataFrame, labels: DataFrame, how: Toxicity = Toxicity()) -> Model:  # noqa: B008
    """Train the dictionaries and the calibration; without both classes the model gives every text the score 0."""
    rows = sampled(docs, labels, how)
    if len({label for label, _, _ in rows}) < 2:
        return Model(b"", b"", (-30.0, *[0.0] * FEATURES))
    spark, found = docs.sparkSession, []
    for half in (True, False):
        others = [(label, text) for label, own, text in rows if own != half] or [(label, text) for label, _, text in rows]
        ordinary, toxic = dictionaries([t for k, t in others if k], [t for k, t in others if not k], how)
        judged = [(label, text) for label, own, text in rows if own == half]
        frame = spark.createDataFrame(judged, "label int, text string").repartition(max(2, spark.sparkContext.defaultParallelism))
        found += features(frame, ordinary, toxic, how).collect()
    found = sorted(found)
    ordinary, toxic = dictionaries([t for k, _, t in rows if k], [t for k, _, t in rows if not k], how)
    x = np.array([r[1:] for r in found])
    scale = np.maximum(x.std(axis=0), 1e-9)
    first, *weights = logistic(x / scale, np.array([r[0] for r in found], float))
    return Model(ordinary, toxic, (first, *(float(v) for v in np.array(weights) / scale)))


def score_texts(docs: DataFrame, model: Model, how: Toxicity = Toxicity()) -> DataFrame:  # noqa: B008
    """doc_id, held_out, score, predicted for every row of ``docs`` (doc_id, text).

    A text without letters (NULL, empty) has no windows and gets the score of no gains. NULL ids count as the
    empty text in the fold rule, repeated ids and rows are scored one by one, an empty table gives no rows, very
    long texts are scored whole. Other columns are ignored; language, source and id never enter a score.
    """
    found = features(docs.select("doc_id", held_out().alias("held_out"), "text"), model.ordinary, model.toxic, how)
    linear = F.lit(model.weights[0])
    for k in range(FEATURES):
        linear = linear + F.col(f"f{k}") * model.weights[k + 1]
    score = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), linear))))
    return found.withColumn("score", score).select(
        "doc_id", "held_out", "score", (F.col("score") >= how.threshold).cast("int").alias("predicted")
    )


def toxic_report(docs: DataFrame, labels: DataFrame, how: Toxicity = Toxicity()) -> DataFrame:  # noqa: B008
    """``score_texts`` by a model fitted on the labelled rows (doc_id, toxic) that are not held out.

    Without rows of both classes, as in empty tables, nothing is predicted toxic. Labels of NULL ids, and of values
    other than 0 and 1, are not used; of several labels of an id the larger counts.
    """
    return score_texts(docs, fit(docs, labels, how), how)
