"""Quality rules with robust multivariate outliers (native).

Every text gets base counts, two fixed rules, and a vector of five transformed statistics. Per language and source
the centre and scatter of the vectors are the minimum-covariance-determinant estimates: from a start at medians and
quartile ranges, concentration steps keep the share ``core`` of the rows with the least Mahalanobis distance and
estimate again until the determinant stops falling; a last step reweights with all rows that are not outlying. Rows
beyond the cutoff are rejected.

Scale: texts are read once and only narrow vectors are stored. A concentration step is one aggregate: vectors are
fixed-point integers, their moments are summed exactly by group and by range of the distance (map-side, so a hot
group is no hot task), and the ranges that make up the core are added up. Nothing hangs on row order, so reruns agree.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.native import once, same, words
from tallymart.session import stable

DIMS = 5
#: Fixed point of a vector's entries, and distance ranges per power of e.
UNIT, FINE = 4096, 32
#: Fixed value: characters that count as symbols.
SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Rules:
    """``noise`` is the standard deviation below which no statistic is resolved; it is added to every scatter.

    Groups of fewer than ``least`` rows are judged by an estimate over all rows of their language, and languages of
    fewer by one over all rows; only where the whole table has fewer is nothing rejected.
    """

    min_words: int = 50
    most_repeated: int = 50
    core: float = 0.75
    alpha: float = 1e-5
    noise: tuple[float, ...] = (0.5, 0.06, 0.05, 0.08, 0.5)
    least: int = 30
    steps: int = 12


def _gamma_cdf(a: float, x: float) -> float:
    """Regularised lower incomplete gamma function by its series."""
    if x <= 0:
        return 0.0
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= x / n
        total += term
    return min(1.0, total * math.exp(-x + a * math.log(x) - math.lgamma(a)))


def chi2_cdf(x: float, k: int) -> float:
    return _gamma_cdf(k / 2, x / 2)


def chi2_quantile(p: float, k: int) -> float:
    low, high = 0.0, 400.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, k) < p else (low, mid)
    return high


def consistency(share: float) -> float:
    """What the covariance of the innermost ``share`` of normal vectors is too small by."""
    return share / chi2_cdf(chi2_quantile(share, DIMS), DIMS + 2)


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, row_key and the base counts of every whole text; a NULL text has no words."""
    text = F.coalesce("text", F.lit(""))
    split = docs.select("doc_id", "lang", "source", F.xxhash64("doc_id", "text", "lang", "source").alias("row_key"), text.alias("text"))
    split = words(split.withColumn("t", F.col("text")), "t")
    n = F.size("w")
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    hashes = F.slice(F.transform("w", lambda x, i: F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2))), F.lit(1), F.greatest(n - 2, F.lit(0)))
    counted = split.select(
        "doc_id",
        "lang",
        "source",
        "row_key",
        "w",
        n.cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        hashes.alias("hashes"),
    )
    # Equal windows have equal hashes, so most texts need no sorting; the rest compare the windows themselves.
    windows = F.transform("w", lambda x, i: F.struct(F.concat_ws(" ", x, F.get("w", i + 1), F.get("w", i + 2)).alias("k"), i.alias("i")))
    twice = F.size("hashes") > F.size(F.array_distinct("hashes"))
    ordered = F.when(F.col("twice"), F.array_sort(F.slice(windows, F.lit(1), F.greatest(F.col("n_words").cast("int") - 2, F.lit(0)))))
    counted = counted.select(
        "doc_id", "lang", "source", "row_key", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "w", twice.alias("twice"),
    )
    counted = once(counted, "ordered", ordered).drop("w", "twice")
    repeated = F.transform(
        "ordered",
        lambda x, i: F.when(
            (x["k"] == F.get("ordered", i + 1)["k"]) | ((i > 0) & (x["k"] == F.get("ordered", F.greatest(i - 1, F.lit(0)))["k"])), x["i"]
        ),
    )
    counted = once(counted, "places", F.array_sort(F.filter(repeated, lambda x: x.isNotNull()))).drop("ordered")
    # Words covered by windows of three: each window adds its words up to the next one's start.
    covered = F.aggregate(
        F.transform("places", lambda x, i: F.least(F.lit(3), F.coalesce(F.get("places", i + 1) - x, F.lit(3)))),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    return counted.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("places")


def vector(rules: Rules) -> list[Column]:
    """Fixed-point entries: sizes as logarithms, shares as square roots, which evens out their spread."""
    n, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    entries = [
        F.log(n),
        F.log(chars / n),
        F.sqrt(F.col("n_symbols") / chars),
        F.sqrt(F.col("n_repeat_words") / n),
        F.log1p("n_dup_lines"),
    ]
    return [F.round(x * UNIT).cast("long") for x in entries]


X = [f"x{i}" for i in range(DIMS)]
PAIRS = [(i, j) for i in range(DIMS) for j in range(i + 1)]


def _entry(i: int) -> Column:
    return F.col(X[i]) / F.lit(float(UNIT))


def squared_distance() -> Column:
    """From the centre m and the inverse root r of the scatter, both in columns of the joined estimate."""
    d = [_entry(i) - F.col(f"m{i}") for i in range(DIMS)]
    rows = [sum((F.col(f"r{i}{j}") * d[j] for j in range(i + 1)), F.lit(0.0)) for i in range(DIMS)]
    return sum((y * y for y in rows), F.lit(0.0))


def _start(vectors: DataFrame, rules: Rules) -> DataFrame:
    """Medians and quartile ranges per group, from counts of the fixed-point values in steps of 1/64."""
    step = UNIT // 64
    cells = vectors.select("g", F.posexplode(F.array(*[F.floor(F.col(x) / step) for x in X])).alias("dim", "bin"))
    counts = cells.groupBy("g", "dim", "bin").agg(F.count(F.lit(1)).alias("n"))
    part = Window.partitionBy("g", "dim")
    counts = counts.withColumns({"upto": F.sum("n").over(part.orderBy("bin")), "all": F.sum("n").over(part)})
    quarter = [F.min(F.when(F.col("upto") >= F.col("all") * q, F.col("bin"))).alias(f"q{k}") for k, q in ((1, 0.25), (2, 0.5), (3, 0.75))]
    places = counts.groupBy("g", "dim").agg(*quarter)
    spread = (F.col("q3") - F.col("q1")) / 64 / 1.349
    noise = F.get(F.array(*[F.lit(x) for x in rules.noise]), F.col("dim"))
    places = places.select("g", "dim", ((F.col("q2") + 0.5) / 64).alias("m"), (1 / F.sqrt(spread * spread + noise * noise)).alias("r"))
    picks = [F.max(F.when(F.col("dim") == i, F.col("m"))).alias(f"m{i}") for i in range(DIMS)]
    roots = [
        (F.max(F.when(F.col("dim") == i, F.col("r"))) if i == j else F.lit(0.0)).alias(f"r{i}{j}") for i, j in PAIRS
    ]
    return places.groupBy("g").agg(*picks, *roots, F.lit(None).cast("double").alias("log_det"))


def _estimate(moments: DataFrame, rules: Rules, factor: float) -> DataFrame:
    """Centre, inverse Cholesky factor and log determinant from summed moments; a summary row per group."""
    n = F.col("n").cast("double")
    rows = moments.withColumns({f"m{i}": F.col(f"s{i}").cast("double") / n / UNIT for i in range(DIMS)})
    rows = rows.withColumns(
        {
            f"c{i}{j}": (F.col(f"s{i}{j}").cast("double") / n / UNIT**2 - F.col(f"m{i}") * F.col(f"m{j}")) * factor
            + (rules.noise[i] ** 2 if i == j else 0.0)
            for i, j in PAIRS
        }
    )
    for j in range(DIMS):
        known = sum((F.col(f"l{j}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
        rows = rows.withColumn(f"l{j}{j}", F.sqrt(F.greatest(F.col(f"c{j}{j}") - known, F.lit(1e-12))))
        below = {
            f"l{i}{j}": (F.col(f"c{i}{j}") - sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))) / F.col(f"l{j}{j}")
            for i in range(j + 1, DIMS)
        }
        rows = rows.withColumns(below) if below else rows
    for i in range(DIMS):
        rows = rows.withColumn(f"r{i}{i}", 1 / F.col(f"l{i}{i}"))
        for j in range(i):
            inner = sum((F.col(f"l{i}{k}") * F.col(f"r{k}{j}") for k in range(j, i)), F.lit(0.0))
            rows = rows.withColumn(f"r{i}{j}", -inner / F.col(f"l{i}{i}"))
    log_det = sum((2 * F.log(F.col(f"l{i}{i}")) for i in range(DIMS)), F.lit(0.0))
    return rows.select("g", *[f"m{i}" for i in range(DIMS)], *[f"r{i}{j}" for i, j in PAIRS], log_det.alias("log_det"))


def _concentrate(vectors: DataFrame, estimate: DataFrame, rules: Rules, within: float | None) -> DataFrame:
    """One step: the moments of the nearest rows (the core, or all within a distance) and the estimate from them."""
    placed = vectors.join(estimate, "g").withColumn("bin", F.floor(F.log(squared_distance() + 1e-6) * FINE))
    number = "decimal(20,0)"
    sums = [F.count(F.lit(1)).alias("n"), *[F.sum(F.col(X[i]).cast(number)).alias(f"s{i}") for i in range(DIMS)]]
    sums += [F.sum((F.col(X[i]) * F.col(X[j])).cast(number)).alias(f"s{i}{j}") for i, j in PAIRS]
    by_bin = placed.groupBy("g", "bin").agg(*sums)
    part = Window.partitionBy("g")
    if within is None:
        before = F.sum("n").over(part.orderBy("bin")) - F.col("n")
        near = by_bin.withColumn("chosen", before < F.sum("n").over(part) * rules.core)
    else:
        near = by_bin.withColumn("chosen", F.col("bin") <= math.floor(math.log(within) * FINE))
    fields = ["n", *[f"s{i}" for i in range(DIMS)], *[f"s{i}{j}" for i, j in PAIRS]]
    moments = near.where("chosen").groupBy("g").agg(*[F.sum(F.col(f).cast("decimal(38,0)")).alias(f) for f in fields])
    return stable(_estimate(moments, rules, consistency(rules.core if within is None else 0.975)).coalesce(1))


def estimates(vectors: DataFrame, rules: Rules) -> DataFrame:
    """Minimum-covariance-determinant estimate per group of stored vectors (g, x0..x4)."""
    now = stable(_start(vectors, rules).coalesce(1))
    for _ in range(rules.steps):
        after = _concentrate(vectors, now, rules, None)
        fall = (
            after.join(now.select("g", F.col("log_det").alias("was")), "g")
            .agg(F.max(F.coalesce(F.abs(F.col("log_det") - F.col("was")), F.lit(9.0))).alias("most"))
            .first()["most"]
        )
        now = after
        if fall is None or fall < 1e-3:
            break
    return _concentrate(vectors, now, rules, chi2_quantile(0.975, DIMS))


def quality_report(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:  # noqa: B008
    """doc_id, row_key, base counts, base_failed, distance (squared) and kept for every row of ``docs``.

    NULL and empty texts have no words and fail the base rules. NULL languages and sources are groups of their
    own. Equal rows get equal verdicts. An empty table gives no rows; other columns are ignored.
    """
    n, repeated = F.col("n_words"), F.col("n_repeat_words")
    failed = (n < rules.min_words) | (100 * repeated > rules.most_repeated * n)
    entries = vector(rules)
    rows = base_counts(docs).withColumn("base_failed", failed)
    rows = stable(rows.withColumns(dict(zip(X, entries, strict=True))))
    judged = rows.where("not base_failed")
    sizes = judged.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("rows"))
    sizes = stable(sizes.withColumn("of_lang", F.sum("rows").over(Window.partitionBy("lang"))))
    total = sizes.agg(F.sum("rows").alias("n"), F.min("of_lang").alias("least")).first()
    rare = total["n"] is not None and total["least"] < rules.least <= total["n"]
    own = F.when(F.col("rows") >= rules.least, F.to_json(F.struct("lang", "source", F.lit(1).alias("own"))))
    lang = F.when(F.col("of_lang") >= rules.least, F.to_json(F.struct("lang")))
    everything = F.lit("all" if rare else None).cast("string")
    # A row counts in its own group and in the wider ones that some small group is judged by.
    wanted = F.min("rows").over(Window.partitionBy("lang")) < rules.least
    feeds = F.array_compact(F.array(own, F.when(wanted, lang), everything))
    groups = sizes.select(F.col("lang").alias("l"), F.col("source").alias("s"), F.coalesce(own, lang, everything).alias("g"), feeds.alias("feeds"))
    groups = stable(groups.coalesce(1))
    grouped = rows.join(groups, same(F.col("lang"), F.col("l")) & same(F.col("source"), F.col("s")), "left").drop("l", "s")
    found = estimates(grouped.where("not base_failed").select(F.explode("feeds").alias("g"), *X), rules)
    cutoff = chi2_quantile(1 - rules.alpha, DIMS)
    distance = F.when(~F.col("base_failed"), squared_distance())
    return (
        grouped.join(found, "g", "left")
        .withColumn("distance", distance)
        .withColumn("kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cutoff))
        .select(
            "doc_id", "row_key", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "base_failed", "distance", "kept",
        )
    )


def without_rejects(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:  # noqa: B008
    """The rows of ``docs`` that the rules keep, all columns."""
    bad = stable(quality_report(docs, rules).where("not kept").select(F.col("row_key").alias("bad_key"), F.col("doc_id").alias("bad_id")).distinct())
    row = F.struct(*docs.columns).alias("whole_row")
    keyed = docs.select(row, "doc_id", F.xxhash64("doc_id", "text", "lang", "source").alias("row_key"))
    kept = keyed.join(bad, (F.col("row_key") == F.col("bad_key")) & same(F.col("doc_id"), F.col("bad_id")), "left_anti")
    return kept.select(*[F.col("whole_row")[c].alias(c) for c in docs.columns])
