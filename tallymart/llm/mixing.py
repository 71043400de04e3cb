"""Mix sources to target weights by Pareto order sampling (native).

Every source gets a target number of words. Within a source the expected number of copies of a document grows
with a weight of its own (by default the bit length of its word count) and is solved so that the expected words
equal the target, nobody above ``most`` copies. The whole part of that expectation is allocated for certain; the
fraction is an inclusion probability p. Documents are ranked by random odds over inclusion odds,
u (1 - p) / ((1 - u) p), and the sample takes them in this order until the words left are used up, to within half
a document. The random number hangs on the document id alone, so reruns agree.

Scale: one pass over the texts gives narrow rows; the shares are solved on one row per source and weight class;
the cut of the order is found from word counts of 65,536 ranges of the order value and a sort of the one range
per source that holds the cut. No source is gathered anywhere, and applying the plan needs no shuffle of texts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.native import fill, fresh, same, unit, word_count
from tallymart.session import stable

RANGES = 65_536


@dataclass(frozen=True)
class Mix:
    """``weights`` go to the sources by code point (NULL last) and repeat; the sources share ``share`` times all words."""

    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    share: float = 1.5
    most: float = 2.0
    seed: str = "mix"


def length_class(size: Column) -> Column:
    """Bits of the word count: 0 for no words, 1, 2, 2, 3, 3, 3, 3, ... An integer weight per document."""
    return F.when(size > 0, F.length(F.conv(size.cast("string"), 10, 2))).otherwise(0).cast("int")


def measured(docs: DataFrame, mix: Mix) -> DataFrame:
    """doc_id, source, size, class and random number per row; texts are read here only."""
    return _sized(docs.select("doc_id", "source", "text"), mix)


def _sized(rows: DataFrame, mix: Mix) -> DataFrame:
    sized = word_count(rows, "text", "size").withColumn("u", unit("doc_id", seed=mix.seed))
    return sized.withColumn("class", length_class(F.col("size")))


def targets(totals: DataFrame, mix: Mix) -> DataFrame:
    """Target words per source from (source, source_size): the budget by weight, excess over the cap dealt out again."""
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(float(w)) for w in mix.weights]), place % len(mix.weights))
    rows = totals.withColumns({"weight": weight, "cap": F.col("source_size") * F.lit(float(mix.most))}).withColumn(
        "budget", F.sum("source_size").over(Window.partitionBy(F.lit(0))) * F.lit(float(mix.share))
    )
    return fill(rows, [], "weight", "cap", "budget", "target").select("source", "source_size", "target")


def order_value(u: Column, p: Column) -> Column:
    """q / (1 + q) for q = odds of u over odds of p: the same order as q, within 0 and 1."""
    return u * (1 - p) / (u * (1 - p) + (1 - u) * p)


def plan(rows: DataFrame, mix: Mix) -> DataFrame:
    """A row per source and class: source_size, target, whole copies, probability p, and the last row the sample takes.

    ``rows`` are measured rows, stored, since they are read three times.
    """
    classes = stable(rows.groupBy("source", "class").agg(F.sum("size").alias("words")))
    goal = targets(classes.groupBy("source").agg(F.sum("words").alias("source_size")), mix).withColumnRenamed(
        "source", "goal_source"
    )
    shares = fill(
        classes.join(goal, same(F.col("source"), F.col("goal_source")))
        .drop("goal_source")
        .withColumns({"weight": F.col("words").cast("double") * F.col("class"), "cap": F.col("words") * F.lit(float(mix.most))}),
        ["source"],
        "weight",
        "cap",
        "target",
        "expected",
    )
    copies = F.coalesce(F.try_divide("expected", "words"), F.lit(0.0))
    # Added up in the order of the classes, so that the last digits do not depend on a shuffle.
    in_order = Window.partitionBy("source").orderBy("class").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    chances = stable(
        shares.withColumn("copies", copies)
        .withColumn("whole", F.floor("copies"))
        .withColumn("p", F.col("copies") - F.col("whole"))
        .withColumn("left", F.sum(F.col("p") * F.col("words")).over(in_order))
        .select("source", "class", "source_size", "target", "whole", "p", "left")
    )
    drawn = _with_chances(rows, chances).where("p > 0").withColumn("v", order_value(F.col("u"), F.col("p")))
    drawn = drawn.withColumn("range", F.floor(F.col("v") * RANGES))
    sums = drawn.groupBy("source", "range").agg(F.sum("size").alias("words"), F.max("left").alias("left"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("range"))
    cut = (
        sums.withColumn("upto", upto)
        .where(F.col("upto") > F.col("left"))
        .groupBy("source")
        .agg(F.min(F.struct("range", (F.col("upto") - F.col("words")).alias("before"))).alias("cut"))
        .select(F.col("source").alias("cut_source"), "cut.range", "cut.before")
    )
    cut = stable(cut)
    near = drawn.join(cut.withColumnRenamed("range", "cut_range"), same(F.col("source"), F.col("cut_source")) & (F.col("range") == F.col("cut_range")))
    used = F.sum("size").over(
        Window.partitionBy("source").orderBy("v", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    last = (
        near.withColumn("used", used + F.col("before"))
        .where(F.col("used") - F.col("size") / 2 <= F.col("left"))
        .groupBy("source")
        .agg(F.max(F.struct("v", "doc_id", "size")).alias("last"))
        .select(F.col("source").alias("last_source"), "last")
    )
    return stable(
        chances.join(cut, same(F.col("source"), F.col("cut_source")), "left")
        .join(last, same(F.col("source"), F.col("last_source")), "left")
        .select("source", "class", "source_size", "target", "whole", "p", "range", "last")
    )


def _with_chances(rows: DataFrame, chances: DataFrame) -> DataFrame:
    """Rows with what their source and class gets. No hint: Spark broadcasts the summary only while it is small."""
    other = chances.withColumnsRenamed({"source": "their_source", "class": "their_class"})
    return rows.join(other, same(F.col("source"), F.col("their_source")) & (F.col("class") == F.col("their_class")), "left").drop(
        "their_source", "their_class"
    )


def taken(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """Measured rows (with any other columns) and how many copies of each the mix takes.

    Rows that agree in doc_id and size move together; a document without words is never taken.
    """
    v = order_value(F.col("u"), F.col("p"))
    place = F.floor(v * RANGES)
    here = F.struct(v.alias("v"), F.col("doc_id").alias("doc_id"), F.col("size").alias("size"))
    sampled = (F.col("p") > 0) & (
        F.col("range").isNull() | (place < F.col("range")) | ((place == F.col("range")) & F.coalesce(here <= F.col("last"), F.lit(False)))
    )
    copies = F.when(F.col("size") > 0, F.col("whole") + F.coalesce(sampled, F.lit(False)).cast("long")).otherwise(0)
    return (
        _with_chances(rows, planned)
        .withColumn("copies", copies.cast("long"))
        .drop("whole", "p", "range", "last")
        .withColumn("taken", F.col("copies") * F.col("size"))
    )


def mix_report(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:  # noqa: B008
    """doc_id, source, size, source_size, target, copies, taken for every row of ``docs`` (doc_id, text, source).

    NULL texts and texts without words have size 0 and are never taken; a NULL source is a source of its own, the
    last; NULL ids draw one number; an empty table gives no rows; other columns are ignored.
    """
    rows = stable(measured(docs, mix))
    return taken(rows, plan(rows, mix)).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:  # noqa: B008
    """The mix itself: the columns of ``docs``, a row for each copy taken.

    The plan is made from narrow rows; applying it reads the texts once more and shuffles none of them.
    """
    planned = plan(stable(measured(docs, mix)), mix)
    (whole,) = fresh(docs, "whole_row")
    rows = docs.select(F.struct(*docs.columns).alias(whole), "doc_id", "text", "source")
    counted = taken(_sized(rows, mix), planned).where("copies > 0")
    repeated = counted.select(whole, F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return repeated.select(*[F.col(whole)[c].alias(c) for c in docs.columns])
