"""Column helpers shared by the corpus operators; only DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def spaced(text: Column | str) -> Column:
    """The text with one space between words and none around them; plain byte replacements, no regular expression.

    Runs of over sixteen white-space characters are rare; texts with one take the pattern.
    """
    t = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    for c in "\t\n\x0b\x0c\r":
        t = F.replace(t, F.lit(c), F.lit(" "))
    for _ in range(4):
        t = F.replace(t, F.lit("  "), F.lit(" "))
    return t


def _trimmed(t: Column) -> Column:
    return F.trim(F.when(F.contains(t, F.lit("  ")), F.regexp_replace(t, " +", " ")).otherwise(t))


def words(rows: DataFrame, text: str = "text", name: str = "w") -> DataFrame:
    """``rows`` with the array of a text's words in place of the text; none for NULL."""
    (spread,) = fresh(rows, "spread")
    rows = once(rows, spread, spaced(text)).drop(text)
    t = _trimmed(F.col(spread))
    return once(rows, name, F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, " "))).drop(spread)


def word_count(rows: DataFrame, text: str, name: str) -> DataFrame:
    """``rows`` with the number of words of a text in place of the text."""
    first, second = fresh(rows, "spread", "trimmed")
    rows = once(once(rows, first, spaced(text)).drop(text), second, _trimmed(F.col(first))).drop(first)
    gaps = F.octet_length(second) - F.octet_length(F.replace(F.col(second), F.lit(" "), F.lit("")))
    return rows.withColumn(name, F.when(F.col(second) == "", 0).otherwise(gaps + 1).cast("long")).drop(second)


def once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """``rows`` with a column that is worked out once per row.

    A generator's output is never inlined, so lambdas and filters above it that use the column many times do not
    repeat the work for each element.
    """
    return rows.select("*", F.explode(F.array(value)).alias(name))


def unit(*parts: Column | str, seed: str) -> Column:
    """A number in [0, 1) with 52 random bits that depends on the values alone, so reruns and lost tasks agree."""
    texts = [F.coalesce(F.col(p).cast("string") if isinstance(p, str) else p, F.lit("")) for p in parts]
    bits = F.conv(F.substring(F.md5(F.concat_ws("\t", F.lit(seed), *texts)), 1, 13), 16, 10)
    return bits.cast("double") / F.lit(float(2**52))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that clash with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def same(left: Column, right: Column) -> Column:
    """Equality that holds for two NULLs."""
    return left.eqNullSafe(right)


def fill(df: DataFrame, group: list[str], weight: str, cap: str, budget: str, share: str) -> DataFrame:
    """Deal ``budget`` out by ``weight``, nobody above ``cap``; what a full one leaves goes to the others.

    Going up the ratio of cap to weight, a row is full when the full ones before it and the rest at its own
    ratio fit into the budget. ``df`` is a summary (a row per source, or per source and class).
    """
    part = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    ratio, full = fresh(df, "ratio", "full")
    upto = part.orderBy(ratio).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    least = F.sum(cap).over(upto) + F.col(ratio) * (F.sum(weight).over(part) - F.sum(weight).over(upto))
    rest = F.col(budget) - F.sum(F.when(F.col(full), F.col(cap)).otherwise(0.0)).over(part)
    open_weight = F.sum(F.when(~F.col(full), F.col(weight))).over(part)
    return (
        df.withColumn(ratio, F.coalesce(F.try_divide(cap, weight), F.lit(0.0)))
        .withColumn(full, least <= F.col(budget))
        .withColumn(share, F.when(F.col(full), F.col(cap)).otherwise(rest / open_weight * F.col(weight)))
        .drop(ratio, full)
    )
