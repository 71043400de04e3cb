"""Feature preparation: filters, caps, scaling, normalising, category indexes."""

from __future__ import annotations

from math import sqrt

from pyspark.ml import Pipeline
from pyspark.ml.feature import Normalizer, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions.defaults import MAX_AGE_YEARS, MAX_INCOME
from tallymart.functions.rules import cap, existing

# The numeric features of the churn model, in model order.
CHURN_FEATURES = [
    "avg_tx_amount",
    "total_tx_count",
    "days_since_last_tx",
    "customer_lifetime_days",
    "tx_frequency",
    "std_tx_amount",
]
# The measure from which the churn flag is computed.
CHURN_LABEL_INPUTS = ["days_since_last_tx"]


def valid_scoring_rows(df: DataFrame) -> DataFrame:
    """Age within 0 and 100 and a non-negative income, neither missing."""
    return df.where(F.col("age").isNotNull() & F.col("income").isNotNull()).where(
        F.col("age").between(0, MAX_AGE_YEARS) & (F.col("income") >= 0)
    )


def capped_income(df: DataFrame, limit: float = MAX_INCOME) -> DataFrame:
    return df.withColumn("income", cap("income", limit))


def assemble(df: DataFrame, columns: list[str], output: str = "features", invalid: str = "error") -> DataFrame:
    """One vector per row. ``invalid`` is "error" or "skip" (drop rows with NULL or NaN)."""
    return VectorAssembler(inputCols=columns, outputCol=output, handleInvalid=invalid).transform(df)


def standardise(df: DataFrame, source: str = "features", output: str = "scaled_features") -> DataFrame:
    """Subtract the mean and divide by the sample deviation."""
    scaler = StandardScaler(inputCol=source, outputCol=output, withMean=True, withStd=True)
    return scaler.fit(df).transform(df)


def standardise_columns(df: DataFrame, columns: list[str], population: bool = False, suffix: str = "_scaled") -> DataFrame:
    """Standardise scalar columns, by the sample or the population deviation; constants become 0."""
    deviation = F.stddev_pop if population else F.stddev_samp
    row = df.agg(*[F.avg(c).alias(f"{c}_mean") for c in columns], *[deviation(c).alias(f"{c}_dev") for c in columns])
    stats = row.select(F.struct(*row.columns)).scalar()
    return df.withColumns(
        {
            f"{c}{suffix}": (F.col(c) - stats[f"{c}_mean"])
            / F.when(stats[f"{c}_dev"] == 0, 1.0).otherwise(stats[f"{c}_dev"])
            for c in columns
        }
    )


def population_factor(rows: int) -> float:
    """Turns values scaled by the sample deviation into values scaled by the population deviation."""
    return sqrt(rows / (rows - 1)) if rows > 1 else 1.0


def normalise(df: DataFrame, source: str = "scaled_features", output: str = "normalized_features") -> DataFrame:
    """Divide each vector by its Euclidean length; a zero vector stays zero."""
    return Normalizer(inputCol=source, outputCol=output, p=2.0).transform(df)


def scaled_scoring_features(df: DataFrame) -> DataFrame:
    """Filter, cap, assemble, standardise and normalise the scoring customers."""
    rows = capped_income(valid_scoring_rows(df))
    return normalise(standardise(assemble(rows, ["age", "income"])))


def index_categories(df: DataFrame, column: str = "region", output: str | None = None) -> DataFrame:
    """Index by falling frequency, ties in name order; NULL and unseen values get the last index."""
    indexer = StringIndexer(
        inputCol=column,
        outputCol=output or f"{column}_index",
        stringOrderType="frequencyDesc",
        handleInvalid="keep",
    )
    return indexer.fit(df).transform(df)


def churn_stages(
    df: DataFrame, exclude_leaky: bool = False, gaps: str = "fill"
) -> tuple[list[StringIndexer | SQLTransformer | VectorAssembler], list[str]]:
    """The unfitted feature stages and the names of the vector's entries.

    A customer with one transaction has no deviation. ``gaps="fill"`` reads it as 0 and adds an entry that says
    so; ``gaps="skip"`` leaves such customers out.
    """
    if gaps not in ("fill", "skip"):
        raise ValueError(f"unknown way with gaps: {gaps}")
    names = [c for c in existing(df, CHURN_FEATURES) if not (exclude_leaky and c in CHURN_LABEL_INPUTS)]
    stages: list[StringIndexer | SQLTransformer | VectorAssembler] = []
    inputs = dict(zip(names, names, strict=True))
    if gaps == "fill" and "std_tx_amount" in names:
        filled = "coalesce(std_tx_amount, 0.0D) AS _std_filled, cast(std_tx_amount IS NULL AS double) AS _std_missing"
        stages.append(SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"))
        inputs |= {"std_tx_amount": "_std_filled", "std_missing": "_std_missing"}
        names = [*names, "std_missing"]
    if "region" in df.columns:
        stages.append(StringIndexer(inputCol="region", outputCol="region_index", handleInvalid="keep"))
        names = [*names, "region_index"]
    columns = [inputs.get(n, n) for n in names]
    stages.append(VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="error" if gaps == "fill" else "skip"))
    return stages, names


def churn_vectors(train: DataFrame, rows: DataFrame) -> tuple[DataFrame, list[str]]:
    """Fit the feature stages on ``train`` only and apply them to ``rows``."""
    stages, names = churn_stages(train)
    return Pipeline(stages=stages).fit(train).transform(rows), names


def vector_columns(df: DataFrame, vector: str, names: list[str]) -> DataFrame:
    """Add the entries of a vector column as double columns."""
    entries = vector_to_array(F.col(vector))
    return df.withColumns({name: entries[i] for i, name in enumerate(names)})
