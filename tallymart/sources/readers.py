"""Readers. Schemas are declared, so no pass over the data is spent on inference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.sources.writers import CSV_OPTIONS


def _struct(schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def read_csv_strings(spark: SparkSession, path: str, sep: str = ",", line_breaks: bool = False) -> DataFrame:
    """CSV with a header, every column as text. Files whose values hold line breaks cannot be split."""
    return spark.read.options(**CSV_OPTIONS).csv(path, sep=sep, multiLine=line_breaks)


def typed(df: DataFrame, schema: str) -> DataFrame:
    """Cast text columns to a schema; a value that does not parse becomes NULL instead of an error."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in _struct(schema).fields])


def read_csv(spark: SparkSession, path: str, schema: str, sep: str = ",", line_breaks: bool = False) -> DataFrame:
    """CSV with a header and a declared schema; ``_corrupt_record`` holds a line that does not fit.

    The header must name the columns in the declared order, or reading fails. A line with too many or too few
    values, or with a value that does not parse, is corrupt whichever columns are asked for: every line is
    parsed in full, and the verdict hangs on all columns. ``accepted`` and ``rejected`` tell the rows apart.
    """
    fields = _struct(schema).fields
    texts = [T.StructField(f.name, T.StringType()) for f in fields]
    with_line = T.StructType([*texts, T.StructField("_line", T.StringType())])
    options = {**CSV_OPTIONS, "columnNameOfCorruptRecord": "_line", "columnPruning": False, "enforceSchema": False}
    lines = spark.read.options(**options).schema(with_line).csv(path, sep=sep, multiLine=line_breaks)
    raw = F.concat_ws(sep, *[F.coalesce(F.col(f.name), F.lit("")) for f in fields])
    bad = F.col("_line").isNotNull() | (F.length(raw) < 0)  # the second never holds, but reads every column
    for f in fields:
        if not isinstance(f.dataType, T.StringType):
            bad = bad | (F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull())
    values = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in fields]
    return lines.select(*values, F.when(bad, F.coalesce("_line", raw)).alias("_corrupt_record"))


def accepted(df: DataFrame) -> DataFrame:
    return df.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record")


def rejected(df: DataFrame) -> DataFrame:
    """The lines that do not fit: the values that could be read, and all texts."""
    return df.where(F.col("_corrupt_record").isNotNull())


def cast_failures(df: DataFrame, schema: str) -> DataFrame:
    """Per column: how many non-NULL texts do not parse as the declared type. One pass."""
    fields = _struct(schema).fields
    counts = df.agg(
        *[
            F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(f.name)
            for f in fields
        ]
    )
    pairs = F.array(*[F.struct(F.lit(f.name).alias("column"), F.col(f.name).alias("failures")) for f in fields])
    return counts.select(F.inline(pairs))


def read_parquet(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Parquet; with a schema only the declared columns are read, and a missing one reads as NULL."""
    reader = spark.read
    return (reader.schema(_struct(schema)) if schema else reader).parquet(path)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with a declared schema; what does not fit reads as NULL. ``read_json_lines`` tells such lines apart."""
    return spark.read.schema(_struct(schema)).json(path)


#: Two objects on one line. Between objects that are no text, valid JSON has a comma.
_GLUED = r"\}\s*+\{"
_TEXTS = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with a declared schema; ``_corrupt_record`` holds a line that does not fit.

    A line fits if it is one JSON object, and whatever declared field it has, at any depth, is of the declared type.
    Missing fields and explicit nulls read as NULL, further fields are ignored, numbers are texts where a text is
    declared. Lines are read as texts and parsed in full, so the verdict hangs on all columns, whichever are asked
    for. What could be read of a bad line stands in its columns. Blank lines are no records. ``accepted`` and
    ``rejected`` tell the rows apart.
    """
    fields = _struct(schema).fields
    with_line = T.StructType([*fields, T.StructField("_line", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_line"}  # options also keep the parser from skipping columns
    lines = spark.read.text(path).select(F.col("value").alias("_text"), F.trim(F.translate("value", "\t\r", "  ")).alias("_bare"))
    parsed = lines.where("_bare <> ''").withColumn("_record", F.from_json("_text", with_line, options))
    whole = F.col("_bare").startswith("{") & F.col("_bare").endswith("}")
    glued = F.col("_bare").rlike(_GLUED) & F.regexp_replace("_bare", _TEXTS, "").rlike(_GLUED)
    bad = ~whole | glued | F.col("_record._line").isNotNull()
    values = [F.col(f"_record.`{f.name}`").alias(f.name) for f in fields]
    return parsed.select(*values, F.when(bad, F.col("_text")).alias("_corrupt_record"))


def read_history(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of all finished runs of a history written by ``append_run``, with ``run``."""
    fields = T.StructType([*_struct(schema).fields, T.StructField("run", T.StringType())])
    return spark.read.schema(fields).json(path)


def history_runs(spark: SparkSession, path: str) -> DataFrame:
    """The manifests of a history: run, rows, columns."""
    return spark.read.schema("run string, rows bigint, columns array<string>").option("pathGlobFilter", "manifest.json").json(f"{path}/run=*/_manifest")
