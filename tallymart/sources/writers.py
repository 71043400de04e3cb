"""Writers. The default mode states what each report needs: fail, overwrite or append."""

from __future__ import annotations

import json
import uuid
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.session import on_release

# How CSV files spell what plain text cannot; readers use the same.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "nullValue": r"\N",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "errorifexists") -> None:
    r"""CSV with a header. Texts come back as they are; NULL is written as ``\N``, empty text as ``""``."""
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path, sep=sep)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    by: str = "region",
    rows_per_file: int = 5_000_000,
    mode: str = "overwrite",
    only_present: bool = False,
) -> None:
    """Parquet in one folder per value of ``by``.

    Overwriting replaces the whole table; with ``only_present`` it replaces the folders of the values that the rows
    have and leaves the others, so one region can be run again. NULL has a folder like any value.

    The rows of a value are brought together so that small values get one file; partitions over the
    advisory size are split at run time, so a value that holds a third of all rows is written by as
    many tasks as its size asks for.
    """
    gathered = df.hint("rebalance", F.col(by))
    how = "dynamic" if only_present else "static"
    writer = gathered.write.mode(mode).option("partitionOverwriteMode", how).option("maxRecordsPerFile", rows_per_file)
    writer.partitionBy(by).parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def append_json(df: DataFrame, path: str) -> None:
    """Add rows to a history of JSON lines, for example one metrics row per run."""
    write_json(df, path, mode="append")


def append_run(df: DataFrame, path: str, run: str) -> bool:
    """Add the rows of a run to a history of JSON lines, once; tell whether they were added.

    A run is a folder ``run=<id>`` with its rows and a manifest. Rows are written beside the history and moved into it
    by one rename that fails where the folder exists. So a run that broke off leaves nothing that is read, and may be
    repeated; a run that was finished adds nothing when it is repeated, also not by two jobs at once.
    """
    spark = df.sparkSession
    paths = spark._jvm.org.apache.hadoop.fs
    final = paths.Path(f"{path}/run={quote(run, safe='')}")
    attempt = f"{path}/_attempts/{uuid.uuid4().hex}"
    files = final.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(final):
        return False
    df.write.json(attempt)
    written = spark.read.text(attempt).count()  # a row per line
    line = json.dumps({"run": run, "rows": written, "columns": df.columns})
    out = files.create(paths.Path(f"{attempt}/_manifest/manifest.json"))
    out.write(bytearray(line.encode()))
    out.close()
    return _moved(spark, paths.Path(attempt), final)


def _moved(spark: SparkSession, source, final) -> bool:
    """Rename a folder unless the name is taken; the folder of the one that comes second is deleted."""
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), spark._jsc.hadoopConfiguration())
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    never = spark._sc._gateway.new_array(rename, 1)
    never[0] = rename.NONE
    try:
        context.rename(source, final, never)
        return True
    except Py4JJavaError as failed:
        if "FileAlreadyExistsException" not in failed.java_exception.getClass().getName():
            raise
        context.delete(source, True)
        return False


def write_document(df: DataFrame, path: str) -> None:
    """One text file from a report of a few rows with a single string column."""
    df.coalesce(1).write.mode("overwrite").text(path)


def save_table(df: DataFrame, database: str, table: str, path: str) -> None:
    """An external table of the session catalog.

    A missing database is created in the warehouse, never inside a folder that ends with its tables. Inside a
    ``scratch`` block that creates it, it goes at the end of the block, unless it holds other tables by then.
    """
    spark = df.sparkSession
    if not spark.catalog.databaseExists(database):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        on_release(lambda: drop_empty(spark, database))
    df.write.mode("overwrite").option("path", path).saveAsTable(f"`{database}`.`{table}`")


def drop_empty(spark: SparkSession, database: str) -> None:
    """Drop a database unless it holds tables."""
    if spark.catalog.databaseExists(database) and not [t for t in spark.catalog.listTables(database) if not t.isTemporary]:
        spark.sql(f"DROP DATABASE `{database}` RESTRICT")


def save_model(model: PipelineModel, path: str) -> None:
    """The whole fitted pipeline, feature stages included, so that scoring can be replayed."""
    model.write().overwrite().save(path)
