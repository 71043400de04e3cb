import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallymart.operators import churn, marts
from tallymart.session import scratch_path, shared_dir, stable
from tallymart.sources import feeds, readers, schemas, tables, writers


def test_csv_refuses_an_existing_path(spark, tables, tmp_path):
    path = str(tmp_path / "out")
    writers.write_csv(feeds.clients(tables), path)
    with pytest.raises(AnalysisException):
        writers.write_csv(feeds.clients(tables), path)
    writers.write_csv(feeds.clients(tables).limit(3), path, mode="overwrite")
    assert readers.read_csv_strings(spark, path).count() == 3


def test_bad_lines_are_kept_apart(spark, tmp_path):
    path = tmp_path / "orders.csv"
    path.write_text(
        "order_id,client_id,order_amount,order_date,city,loyalty_level\n"
        "1,a,10.5,2024-01-01,X,gold\n2,b,many,2024-01-02,Y,basic\n3,c,1,2024-01-03,Z,basic\n"
    )
    rows = readers.read_csv(spark, str(path), schemas.ORDERS)
    assert [r["order_id"] for r in readers.accepted(rows).collect()] == ["1", "3"]
    assert readers.accepted(rows).select("order_id").count() == 2
    assert "many" in readers.rejected(rows).first()["_corrupt_record"]
    assert readers.rejected(rows).count() == 1
    text = readers.read_csv_strings(spark, str(path))
    assert [r["order_amount"] for r in readers.typed(text, schemas.ORDERS).collect()] == [10.5, None, 1.0]
    failures = {r["column"]: r["failures"] for r in readers.cast_failures(text, schemas.ORDERS).collect()}
    assert failures["order_amount"] == 1 and failures["order_id"] == 0


def test_null_region_comes_back_from_its_partition(spark, tables, tmp_path):
    path = str(tmp_path / "features")
    rows = churn.churn_features(feeds.transactions(tables), feeds.known_customers(tables))
    writers.write_partitioned(rows, path, "region", rows_per_file=10)
    back = readers.read_parquet(spark, path)
    assert back.columns[-1] == "region"
    assert back.where("region IS NULL").count() == rows.where("region IS NULL").count() > 0
    plan = back.where("region = 'ASIA'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(region" in plan


def test_missing_columns_read_as_null(spark, tmp_path):
    path = str(tmp_path / "tx")
    spark.createDataFrame([("c", 1.0, "extra")], "customer_id string, tx_amount double, more string").write.parquet(path)
    row = readers.read_parquet(spark, path, schemas.CHURN_TRANSACTIONS).first()
    assert row.asDict() == {"customer_id": "c", "tx_amount": 1.0, "tx_date": None}


def test_json_round_trip(spark, tmp_path):
    path = str(tmp_path / "people")
    rows = [("a", dt.date(2020, 1, 2), "X"), ("b", None, None)]
    writers.write_json(spark.createDataFrame(rows, schemas.CUSTOMERS), path)
    assert sorted(tuple(r) for r in readers.read_json(spark, path, schemas.CUSTOMERS).collect()) == rows


NESTED = "a bigint, b string, d date, n struct<k: int, t: array<string>>"


def json_file(tmp_path, *lines):
    path = tmp_path / "lines.json"
    path.write_text("\n".join(lines))
    return str(path)


def test_json_lines_that_fit(spark, tmp_path):
    good = [
        '{"a":1,"b":"x","d":"2024-01-02","n":{"k":1,"t":["p"]}}',
        '{"a":5,"b":7,"extra":{"a":"no"}}',
        "  {}\t",
        '{"a":null,"n":null}',
        '{"b":"}  {","a":3}',
        '{"b":"\\" } {"}',
        '{"x":[{},{"y":{}}]}',
        "",
        "   ",
    ]
    rows = readers.read_json_lines(spark, json_file(tmp_path, *good), NESTED)
    assert readers.rejected(rows).count() == 0
    assert [r["a"] for r in readers.accepted(rows).collect()] == [1, 5, None, None, 3, None, None]


@pytest.mark.parametrize(
    "line",
    [
        '{"a":"no","b":"x"}', '{"a":1.5}', '{"a":99999999999999999999}', '{"d":"2024-13-45"}', '{"n":{"k":"bad","t":["p"]}}', '{"n":7}',
        '{"n":{"t":"p"}}', '{"a":4', "[1,2]", '"text"', "null", "7", '[{"a":8}]', '{"a":9} trailing', '{"a":9}{"a":8}', '{"a":9} {"b":"}"}', "text",
    ],
)
def test_json_lines_that_do_not_fit(spark, tmp_path, line):
    rows = readers.read_json_lines(spark, json_file(tmp_path, '{"a":1}', line, '{"a":2}'), NESTED)
    assert [r["_corrupt_record"] for r in readers.rejected(rows).collect()] == [line]
    # the verdict does not hang on the columns asked for
    assert [r["b"] for r in readers.accepted(rows).select("b").collect()] == [None, None]
    assert readers.accepted(rows).count() == 2 and readers.rejected(rows).select("n").count() == 1


def test_long_texts_in_json_lines(spark, tmp_path):
    path = json_file(tmp_path, '{"b":"' + '\\\\ } {' * 100_000 + '"}', '{"b":"' + "x" * 1_000_000 + '"}{}')
    rows = readers.read_json_lines(spark, path, NESTED)
    assert (readers.accepted(rows).count(), readers.rejected(rows).count()) == (1, 1)


def test_rerun_of_the_null_region(spark, tmp_path):
    path = str(tmp_path / "regions")
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "v int, region string")
    writers.write_partitioned(rows, path)
    writers.write_partitioned(rows.where("region IS NULL").withColumn("v", -F.col("v")), path, only_present=True)
    assert sorted(map(tuple, readers.read_parquet(spark, path).collect()), key=str) == [(-3, None), (1, "a"), (2, "b")]
    writers.write_partitioned(rows.where("v = 1"), path)
    assert readers.read_parquet(spark, path).count() == 1


def test_history_takes_a_run_once(spark, tmp_path):
    path = str(tmp_path / "history")
    rows = spark.createDataFrame([(1, "a"), (2, None)], "v int, w string")
    assert writers.append_run(rows, path, "2024-01-01/x y%")
    assert not writers.append_run(rows, path, "2024-01-01/x y%")
    assert writers.append_run(rows.limit(0), path, "empty")
    broken = rows.withColumn("w", F.raise_error(F.lit("lost")))
    with pytest.raises(Exception, match="lost"):
        writers.append_run(broken, path, "late")
    assert writers.append_run(rows.limit(1), path, "late")
    found = readers.read_history(spark, path, "v int, w string")
    assert sorted(map(tuple, found.select("v", "w", "run").collect())) == [(1, "a", "2024-01-01/x y%"), (1, "a", "late"), (2, None, "2024-01-01/x y%")]
    assert {r["run"]: r["rows"] for r in readers.history_runs(spark, path).collect()} == {"2024-01-01/x y%": 2, "empty": 0, "late": 1}


def test_two_jobs_of_one_run(spark, tmp_path):
    """The second finds the folder taken when it is ready, and leaves nothing."""
    path, paths = str(tmp_path / "history"), spark._jvm.org.apache.hadoop.fs
    rows = spark.createDataFrame([(1,)], "v int")
    assert writers.append_run(rows, path, "r")
    rows.write.json(f"{path}/_attempts/other")
    assert not writers._moved(spark, paths.Path(f"{path}/_attempts/other"), paths.Path(f"{path}/run=r"))
    assert readers.read_history(spark, path, "v int").count() == 1
    assert not (tmp_path / "history" / "_attempts" / "other").exists()


def test_document_is_one_file(spark, tmp_path):
    path = tmp_path / "doc"
    writers.write_document(spark.createDataFrame([("text",)], "content string").repartition(4), str(path))
    assert len(list(path.glob("part-*"))) == 1


def test_catalog(spark, tables):
    from tallymart.sources import tables as catalog

    name = scratch_path(spark, "sales").rsplit("/", 1)[1].replace("-", "_")
    path = scratch_path(spark, "sales-files")
    writers.save_table(feeds.sales(tables), "tallymart_test", name, path)
    assert name in catalog.list_tables(spark, "tallymart_test")
    assert catalog.list_tables(spark, "no_such_database") == []
    described = {r["col_name"]: r["data_type"] for r in catalog.describe_table(spark, f"tallymart_test.{name}").collect()}
    assert described["amount"] == "double" and described["Type"] == "EXTERNAL"
    assert catalog.first_rows(spark.table(f"tallymart_test.{name}"), "id", 10).count() == 10


def test_stable_rows_live_in_the_shared_folder(spark):
    rows = stable(spark.range(10).toDF("n"))
    assert rows.count() == 10
    assert all(shared_dir(spark) in f for f in rows.inputFiles())


def test_customer_and_labelled_rows(spark):
    df = spark.createDataFrame([("b", 1), ("a", None), ("c", 0)], "customer_id string, churn_label int")
    df.createOrReplaceTempView("people_rows")
    assert [r["customer_id"] for r in tables.customer_rows(spark, "people_rows", 2).collect()] == ["a", "b"]
    assert [r["customer_id"] for r in tables.labelled_rows(spark, "people_rows", limit=1).collect()] == ["b"]
    spark.range(6000).selectExpr("cast(id AS string) AS customer_id", "1 AS churn_label").createOrReplaceTempView("many_rows")
    assert tables.customer_rows(spark, "many_rows").count() == 6000
    assert tables.labelled_rows(spark, "many_rows").count() == 6000
    assert "many_rows" not in tables.list_tables(spark, "default")


def test_statistics_of_every_customer(spark):
    rows = spark.range(300).selectExpr("cast(id AS string) AS customer_id", "1.5 AS tx_amount", "date '2024-01-01' AS tx_date")
    assert marts.transaction_statistics(rows).count() == 300
    assert marts.transaction_statistics(rows, limit=100).count() == 100


def test_ragged_lines_are_rejected(spark, tmp_path):
    path = tmp_path / "orders.csv"
    head = "order_id,client_id,order_amount,order_date,city,loyalty_level\n"
    path.write_text(head + "1,a,1,2024-01-01,X,gold\n2,b,1,2024-01-02,Y,basic,more,more\n3,c\n")
    rows = readers.read_csv(spark, str(path), schemas.ORDERS)
    assert [r["order_id"] for r in readers.accepted(rows).collect()] == ["1"]
    assert readers.rejected(rows).count() == 2
    assert readers.accepted(rows).select("city").collect() == [("X",)]
    text = readers.read_csv(spark, str(path), ", ".join(f"{c} string" for c in head.strip().split(",")))
    assert readers.rejected(text).count() == 2


def test_swapped_columns_fail(spark, tmp_path):
    path = tmp_path / "clients.csv"
    path.write_text("client_id,city,name,loyalty_level\n1,a,b,c\n")
    with pytest.raises(Exception, match="header"):
        readers.read_csv(spark, str(path), schemas.CLIENTS).collect()


def test_texts_come_back_from_csv(spark, tmp_path):
    path = str(tmp_path / "texts")
    names = ["  lead", "trail ", " ", "", None, 'a "b", c', "two\nlines", "back\\", "\t"]
    rows = [(str(i), n, "x", "y") for i, n in enumerate(names)]
    writers.write_csv(spark.createDataFrame(rows, schemas.CLIENTS), path)
    back = readers.accepted(readers.read_csv(spark, path, schemas.CLIENTS, line_breaks=True)).collect()
    assert sorted(tuple(r) for r in back) == rows


def test_scratch_leaves_nothing_behind(spark, tables):
    from pathlib import Path

    from tallymart.plans import QUERIES
    from tallymart.session import scratch

    folder = Path(shared_dir(spark)) / "tallymart"
    before = set(folder.glob("*"))
    listed = [r[0] for r in spark.sql("SHOW DATABASES").collect()]
    with scratch():
        assert QUERIES["catalog_null_profile"](spark, tables.folder).count() == 1
        assert QUERIES["catalog_tables"](spark, tables.folder).count() == 2
        assert QUERIES["quality_report"](spark, tables.folder).count() == 14
        assert set(folder.glob("*")) - before
    assert set(folder.glob("*")) == before
    assert [r[0] for r in spark.sql("SHOW DATABASES").collect()] == listed


def test_database_outlives_the_folder_of_its_first_table(spark, tables):
    from tallymart.session import scratch

    database = "tallymart_lasting"
    with scratch():
        with scratch():
            writers.save_table(feeds.sales(tables), database, "first_rows", scratch_path(spark, "first"))
            spark.sql(f"DROP TABLE {database}.first_rows")
        assert not spark.catalog.databaseExists(database)
        writers.save_table(feeds.sales(tables), database, "second_rows", scratch_path(spark, "second"))
        assert spark.table(f"{database}.second_rows").count() > 0
        spark.sql(f"DROP TABLE {database}.second_rows")
    assert not spark.catalog.databaseExists(database)
