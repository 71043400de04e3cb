"""Round trips through every sink and source: what is read back must equal what was computed."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tallymart.operators import churn, models, profile
from tallymart.plans import sql_parts as q
from tallymart.plans.registry import query, rounded
from tallymart.plans.risk import base, risks
from tallymart.plans.sales import features
from tallymart.session import on_release, scratch_path
from tallymart.sources import feeds, readers, schemas, tables, writers

# Columns that the fitted pipeline adds to its input.
MODEL_COLUMNS = ["features", "region_index", "_std_filled", "_std_missing", "rawPrediction", "probability", "prediction"]


@query(f"WITH {q.ODD_CLIENTS} SELECT * FROM odd_clients")
def csv_text_round_trip(t):
    """Names with blanks around them, quotes, line breaks, empty and missing ones come back as they were."""
    path = scratch_path(t.spark, "clients")
    writers.write_csv(feeds.odd_clients(t), path)
    return readers.typed(readers.read_csv_strings(t.spark, path, line_breaks=True), schemas.CLIENTS)


@query(f"WITH {q.SHOP} SELECT * FROM shop")
def csv_typed_round_trip(t):
    path = scratch_path(t.spark, "orders")
    writers.write_csv(feeds.shop_orders(t), path, mode="overwrite")
    return readers.accepted(readers.read_csv(t.spark, path, schemas.ORDERS))


@query(
    f"""WITH {q.FEATURES} SELECT customer_id, last_tx_date, total_tx_amount, days_since_last_tx, is_churned, region
FROM features"""
)
def csv_semicolon_round_trip(t):
    path = scratch_path(t.spark, "features")
    columns = ["customer_id", "last_tx_date", "total_tx_amount", "days_since_last_tx", "is_churned", "region"]
    table = features(t).select(*columns)
    writers.write_csv(table, path, sep=";", mode="overwrite")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema.fields)
    return readers.accepted(readers.read_csv(t.spark, path, schema, sep=";"))


@query(
    f"""WITH {q.END}, {q.RAW_TX}, counts AS (
  SELECT count(*) FILTER (WHERE transaction_id LIKE '%-dup') AS bad_ids,
         count(*) FILTER (WHERE try_cast(tx_amount AS DOUBLE) IS NULL AND tx_amount IS NOT NULL) AS bad_amounts FROM raw_tx)
SELECT 'transaction_id' AS "column", bad_ids AS failures FROM counts UNION ALL SELECT 'tx_amount', bad_amounts FROM counts"""
)
def csv_cast_failures(t):
    path = scratch_path(t.spark, "raw-transactions")
    writers.write_csv(feeds.raw_transactions(t), path)
    return readers.cast_failures(readers.read_csv_strings(t.spark, path), "transaction_id bigint, tx_amount double")


@query(f"WITH {q.END}, {q.RAW_TX} SELECT customer_id, tx_amount, tx_date FROM raw_tx")
def parquet_subset_round_trip(t):
    path = scratch_path(t.spark, "transactions")
    writers.write_parquet(feeds.raw_transactions(t), path)
    return readers.read_parquet(t.spark, path, schemas.CHURN_TRANSACTIONS)


@query(f"WITH {q.FEATURES} SELECT customer_id, total_tx_count, is_churned, region FROM features")
def partitioned_round_trip(t):
    path = scratch_path(t.spark, "churn-features")
    table = features(t).select("customer_id", "total_tx_count", "is_churned", "region")
    writers.write_partitioned(table, path, "region")
    return readers.read_parquet(t.spark, path)


@query(f"WITH {q.END}, {q.PEOPLE}, {q.RAW_CUSTOMERS} SELECT * FROM raw_customers")
def json_round_trip(t):
    path = scratch_path(t.spark, "customers")
    writers.write_json(feeds.raw_customers(t), path)
    return readers.read_json(t.spark, path, schemas.CUSTOMERS)


_C = "c_custkey"
_GOOD_LINE = f"""'{{"customer_id":' || {_C} || ',"registration_date":"2001-02-03","place":{{"region":"' || r_name || '","visits":[' || {_C} % 5 || ',2]}}}}'"""
#: SQL of a line by the customer's number: cut off, a text for a date, a text in a nested list, no object, two objects,
#: and lines that only look odd.
_LINE = f"""CASE {_C} % 11 WHEN 0 THEN '{{"customer_id":' || {_C} || ',"place":{{"region":'
  WHEN 1 THEN '{{"customer_id":' || {_C} || ',"registration_date":"never"}}'
  WHEN 2 THEN '{{"customer_id":' || {_C} || ',"place":{{"region":"x","visits":["two"]}}}}'
  WHEN 3 THEN '[{{"customer_id":' || {_C} || '}}]'
  WHEN 4 THEN {_GOOD_LINE} || {_GOOD_LINE}
  WHEN 5 THEN '  {{"customer_id":' || {_C} || ',"more":"}} {{","place":null}} '
  ELSE {_GOOD_LINE} END"""
_LINE_SCHEMA = "customer_id bigint, registration_date date, place struct<region: string, visits: array<int>>"


def _json_lines(t):
    """Customers as JSON lines, every eleventh damaged in one of five ways, and blank lines between them."""
    path = scratch_path(t.spark, "lines")
    places = feeds.customer_places(t)
    lines = places.select(F.expr(_LINE).alias("value")).unionByName(places.select(F.lit(" ").alias("value")))
    lines.write.text(path)
    return readers.read_json_lines(t.spark, path, _LINE_SCHEMA)


@query(
    f"""WITH {q.PLACES} SELECT c_custkey AS customer_id, CASE WHEN c_custkey % 11 <> 5 THEN DATE '2001-02-03' END AS registration_date,
  CASE WHEN c_custkey % 11 <> 5 THEN r_name END AS region, CASE WHEN c_custkey % 11 <> 5 THEN (c_custkey % 5)::INT END AS visits
FROM places WHERE c_custkey % 11 >= 5"""
)
def json_accepted_lines(t):
    rows = readers.accepted(_json_lines(t))
    return rows.select("customer_id", "registration_date", "place.region", F.get("place.visits", F.lit(0)).alias("visits"))


@query(f"WITH {q.PLACES} SELECT {_LINE} AS line FROM places WHERE c_custkey % 11 < 5")
def json_rejected_lines(t):
    """Lines that are no object of the declared types come back as they stand in the file."""
    return readers.rejected(_json_lines(t)).select(F.col("_corrupt_record").alias("line"))


@query(
    f"""WITH {q.FEATURES} SELECT customer_id, CASE WHEN region IN ('ASIA', 'EUROPE') THEN -total_tx_count ELSE total_tx_count END AS total_tx_count,
  region FROM features WHERE region IS NULL OR region <> 'EUROPE' OR customer_id::BIGINT % 2 = 0"""
)
def region_rerun(t):
    """Two regions are written again, one of them with half of its rows; the others, NULL among them, keep theirs."""
    path = scratch_path(t.spark, "regions")
    table = features(t).select("customer_id", "total_tx_count", "region")
    writers.write_partitioned(table, path, "region")
    again = table.where("region = 'ASIA' OR region = 'EUROPE' AND cast(customer_id AS bigint) % 2 = 0")
    again = again.withColumn("total_tx_count", -F.col("total_tx_count"))
    writers.write_partitioned(again, path, "region", only_present=True)
    return readers.read_parquet(t.spark, path)


@query(
    f"""WITH {q.FEATURES}, counts AS (SELECT region, is_churned, count(*) AS "count" FROM features GROUP BY region, is_churned)
SELECT 'day/1' AS run, *, (SELECT count(*) FROM counts)::BIGINT AS run_rows FROM counts
UNION ALL SELECT 'day 2', *, (SELECT count(*) FROM counts WHERE is_churned = 1) FROM counts WHERE is_churned = 1"""
)
def json_history_runs(t):
    """A run that is repeated adds nothing, whatever it brings; each row has the rows that its run's manifest states."""
    path = scratch_path(t.spark, "run-history")
    counts = churn.region_churn_counts(features(t))
    writers.append_run(counts, path, "day/1")
    writers.append_run(counts.where("is_churned = 1"), path, "day 2")
    writers.append_run(counts.limit(1), path, "day/1")
    history = readers.read_history(t.spark, path, "region string, is_churned int, count bigint")
    runs = readers.history_runs(t.spark, path).select("run", F.col("rows").alias("run_rows"))
    return history.join(runs, "run")


@query(
    f"""WITH {q.FEATURES} SELECT region, is_churned, count(*) AS "count", 2::BIGINT AS runs FROM features
GROUP BY region, is_churned"""
)
def json_history(t):
    path = scratch_path(t.spark, "history")
    counts = churn.region_churn_counts(features(t))
    for _ in range(2):
        writers.append_json(counts, path)
    history = readers.read_json(t.spark, path, "region string, is_churned int, count bigint")
    return history.groupBy("region", "is_churned", "count").agg(F.count(F.lit(1)).alias("runs"))


@query(
    f"""WITH {q.FEATURES} SELECT sum(is_churned)::BIGINT AS churned_customers, count(*) AS total_customers,
  round(sum(is_churned) / count(*), 9) AS churn_rate FROM features"""
)
def document_round_trip(t):
    path = scratch_path(t.spark, "summary")
    totals = churn.churn_totals(features(t))
    writers.write_document(totals.select(F.to_json(F.struct(*totals.columns)).alias("content")), path)
    schema = "churned_customers bigint, total_customers bigint, churn_rate double"
    return rounded(t.spark.read.text(path).select(F.from_json("value", schema).alias("d")).select("d.*"), 9, "churn_rate")


def save_external(t, df, table: str) -> str:
    """Save under a fresh table name in the session catalog; the name is returned."""
    path = scratch_path(t.spark, table)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    writers.save_table(df, "tallymart", name, path)
    on_release(lambda: t.spark.sql(f"DROP TABLE IF EXISTS tallymart.{name}"))
    return f"tallymart.{name}"


@query(
    f"""WITH {q.SALES} SELECT count(*) AS total_rows, count(*) FILTER (WHERE amount IS NULL) AS null_amounts,
  count(*) FILTER (WHERE amount < 0) AS negative_amounts,
  round(count(*) FILTER (WHERE amount IS NULL) * 100.0::DOUBLE / count(*), 2) AS null_percentage,
  round(count(*) FILTER (WHERE amount < 0) * 100.0::DOUBLE / count(*), 2) AS negative_percentage FROM sales"""
)
def catalog_null_profile(t):
    return profile.null_and_negative(t.spark.table(save_external(t, feeds.sales(t), "sales")))


@query(f"WITH {q.BASE} SELECT * FROM base")
def catalog_first_customers(t):
    return tables.customer_rows(t.spark, save_external(t, base(t), "customer_base"))


@query(
    f"""WITH {q.RISK} SELECT customer_id, CASE WHEN activity_risk = 0 THEN composite_risk END AS churn_label FROM risk
WHERE activity_risk = 0"""
)
def catalog_labelled_rows(t):
    labelled = risks(t).select(
        "customer_id", F.when(F.col("activity_risk") == 0, F.col("composite_risk")).alias("churn_label")
    )
    return tables.labelled_rows(t.spark, save_external(t, labelled, "churn_rows"))


@query()
def model_round_trip(t):
    """Rows scored by the saved and reloaded pipeline, with the difference to the model in memory."""
    path = scratch_path(t.spark, "model")
    trained = models.train_churn_model(features(t))
    writers.save_model(trained.model, path)
    raw = trained.predictions.drop(*MODEL_COLUMNS)
    again = models.scored_rows(PipelineModel.load(path).transform(raw), "is_churned")
    before = models.scored_rows(trained.predictions, "is_churned").select("customer_id", F.col("score").alias("before"))
    return again.join(before, "customer_id").withColumn("difference", F.abs(F.col("score") - F.col("before")))


@query(
    f"""WITH {q.FEATURES} SELECT count(*) AS "rows", 0::BIGINT AS changed_scores, 0::BIGINT AS changed_classes
FROM features WHERE md5(customer_id || '|42') >= 'cccccccd'"""
)
def model_reload_differences(t):
    """Test rows scored by the reloaded pipeline, and how many of them changed."""
    path = scratch_path(t.spark, "model")
    trained = models.train_churn_model(features(t))
    writers.save_model(trained.model, path)
    raw = trained.predictions.drop(*MODEL_COLUMNS)
    again = models.scored_rows(PipelineModel.load(path).transform(raw), "is_churned")
    before = models.scored_rows(trained.predictions, "is_churned").select(
        "customer_id", F.col("score").alias("before"), F.col("prediction").alias("was")
    )
    return again.join(before, "customer_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.abs(F.col("score") - F.col("before")) > 1e-12).alias("changed_scores"),
        F.count_if(F.col("prediction") != F.col("was")).alias("changed_classes"),
    )


@query("SELECT 'orders' AS \"table\" UNION ALL SELECT 'sales'")
def catalog_tables(t):
    """The tables of a database; a temporary view of the session is none of them."""
    home = scratch_path(t.spark, "catalog")
    database = home.rsplit("/", 1)[1].replace("-", "_")
    writers.save_table(feeds.sales(t), database, "sales", f"{home}/sales")
    writers.save_table(feeds.order_totals(t), database, "orders", f"{home}/orders")
    on_release(lambda: t.spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE"))
    feeds.transactions(t).createOrReplaceTempView("tallymart_session_view")
    names = tables.list_tables(t.spark, database)
    return t.spark.createDataFrame([(n,) for n in names], "table string")


@query(
    """SELECT 'id' AS "column", 'bigint' AS kind UNION ALL SELECT 'product', 'string' UNION ALL SELECT 'amount', 'double'
UNION ALL SELECT 'Type', 'EXTERNAL'"""
)
def catalog_description(t):
    described = tables.describe_table(t.spark, save_external(t, feeds.sales(t), "sales"))
    wanted = F.col("col_name").isin("id", "product", "amount", "Type")
    return described.where(wanted).select(F.col("col_name").alias("column"), F.col("data_type").alias("kind"))
