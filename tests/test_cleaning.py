import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallymart.operators import cleaning
from tallymart.session import stable
from tallymart.sources import feeds

END = dt.date(2001, 8, 1)
SCHEMA = "transaction_id string, customer_id string, tx_amount double, tx_date date"


def test_every_rule_removes_rows(tables):
    end = feeds.last_order_day(tables)
    row = cleaning.cleaning_statistics(
        feeds.raw_transactions(tables), cleaning.transaction_rules(end), cleaning.TRANSACTION_KEYS
    ).first()
    assert all(row[c] > 0 for c in row.asDict() if c.startswith("removed_"))
    people = cleaning.cleaning_statistics(
        feeds.raw_customers(tables), cleaning.customer_rules(end), cleaning.CUSTOMER_KEYS
    ).first()
    # No customer id is blank in the profiles: their ids come from the key.
    assert all(people[c] > 0 for c in people.asDict() if c.startswith("removed_") and c != "removed_blank_customer")


def test_statistics_of_an_empty_table(spark):
    rules = cleaning.transaction_rules(F.lit(END))
    row = cleaning.cleaning_statistics(spark.createDataFrame([], SCHEMA), rules, cleaning.TRANSACTION_KEYS).first()
    assert row["original_count"] == 0 and row["cleaned_count"] == 0 and row["removed_percent"] is None


rows = st.lists(
    st.tuples(
        st.integers(0, 5).map(str),
        st.sampled_from(["a", "b", " ", None]),
        st.sampled_from([-1.0, 0.0, 1.0, 1e6, 1e6 + 1, None]),
        st.sampled_from([END, END - dt.timedelta(1825), END - dt.timedelta(1826), END + dt.timedelta(1), None]),
    ),
    max_size=25,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows)
def test_cleaning_properties(spark, data):
    raw = spark.createDataFrame(data, SCHEMA)
    clean = cleaning.clean_transactions(raw, END)
    once = sorted(tuple(r) for r in clean.collect())
    again = sorted(tuple(r) for r in cleaning.clean_transactions(clean, END).collect())
    assert once == again
    kept = {}
    for t, c, a, d in data:
        if c and c.strip() and a is not None and 0 < a <= 1e6 and d and END - dt.timedelta(1825) <= d <= END:
            kept[c, d, a] = min(kept.get((c, d, a), t), t)
    assert once == sorted((t, c, a, d) for (c, d, a), t in kept.items())


def test_hot_group_collapses_before_the_shuffle(spark):
    copies = [("x", "c", 5.0, END)] * 3000 + [(str(i), f"k{i}", 1.0, END) for i in range(50)]
    df = spark.createDataFrame(copies, SCHEMA).repartition(4)
    clean = cleaning.clean_transactions(df, END)
    assert clean.count() == 51
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_quality_report_skips_when_a_side_is_empty(spark, tables):
    tx = feeds.transactions(tables)
    none = spark.createDataFrame([], "customer_id string, registration_date date, region string")
    assert cleaning.quality_report(tx, none).count() == 0
    assert cleaning.quality_report(tx.where("false"), feeds.customers(tables)).count() == 0
    assert cleaning.quality_report(tx, feeds.customers(tables)).count() == 14


def test_amount_filters_reach_the_scan(spark, tables, tmp_path):
    path = str(tmp_path / "tx")
    feeds.raw_transactions(tables).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = cleaning.clean_transactions(spark.read.parquet(path), END)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThan(tx_amount,0.0)" in plan and "LessThanOrEqual(tx_amount,1000000.0)" in plan


def test_a_future_date_does_not_become_today(spark):
    good = [(str(i), f"c{i}", 1.0, END) for i in range(20)]
    raw = spark.createDataFrame([*good, ("x", "c", 1.0, dt.date(2099, 1, 1))], SCHEMA)
    assert cleaning.clean_transactions(raw, END).count() == 20
    with pytest.raises(TypeError):
        cleaning.clean_transactions(raw)
    people = spark.createDataFrame([("a", END, "X"), ("b", dt.date(2099, 1, 1), "X")], "customer_id string, registration_date date, region string")
    assert [r["customer_id"] for r in cleaning.clean_customers(people, END).collect()] == ["a"]


def test_statistics_of_one_write(spark, tables, tmp_path):
    """As by separate passes over the rows."""
    raw, end = stable(feeds.raw_transactions(tables)), feeds.last_order_day(tables)
    rules = cleaning.transaction_rules(end)
    rows, found = cleaning.clean_and_count(
        raw, rules, cleaning.TRANSACTION_KEYS, ["transaction_id"], str(tmp_path / "rows"), cleaning.amount_aggregates()
    )
    wanted = cleaning.clean_transactions(raw, end)
    assert rows.exceptAll(wanted).isEmpty() and wanted.exceptAll(rows).isEmpty()
    apart = {**cleaning.cleaning_statistics(raw, rules, cleaning.TRANSACTION_KEYS).first().asDict(), **cleaning.amount_profile(wanted).first().asDict()}
    assert found.first().asDict() == pytest.approx(apart)


def test_one_write_of_nothing(spark, tables, tmp_path):
    rules = cleaning.customer_rules(feeds.last_order_day(tables))
    rows, found = cleaning.clean_and_count(
        feeds.raw_customers(tables).limit(0), rules, cleaning.CUSTOMER_KEYS, ["registration_date", "region"], str(tmp_path / "rows")
    )
    assert rows.count() == 0
    assert found.first()["original_count"] == 0 and found.first()["removed_percent"] is None
