"""Runs that add to facts: rows written by change, facts that hold, merging, and bitmaps that are made once."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import marts
from tallyspark.plans import jobs
from tallyspark.session import TASK_BYTES, size_partitions
from tallyspark.sources import versions
from tallyspark.sources.versions import Store

from .test_engine import BRONZE, snapshot


@pytest.mark.parametrize("merge", [0.5, 0.0])
def test_runs_add_what_changed(spark, tmp_path, monkeypatch, merge):
    """Corrections move an order to another month and customer, drop a line, cancel, and come again; facts are those of a full build."""
    monkeypatch.setattr(jobs, "MERGE_FACTS", merge)
    at = lambda i: f"2023-{i % 4 + 1:02d}-05T10:00:00Z"
    one = json.dumps([{"line_id": "1", "product_id": "p9", "category": "c", "quantity": 1, "amount": "7.00"}])
    rows = [snapshot(str(i), customer_id=str(i % 4), purchased_at=at(i), returns=None) for i in range(16)]
    rows += [
        snapshot("1", version=2, batch=2, customer_id="9", purchased_at="2023-06-11T10:00:00Z", returns=None),
        snapshot("2", version=2, batch=2, purchased_at=at(2), status="CANCELLED", returns=None), snapshot("3", version=2, batch=2, customer_id="3", purchased_at=at(3), items=one, returns=None),
        snapshot("50", batch=2, customer_id="7", purchased_at=at(0), returns=None),
        snapshot("1", version=3, batch=3, customer_id="1", purchased_at=at(1), items=one, returns=None), snapshot("2", version=3, batch=3, customer_id="2", purchased_at=at(2), returns=None),
        snapshot("50", version=2, batch=3, customer_id=None, purchased_at=at(0), returns=None),
    ]
    store, as_of = Store(spark, str(tmp_path)), date(2023, 7, 1)
    bronze = store.write(spark.createDataFrame(rows, BRONZE), "raw", 1)
    work = jobs.PurchaseAnalytics(store, bronze, spark.createDataFrame([(n, "append") for n in (1, 2, 3)], "batch_id long, op string"))
    for bound in (1, 2, 3):
        head = work.build(as_of, bound)
    orders = jobs.accepted_by_range(bronze, [1, 2, 3])
    full, frames = jobs.marts_of(orders, as_of), work.frames()
    for name in ("customer", "product"):
        full[f"{name}_monthly"] = marts.monthly(full[f"{name}_daily"], f"{name}_key")
    for name, frame in full.items():
        assert versions.same_rows(frame, frames[name].select(frame.columns)), name
    # A month of a table that is asked for has the rows of that month, also of orders that left it.
    for name, day in (("purchase_orders", "purchased_at"), ("customer_daily", "metric_date")):
        found = frames[name].where(F.col(jobs.MONTH) == "2023-02")
        assert versions.same_rows(full[name].where(F.date_format(day, "yyyy-MM") == "2023-02"), found.select(full[name].columns)), name
    written = lambda table: {r["run"]: r["count"] for r in store.read(table, head["versions"][table], writer="run").groupBy("run").count().collect()}
    # Each run writes the orders that it changed, not their months; once they are merged, one folder has all.
    assert written("purchase_orders") == ({"3": 17} if merge == 0 else {"1": 16, "2": 4, "3": 3})
    assert set(written("product_daily")) == ({"3"} if merge == 0 else {"1", "2", "3"})


def test_places_are_moved_to_their_bitmap(spark):
    """Tasks do not make bitmaps of all customers each: places meet where their bitmap is made."""
    daily = spark.range(1000).selectExpr("cast(id % 90 as string) as customer_key", "if(id % 5 = 0, 'USD', 'EUR') as currency", "date_add(date'2023-01-01', cast(id % 200 as int)) as metric_date")
    numbers = daily.select("customer_key").distinct().withColumn("number", F.col("customer_key").cast("long"))
    made = marts.activity_bitmaps(daily, numbers, date(2023, 6, 1))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Exchange")[0].count("SortAggregate") == 2  # what a task finds and its sum, with nothing sent between them
    assert versions.same_rows(marts.customer_cohorts(daily, date(2023, 6, 1)), marts.cohorts_of_bitmaps(made, date(2023, 6, 1)))


def test_tasks_of_a_shuffle_are_bounded(spark):
    names = ("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.files.minPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        size_partitions(spark, 10**9, 250_000)
        assert spark.conf.get(names[2]) == TASK_BYTES == "16m"
    finally:
        for name in names:
            spark.conf.unset(name)
