"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from datetime import date  # noqa: E402

from pyspark.sql import functions as F  # noqa: E402

from tallyspark.plans import catalogue, jobs  # noqa: E402
from tallyspark.session import local_session, workspace  # noqa: E402
from tallyspark.sources.versions import Store  # noqa: E402

HEADLINE = [
    "customer_profiles", "customer_daily", "product_daily", "customer_cohorts", "rejected_purchases", "purchase_items", "summary_window", "customer_page_window", "summary_five_years", "product_totals",
    "conform_orders", "inventory_daily", "daily_kpis", "demand_features", "customer_history", "event_routing", "payment_findings", "retail_orders", "skew_join"
]


#: Purchases from then on are recent.
RECENT = "2001-07-18"


def written(work: jobs.PurchaseAnalytics, sequence: int) -> int:
    """Bytes that a run wrote into the tables that its publication names."""
    store, named = work.store, work.publications.all().where(F.col("sequence") == sequence).first()["versions"]
    files = store.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    return files.load([store.path(t, sequence) for t, v in named.items() if v.split("@")[0] == str(sequence)]).agg(F.sum("length")).first()[0]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = local_session(cores)
    names = sys.argv[1:] or HEADLINE
    took = {}
    # The raw event tables are written first, as ingestion would have left them.
    began = time.time()
    for name in ("purchase_bronze", "order_events", "payment_events", "inventory_events", "customer_changes", "raw_event_stream", "retail_lines"):
        catalogue.bronze(spark, sf_dir, name)
    took["ingest"] = round(time.time() - began, 3)
    # The marts that served queries read, built and published.
    began = time.time()
    catalogue.published(spark, sf_dir)
    took["publish_marts"] = round(time.time() - began, 3)
    for name in names:
        began = time.time()
        catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    more = {}
    if names is HEADLINE:
        bronze = catalogue.bronze(spark, sf_dir, "purchase_bronze").withColumn("batch_id", F.col("batch_id").cast("long"))
        # Of the corrections, those of the last two weeks come first, as a batch of about 0.1 % of all orders.
        recent = F.col("payload")["purchased_at"] >= RECENT
        bronze = bronze.withColumn("batch_id", F.when((F.col("batch_id") == 3) & ~recent, 4).otherwise(F.col("batch_id")))
        store = Store(spark, workspace(spark, "bench"))
        # The events lie by batch, as they were appended, and each batch has a row in the manifest.
        bronze = store.write(bronze, "purchase_events", 1, ["batch_id"])
        manifest = store.write(bronze.select("batch_id").distinct().withColumn("op", F.lit("append")), "manifest", 1)
        work = jobs.PurchaseAnalytics(store, bronze, manifest)
        runs = (("initial_processing", 1, 1), ("incremental_processing", 1, 2), ("no_input_refresh", 1, 2), ("small_batch", 1, 3), ("age_one_day", 2, 3))
        for name, day, bound in runs:
            began = time.time()
            work.build(date(2001, 8, day), bound)
            took[name] = round(time.time() - began, 3)
        more = {f"bytes_of_run_{n}": written(work, n) for n in (1, 2, 3, 4)}
        more["share_of_profiles_aged"] = round(store.rows["profile_states"] / work.frames()["customer_profiles"].count(), 4)
    print(json.dumps({"metric": "total_time", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/"))} | more))
    spark.stop()


if __name__ == "__main__":
    main()
