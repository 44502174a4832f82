"""Runs that continue a full build, the calendar of profiles, monthly sums, bitmaps, keyed tables, ranks and line numbers."""

import json
import random
import shutil
import time
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import marts, purchases, reconcile, serving
from tallyspark.plans import jobs
from tallyspark.plans.publication import Publications, audits
from tallyspark.session import freed_shuffles, partitions, size_partitions
from tallyspark.sources import events, versions
from tallyspark.sources.versions import Store
from tallyspark.streaming import ingest

from .test_engine import BRONZE, snapshot

DAILY = "customer_key string, currency string, metric_date date, orders long, units long, gross_amount decimal(38,2), returned_amount decimal(38,2), net_amount decimal(38,2)"


def daily_rows(seed, customers=40, days=700):
    from decimal import Decimal

    rng, rows = random.Random(seed), {}
    for _ in range(customers * 6):
        key = (f"c{rng.randrange(customers)}", rng.choice(["EUR", "USD"]), date(2022, 1, 1) + timedelta(days=rng.randrange(days)))
        rows[key] = (rng.randint(1, 3), rng.randint(1, 9), Decimal(rng.randint(1, 999)), Decimal(0), Decimal(rng.randint(1, 999)))
    return [(*k, *v) for k, v in rows.items()]


def test_states_hold_until_they_are_due(spark):
    """On every one of 400 days a state has the figures of a full build until the day before it is due, and others then."""
    rows = daily_rows(1)
    held = defaultdict(list)
    for c, cur, day, orders, _, _, _, net in rows:
        held[c, cur].append((day, orders, net))

    def figures(facts, on):
        ages = [((on - day).days, orders, net) for day, orders, net in facts]
        out = [sum(o for age, o, _ in ages if age >= 0)]
        for n in marts.WINDOWS:
            out += [sum(o for age, o, _ in ages if 0 <= age < n), sum(x for age, _, x in ages if 0 <= age < n)]
        return [float(x) for x in out]

    df = spark.createDataFrame(rows, DAILY)
    for as_of in (date(2021, 12, 1), date(2022, 6, 30), date(2023, 3, 5), date(2024, 8, 1)):
        found = marts.profile_states(df, as_of).collect()
        assert len(found) == len(held)
        for r in found:
            facts, mine = held[r["customer_key"], r["currency"]], [float(r[n]) for n in marts.FIGURES]
            for k in range(400):
                on = as_of + timedelta(days=k)
                if r["due"] is not None and on == r["due"]:
                    assert figures(facts, on) != mine
                    break
                assert figures(facts, on) == mine


@pytest.mark.parametrize("merge", [0.2, 0.0])
def test_runs_continue_a_full_build_and_age(spark, tmp_path, monkeypatch, merge):
    monkeypatch.setattr(jobs, "MERGE", merge)
    rows = [snapshot(str(i), customer_id=str(i % 4), purchased_at=f"2023-{i % 6 + 1:02d}-05T10:00:00Z", returns=None) for i in range(12)]
    rows += [snapshot("3", version=2, batch=2, customer_id="9", purchased_at="2023-02-11T10:00:00Z", returns=None), snapshot("77", batch=2, currency="x")]
    store = Store(spark, str(tmp_path))
    bronze = store.write(spark.createDataFrame(rows, BRONZE), "raw", 1)
    orders = lambda bounds: jobs.accepted_by_range(bronze, bounds)
    jobs.publish_marts(store, orders([1]), date(2023, 7, 1), 1)
    work = jobs.PurchaseAnalytics(store, bronze, spark.createDataFrame([(1, "append"), (2, "append")], "batch_id long, op string"))
    work.build(date(2023, 7, 1), 2)
    head = work.build(date(2023, 9, 20), 2)
    assert (head["sequence"], head["created_by"]) == (3, "source")
    full, frames = jobs.marts_of(orders([1, 2]), date(2023, 9, 20)), work.frames()
    for name, frame in full.items():
        assert versions.same_rows(frame, frames[name]), name
    assert frames["purchase_rejections"].count() == 1
    kept = {r["output_version"]: (r["status"], r["input_rows"], r["rejected_rows"]) for r in audits(store).collect()}
    assert kept == {"2": ("SUCCEEDED", 2, 1), "3": ("SUCCEEDED", 0, 0)}
    # What the retention plan names can go: every kept version can still be read.
    publications = work.publications.all()
    named = publications.select("pipeline", "sequence", F.lit(datetime(2023, 1, 1)).alias("published_at"), F.explode("versions").alias("table", "version")).withColumn("version", F.split("version", "@")[0])
    parted = [t for t, v in head["versions"].items() if "@" in v]
    gone = versions.droppable_versions(named.select("table", "version").distinct(), named, F.lit(datetime(2024, 1, 1)), last=1, days=1, parts=store.part_folders(parted)).collect()
    assert gone
    for r in gone:
        shutil.rmtree(tmp_path / r["table"] / f"v={r['version']}")
    again = jobs.frames_of(Publications(Store(spark, str(tmp_path))), head)
    for name, frame in full.items():
        assert versions.same_rows(frame, again[name]), name


def test_input_rows_are_no_metric_of_held_changes(spark, tmp_path, monkeypatch):
    """A metric of a cached frame counts a partition in every executor that makes it; audit rows must not depend on one."""
    from pyspark.sql import Observation

    class TwoExecutors(Observation):
        @property
        def get(self):
            return {n: 2 * v for n, v in super().get.items()}

    monkeypatch.setattr(jobs, "Observation", TwoExecutors, raising=False)
    store = Store(spark, str(tmp_path))
    bronze = store.write(spark.createDataFrame([snapshot(str(i)) for i in range(5)], BRONZE), "raw", 1)
    jobs.PurchaseAnalytics(store, bronze, spark.createDataFrame([(1, "append")], "batch_id long, op string")).build(date(2024, 1, 20), 1)
    assert [r["input_rows"] for r in audits(store).collect()] == [5]


def test_failed_runs_leave_an_audit_row(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    bronze = store.write(spark.createDataFrame([snapshot()], BRONZE), "raw", 1)
    work = jobs.PurchaseAnalytics(store, bronze, spark.createDataFrame([(1, "overwrite")], "batch_id long, op string"))
    with pytest.raises(ValueError):
        work.build(date(2024, 1, 20), 1)
    row = audits(store).collect()[0]
    assert row["status"] == "FAILED" and row["failure"].startswith("ValueError") and work.publications.head(jobs.PIPELINE) is None


def test_kinds_of_orders(spark):
    kind = lambda *sources: jobs.publication_kind(spark.createDataFrame([(s,) for s in sources], "source string"))
    assert kind("generated-a", "generated-b") == "generated" and kind(jobs.PUBLIC, jobs.PUBLIC) == "public dataset"
    assert kind("generated-a", jobs.PUBLIC) == kind("shop") == kind(jobs.PUBLIC, "shop") == "source"
    assert jobs.joined_kind(["generated", "generated"]) == "generated" and jobs.joined_kind(["generated", "public dataset"]) == "source"


@pytest.mark.parametrize(("first", "last"), [(date(2022, 1, 1), date(2022, 3, 31)), (date(2022, 1, 15), date(2023, 5, 2)), (date(2022, 2, 3), date(2022, 2, 20)), (date(2022, 2, 3), date(2022, 3, 20)), (date(2022, 2, 1), date(2022, 2, 28)), (date(2022, 5, 31), date(2022, 6, 1))])
def test_windows_of_months_and_edges(spark, first, last):
    daily = spark.createDataFrame(daily_rows(2), DAILY)
    months = marts.monthly(daily, "customer_key")
    by_month = lambda df, day: df.withColumn("month", F.date_format(day, "yyyy-MM"))
    plain = serving.window_summary(daily, first, last, "EUR").collect()
    assert serving.window_summary(daily, first, last, "EUR", months).collect() == plain
    assert serving.window_summary(by_month(daily, "metric_date"), first, last, "EUR", by_month(months, "first_day")).collect() == plain


def test_cohorts_by_bitmaps_over_several_buckets(spark):
    daily = spark.createDataFrame(daily_rows(3), DAILY)
    numbers = daily.select("customer_key").distinct().withColumn("number", F.substring("customer_key", 2, 9).cast("long") + 32_750)
    as_of = date(2023, 6, 10)
    bitmaps = marts.activity_bitmaps(daily, numbers, as_of)
    assert bitmaps.select("bucket").distinct().count() == 2
    assert versions.same_rows(marts.customer_cohorts(daily, as_of), marts.cohorts_of_bitmaps(bitmaps, as_of))


def test_numbers_without_gaps(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    rows = versions.numbered(spark.range(1000).repartition(7), store, "numbers", 1, 5)
    assert sorted(r["number"] for r in rows.collect()) == list(range(5, 1005))
    assert versions.numbered(spark.range(0), store, "numbers", 2, 5).count() == 0 and store.rows["numbers"] == 0


def test_lines_returned_are_summed_in_the_row(spark):
    two = '[{"return_id":"r1","line_id":"1","quantity":1,"amount":"5.00","occurred_at":"2024-01-11T10:00:00Z"},{"return_id":"r2","line_id":"1","quantity":1,"amount":"2.50","occurred_at":"2024-01-12T10:00:00Z"}]'
    found = purchases.purchase_changes(spark.createDataFrame([snapshot(returns=two), snapshot("2", returns=None)], BRONZE))
    items = purchases.purchase_items(purchases.latest_purchases(found))
    got = sorted((r["order_key"], r["line_id"], r["returned_quantity"], float(r["returned_amount"]), float(r["net_amount"])) for r in items.collect())
    assert got == [("shop:1", "1", 2, 7.5, 12.5), ("shop:1", "2", 0, 0, 10), ("shop:2", "1", 0, 0, 20), ("shop:2", "2", 0, 0, 10)]
    assert "Exchange" not in purchases.purchase_items(found)._jdf.queryExecution().executedPlan().toString()


def test_keyed_tables(spark, tmp_path):
    rows = lambda *r: spark.createDataFrame(list(r), "event_id string, x string, source_timestamp timestamp, source_partition int, source_offset long")
    at = lambda n: datetime(2024, 1, n)
    for last, expected in ((True, {"a": "a3", "b": "b1", "c": "c2"}), (False, {"a": "a1", "b": "b1", "c": "c2"})):
        table = ingest.KeyedTable(spark, f"{tmp_path}/{last}", ["event_id"], last)
        table.write(rows(("a", "a1", at(1), 0, 1), ("b", "b1", at(1), 0, 2)), 0)
        table.write(rows(("c", "c2", at(2), 0, 3), ("a", "a2", at(2), 0, 4)), 1)
        seen = lambda t=table: {r["event_id"]: r["x"] for r in t.rows().collect()}
        table.settle(0)
        table.settle(1)
        table.write(rows(("a", "a3", at(1), 0, 9)), 2)
        table.write(rows(("a", "a3", at(1), 0, 9)), 2)
        assert seen() == expected
        table.settle(2)
        assert seen() == expected
    # Of copies in one batch the newest counts, or the first to come.
    both = rows(("a", "old", at(1), 0, 1), ("a", "new", at(2), 0, 2))
    for last, value in ((True, "new"), (False, "old")):
        table = ingest.KeyedTable(spark, f"{tmp_path}/both-{last}", ["event_id"], last)
        table.write(both, 0)
        assert [r["x"] for r in table.rows().collect()] == [value]


def test_places_and_sketches(spark):
    rng = random.Random(4)
    values = [rng.choice([1.5, 2.0, rng.random() * 9]) for _ in range(999)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    ordered = sorted(values)
    got = {r["name"]: r["value"] for r in reconcile.at_places(df, "v", {"first": 0, "middle": 499, "last": 998}, ranges=8).collect()}
    assert got == {"first": ordered[0], "middle": ordered[499], "last": ordered[998]}
    assert {r["share"]: r["value"] for r in reconcile.nearest_rank(df, "v", [0.5, 0.999, 1.0]).collect()} == {0.5: ordered[499], 0.999: ordered[998], 1.0: ordered[998]}
    assert reconcile.nearest_rank(df.where("v > 99"), "v", [0.5]).count() == 0
    start = datetime(2024, 1, 1)
    rows = [(f"t{i % 3}", start, start + timedelta(milliseconds=rng.randrange(10**7), days=rng.randrange(30))) for i in range(20_000)]
    bronze = spark.createDataFrame(rows, "source_topic string, source_timestamp timestamp, ingested_at timestamp").repartition(5)
    sketches = reconcile.latency_sketches(bronze)
    for by in ([], ["source_topic"]):
        for r in reconcile.merged_percentiles(sketches, {"p50": 0.5, "p95": 0.95}, by).collect():
            delays = sorted((e - s).total_seconds() * 1000 for t, s, e in rows if not by or t == r["source_topic"])
            assert r["events"] == len(delays)
            for name, q in (("p50", 0.5), ("p95", 0.95)):
                rank = sum(d <= r[name] for d in delays) / len(delays)
                assert abs(rank - q) <= 2 * reconcile.RANK_ERROR


def test_line_numbers_across_splits(spark, tmp_path):
    good = '{"source":"shop","order_id":"%d","version":1,"items":[],"returns":[]}'
    bad = {}
    for f in range(3):
        lines = []
        for i in range(400):
            lines.append("{broken %d" % i if i % 37 == f else " " if i % 11 == 0 else good % i)
        bad |= {(f"f{f}.jsonl", i + 1): t for i, t in enumerate(lines) if t.startswith("{broken")}
        (tmp_path / f"f{f}.jsonl").write_text("\n".join(lines) + "\n")
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
        spark.conf.set("spark.sql.files.openCostInBytes", "100")
        rows, faulty = events.read_purchases(spark, str(tmp_path))
        assert rows.rdd.getNumPartitions() > 6
        assert {(r["file"].rsplit("/", 1)[1], r["line_number"]): r["raw_value"] for r in faulty.collect()} == bad
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_digests_name_what_differs(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    rows = spark.range(2000).select("id", (F.col("id") % 7).alias("x"), F.create_map(F.lit("a"), F.col("id").cast("string")).alias("m"))
    other = rows.where("id <> 5").withColumn("x", F.when(F.col("id") == 900, 99).otherwise(F.col("x"))).unionByName(rows.where("id = 33"))
    store.write(rows, "t", 1)
    store.write(other, "t", 2)
    kept = tuple(versions.kept_digests(store, "t", v, ["id"], rows.columns) for v in (1, 2))
    assert sorted(r["id"] for r in versions.differing_keys(store.read("t", 1), store.read("t", 2), ["id"], kept).collect()) == [5, 33, 900]
    assert versions.differing_keys(rows, rows.repartition(3), ["id"]).count() == 0


def test_equal_rows_are_not_moved_to_be_counted(spark):
    """Rows of buckets with equal digests are not compared; of others the distinct rows in one frame only are counted."""
    rows = spark.range(3000).select("id", (F.col("id") % 7).alias("x"), F.when(F.col("id") % 5 > 0, F.lit("a")).alias("s"))
    same = versions.difference_count(rows, rows.repartition(3))
    assert same.collect()[0][0] == 0 and _shuffles(same) == 0
    other = rows.where("id <> 5").withColumn("x", F.when(F.col("id") == 900, 99).otherwise(F.col("x"))).unionByName(rows.where("id = 33"))
    assert versions.difference_count(rows, other).collect()[0][0] == versions.difference_count(other, rows, 1).collect()[0][0] == 3
    assert versions.difference_count(rows, rows.where("id < 0")).collect()[0][0] == 3000


def test_shuffle_files_go_with_their_job(spark, tmp_path):
    def held():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {str(files.apply(i).getName()) for i in range(files.size()) if str(files.apply(i).getName()).startswith("shuffle_")}

    moved, before = spark.range(2000).repartition(3, "id"), held()
    with freed_shuffles(spark):
        moved.write.parquet(f"{tmp_path}/a")
    end = time.time() + 20
    while held() - before and time.time() < end:
        time.sleep(0.1)
    assert not held() - before and spark.read.parquet(f"{tmp_path}/a").count() == 2000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_marts_on_demand_equal_a_full_build(spark, tmp_path):
    """A mart asked for brings what it is made of, no other, and is the one of a full build; complete, later runs continue it."""
    rows = [snapshot(str(i), customer_id=str(i % 4), purchased_at=f"2023-{i % 6 + 1:02d}-05T10:00:00Z") for i in range(12)]
    rows += [snapshot("3", version=2, customer_id="9", purchased_at="2023-02-11T10:00:00Z", returns=None), snapshot("77", currency="x")]
    rows += [snapshot("5", version=2, batch=2, customer_id="8", purchased_at="2023-03-11T10:00:00Z", returns=None)]
    as_of, bronze = date(2023, 7, 1), Store(spark, f"{tmp_path}/raw").write(spark.createDataFrame(rows, BRONZE), "raw", 1)
    changes = purchases.purchase_changes(bronze.where("batch_id = 1"))
    accepted, rejected = purchases.accepted_purchases(changes), purchases.rejected_purchases(changes)
    whole = Store(spark, f"{tmp_path}/whole")
    jobs.publish_marts(whole, purchases.latest_purchases(accepted), as_of, 1, rejections=rejected)
    want = jobs.frames_of(Publications(whole), Publications(whole).head(jobs.PIPELINE))
    found = {
        "customer_profiles": {"customer_daily", "profile_states"}, "customer_monthly": {"customer_daily", "customer_monthly"}, "product_monthly": {"product_daily", "product_monthly"},
        "customer_cohorts": {"customer_daily", "customer_numbers", "activity_bitmaps", "customer_cohorts"}, "purchase_rejections": {"purchase_rejections"}, "purchase_items": {"purchase_orders", "purchase_items"},
    }
    for name, made in found.items():
        store = Store(spark, f"{tmp_path}/{name}")
        one = jobs.MartsOnDemand(store, accepted, rejected, as_of, 1)
        dashboard = serving.dashboard(one.frames(), as_of, "EUR")
        got = one.frames()[name]
        assert set(Publications(store).head(jobs.PIPELINE)["versions"]) == made and versions.same_rows(want[name].select(got.columns), got), name
    assert dashboard["segments"].count() == want["customer_profiles"].where("currency = 'EUR'").select("segment").distinct().count()
    assert {"purchase_orders", "purchase_items", "customer_daily", "profile_states"} == set(Publications(store).head(jobs.PIPELINE)["versions"])
    frames = one.complete()
    for name in want:
        if name != "customer_numbers" and name != "activity_bitmaps":  # a customer may get any number
            assert versions.same_rows(want[name].select(frames[name].columns), frames[name]), name
    work = jobs.PurchaseAnalytics(store, bronze, spark.createDataFrame([(1, "append"), (2, "append")], "batch_id long, op string"))
    work.build(date(2023, 7, 2), 2)
    full, frames = jobs.marts_of(jobs.accepted_by_range(bronze, [1, 2]), date(2023, 7, 2)), work.frames()
    for name in jobs.MARTS:
        assert versions.same_rows(full[name], frames[name]), name


def test_reasons_do_not_read_lists_again(spark, tmp_path):
    rows = [snapshot(), snapshot("2", currency="x"), snapshot("3"), snapshot("3", event="other", country="FR"), snapshot("4", returns='[{"return_id":"r1","line_id":"1","quantity":99,"amount":"5.00","occurred_at":"2024-01-11T10:00:00Z"}]')]
    changes = purchases.purchase_changes(spark.createDataFrame(rows, BRONZE))
    judged = Store(spark, str(tmp_path)).write(purchases.judged_changes(changes), "changes", 1)
    found = purchases.rejection_reasons(judged)
    assert sorted(found.collect()) == sorted(purchases.rejection_reasons(changes).collect()) and found.count() == 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "content_hash" in plan and "items" not in plan


def test_clashing_copies_are_not_trusted(spark):
    rows = spark.createDataFrame([("a", 1, 1), ("a", 1, 2), ("b", 1, 1), ("b", 2, 1), ("c", 3, 1)], "last_event_id string, amount long, source_offset long")
    assert sorted((r["last_event_id"], r["source_offset"]) for r in reconcile.unclashed(rows, ["amount"]).collect()) == [("a", 1), ("c", 1)]


def test_open_ranges(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "batch_id long, x string")
    manifest = spark.createDataFrame([(1, "append"), (2, "append"), (3, "append")], "batch_id long, op string")
    read = lambda *b: (lambda df, words: ("".join(sorted(r["x"] for r in df.collect())), words))(*versions.read_range(rows, manifest, *b))
    assert read() == ("abc", "full-current-snapshot") and read(1) == ("bc", "start=1") and read(None, 2) == ("ab", "end=2") and read(1, 2) == ("b", "start=1,end=2")


def _shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_facts_move_once(spark):
    """Lines that count orders give the daily facts of those that do not, moved once; also where a product comes again in an order or has no id."""
    line = lambda n, product: {"line_id": n, "category": "c", "quantity": 2, "amount": "10.00"} | ({"product_id": product} if product else {})
    many = json.dumps([line("1", "a"), line("2", "b"), line("3", "a"), line("4", None), line("5", None), line("6", "b")])
    rows = [snapshot(str(i), customer_id=str(i % 2), purchased_at=f"2023-0{i % 3 + 1}-05T10:00:00Z", items=many, returns=None) for i in range(8)]
    orders = purchases.latest_purchases(purchases.purchase_changes(spark.createDataFrame(rows, BRONZE)))
    plain = purchases.purchase_items(orders)
    counted = purchases.purchase_items(orders, counted=True).withColumn("month", jobs.in_month("purchased_at")).localCheckpoint()
    products = marts.product_daily(counted, "month", 3)
    for got, want, shuffles in ((marts.customer_daily(counted), marts.customer_daily(plain), 1), (products, marts.product_daily(plain), 1)):
        assert versions.same_rows(got, want.select(*got.columns))
        assert _shuffles(got) == shuffles
    assert {(r["product_key"], r["orders"]) for r in products.where("metric_date = '2023-01-05'").collect()} == {("shop:a", 3), ("shop:b", 3), ("shop", 3)}
    daily = products.withColumn("month", jobs.in_month("metric_date")).localCheckpoint()
    sums = marts.monthly(daily, "product_key", "month", 3)
    assert _shuffles(sums) == 1
    assert versions.same_rows(sums, marts.monthly(daily, "product_key").select(*sums.columns))


def test_parts_that_are_laid_out_are_not_moved(spark, tmp_path):
    """Rows that lie by their parts are written where they are, in order within their files."""
    store = Store(spark, str(tmp_path))
    store.write_parts(spark.range(1000).selectExpr("id", "cast(id % 4 as string) as part").repartition(8, "part"), "t", 1, "part", order=("id",), laid=True)
    found = store.read("t", "1@part")
    placed = found.select("part", "id", "_metadata.file_name", "_metadata.file_block_start", F.monotonically_increasing_id().alias("place")).collect()
    assert len({(r["part"], r["file_name"]) for r in placed}) == 4
    for part in "0123":
        ids = [r["id"] for r in sorted(placed, key=lambda r: r["place"]) if r["part"] == part]
        assert ids == sorted(ids) and len(ids) == 250


def test_tasks_follow_the_size_of_tables(spark):
    names = ("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.files.minPartitionNum")
    try:
        for rows, number in ((0, 4), (400, 4), (401, 5), (6000, 60)):
            size_partitions(spark, rows, 100)
            assert partitions(spark) == number
    finally:
        for name in names:
            spark.conf.unset(name)
