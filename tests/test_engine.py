"""Rules of the transforms on small frames: corrections, conflicts, ties, gates, replays and publications."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import conform, history, marts, purchases, quality, reconcile, retail, serving
from tallyspark.plans import jobs
from tallyspark.plans.publication import append_audit, write_audit_publish
from tallyspark.sources import events, fixtures, versions
from tallyspark.sources.versions import Store
from tallyspark.streaming import ingest

AT = "2024-01-10T10:00:00Z"
ITEMS = '[{"line_id":"1","product_id":"a","category":"c","quantity":2,"amount":"20.00"},{"line_id":"2","product_id":"a","category":"c","quantity":1,"amount":"10.00"}]'
RETURNS = '[{"return_id":"r1","line_id":"1","quantity":1,"amount":"10.00","occurred_at":"2024-01-11T10:00:00Z"}]'
BRONZE = "event_id string, event_type string, payload map<string,string>, ingested_at timestamp, batch_id long, source string"


def snapshot(order="1", version=1, event=None, known=1, batch=1, **changes):
    payload = {"source": "shop", "order_id": order, "version": str(version), "customer_id": "7", "currency": "EUR", "country": "IT", "purchased_at": AT, "status": "CONFIRMED", "items": ITEMS, "returns": RETURNS}
    payload = {k: v for k, v in (payload | changes).items() if v is not None}
    return (event or f"{order}-{version}", "order.snapshot", payload, datetime(2024, 1, 12, known), batch, "shop")


def changes_of(spark, *rows):
    return purchases.purchase_changes(spark.createDataFrame(list(rows), BRONZE))


def test_two_lines_and_a_return_are_one_order(spark):
    daily = marts.customer_daily(purchases.purchase_items(purchases.latest_purchases(changes_of(spark, snapshot(), snapshot(known=2)))))
    r = daily.collect()
    assert len(r) == 1 and (r[0]["orders"], r[0]["units"], float(r[0]["gross_amount"]), float(r[0]["returned_amount"]), float(r[0]["net_amount"])) == (1, 3, 30, 10, 20)


def test_versions_outrank_time_and_can_empty_an_order(spark):
    found = changes_of(spark, snapshot(version=2, known=1, items="[]", returns="[]"), snapshot(version=1, known=9), snapshot("2", status="CANCELLED"), snapshot("3", customer_id=" "))
    latest = purchases.latest_purchases(found)
    assert {r["order_key"]: r["version"] for r in latest.collect()} == {"shop:1": 2, "shop:2": 1, "shop:3": 1}
    items = purchases.purchase_items(latest)
    assert {r["order_key"] for r in items.collect()} == {"shop:3"} and marts.customer_daily(items).count() == 0


@pytest.mark.parametrize(
    ("change", "reason"),
    [
        ({"currency": "eur"}, purchases.INVALID), ({"source": "Shop"}, purchases.INVALID), ({"order_id": None}, purchases.INVALID), ({"version": "x"}, purchases.INVALID), ({"purchased_at": "soon"}, purchases.INVALID),
        ({"status": "LOST"}, purchases.INVALID), ({"items": "no list"}, purchases.INVALID), ({"items": ITEMS.replace("20.00", "20.009")}, purchases.INVALID), ({"items": ITEMS.replace('"line_id":"2"', '"line_id":"1"')}, purchases.INVALID),
        ({"returns": RETURNS.replace('"line_id":"1"', '"line_id":"9"')}, purchases.INVALID), ({"returns": RETURNS.replace("2024-01-11", "2024-01-09")}, purchases.INVALID), ({"returns": RETURNS.replace("10.00", "25.00")}, purchases.OVER_RETURN),
    ],
)
def test_one_fault_withholds_the_order(spark, change, reason):
    args = {"order_id": "1"} | change
    found = changes_of(spark, snapshot(**args), snapshot("2"))
    assert {r["reason"] for r in purchases.rejection_reasons(found).collect()} == {reason}
    assert {r["order_key"] for r in purchases.accepted_purchases(found).collect()} == {"shop:2"}


def test_conflicting_payloads_and_returns_of_two_versions(spark):
    found = changes_of(spark, snapshot(), snapshot(event="x", country="FR"), snapshot("2"), snapshot("2", version=2), snapshot("3", returns=None))
    assert {(r["order_key"], r["reason"]) for r in purchases.rejection_reasons(found).collect()} == {("shop:1", purchases.CONFLICT)}
    evidence = purchases.rejection_evidence(purchases.rejected_purchases(found), "1").collect()
    assert len(evidence) == 2 and len({r["rejection_id"] for r in evidence}) == 2


def test_order_of_keys_does_not_change_the_hash(spark):
    a, b = snapshot(), snapshot(event="y")
    b = (*b[:2], dict(reversed(b[2].items())), *b[3:])
    assert len({r["content_hash"] for r in changes_of(spark, a, b).collect()}) == 1


def test_profiles_age_and_cohorts_have_zeros(spark):
    daily = spark.createDataFrame([("c", "EUR", date(2024, 1, 31), 1, 1, 5.0), ("c", "EUR", date(2024, 3, 1), 2, 1, 7.0), ("d", "EUR", date(2024, 1, 2), 1, 1, 1.0)], "customer_key string, currency string, metric_date date, orders long, units long, net_amount double")
    daily = daily.withColumn("net_amount", F.col("net_amount").cast("decimal(38,2)"))
    seen = {r["customer_key"]: r["segment"] for r in marts.customer_profiles(daily, date(2024, 3, 2)).collect()}
    later = {r["customer_key"]: r["segment"] for r in marts.customer_profiles(daily, date(2024, 9, 1)).collect()}
    assert seen == {"c": "Repeat", "d": "New"} and later == {"c": "Inactive", "d": "Inactive"}
    grid = sorted((r["month_number"], r["active_customers"], float(r["retention"]), r["complete"]) for r in marts.customer_cohorts(daily, date(2024, 3, 2)).collect())
    assert grid == [(0, 2, 1.0, True), (1, 0, 0.0, True), (2, 1, 0.5, False)]


def _changes(spark, rows):
    return spark.createDataFrame(rows, "k string, country string, at timestamp, lsn long")


def test_history_collapses_runs_and_breaks_ties(spark):
    days = [datetime(2024, 1, d) for d in (1, 2, 3)]
    rows = [("c", "IT", days[0], 1), ("c", "IT", days[1], 2), ("c", "FR", days[2], 3), ("c", "DE", days[2], 4), ("c", "DE", days[2], 4)]
    import random

    for seed in range(3):
        random.Random(seed).shuffle(rows)
        got = sorted((r["at"], r["country"], r["valid_to"], r["is_current"]) for r in history.build_history(_changes(spark, rows), ["k"], ["country"], "at", ["lsn"]).collect())
        assert got == [(days[0], "IT", days[2], False), (days[2], "DE", None, True)]


def test_splices_equal_a_rebuild_in_any_order(spark, tmp_path):
    """Batches in random orders, with ties, repeats, null keys and attributes, give the rebuilt history; a change alters three rows at most."""
    import random

    args = (["k"], ["country"], "at", ["lsn"])
    for seed in range(4):
        rng = random.Random(seed)
        rows = [(rng.choice(["a", "b", None]), rng.choice(["IT", "FR", None]), datetime(2024, 1, rng.randint(1, 25)), n) for n in range(60)]
        rng.shuffle(rows)
        batches = [rows[:30], rows[30:31], rows[31:33], rows[31:33], rows[33:]]
        kept = None
        for i, batch in enumerate(batches):
            altered = history.splice(kept, _changes(spark, [*batch, *batch[:1], ("a", "XX", None, 99)]), *args)
            new = altered if kept is None else versions.upsert(kept, altered, ["k", "at"])
            new.write.parquet(f"{tmp_path}/{seed}-{i}")
            n = altered.count()
            assert n <= 3 * len(batch) and (i != 3 or n == 0)
            kept = spark.read.parquet(f"{tmp_path}/{seed}-{i}")
        show = lambda frame: sorted((str(r["k"]), r["at"], str(r["country"]), r["lsn"], str(r["valid_to"]), r["is_current"]) for r in frame.collect())
        assert show(history.runs(kept)) == show(history.build_history(_changes(spark, rows), *args))
    assert history.splice(kept, _changes(spark, []), *args).count() == 0
    assert history.splice(None, _changes(spark, []), *args).count() == 0


def test_gates_name_all_failures(spark):
    frame = spark.createDataFrame([(None, 1, "A"), ("x", -1, "B"), ("x", 1, "A")], "id string, amount long, status string")
    gates = {"not_null": ["id"], "unique": ["id"], "values": {"status": ["A"]}, "non_negative": ["amount"]}
    with pytest.raises(quality.GateError) as e:
        quality.enforce("t", quality.run_gates(frame, gates))
    assert {c.name for c in e.value.failures} == {"id_not_null", "id_unique", "status_domain", "amount_non_negative"}
    quality.enforce("t", quality.run_gates(frame.limit(0), gates))
    assert quality.reconcile("r", frame, frame, "amount").passed and not quality.reconcile("r", frame, frame.limit(1)).passed


def test_overlaps_are_found_once(spark):
    d = lambda n: datetime(2024, 1, n)
    rows = spark.createDataFrame([("a", d(1), d(5)), ("a", d(3), d(4)), ("a", d(5), None), ("b", d(1), None), ("b", d(2), d(3))], "k string, valid_from timestamp, valid_to timestamp")
    assert sorted((r["k"], r["valid_from"].day) for r in history.overlaps(rows, "k").collect()) == [("a", 3), ("b", 2)]


def test_upserts(spark):
    t = spark.createDataFrame([("a", 2, "old"), ("b", None, "old"), (None, 1, "old")], "k string, v long, s string")
    s = spark.createDataFrame([("a", 2, "new"), ("b", 1, "new"), (None, 2, "new"), ("c", 1, "new")], "k string, v long, s string")
    as_set = lambda df: {(r["k"], r["v"], r["s"]) for r in df.collect()}
    assert as_set(versions.upsert(t, s, ["k"])) == as_set(s)
    newer = versions.upsert_newer(t, s, ["k"], ["v"])
    assert as_set(newer) == {("a", 2, "old"), ("b", 1, "new"), (None, 2, "new"), ("c", 1, "new")}
    assert as_set(versions.upsert_newer(newer, s, ["k"], ["v"])) == as_set(newer)
    assert as_set(versions.insert_absent(t, s, ["k"])) == as_set(t) | {("c", 1, "new")}
    gone = spark.createDataFrame([("a",), ("z",)], "k string")
    assert as_set(versions.replace_groups(t, s.where("k = 'z'"), gone, ["k"])) == {("b", None, "old"), (None, 1, "old")}


def test_ranges_are_checked(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "batch_id long, x string")
    manifest = spark.createDataFrame([(1, "append"), (2, "append"), (4, "append"), (5, "overwrite")], "batch_id long, op string")
    assert versions.batch_range(rows, manifest, None, 2).count() == 2 and versions.batch_range(rows, manifest, 2, 2).count() == 0
    for low, high in ((2, 3), (4, 5), (3, 1)):
        with pytest.raises(ValueError):
            versions.batch_range(rows, manifest, low, high)
    dated = spark.createDataFrame([(datetime(2024, 1, 5),)], "occurred_at timestamp")
    assert versions.date_range(dated, date(2024, 1, 1), date(2024, 1, 31)).count() == 1
    with pytest.raises(ValueError):
        versions.date_range(dated, date(2024, 1, 1), date(2024, 2, 1))


def test_incremental_runs(spark, tmp_path):
    rows = [snapshot(str(i), customer_id=str(i % 3)) for i in range(6)]
    rows += [snapshot("1", version=2, batch=2, customer_id="9"), snapshot("2", event="other", batch=2, country="FR"), snapshot("7", batch=2, currency="x"), snapshot("3", version=2, batch=2, items="[]", returns="[]")]
    store = Store(spark, str(tmp_path))
    bronze = store.write(spark.createDataFrame(rows, BRONZE), "raw", 1)
    manifest = spark.createDataFrame([(1, "append"), (2, "append")], "batch_id long, op string")
    work = jobs.PurchaseAnalytics(store, bronze, manifest)
    first = work.build(date(2024, 1, 20), 1)
    assert work.build(date(2024, 1, 20), 1)["sequence"] == first["sequence"] == 1
    assert work.build(date(2024, 1, 21), 2, publish=False)["sequence"] == 1  # an abandoned run leaves the head
    with pytest.raises(ValueError):
        work.build(date(2024, 1, 1), 2)
    head = work.build(date(2024, 1, 21), 2)
    frames = work.frames()
    assert head["sequence"] == 2 and head["created_by"] == "source"
    assert {r["reason"] for r in frames["purchase_rejections"].collect()} == {purchases.INVALID, purchases.CONFLICT}
    owners = {r["customer_key"]: r["lifetime_orders"] for r in frames["customer_profiles"].collect()}
    assert owners == {"shop:0": 1, "shop:1": 1, "shop:2": 2, "shop:9": 1}
    clean = bronze.where("event_id <> 'other' and event_id <> '7-1'")
    orders = purchases.latest_purchases(purchases.accepted_purchases(purchases.purchase_changes(clean)))
    full = jobs.marts_of(orders, date(2024, 1, 21))
    for name in ("purchase_items", "customer_daily", "customer_profiles", "product_daily", "customer_cohorts"):
        assert versions.same_rows(full[name], frames[name]), name


def test_incremental_equals_full_by_range(spark, tmp_path):
    """An order that is faulty or clashing in one range and right in another is compared too."""
    rows = [snapshot("1"), snapshot("2", currency="x"), snapshot("3"), snapshot("3", event="other", country="FR"), snapshot("4"), snapshot("5")]
    rows += [snapshot("1", version=2, batch=2, currency="x"), snapshot("2", version=2, batch=2), snapshot("3", version=2, batch=2), snapshot("4", event="late", batch=2, country="FR")]
    store = Store(spark, str(tmp_path))
    bronze = store.write(spark.createDataFrame(rows, BRONZE), "raw", 1)
    work = jobs.PurchaseAnalytics(store, bronze, spark.createDataFrame([(1, "append"), (2, "append")], "batch_id long, op string"))
    work.build(date(2024, 1, 20), 1)
    work.build(date(2024, 1, 21), 2)
    full, frames = jobs.marts_of(jobs.accepted_by_range(bronze, [1, 2]), date(2024, 1, 21)), work.frames()
    assert sorted((r["order_key"], r["version"], r["country"] == "FR") for r in full["purchase_orders"].collect()) == [
        ("shop:1", 1, False), ("shop:2", 2, False), ("shop:3", 2, False), ("shop:4", 1, False), ("shop:5", 1, False)
    ]
    for name in ("purchase_items", "customer_daily", "customer_profiles", "product_daily", "customer_cohorts"):
        assert versions.same_rows(full[name], frames[name]), name


def test_runs_write_only_touched_months(spark, tmp_path):
    """An order that moves to another month changes both; the other months stay in the folder of the first run."""
    rows = [snapshot(str(m), purchased_at=f"2023-{m:02d}-05T10:00:00Z", returns=None) for m in range(1, 7)]
    rows += [snapshot("2", version=2, batch=2, purchased_at="2023-04-09T10:00:00Z", returns=None), snapshot("8", version=0, batch=3)]
    store = Store(spark, str(tmp_path))
    bronze = store.write(spark.createDataFrame(rows, BRONZE), "raw", 1)
    work = jobs.PurchaseAnalytics(store, bronze, spark.createDataFrame([(1, "append"), (2, "append"), (3, "append")], "batch_id long, op string"))
    for bound in (1, 2, 3):
        work.build(date(2023, 7, 1), bound)
    for name in ("purchase_orders", "purchase_items", "customer_daily", "product_daily"):
        held = {r["part"]: r["version"] for r in store.parts(name, 3).where("part is not null").collect()}
        assert held == {"2023-01": "1", "2023-03": "1", "2023-04": "2", "2023-05": "1", "2023-06": "1"}, name
    full, frames = jobs.marts_of(jobs.accepted_by_range(bronze, [1, 2, 3]), date(2023, 7, 1)), work.frames()
    for name, frame in full.items():
        assert versions.same_rows(frame, frames[name]), name
    assert frames["purchase_rejections"].count() == 1


def test_tables_without_rows_keep_their_types(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    bronze = store.write(spark.createDataFrame([snapshot(currency="x"), snapshot("2", batch=2)], BRONZE), "raw", 1)
    work = jobs.PurchaseAnalytics(store, bronze, spark.createDataFrame([(1, "append"), (2, "append")], "batch_id long, op string"))
    work.build(date(2024, 1, 20), 1)
    assert [work.frames()[t].count() for t in ("purchase_orders", "purchase_items", "customer_daily")] == [0, 0, 0]
    work.build(date(2024, 1, 20), 2)
    assert [work.frames()[t].count() for t in ("purchase_orders", "purchase_items", "customer_daily")] == [1, 2, 1]


def test_write_audit_publish(spark, tmp_path):
    store, seen = Store(spark, str(tmp_path)), []
    good = spark.createDataFrame([("a", 1)], "id string, amount long")
    gates = {"not_null": ["id"], "non_negative": ["amount"]}
    for name, publish in ((1, None), ("main", seen.append), ("a b", seen.append)):
        with pytest.raises(ValueError):
            write_audit_publish(store, good, "t", name, publish, gates)
    write_audit_publish(store, good, "t", 1, seen.append, gates)
    with pytest.raises(quality.GateError):
        write_audit_publish(store, good.withColumn("amount", F.lit(-1)), "t", 2, seen.append, gates)
    assert seen == ["candidate-1"]
    append_audit(store, run_id="r", pipeline="p", dataset="t", status="FAILED", failure="gate x", ended_at=datetime(2024, 1, 1))
    append_audit(store, run_id="s", pipeline="p", dataset="t", status="SUCCEEDED", rejected_rows=3, ended_at=datetime(2024, 1, 2))
    r = reconcile.pipeline_health(spark.read.parquet(f"{tmp_path}/pipeline_runs"), F.lit("2024-01-02 00:10:00").cast("timestamp")).collect()[0]
    assert list(r["alerts"]) == ["REJECTED_ROWS"]


def test_reconciliation_fails_on_each_fault(spark):
    accepted = spark.createDataFrame([("a",)] * 19, "source_topic string")
    quarantined = spark.createDataFrame([("a",)], "source_topic string")
    expected = spark.createDataFrame([("a", 20)], "source_topic string, events long")
    fine = spark.createDataFrame([("t", 1, 1)], "dataset string, row_count long, expected_rows long")
    result = lambda *a: reconcile.run_report(*a).collect()[0]["result"]
    assert result(accepted, quarantined, expected, fine) == "PASS"
    assert result(accepted, accepted, expected, fine) == "FAIL" and result(accepted, quarantined, expected.withColumn("events", F.lit(21)), fine) == "FAIL"
    assert result(accepted, quarantined, expected, fine.withColumn("row_count", F.lit(2))) == "FAIL" and result(accepted.limit(0), quarantined.limit(0), expected.limit(0), fine) == "FAIL"


def test_pages_cover_every_key_once(spark):
    rows = spark.createDataFrame([(f"k{i:03d}", i) for i in range(120)], "key string, n long")
    seen, after = [], None
    while True:
        found, after = serving.split_page(serving.page(rows, "key", after).collect(), "key")
        seen += [r["key"] for r in found]
        if after is None:
            break
    assert seen == [f"k{i:03d}" for i in range(120)]
    assert serving.capped(rows, 100).truncated and not serving.capped(rows, 120).truncated
    with pytest.raises(ValueError):
        serving.observation_window(date(2024, 1, 1), start=date(2024, 2, 1))


def test_retail_reasons_and_rounding(spark):
    names = ["row_id", "invoice", "product", "quantity", "day_serial", "price", "customer", "country"]
    base = {"row_id": "1", "invoice": "500001", "product": "10001", "quantity": "3", "day_serial": "43831.5", "price": "0.335", "customer": "12", "country": "UK"}
    cases = [({}, "accepted"), ({"invoice": "Invoice"}, "header"), ({"invoice": "C1"}, "unlinked_cancellation"), ({"product": "POST"}, "non_product_or_missing_invoice"), ({"invoice": " "}, "non_product_or_missing_invoice"),
             ({"quantity": "x"}, "invalid_value"), ({"quantity": "0", "price": "x"}, "invalid_value"), ({"quantity": "-1"}, "invalid_quantity"), ({"price": "NaN"}, "non_positive_price"), ({"price": "0"}, "non_positive_price"), ({"country": " "}, "invalid_value")]
    frame = spark.createDataFrame([tuple((base | {"row_id": str(i)} | c)[n] for n in names) for i, (c, _) in enumerate(cases)], ", ".join(f"{n} string" for n in names))
    got = retail.classify(frame)
    assert {int(r["row_id"]): r["reason"] for r in got.collect()} == {i: reason for i, (_, reason) in enumerate(cases)}
    line = retail.typed_lines(got).collect()[0]
    assert str(line["amount"]) == "1.01" and line["purchased_at"] == datetime(2020, 1, 1, 12)
    two = retail.typed_lines(retail.classify(spark.createDataFrame([tuple((base | {"country": c, "row_id": c})[n] for n in names) for c in ("UK", "FR")], frame.schema)))
    assert [r["problem"] for r in retail.invoices(two).collect()] == ["conflicting_headers"] and retail.retail_purchases(two).count() == 0


def test_json_lines_keep_bad_rows(spark, tmp_path):
    (tmp_path / "p.jsonl").write_text('{"source":"shop","order_id":"1","version":1,"items":[],"returns":[]}\n\n{broken\n')
    good, bad = events.read_purchases(spark, str(tmp_path))
    assert good.count() == 1 and [r["raw_value"] for r in bad.collect()] == ["{broken"]


def test_orders_rank_by_sequence_and_payments_by_time(spark):
    def event(kind, at, sequence, offset):
        return (f"{kind}{offset}", kind, datetime(2024, 1, at), "1", {"order_id": "1", "payment_id": "p", "amount": "1.00", "gross_amount": "bad"}, sequence, 0, offset, [])

    schema = "event_id string, event_type string, occurred_at timestamp, partition_key string, payload map<string,string>, producer_sequence long, source_partition int, source_offset long, quality_flags array<string>"
    rows = [event("order.confirmed", 1, 2, 1), event("order.created", 5, 1, 2), event("payment.captured", 1, 9, 3), event("payment.authorized", 2, None, 4)]
    bronze = spark.createDataFrame(rows, schema)
    assert [r["status"] for r in conform.conform_orders(bronze).collect()] == ["CONFIRMED"]
    assert [r["status"] for r in conform.conform_payments(bronze).collect()] == ["AUTHORIZED"]


def test_stream_restart_adds_nothing(spark, tmp_path):
    value = '{"event_id":"e%d","event_type":"a.b","occurred_at":"2024-01-01T00:00:0%dZ","partition_key":"k","payload":{}}'
    rows = [(None, bytearray((value % (i % 7, i % 7)).encode()), "t", 0, i, datetime(2024, 1, 1)) for i in range(10)] + [(None, bytearray(b"{bad"), "t", 0, 10, datetime(2024, 1, 1))]
    root = str(tmp_path)
    spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset long, timestamp timestamp").write.parquet(f"{root}/records")
    for delay, n in (("24 hours", 7), (None, 10)):
        out = f"{root}/{n}"
        for _ in range(2):
            ingest.drain(ingest.ingest(events.event_stream(spark, f"{root}/records"), out, "run", delay))
            assert spark.read.parquet(f"{out}/accepted").count() == n and spark.read.parquet(f"{out}/quarantined").count() == 1


def test_droppable_versions_of_every_order(spark, tmp_path):
    """Every order a publication of one of three pipelines, one of which has most; each task sends few rows of a pipeline."""
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select("o_orderkey", "o_orderdate", F.when(F.col("o_orderkey") % 10 > 1, "p2").otherwise(F.concat(F.lit("p"), F.col("o_orderkey") % 2)).alias("pipeline"))
    named = orders.select("pipeline", F.col("o_orderkey").alias("sequence"), F.col("o_orderdate").cast("timestamp").alias("published_at"), F.explode(F.array(F.lit("a"), F.lit("b"))).alias("table"))
    named = named.withColumn("version", F.when(F.col("table") == "a", F.col("sequence")).otherwise(F.floor(F.col("sequence") / 20)))
    named.write.parquet(str(tmp_path / "named"))
    named = spark.read.parquet(str(tmp_path / "named"))
    rows = [(r["pipeline"], r["sequence"], r["published_at"], (r["table"], r["version"])) for r in named.collect()]
    since = datetime(2001, 7, 1)
    got = versions.droppable_versions(named.select("table", "version").distinct(), named, F.lit(datetime(2001, 7, 11)), last=5, days=10)
    last = {p: sorted({s for q, s, _, _ in rows if q == p})[-5:] for p in {r[0] for r in rows}}
    kept = {v for p, s, at, v in rows if s in last[p] or at >= since}
    assert {(r["table"], r["version"]) for r in got.collect()} == {r[3] for r in rows} - kept
    assert len(last) == 3 and "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()


def test_retail_invoices_beyond_six_digits(spark, tmp_path):
    """Invoice and product numbers longer than their padding stay apart, in the queries and in their SQL."""
    import duckdb

    import __spark_entry__ as entry

    base = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").where("l_orderkey between 1 and 40").toPandas()
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").where("o_orderkey between 1 and 40").toPandas()
    base["l_orderkey"] += 3_000_000
    orders["o_orderkey"] += 3_000_000
    base["l_partkey"] += 1_200_000
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet").toPandas()
    part["p_partkey"] += 1_200_000
    made = {"lineitem": base, "orders": orders, "part": part}
    con = duckdb.connect()
    for name in ("lineitem", "orders", "part", "customer", "nation", "region"):
        if name in made:
            spark.createDataFrame(made[name]).write.parquet(f"{tmp_path}/{name}.parquet")
            con.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
        else:
            spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
            con.execute(f"create view {name} as select * from '/root/testdata/sf0.001/{name}.parquet'")
    for name in ("retail_orders", "retail_report"):
        rows = entry.queries()[name](spark, str(tmp_path))
        want = con.execute(f"select {', '.join(rows.columns)} from ({entry.oracle_sql()[name]})").fetchall()
        assert sorted(map(tuple, rows.collect()), key=str) == sorted(want, key=str), name
    found = entry.queries()["retail_orders"](spark, str(tmp_path)).collect()
    assert len(found) > 20 and all(len(r["order_id"]) == 7 for r in found)
    lines = fixtures.retail_lines(spark, str(tmp_path)).where("product <> 'POST'")
    assert lines.select("product").distinct().count() == base["l_partkey"][base["l_partkey"] % 23 != 0].nunique()


def test_framed_bodies_come_back_whole(spark):
    """The query reads and returns what lies behind each frame, not only the frame."""
    import hashlib

    from tallyspark.plans.catalogue import QUERIES

    sf = "/root/testdata/sf0.001"
    sent = {(r["topic"], r["offset"]): bytes(r["value"]) for r in fixtures.raw_event_stream(spark, sf).collect()}
    rows = QUERIES["framed_events"](spark, sf).collect()
    assert len(rows) == len(sent) and any(not r["framed"] for r in rows)
    for r in rows:
        body = sent[r["topic"], r["offset"]] if r["framed"] else None
        assert (r["body_bytes"], r["body_sha256"]) == ((len(body), hashlib.sha256(body).hexdigest()) if body is not None else (None, None))
        assert r["events"] == sum((x["topic"], x["framed"], x["schema_id"]) == (r["topic"], r["framed"], r["schema_id"]) for x in rows)


def test_lines_are_gathered_once_for_all_deliveries(spark):
    """Snapshots and order events read and gather the lines of an order once, and no event carries all of them."""
    sf = "/root/testdata/sf0.001"
    for made in (fixtures.purchase_bronze(spark, sf), fixtures.order_events(spark, sf)):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Aggregate [l_orderkey") == 1, plan


def test_states_of_orders_need_no_shuffle_of_whole_changes(spark):
    """The changes lie in buckets by order: they are not shuffled again, and only the few reasons are where these can't be sent to all."""
    from tallyspark.plans import catalogue

    sf = "/root/testdata/sf0.001"
    plain = purchases.purchase_changes(catalogue.bronze(spark, sf, "purchase_bronze"))
    want = purchases.latest_purchases(purchases.accepted_purchases(plain))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit, shuffles in ((threshold, 0), ("-1", 1)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            got = catalogue.orders(spark, sf)
            assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == shuffles
            assert versions.same_rows(got, want.select(*got.columns))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_events_do_not_carry_the_lines_of_their_order(spark):
    """What an order tells is worked out before its events are laid out, not again for each event."""
    for make in (fixtures.order_events, fixtures.payment_events):
        plan = make(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        above = plan.split("Generate explode")[0]
        assert "Project" in above and "l_extendedprice" not in above and "l_suppkey" not in above
