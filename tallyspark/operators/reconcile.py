"""Reconciliation of runs, tables and evidence, payment findings, pipeline health and latency."""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .purchases import latest


def dataset_counts(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(dataset, row_count, expected_rows) of each named (actual, expected) pair, as one union."""
    parts = [
        actual.agg(F.count(F.lit(1)).alias("row_count")).join(expected.agg(F.count(F.lit(1)).alias("expected_rows"))).select(F.lit(name).alias("dataset"), "row_count", "expected_rows")
        for name, (actual, expected) in pairs.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def matching_rows(actual: DataFrame, expected: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Rows of both frames with equal keys and equal values, nulls equal to nulls."""
    a, b = actual.select(*keys, *values).alias("a"), expected.select(*keys, *values).alias("b")
    rule = reduce(Column.__and__, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*keys, *values]])
    return a.join(b, rule).select(*[F.col(f"a.{c}").alias(c) for c in [*keys, *values]])


def matching_using(actual: DataFrame, expected: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys (never null) of both frames under which they have the same value."""
    return actual.select(*keys, value).join(expected.select(*keys, F.col(value).alias("_expected")), keys).where(F.col(value) == F.col("_expected")).drop("_expected")


def events_per_topic(bronze: DataFrame, run: str | None = None) -> DataFrame:
    if run is not None:
        bronze = bronze.where(F.col("payload")["simulation_id"] == run)
    return bronze.groupBy("source_topic").agg(F.count(F.lit(1)).alias("events"))


def latency_ms(start: str = "source_timestamp", end: str = "ingested_at") -> Column:
    return F.unix_millis(end) - F.unix_millis(start)


#: Size parameter of the quantile sketches; a quantile's rank is off by RANK_ERROR at most in 99 of 100 sketches.
SKETCH, RANK_ERROR = 400, 0.0068


def latency_sketches(bronze: DataFrame) -> DataFrame:
    """Per topic and day of arrival the number of events and a mergeable sketch of their delays in ms."""
    return bronze.groupBy("source_topic", F.to_date("ingested_at").alias("day")).agg(F.count(F.lit(1)).alias("events"), F.kll_sketch_agg_bigint(latency_ms(), SKETCH).alias("delays"))


def merged_percentiles(sketches: DataFrame, shares: dict[str, float], by: list[str] | None = None) -> DataFrame:
    """Percentiles of any union of topics and days from their sketches; no event is read again."""
    merged = sketches.groupBy(*(by or [])).agg(F.sum("events").alias("events"), F.kll_merge_agg_bigint("delays", SKETCH).alias("delays"))
    return merged.select(*(by or []), "events", *[F.kll_sketch_get_quantile_bigint("delays", F.lit(float(q))).cast("double").alias(n) for n, q in shares.items()])


def ingest_latency(bronze: DataFrame, exact: bool = False) -> DataFrame:
    """Median and 95th percentile of the delay from source to table, in ms; of a sketch, unless asked exact (interpolated)."""
    if not exact:
        return merged_percentiles(latency_sketches(bronze), {"p50_ms": 0.5, "p95_ms": 0.95}).drop("events")
    delays = bronze.select(latency_ms().alias("ms")).where("ms is not null")
    n = delays.count()
    # The value at share q lies between two places from 0: (n - 1) q rounded down and up.
    places = {name: ((n - 1) * q, name) for name, q in (("p50_ms", 0.5), ("p95_ms", 0.95))}
    wanted = {f"{name}_{side}": int(x) + (side == "high" and x > int(x)) for name, (x, _) in places.items() for side in ("low", "high")}
    found = at_places(delays, "ms", wanted)
    row = found.groupBy().agg(*[F.max(F.when(F.col("name") == k, F.col("value"))).alias(k) for k in wanted])
    between = lambda name: F.col(f"{name}_low") + (F.col(f"{name}_high") - F.col(f"{name}_low")) * F.lit(places[name][0] - int(places[name][0]))
    return row.select(*[between(name).cast("double").alias(name) for name in places])


def at_places(samples: DataFrame, value: str, places: dict[str, int], ranges: int = 64) -> DataFrame:
    """(name, value): the values at given places, counted from 0 in rising order.

    Values are counted first; of the counts, sums per range tell in which range a place lies, and only these ranges are
    put in order, each apart. The cuts between ranges are approximate quantiles; the result is exact however good they are.
    """
    counts = samples.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n")).persist()
    try:
        cuts = counts.agg(F.percentile_approx("value", [i / ranges for i in range(1, ranges)], 10_000).alias("cuts")).first()["cuts"] or []
        number = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col("value"))) if cuts else F.lit(0)
        placed = counts.withColumn("range", number)
        held = {r["range"]: r["n"] for r in placed.groupBy("range").agg(F.sum("n").alias("n")).collect()}  # a row a range
        starts, total = {}, 0
        for r in sorted(held):
            starts[r], total = total, total + held[r]
        rows = [(name, r, place - starts[r]) for name, place in places.items() for r in starts if starts[r] <= place < starts[r] + held[r]]
        asked = samples.sparkSession.createDataFrame(rows, "name string, range int, place long")
        upto = F.sum("n").over(Window.partitionBy("range").orderBy("value"))
        near = placed.where(F.col("range").isin(sorted({r for _, r, _ in rows}))).withColumn("upto", upto)
        found = near.join(asked, "range").where("upto > place").groupBy("name").agg(F.min("value").alias("value")).collect()  # a row a name
        return samples.sparkSession.createDataFrame([(r["name"], r["value"]) for r in found], StructType([StructField("name", StringType()), StructField("value", samples.schema[value].dataType)]))
    finally:
        counts.unpersist()


def nearest_rank(samples: DataFrame, value: str, shares: list[float], ranges: int = 64) -> DataFrame:
    """Percentiles of samples by nearest rank: the value at place ceil(share x count), counted from 1."""
    n = samples.where(F.col(value).isNotNull()).count()
    found = at_places(samples, value, {str(q): max(1, ceil(q * n - 1e-9)) - 1 for q in shares} if n else {}, ranges)
    return found.select(F.col("name").cast("double").alias("share"), "value")


def run_report(accepted: DataFrame, quarantined: DataFrame, expected: DataFrame, datasets: DataFrame, most_quarantined: float = 0.05, sketches: DataFrame | None = None) -> DataFrame:
    """One row that says whether a run reconciles: all topics whole, all datasets as expected, quarantine rate bounded.

    ``expected`` has source_topic and events; ``datasets`` is the result of dataset_counts. With sketches of delays
    (``latency_sketches``) the row has their median and 95th percentile too.
    """
    per_topic = accepted.select("source_topic").withColumn("q", F.lit(0)).unionByName(quarantined.select("source_topic").withColumn("q", F.lit(1)))
    got = per_topic.groupBy("source_topic").agg(F.count(F.lit(1)).alias("seen"), F.sum("q").alias("bad"))
    topics = got.join(expected.select("source_topic", F.col("events").alias("expected")), "source_topic", "full_outer")
    facts = topics.agg(
        F.sum(F.coalesce("seen", F.lit(0))).alias("events"),
        F.sum(F.coalesce("bad", F.lit(0))).alias("quarantined"),
        F.count_if(~F.col("seen").eqNullSafe(F.col("expected"))).alias("topics_off"),
    )
    off = datasets.agg(F.count_if(F.col("row_count") != F.col("expected_rows")).alias("datasets_off"))
    rate = F.coalesce(F.col("quarantined") / F.when(F.col("events") > 0, F.col("events")), F.lit(0.0))
    passed = (F.col("topics_off") == 0) & (F.col("datasets_off") == 0) & (F.col("events") > 0) & (rate <= most_quarantined)
    report = facts.join(off).withColumns({"quarantine_rate": rate, "result": F.when(passed, "PASS").otherwise("FAIL")})
    if sketches is None:
        return report
    return report.join(merged_percentiles(sketches, {"p50_ms": 0.5, "p95_ms": 0.95}).drop("events"))  # one row each


def evidence_findings(acknowledged: DataFrame, bronze: DataFrame) -> DataFrame:
    """What is wrong between acknowledged sends (event_id, content_hash, topic, partition, offset) and the table.

    Each event must be there once, unchanged, at an acknowledged position. Findings: MISSING, REPEATED,
    CHANGED, POSITION_UNKNOWN, UNEXPECTED; one row for each event and finding.
    """
    sent = acknowledged.groupBy("event_id").agg(F.min("content_hash").alias("sent_hash"), F.collect_set(F.struct("topic", "partition", "offset")).alias("positions"))
    place = F.struct(F.col("source_topic").alias("topic"), F.col("source_partition").alias("partition"), F.col("source_offset").alias("offset"))
    held = bronze.groupBy("event_id").agg(F.count(F.lit(1)).alias("n"), F.min("content_hash").alias("low"), F.max("content_hash").alias("high"), F.collect_set(place).alias("held"))
    both = sent.join(held, "event_id", "full_outer")
    known = F.col("positions").isNotNull() & F.col("n").isNotNull()
    found = F.filter(
        F.array(
            F.when(F.col("n").isNull(), "MISSING"),
            F.when(F.col("positions").isNull(), "UNEXPECTED"),
            F.when(known & (F.col("n") > 1), "REPEATED"),
            F.when(known & ((F.col("low") != F.col("sent_hash")) | (F.col("high") != F.col("sent_hash"))), "CHANGED"),
            F.when(known & (F.size(F.array_except("held", "positions")) > 0), "POSITION_UNKNOWN"),
        ),
        lambda x: x.isNotNull(),
    )
    return both.select("event_id", F.explode(found).alias("finding"))


#: A finding's age and amount limits: minutes before a capture is missed, and what makes a finding urgent.
MISSED_AFTER, URGENT_AFTER, URGENT_AMOUNT = 30, 120, 100


def unclashed(events: DataFrame, content: list[str], event_id: str = "last_event_id") -> DataFrame:
    """Events of which all copies agree in ``content``, each once; of an id with differing copies none is trusted."""
    row = F.struct(*[F.col(c) for c in content])
    each = events.groupBy(event_id).agg(F.min(row).alias("_low"), F.max(row).alias("_high"), F.min(F.struct(*[c for c in events.columns if c != event_id])).alias("_row"))
    return each.where(F.col("_low").eqNullSafe(F.col("_high"))).select(event_id, "_row.*")


def payment_findings(orders: DataFrame, payments: DataFrame, cutoff: Column) -> DataFrame:
    """At most one finding per confirmed order, as of ``cutoff``: currency mismatch, then missing capture, then amount mismatch.

    ``orders`` are current states, ``payments`` the events of payments (entity_events), with ``received_at`` if
    their receipt is known. Events that occurred or were received after the cutoff are not looked at, and neither are
    events that come in differing copies (``unclashed``). Of each payment the latest capture or reversal counts, whatever authorisations follow;
    active captures are summed by currency. An order without amount needs no capture.
    """
    seen = F.col("updated_at") <= cutoff
    if "received_at" in payments.columns:
        seen = seen & (F.col("received_at") <= cutoff)
    moved = payments.where(F.col("status").isin("CAPTURED", "REVERSED") & seen)
    last = latest(moved.select("payment_id", "order_id", "currency", "amount", "status", "updated_at", "source_offset", "last_event_id"), ["payment_id"], [F.col(c) for c in ("updated_at", "source_offset", "last_event_id")])
    sums = last.where("status = 'CAPTURED'").groupBy("order_id", "currency").agg(F.sum("amount").cast("decimal(38,2)").alias("paid"))
    of_order = sums.groupBy("order_id").agg(F.map_from_entries(F.collect_list(F.struct("currency", "paid"))).alias("paid"))
    due = orders.where((F.col("status") == "CONFIRMED") & (F.col("updated_at") <= cutoff)).select("order_id", "currency", "gross_amount", "updated_at")
    joined = due.join(of_order, "order_id", "left").withColumns({
        "paid_amount": F.col("paid")[F.col("currency")],
        "foreign": F.exists(F.map_keys("paid"), lambda x: x != F.col("currency")),
        "age": F.timestamp_diff("MINUTE", F.col("updated_at"), cutoff),
    })
    finding = (
        F.when(F.col("foreign"), "CURRENCY_MISMATCH")
        .when(F.col("paid").isNull() & (F.col("gross_amount") > 0) & (F.col("age") >= MISSED_AFTER), "MISSING_CAPTURE")
        .when(F.col("paid_amount") != F.col("gross_amount"), "AMOUNT_MISMATCH")
    )
    urgent = F.when(F.col("finding") == "MISSING_CAPTURE", F.col("age") >= URGENT_AFTER).when(F.col("finding") == "AMOUNT_MISMATCH", F.abs(F.col("paid_amount") - F.col("gross_amount")) >= URGENT_AMOUNT).otherwise(True)
    found = joined.withColumn("finding", finding).where("finding is not null")
    return found.select("order_id", "currency", "gross_amount", "paid_amount", "finding", F.when(urgent, "HIGH").otherwise("NORMAL").alias("priority"))


def pipeline_health(runs: DataFrame, now: Column, stale_minutes: int = 30) -> DataFrame:
    """Per pipeline: last success and failure, rejected rows of the last run, and what is wrong."""
    ended = F.col("ended_at")
    facts = runs.groupBy("pipeline").agg(
        F.max(F.when(F.col("status") == "SUCCEEDED", ended)).alias("last_success"),
        F.max(F.when(F.col("status") == "FAILED", ended)).alias("last_failure"),
        F.max(F.when(F.col("failure").startswith("gate"), ended)).alias("last_gate_failure"),
        F.max_by("rejected_rows", "ended_at").alias("rejected_rows"),
    )
    stale = F.col("last_success").isNull() | (F.col("last_success") < now - F.make_dt_interval(mins=F.lit(stale_minutes)))
    failing = F.col("last_failure") > F.coalesce("last_success", F.lit("1970-01-01").cast("timestamp"))
    gate = F.col("last_gate_failure") >= now - F.make_dt_interval(mins=F.lit(stale_minutes))
    flags = F.array(F.when(stale, "STALE"), F.when(failing, "FAILING"), F.when(gate, "GATE_FAILED"), F.when(F.col("rejected_rows") > 0, "REJECTED_ROWS"))
    return facts.withColumn("alerts", F.filter(flags, lambda x: x.isNotNull()))


def event_state_mismatches(events: DataFrame, current: DataFrame, key: str, rank: list[Column]) -> DataFrame:
    """Entities whose current state is not that of their last event (frames with the key and status)."""
    last = latest(events, [key], rank).select(key, F.col("status").alias("event_status"))
    return last.join(current.select(key, "status"), key, "full_outer").where(~F.col("status").eqNullSafe(F.col("event_status")))
