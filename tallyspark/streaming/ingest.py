"""Stream ingestion: routing into append-only, upserting and quarantine tables, with replay safety and figures of progress."""

from __future__ import annotations

import json
import threading
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..operators.conform import decode_json, route
from ..operators.purchases import latest
from ..session import path_exists

WATERMARK = "24 hours"
#: Keys of the two keyed tables.
EVENT_KEY, POSITION_KEY = ["event_id"], ["source_topic", "source_partition", "source_offset"]
PROGRESS = "query string, batch_id long, started_at timestamp, input_rows long, late_rows long, state_rows long, watermark timestamp"


def trigger(continuous: str | None = None) -> dict:
    """Process what there is and end, or go on at an interval."""
    return {"processingTime": continuous} if continuous else {"availableNow": True}


def deduplicated(events: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Each event id once within the watermark; rows later than that are dropped and counted by the query's progress."""
    return events.withWatermark("occurred_at", delay).dropDuplicatesWithinWatermark(EVENT_KEY)


def append_sink(rows: DataFrame, path: str, checkpoint: str, continuous: str | None = None, name: str | None = None) -> StreamingQuery:
    """Append-only: the file sink's log makes each epoch count once, and every late correction is kept."""
    writer = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(**trigger(continuous))
    return (writer.queryName(name) if name else writer).start()


class KeyedTable:
    """Rows by key, kept as what each batch brought; the last batch of a key counts, or the first.

    A batch writes its own folder and reads nothing, so its cost is that of its rows, however large the table is, and a batch
    that runs again overwrites itself. Keys are resolved when the table is read; ``settle`` resolves all batches up to one
    into a folder, beside which only later ones are resolved again.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], last: bool = True):
        self.spark, self.path, self.keys, self.last = spark, path, keys, last

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """Keep one row of a key: of several in the batch that with the greatest source time and position."""
        place = [F.col(c) for c in ("source_timestamp", "source_offset", "source_partition") if c in batch.columns]
        latest(batch, self.keys, place if self.last else [-F.col("source_offset")]).write.mode("overwrite").parquet(f"{self.path}/batches/batch={batch_id}")

    def _folder(self, name: str) -> DataFrame | None:
        path = f"{self.path}/{name}"
        return self.spark.read.parquet(path) if path_exists(self.spark, path) else None

    def _parts(self) -> tuple[DataFrame | None, DataFrame | None]:
        """What is settled, and the later batches."""
        batches, settled = self._folder("batches"), self._folder("settled")
        if settled is None or batches is None:
            return None, batches
        upto = settled.agg(F.max("upto")).first()[0]
        return settled.where(F.col("upto") == upto).drop("upto"), batches.where(F.col("batch") > upto)

    def rows(self) -> DataFrame:
        """The table: one row of each key."""
        settled, later = self._parts()
        if later is None:
            raise ValueError(f"{self.path} has no batches")
        order = F.col("batch") if self.last else -F.col("batch")
        resolved = latest(later, self.keys, [order])
        if settled is not None:
            over, under = (resolved, settled) if self.last else (settled, resolved)
            resolved = over.unionByName(under.join(over.select(*self.keys), self.keys, "left_anti"))
        return resolved.drop("batch")

    def settle(self, upto: int) -> None:
        """Resolve all batches up to ``upto``; it must have ended, and an earlier settling is taken along."""
        settled, later = self._parts()
        order = F.col("batch") if self.last else -F.col("batch")
        rows = later.where(F.col("batch") <= upto)
        rows = rows if settled is None else rows.unionByName(settled)
        latest(rows, self.keys, [order]).write.mode("overwrite").parquet(f"{self.path}/settled/upto={upto}")


def _keyed_sink(rows: DataFrame, table: KeyedTable, checkpoint: str, metrics: str | None, continuous: str | None, name: str | None) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        if not metrics:
            table.write(batch, batch_id)
            return
        seen = Observation()
        table.write(batch.observe(seen, F.max("source_timestamp").alias("newest"), F.count(F.lit(1)).alias("rows")), batch_id)
        now, facts = datetime.now(timezone.utc), seen.get
        lag = (now - facts["newest"].astimezone(timezone.utc)).total_seconds() if facts["newest"] else None
        row = [(facts["newest"], facts["rows"], max(0.0, lag) if lag is not None else None)]
        batch.sparkSession.createDataFrame(row, "max_source_timestamp timestamp, rows long, lag_seconds double").coalesce(1).write.mode("overwrite").parquet(f"{metrics}/batch={batch_id}")

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger(continuous))
    return (writer.queryName(name) if name else writer).start()


def accepted_table(spark: SparkSession, root: str) -> KeyedTable:
    """Accepted events: a delivery of a known id replaces what there was."""
    return KeyedTable(spark, f"{root}/accepted", EVENT_KEY)


def quarantine_table(spark: SparkSession, root: str) -> KeyedTable:
    """Faulty records, each source position once; the first seen stays."""
    return KeyedTable(spark, f"{root}/quarantined", POSITION_KEY, last=False)


def ingest(records: DataFrame, root: str, run_id: str, delay: str | None = WATERMARK, continuous: str | None = None) -> list[StreamingQuery]:
    """One stream of records into two tables with checkpoints of their own.

    With a delay, accepted events are made unique within the watermark and upserted; without one, every
    delivery is appended and the canonical step resolves versions.
    """
    spark = records.sparkSession
    routed = route(decode_json(records), run_id)
    if delay is None:
        first = append_sink(routed.accepted, f"{root}/accepted", f"{root}/checkpoints/accepted", continuous)
    else:
        first = _keyed_sink(deduplicated(routed.accepted, delay), accepted_table(spark, root), f"{root}/checkpoints/accepted", f"{root}/metrics", continuous, None)
    return [first, _keyed_sink(routed.quarantined, quarantine_table(spark, root), f"{root}/checkpoints/quarantined", None, continuous, None)]


class ProgressLog(StreamingQueryListener):
    """Progress of streaming queries as rows: of each batch what came in, what came too late, and the watermark.

    A listener hears of every batch, however long a query runs; ``save`` writes what it has heard since.
    """

    def __init__(self):
        self._lock, self._rows, self._ended = threading.Lock(), [], {}

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self._ended.setdefault(str(event.id), threading.Event())

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        at = lambda text: datetime.fromisoformat(text.replace("Z", "+00:00")) if text else None
        late = sum(int(s.get("numRowsDroppedByWatermark", 0)) for s in p["stateOperators"])
        held = sum(int(s.get("numRowsTotal", 0)) for s in p["stateOperators"])
        with self._lock:
            self._rows.append((p.get("name") or p["id"], p["batchId"], at(p["timestamp"]), p["numInputRows"], late, held, at(p.get("eventTime", {}).get("watermark"))))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended.setdefault(str(event.id), threading.Event()).set()

    def wait(self, queries: list[StreamingQuery], timeout: float = 60.0) -> None:
        """Until the end of the queries has been heard, and with it all their progress."""
        for q in queries:
            with self._lock:
                ended = self._ended.setdefault(str(q.id), threading.Event())
            if not ended.wait(timeout):
                raise TimeoutError("the end of a query was not heard")

    def save(self, spark: SparkSession, path: str) -> None:
        """Append what was heard (a row for each batch) and forget it."""
        with self._lock:
            rows, self._rows = self._rows, []
        spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(path)


def drain(queries: list[StreamingQuery], timeout: float = 600.0) -> None:
    """Wait until all available input is processed; a failed or late query raises."""
    for q in queries:
        done = q.awaitTermination(timeout)
        if q.exception():
            raise RuntimeError(str(q.exception()))
        if not done:
            q.stop()
            raise TimeoutError(f"the query did not end within {timeout} s")


def run_logged(spark: SparkSession, root: str, start, timeout: float = 600.0) -> None:
    """Start queries, drain them, and write their progress to ``<root>/progress``."""
    log = ProgressLog()
    spark.streams.addListener(log)
    try:
        queries = start()
        drain(queries, timeout)
        log.wait(queries)
    finally:
        spark.streams.removeListener(log)
    log.save(spark, f"{root}/progress")
