"""Event sources: the stream, JSON lines of purchases, retained positions and newest records of topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import KAFKA_SHAPE, SNAPSHOT


def event_stream(spark: SparkSession, path: str | None = None, per_trigger: int = 100, broker: dict[str, str] | None = None) -> DataFrame:
    """A stream of broker records. With broker options the connector is used (it must be on the class path);
    else files of records are read, at most ``per_trigger`` of them a batch."""
    if broker is not None:
        return spark.readStream.format("kafka").options(**broker).load().select(*[c.split()[0] for c in KAFKA_SHAPE.split(", ")])
    return spark.readStream.schema(KAFKA_SHAPE).option("maxFilesPerTrigger", per_trigger).parquet(path)


def read_purchases(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Full-state purchases from JSON lines: (good rows, bad rows with text, file and line number).

    Blank lines are skipped. A bad line does not stop the job; its evidence is returned instead. A file is read in
    splits; a line's number is its place in its split and the lines of the splits before, of which there is one small row each.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"))
    splits = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.select("file", "block", "first", F.coalesce(before, F.lit(0)).alias("before"))
    lines = lines.where(F.length(F.trim("value")) > 0)
    parsed = lines.withColumn("p", F.from_json("value", SNAPSHOT + ", _bad string", {"columnNameOfCorruptRecord": "_bad"}))
    bad = F.col("p").isNull() | F.col("p._bad").isNotNull()
    good = parsed.where(~bad).select("p.*").drop("_bad")
    number = (F.col("before") + F.col("place") - F.col("first") + 1).alias("line_number")
    return good, parsed.where(bad).join(splits, ["file", "block"]).select(F.col("value").alias("raw_value"), "file", number)


def retained_messages(records: DataFrame) -> DataFrame:
    """Per topic its partitions and the messages between their lowest and highest positions."""
    ends = records.groupBy("topic", "partition").agg(F.min("offset").alias("low"), (F.max("offset") + 1).alias("high"))
    return ends.groupBy("topic").agg(F.count(F.lit(1)).alias("partitions"), F.sum(F.greatest(F.col("high") - F.col("low"), F.lit(0))).alias("messages"))


def recent_events(records: DataFrame, topic: str, limit: int, longest: int = 16_384) -> DataFrame:
    """The newest records of a topic, each position once, values cut to ``longest`` bytes. A bounded report."""
    once = records.where(F.col("topic") == topic).dropDuplicates(["topic", "partition", "offset"])
    newest = once.orderBy(F.col("timestamp").desc(), F.col("offset").desc(), "partition").limit(limit)
    return newest.select("topic", "partition", "offset", "timestamp", F.substring("value", 1, longest).alias("value"), (F.octet_length("value") > longest).alias("truncated"))


def recent_per_topic(records: DataFrame, limit: int) -> DataFrame:
    """The newest ``limit`` records of every topic. Spark limits each partition before the shuffle."""
    once = records.dropDuplicates(["topic", "partition", "offset"])
    w = Window.partitionBy("topic").orderBy(F.col("timestamp").desc(), F.col("offset").desc(), "partition")
    return once.withColumn("place", F.row_number().over(w)).where(F.col("place") <= limit)
