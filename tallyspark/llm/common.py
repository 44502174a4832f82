"""What several operators share: shared tables, gapless ranks, connected components."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that all machines share, from spark.checkpoint.dir.

    Only where the setting is absent on a local master (tests on one machine) a folder of our own is made and set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def table(df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared folder and read it back; cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bits for each key, and least and most bits, of a bitmap. The most are 128 MB; beyond that a bitmap lets more through.
KEY_BITS, LEAST_BITS, MOST_BITS = 8, 1 << 20, 1 << 30


def bitmap(keys: DataFrame, column: str) -> tuple[np.ndarray, int]:
    """Bits and size of a bitmap of the long keys in ``column``, of bounded size: a first sieve whose passes a join confirms."""
    size = LEAST_BITS
    while size < min(MOST_BITS, KEY_BITS * keys.count()):
        size *= 2
    slot = F.pmod(F.col(column), F.lit(size)) + 1
    marked = keys.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    bits = np.zeros(size // 8, np.uint8)
    for r in marked.toLocalIterator():  # at most ``size`` bits
        part = np.frombuffer(r["bits"], np.uint8)
        here = bits[(r["bucket"] - 1) * len(part) :][: len(part)]
        here |= part[: len(here)]
    return bits, size


def in_bitmap(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the long keys a bitmap lets through."""
    slot = np.mod(keys, len(bits) * 8)
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)


#: Rows of a key in one bucket of gapless_rank.
RANKED = 100_000


def gapless_rank(df: DataFrame, keys: list[str], spread: Column, order: list[Column], name: str, buckets: int | None = None) -> DataFrame:
    """Number the rows of each key from 0 without gaps, without one task per key.

    A key's rows are dealt by ``spread`` over buckets, as many as the rows need; the rank is the number of
    the key's rows in earlier buckets plus the row number within the bucket, so a key that holds a third of
    all rows is split. Keys must not be null. ``df`` is read more than once and must give the same rows each
    time; rows that agree in ``spread`` share a bucket.
    """
    buckets = buckets or max(64, -(-df.count() // RANKED))
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(spread), F.lit(buckets)).cast("int"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(*keys, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*keys, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    within = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    return (
        dealt.withColumn("_row", F.row_number().over(within) - 1)
        .join(starts, [*keys, "_bucket"])
        .withColumn(name, F.col("_start") + F.col("_row"))
        .drop("_bucket", "_row", "_start")
    )


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """Connected components by alternating large-star and small-star rounds.

    ``edges`` has long columns src and dst, in any direction and with repeats. Returns (node, component)
    for every node that has an edge to another; component is the smallest node of its component.
    Each round is a pair of aggregations and joins on the edges, written to the shared folder.
    """
    now = table(edges.where("src <> dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct(), "edges")

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first())

    seen = state(now)
    for _ in range(rounds):
        if not seen[0]:
            break
        both = now.unionByName(now.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        lowest = both.groupBy("src").agg(F.least(F.min("dst"), F.first("src")).alias("m"))
        large = both.where("dst > src").join(lowest, "src").select(F.col("dst").alias("src"), F.col("m").alias("dst")).distinct()
        lowest = large.groupBy("src").agg(F.min("dst").alias("m"))
        small = large.join(lowest, "src").select(F.explode(F.array(F.struct(F.col("src").alias("a"), F.col("m").alias("b")), F.struct(F.col("dst").alias("a"), F.col("m").alias("b")))).alias("e"))
        now = table(small.select(F.col("e.a").alias("src"), F.col("e.b").alias("dst")).where("src <> dst").distinct(), "edges")
        after = state(now)
        if after == seen:
            break
        seen = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = now.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
    return now.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionByName(roots)
