"""Tables as immutable versions: a version is a Parquet folder, and readers are told which one to read.

Writers name a version themselves, so a repeated attempt overwrites its own output and nothing else.
One writer per table is assumed.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import names_in, path_exists


PARTS = "part string, version string, schema string"


class Store:
    """A folder of versioned tables. ``rows`` tells how many rows each table got when it was last written."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.rows: dict[str, int] = {}
        self._held: dict[tuple[str, str], list] = {}  # parts of versions; these do not change
        self._unwritten: dict[str, list] = {}  # rows of parts by their path, until they are written

    def _write(self, df: DataFrame, table: str, version: int | str, partition_by: list[str], order: tuple[str, ...] = ()) -> None:
        """Write a version's folder, with the rows of a file in ``order``; its rows are counted on the way."""
        seen = Observation()
        rows = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        writer = (rows.sortWithinPartitions(*partition_by, *order) if order else rows).write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self.path(table, version))
        self.rows[table] = seen.get["rows"]

    def path(self, table: str, version: int | str) -> str:
        return f"{self.root}/{table}/v={version}"

    def write(self, df: DataFrame, table: str, version: int | str, partition_by: list[str] | None = None) -> DataFrame:
        """Write (or write again) a version and read it back; partitions are derived columns of the frame."""
        self._write(df, table, version, partition_by or [])
        return self.read(table, version, df.schema)

    def write_parts(self, df: DataFrame, table: str, version: int | str, by: str, before: int | str | None = None, touched: list[str] | None = None, order: tuple[str, ...] = (), laid: bool = False, add: bool = False) -> DataFrame:
        """Write the partitions of a table that change, by the text column ``by``, and read the new version.

        ``df`` has all rows of the partitions ``touched`` and any new ones, or the whole table if there is no version before.
        The other partitions stay in the folders of earlier versions; a row per partition in ``<table>.parts``
        says in which (``write_down``), so a version's folder may go only when no version that is kept names it. Adaptive
        execution splits a large partition over tasks and puts small ones together; rows that are ``laid`` out by partition
        already, as those read from such a table, are not moved. ``order`` is that of the rows in a file. With ``add`` the rows are
        added to what the version before has in their partitions, so that a partition lies in several folders.
        """
        self._write(df if laid else df.hint("rebalance", F.col(by)), table, version, [by], order)
        # The folder names tell which partitions there are; a row without a partition keeps the types of a table without rows.
        written = [n.split("=", 1)[1] for n in names_in(self.spark, self.path(table, version)) if n.startswith(f"{by}=")]
        kept = [] if before is None else [(r["part"], r["version"]) for r in self.held(table, before) if r["part"] is not None and (add or r["part"] not in touched)]
        rows = [(part, held, df.schema.json()) for part, held in [(None, None), *((p, str(version)) for p in written), *kept]]
        self._unwritten[self.path(f"{table}.parts", version)] = rows
        self._held[table, str(version)] = [Row(part=p, version=v, schema=s) for p, v, s in rows]
        return self.read(table, f"{version}@{by}")

    def write_down(self) -> None:
        """Write the rows that say where parts lie; to be done before a publication names the versions. One small file a table."""
        write = lambda path, rows: self.spark.createDataFrame(rows, PARTS).coalesce(1).write.mode("overwrite").parquet(path)
        if self._unwritten:
            with ThreadPoolExecutor(len(self._unwritten)) as pool:
                for done in [pool.submit(write, *item) for item in self._unwritten.items()]:
                    done.result()
        self._unwritten = {}

    def parts(self, table: str, version: int | str) -> DataFrame:
        """The partitions of a version and the versions whose folders hold them."""
        return self.spark.read.schema(PARTS).parquet(self.path(f"{table}.parts", str(version).split("@")[0]))

    def held(self, table: str, version: int | str) -> list:
        """The rows of ``parts``, one a partition, read once."""
        key = (table, str(version).split("@")[0])
        if key not in self._held:
            self._held[key] = self.parts(*key).collect()
        return self._held[key]

    def part_folders(self, tables: list[str]) -> DataFrame:
        """(table, version, held): the versions in whose folders the parts of each version lie, for tables kept in parts."""
        found = []
        for table in tables:
            path = f"{self.root}/{table}.parts"
            rows = self.spark.read.schema("version string, v string").option("basePath", path).parquet(path).where("version is not null")
            found.append(rows.select(F.lit(table).alias("table"), F.col("v").alias("version"), F.col("version").alias("held")).distinct())
        return reduce(DataFrame.unionByName, found)

    def writers(self, table: str, version: int | str) -> list[str]:
        """The versions in whose folders the parts of a version lie, in order of their numbers."""
        return sorted({r["version"] for r in self.held(table, version) if r["version"] is not None}, key=int)

    def _read_parts(self, table: str, version: str, by: str, writer: str | None = None) -> DataFrame:
        """A version in parts: the folders it names, filtered by partition columns, which the scan prunes.

        ``writer`` names a column that tells the version in whose folder a row lies.
        """
        named = self.held(table, version)
        schema = StructType.fromJson(json.loads(named[0]["schema"]))
        folders: dict[str, list[str]] = {}
        for row in named:
            if row["version"] is not None:
                folders.setdefault(row["version"], []).append(row["part"])
        if not folders:
            return self.spark.createDataFrame([], schema if writer is None else StructType([*schema, StructField(writer, StringType())]))
        rows = self.spark.read.schema(StructType([*schema, StructField("v", StringType())])).option("basePath", f"{self.root}/{table}")
        rows = rows.parquet(*[self.path(table, v) for v in folders])
        held = [(F.col("v") == v) & F.col(by).isin(values) for v, values in folders.items()]
        return rows.where(reduce(Column.__or__, held)).select(*schema.names, *([] if writer is None else [F.col("v").alias(writer)]))

    def read(self, table: str, version: int | str, schema=None, writer: str | None = None) -> DataFrame:
        """A table at a pinned version; columns that the version lacks are null. ``n@by`` is version n in parts by a column (``writer``: see there)."""
        if "@" in str(version):
            return self._read_parts(table, *str(version).split("@"), writer)
        reader = self.spark.read.option("mergeSchema", "true")
        if schema is not None:
            reader = self.spark.read.schema(schema)
        return reader.parquet(self.path(table, version))

    def files(self, table: str, version: int | str) -> DataFrame:
        return file_statistics(self.read(table, version))


def file_statistics(df: DataFrame) -> DataFrame:
    """Rows and bytes of each file behind a frame that reads files."""
    return df.select("_metadata.file_path", "_metadata.file_size").groupBy("file_path").agg(F.count(F.lit(1)).alias("records"), F.max("file_size").alias("bytes"))


def with_columns_of(df: DataFrame, schema) -> DataFrame:
    """df with missing columns of ``schema`` added as nulls, in its order (additive migration)."""
    have = set(df.columns)
    return df.select(*[F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows replace target rows of the same keys; nulls are equal. Source keys must be unique."""
    return target.join(source.select(*keys), _same(target, source, keys), "left_anti").unionByName(source)


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    rule = None
    for k in keys:
        one = left[k].eqNullSafe(right[k])
        rule = one if rule is None else rule & one
    return rule


def upsert_newer(target: DataFrame, source: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """Like upsert, but a target row goes only for a strictly newer version (compared column by column, nulls lowest).

    Of source rows of the same keys the newest counts.
    """
    old = target.select(*[F.col(c) for c in source.columns], F.lit(1).alias("_old"))
    new = source.withColumn("_old", F.lit(0))
    rank = F.struct(*[F.col(c) for c in version], F.col("_old"))
    best = F.max_by(F.struct(*[F.col(c) for c in source.columns]), rank)
    return old.unionByName(new).groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(best.alias("_row")).select("_row.*")


def insert_absent(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose keys the target lacks are added; nothing is changed."""
    return target.unionByName(source.join(target.select(*keys), _same(source, target, keys), "left_anti"))


def replace_groups(target: DataFrame, source: DataFrame, affected: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of the affected groups are replaced by the source's; groups that the source lacks become empty."""
    return target.join(affected.select(*keys).distinct(), keys, "left_anti").unionByName(source)


def group_changes(target: DataFrame, source: DataFrame, affected: DataFrame, keys: list[str], row_keys: list[str]) -> DataFrame:
    """The change that replace_groups makes: source rows, and a removal for each row of the groups that is not there any more."""
    held = target.join(affected.select(*keys).distinct(), keys, "left_semi")
    gone = held.join(source.select(*row_keys), row_keys, "left_anti")
    return source.withColumn("_remove", F.lit(False)).unionByName(gone.withColumn("_remove", F.lit(True)))


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Only the partitions that df has are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def append_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Append a batch under its number; writing the same batch again replaces it."""
    df.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)


def batch_range(bronze: DataFrame, manifest: DataFrame, start: int | None, end: int) -> DataFrame:
    """Rows of the batches in (start, end], after checking that all of them are there and were appended.

    ``manifest`` has batch_id and op. Without a start the range begins with the first batch. Nothing is
    read for an empty range. The check reads one aggregated row.
    """
    low = start if start is not None else 0
    if low > end:
        raise ValueError(f"the range ({low}, {end}] runs backwards")
    if low == end:
        return bronze.limit(0)
    facts = manifest.where(F.col("batch_id").between(low + 1, end)).agg(F.countDistinct("batch_id").alias("n"), F.count(F.when(F.col("op") != "append", 1)).alias("changed")).first()
    if facts["changed"]:
        raise ValueError(f"{facts['changed']} batches of ({low}, {end}] are not plain appends")
    if facts["n"] != end - low:
        raise ValueError(f"{end - low - facts['n']} batches of ({low}, {end}] are missing")
    return bronze.where((F.col("batch_id") > low) & (F.col("batch_id") <= end))


def read_range(bronze: DataFrame, manifest: DataFrame, start: int | None = None, end: int | None = None) -> tuple[DataFrame, str]:
    """Rows of a range of batches whose bounds may be left open, and the words by which a run records it.

    Without any bound it is the table as it is; an open end reaches to the last batch at hand.
    """
    if start is None and end is None:
        return bronze, "full-current-snapshot"
    words = ",".join(f"{name}={value}" for name, value in (("start", start), ("end", end)) if value is not None)
    if end is None:
        end = manifest.agg(F.max("batch_id")).first()[0] or start
    return batch_range(bronze, manifest, start, end), words


def date_range(events: DataFrame, first, last, column: str = "occurred_at", most_days: int = 31) -> DataFrame:
    """Events of the dates first to last, both included; at most ``most_days`` wide."""
    days = (last - first).days
    if days < 0 or days >= most_days:
        raise ValueError(f"a backfill covers 1 to {most_days} days in order")
    return events.where(F.to_date(column).between(F.lit(first), F.lit(last)))


def compact(store: Store, table: str, version: int | str, new_version: int | str, target_bytes: int = 512 << 20) -> DataFrame:
    """Rewrite a version into files of about ``target_bytes`` as a new version with the same rows."""
    before = store.read(table, version)
    size = file_statistics(before).agg(F.sum("bytes")).first()[0] or 0
    after = store.write(before.repartition(max(1, ceil(size / target_bytes))), table, new_version)
    if not same_rows(before, after):
        raise RuntimeError(f"compaction of {table} changed rows")
    return after


def row_digest(df: DataFrame, columns: list[str]) -> tuple:
    """Number of rows, and two sums of row hashes, which don't depend on the order of rows. One pass, one row."""
    cells = _cells(df, columns)
    h = lambda seed: F.sum(F.xxhash64(F.lit(seed), *cells).cast("decimal(38,0)"))
    return tuple(df.agg(F.count(F.lit(1)), h(1), h(2)).first())


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two frames hold the same rows as often, by the number of rows and sums of 64-bit row hashes."""
    return row_digest(a, a.columns) == row_digest(b, a.columns)


#: Buckets of keys of which each has a digest.
BUCKETS = 256


def difference_count(a: DataFrame, b: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row: how many distinct rows are in one frame only.

    Rows lie in buckets by their contents. Where a bucket has as many rows and the same sums of two 64-bit row hashes on both
    sides, its rows are taken as equal and are not moved; the rows of other buckets are compared as they are, equal ones in one
    group. The digests are computed at once.
    """
    sides = a.withColumn("_side", F.lit(1)).unionByName(b.select(*a.columns).withColumn("_side", F.lit(2)))
    cells = _cells(sides, a.columns)
    bucket = F.pmod(F.xxhash64(F.lit(3), *cells), F.lit(buckets)).cast("int")
    total = lambda seed: F.sum(F.xxhash64(F.lit(seed), *cells).cast("decimal(38,0)")).alias(f"h{seed}")
    digests = sides.groupBy(bucket.alias("bucket"), "_side").agg(F.count(F.lit(1)).alias("n"), total(1), total(2))
    off = digests.groupBy("bucket", "n", "h1", "h2").agg(F.count(F.lit(1)).alias("c")).where("c < 2").select("bucket").distinct()
    numbers = [r["bucket"] for r in off.collect()]  # as many as there are buckets
    found = sides.where(bucket.isin(numbers)).groupBy(*[F.col(f"`{c}`") for c in a.columns]).agg(F.min("_side").alias("_low"), F.max("_side").alias("_high"))
    return found.where("_low = _high").agg(F.count(F.lit(1)).alias("differences"))


def _cells(df: DataFrame, columns: list[str]) -> list[Column]:
    return [F.to_json(F.struct(F.col(f"`{c}`"))) if t.startswith("map") else F.col(f"`{c}`") for c, t in df.select(*[f"`{c}`" for c in columns]).dtypes]


def _hashed(df: DataFrame, keys: list[str], columns: list[str], buckets: int) -> DataFrame:
    """The keys of each row with their bucket and two hashes of the row."""
    cells = _cells(df, columns)
    return df.select(*keys, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket"), F.xxhash64(F.lit(1), *cells).alias("h1"), F.xxhash64(F.lit(2), *cells).alias("h2"))


def bucket_digests(df: DataFrame, keys: list[str], columns: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Per bucket of keys the number of rows and sums of row hashes, whatever the order of rows."""
    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    return _hashed(df, keys, columns, buckets).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), total("h1"), total("h2"))


def kept_digests(store: Store, table: str, version: int | str, keys: list[str], columns: list[str], buckets: int = BUCKETS) -> DataFrame:
    """The digests of a table version, computed when first asked for and kept beside it."""
    path = store.path(f"{table}.digests", f"{version}-{buckets}-{'-'.join(keys)}")
    if not path_exists(store.spark, f"{path}/_SUCCESS"):
        bucket_digests(store.read(table, version), keys, columns, buckets).coalesce(1).write.mode("overwrite").parquet(path)
    return store.spark.read.schema("bucket int, n long, h1 decimal(38,0), h2 decimal(38,0)").parquet(path)


def differing_keys(a: DataFrame, b: DataFrame, keys: list[str], digests: tuple[DataFrame, DataFrame] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Keys under which two frames do not hold the same rows as often; rows of buckets with equal digests are not compared.

    ``digests`` are those of both frames, if they are at hand (kept_digests); then no row of an equal bucket is read either.
    """
    columns = a.columns
    one, two = digests or (bucket_digests(a, keys, columns, buckets), bucket_digests(b, keys, columns, buckets))
    sides = one.withColumn("_s", F.lit(1)).unionByName(two.withColumn("_s", F.lit(2)))
    off = sides.groupBy("bucket", "n", "h1", "h2").agg(F.count(F.lit(1)).alias("c")).where("c < 2").select("bucket").distinct()
    numbers = [r["bucket"] for r in off.collect()]  # as many as there are buckets
    rows = [_hashed(df, keys, columns, buckets).where(F.col("bucket").isin(numbers)).withColumn("_s", F.lit(s)) for df, s in ((a, 1), (b, -1))]
    sign = lambda c: F.sum(F.col("_s") * F.col(c).cast("decimal(38,0)")) != 0
    met = rows[0].unionByName(rows[1]).groupBy(*keys).agg(F.sum("_s").alias("n"), sign("h1").alias("x"), sign("h2").alias("y"))
    return met.where("n <> 0 or x or y").select(*keys)


def droppable_versions(versions: DataFrame, publications: DataFrame, now: Column, last: int = 10, days: int = 30, parts: DataFrame | None = None) -> DataFrame:
    """Versions (table, version) that no protected publication names, and in whose folders no part of a named version lies.

    Protected are, per pipeline, the head, the last ``last`` publications and those of the last ``days`` days.
    ``parts`` has table, version and held: the version whose folder holds a part of it (``Store.part_folders``).
    ``publications`` has pipeline, sequence, published_at, table and version. Ranks are a filter of their own,
    so that each task sends only its last publications of a pipeline (up to the session's
    windowGroupLimitThreshold of 1,000), however many the pipeline has.
    """
    documents = publications.select("pipeline", "sequence", "published_at").distinct()
    place = F.row_number().over(Window.partitionBy("pipeline").orderBy(F.col("sequence").desc()))
    recent = documents.withColumn("_place", place).where(F.col("_place") <= last).drop("_place")
    kept = recent.unionByName(documents.where(F.col("published_at") >= now - F.make_dt_interval(days=F.lit(days))))
    named = publications.join(kept.select("pipeline", "sequence"), ["pipeline", "sequence"], "left_semi").select("table", "version").distinct()
    if parts is not None:
        held = parts.join(named, ["table", "version"], "left_semi").select("table", F.col("held").alias("version"))
        named = named.unionByName(held).distinct()
    return versions.join(named, ["table", "version"], "left_anti")


def numbered(df: DataFrame, store: Store, table: str, version: int | str, start: int, name: str = "number") -> DataFrame:
    """Rows written as a version, numbered from ``start`` without gaps.

    Each task counts its own rows while it writes; a task's first number is the sum of the tasks before it, of
    which there is one small row each. No row is moved.
    """
    placed = store.write(df.withColumn("_place", F.monotonically_increasing_id()), table, version)
    task = F.shiftright("_place", 33)
    counts = placed.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    first = placed.groupBy(task.alias("_task")).agg(F.min("_place").alias("_first"))
    rows = placed.withColumn("_task", task).join(starts.join(first, "_task"), "_task")
    return rows.withColumn(name, F.col("_start") + F.col("_place") - F.col("_first") + start).drop("_place", "_task", "_start", "_first")
