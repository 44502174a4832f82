"""Sharding by best-fit decreasing: groups of equal texts go whole into the tightest bin that holds them.

The law is ``bytes``: shard sizes near equal. Groups are the indivisible items. What the driver packs is
bounded by arithmetic, not by the data: groups of at least 1/512 of a shard (at most 512 x shards of them)
are items of their own; smaller ones are runs of items of a size class, classes being 1/128 apart at most, so
there are some thousand runs. A run is packed as its items would be one by one: the tightest bin takes as many
as it has room for. A group then finds its bin from its class and its gapless rank there. A capacity search
finds the smallest fixed capacity for which best-fit decreasing needs no more than the wanted number of bins.

Defined results: a null text is an empty group of its own with size OVERHEAD a row; equal texts stay in
one shard unless the group is larger than a shard's fair share, in which case its copies are split into
equal runs over as many items as it has shares (a third of all rows can be copies of one text). Rows
with a null or repeated doc_id are rows like others. An empty table gives an empty result. Extra columns
are kept; columns with the names of the results are replaced.
"""

from __future__ import annotations

import random
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gapless_rank, table

#: Bytes counted for each row besides its text.
OVERHEAD = 16
#: Size classes of an octave.
CLASSES = 128
#: A group of at least 1/FINE of a shard's share is an item of its own.
FINE = 512


class CapacityTree:
    """A balanced search tree (treap) of bins by remaining capacity; finds the tightest that fits."""

    def __init__(self, seed: int = 7):
        self.random, self.root = random.Random(seed), None

    def _split(self, node, key):
        if node is None:
            return None, None
        if node[0] < key:
            low, high = self._split(node[3], key)
            node[3] = low
            return node, high
        low, high = self._split(node[2], key)
        node[2] = high
        return low, node

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] < b[1]:
            a[3] = self._merge(a[3], b)
            return a
        b[2] = self._merge(a, b[2])
        return b

    def add(self, remaining: int, bin_no: int) -> None:
        key = (remaining, bin_no)
        low, high = self._split(self.root, key)
        self.root = self._merge(self._merge(low, [key, self.random.random(), None, None]), high)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the (remaining, bin) of least remaining capacity of at least size."""
        node, best = self.root, None
        while node:
            if node[0][0] >= size:
                best, node = node[0], node[2]
            else:
                node = node[3]
        if best is not None:
            low, high = self._split(self.root, best)
            _, rest = self._split(high, (best[0], best[1] + 1))
            self.root = self._merge(low, rest)
        return best


def best_fit_runs(runs: list[tuple[int, int]], capacity: int, most: int | None = None) -> list[tuple[int, int, int]] | None:
    """(run, bin, count) for runs (size, count) in falling order of size; None if more than ``most`` bins are needed."""
    tree, bins, places = CapacityTree(), 0, []
    for number, (size, left) in enumerate(runs):
        while left:
            found = tree.take_tightest(size)
            if found is None:
                if size > capacity or bins == most:
                    return None
                found, bins = (capacity, bins), bins + 1
            # With each item the bin gets tighter, so it stays the tightest until it is full.
            took = min(left, found[0] // size)
            tree.add(found[0] - took * size, found[1])
            places.append((number, found[1], took))
            left -= took
    return places


def best_fit_decreasing(sizes: list[int], capacity: int, most: int | None = None) -> list[int] | None:
    """Bin of each item of ``sizes`` (already in falling order); None if more than ``most`` bins are needed."""
    places = best_fit_runs([(size, 1) for size in sizes], capacity, most)
    return None if places is None else [b for _, b, _ in places]


def pack_bins(runs: list[tuple[int, int]], bins: int, searches: int = 14) -> list[tuple[int, int, int]]:
    """Places of runs (in falling order) under about the smallest capacity for which ``bins`` bins suffice."""
    if not runs:
        return []
    low = max(ceil(sum(size * n for size, n in runs) / bins), runs[0][0]) - 1
    high, best, step = low + 1, None, max(1, low // 4096)
    while (best := best_fit_runs(runs, high, bins)) is None:
        low, high, step = high, high + step, step * 2
    for _ in range(searches):
        if high - low <= 1:
            break
        middle = (low + high) // 2
        tried = best_fit_runs(runs, middle, bins)
        low, high, best = (low, middle, tried) if tried is not None else (middle, high, best)
    return best


def shard(docs: DataFrame, shards: int = 40, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Add size, text_crc32, law, shard, slot and grown_shard to each row of ``docs`` (the text goes)."""
    spark = docs.sparkSession
    raw = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    kept = [c for c in docs.columns if c not in (text, "size", "text_crc32", "law", "shard", "slot", "grown_shard")]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(id_column).alias("id"), (F.octet_length(raw).cast("long") + OVERHEAD).alias("size"),
        F.crc32(raw).alias("text_crc32"), F.coalesce(F.sha2(F.col(text), 256), F.lit("null")).alias("group"),
    )
    rows = table(rows, "shard-rows")
    groups = table(rows.groupBy("group").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")), "shard-groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    share = max(1, total // shards)
    # By arithmetic at most FINE * shards groups are this large.
    big = F.col("bytes") * FINE >= F.lit(share)
    large = groups.where(big).withColumn("parts", F.least(F.col("rows"), F.ceil(F.col("bytes") / F.lit(share))).cast("long"))
    # The class of a size: its octave, and its place among CLASSES equal parts of it.
    octave = F.floor(F.log2("bytes"))
    small = groups.where(~big).withColumn("class", (octave * CLASSES + F.floor((F.col("bytes") / F.pow(F.lit(2.0), octave) - 1) * CLASSES)).cast("long"))

    runs = [(-(-r["bytes"] // r["n"]), r["n"], r["class"], None) for r in small.groupBy("class").agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()]
    for r in large.collect():
        for part in range(r["parts"]):
            copies = (part + 1) * r["rows"] // r["parts"] - part * r["rows"] // r["parts"]
            runs.append((r["bytes"] // r["rows"] * copies, 1, part, r["group"]))
    runs.sort(key=lambda x: (-x[0], x[3] or "", x[2]))
    spans, singles, first = [], [], {}
    for number, shard_no, n in pack_bins([x[:2] for x in runs], shards):
        _, _, part, group = runs[number]
        if group is None:
            spans.append((part, first.get(part, 0), n, shard_no))
            first[part] = first.get(part, 0) + n
        else:
            singles.append((group, part, shard_no))
    singles = spark.createDataFrame(singles, "group string, part long, shard int")
    spans = spark.createDataFrame(spans, "class long, first long, n long, shard int").groupBy("class").agg(F.collect_list(F.struct("first", "n", "shard")).alias("spans"))

    # Small groups by their rank in the class; their rows join them, and no group of these is large.
    ranked = gapless_rank(small.select("class", "group"), ["class"], F.col("group"), [F.col("group")], "rank").join(F.broadcast(spans), "class")
    mine = F.filter("spans", lambda x: (x["first"] <= F.col("rank")) & (F.col("rank") < x["first"] + x["n"]))
    placed = ranked.select("group", mine[0]["shard"].alias("shard"))
    named = rows.join(F.broadcast(large.select("group", "parts", F.col("rows").alias("copies"))), "group", "left")
    out = named.where("parts is null").join(placed, "group").select("row", "id", "size", "text_crc32", "shard")
    # Copies of a group beyond one share: the k-th copy goes to the part that holds k.
    over = named.where("parts > 1")
    if not large.where("parts > 1").isEmpty():
        over = gapless_rank(over, ["group"], F.struct("id", "row"), [F.col("id")], "k").withColumn("part", F.floor(((F.col("k") + 1) * F.col("parts") - 1) / F.col("copies")))
    else:
        over = over.withColumn("part", F.lit(0).cast("long"))
    whole = named.where("parts = 1").withColumn("part", F.lit(0).cast("long"))
    for more in (whole, over):
        out = out.unionByName(more.join(F.broadcast(singles), ["group", "part"]).select("row", "id", "size", "text_crc32", "shard"))
    placed = gapless_rank(table(out, "shard-placed"), ["shard"], F.struct("id", "text_crc32"), [F.col("id"), F.col("text_crc32"), F.col("size")], "slot")
    return placed.select("row.*", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
