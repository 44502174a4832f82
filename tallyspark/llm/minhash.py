"""MinHash near-deduplication by fast similarity sketching, banding and exact verification.

A text's set is its distinct word shingles. Sketches are made in rounds: in each of the first T rounds
every element is hashed to one of T bins with a value, and in T further rounds every element goes to the
bin of the round; a bin keeps its least (round, value), and a text is done once all its bins are filled.
Documents that agree on all rows of a band meet in a bucket, and what meets is verified on full sets.

Equal sets are one class, named by a number of its own. A bucket's members are first compared with the one
that meets most others; then those outside the bucket's largest component are compared with all members,
in blocks, and a block gives back only links that connect. Pairs within a component need no comparison,
so groups of near copies cost little, and no link that joins two components is lost. The chance that a
pair at the threshold shares no bucket is under 1e-5.

Defined results: a null or empty text, or one without words, has an empty set, links with nothing and is
kept; a text of fewer words than a shingle has its whole sequence as its one shingle. Texts with equal
sets are linked. Rows with a null id take no part: their component_id is null and they are kept. Rows that
repeat an id are rows of their own, each with the links of its text; component_id is the smallest id of all
that are reachable. Ids may be of any type that can be ordered. Extra columns are not kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, table
from .merges import blocks, mix, word_codes

BANDS, ROWS = 30, 5
BLOCK = 4 << 20
#: Members and set items of a cell of a bucket.
CELL, ITEMS = 512, 1_000_000
#: Bits for each candidate, and least and most bits, of the filter by which other rows are skipped when sets are
#: made again. The most are 128 MB; beyond that the filter lets more rows through, which the join then drops.
FILTER_BITS, FILTER_LEAST, FILTER_MOST = 8, 1 << 20, 1 << 30
#: Comparisons with one member that a task makes with one copy of its set.
HUB = 20_000
#: Most busy members that are sent to all tasks, of 12 bytes each.
SENT = 1_000_000
_U = np.uint64


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text."""
    counts, hashes = word_codes(texts)
    ends = np.cumsum(counts)
    total = len(hashes)
    rolled = np.zeros(max(0, total - words + 1), np.uint64)
    for k in range(words):
        rolled = rolled * _U(0x9E3779B97F4A7C15) + mix(hashes[k : total - words + 1 + k] + _U(k + 1)) if len(rolled) else rolled
    rolled = mix(rolled)
    out = []
    for n, end in zip(counts.tolist(), ends.tolist(), strict=True):
        start = end - n
        if n >= words:
            out.append(np.unique(rolled[start : end - words + 1]))
        elif n:
            value = _U(n)
            with np.errstate(over="ignore"):
                for h in hashes[start:end]:
                    value = mix(value * _U(0x9E3779B97F4A7C15) + h)
            out.append(np.array([value]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def sketches(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """Fast similarity sketch of each non-empty set: one row of ``bins`` values (empty sets: all ones)."""
    out = np.full((len(sets), bins), ~_U(0))
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    values = np.concatenate([*sets, np.zeros(0, np.uint64)])
    owner = np.repeat(np.arange(len(sets)), sizes)
    flat = out.reshape(-1)
    for step in range(2 * bins):
        if not len(values):
            break
        seeded = mix(values + _U((step + 1) * 0xD1B54A32D192ED03 % (1 << 64)))
        if step < bins:
            place = ((seeded >> _U(32)) * _U(bins) >> _U(32)).astype(np.int64)
        else:
            place = np.full(len(values), step - bins)
        value = _U(step) << _U(54) | mix(seeded) >> _U(10)
        np.minimum.at(flat, owner * bins + place, value)
        unfilled = (out == ~_U(0)).any(axis=1)
        if step == 0 or step % 8 == 0 or not unfilled.any():
            keep = unfilled[owner]
            values, owner = values[keep], owner[keep]
    return out


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each row and band."""
    cut = sketch[:, : bands * rows].reshape(len(sketch), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), cut.shape[:2]).copy()
    for k in range(rows):
        key = mix(key * _U(0x9E3779B97F4A7C15) + cut[:, :, k])
    return key


def _digests(sets: list[np.ndarray]) -> list[np.ndarray]:
    """Sizes and two 64-bit halves of a digest of each set."""
    n = np.fromiter(map(len, sets), np.int64, len(sets))
    high = np.array([mix(s + _U(0x51ED270B)).sum(dtype=np.uint64) for s in sets], np.uint64).astype(np.int64)
    low = np.array([mix(s ^ _U(0x2545F4914F6CDD1D)).sum(dtype=np.uint64) for s in sets], np.uint64).astype(np.int64)
    return [n, high, low]


def _features(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """id, n (set size), two halves of a 128-bit digest of the set, and its band keys (null for an empty set)."""

    def run(batches):
        for batch in batches:
            texts = batch.column(1)
            for a, b in blocks(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), BLOCK):
                sets = shingle_sets(texts.slice(a, b - a), words)
                keys = band_keys(sketches(sets, bands * rows), bands, rows).astype(np.int64)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(keys.reshape(-1)), bands).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *map(pa.array, _digests(sets)), lists], ["id", "n", "high", "low", "bands"])

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, n long, high long, low long, bands array<long>")


def _candidate_sets(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """rep and set of the classes in ``nodes`` (rep, h: hash of an id that has the set, n, high, low).

    The sets are made again from the texts; a bitmap of bounded size skips most other texts.
    """
    size = FILTER_LEAST
    while size < min(FILTER_MOST, FILTER_BITS * nodes.count()):
        size *= 2
    slot = lambda h: F.pmod(h, F.lit(size))
    marked = nodes.select(slot(F.col("h")).alias("slot")).groupBy(F.bitmap_bucket_number(F.col("slot") + 1).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("slot") + 1)).alias("bits"))
    bits = np.zeros(size // 8, np.uint8)
    for r in marked.toLocalIterator():  # at most ``size`` bits
        part = np.frombuffer(r["bits"], np.uint8)
        start = (r["bucket"] - 1) * len(part)
        here = bits[start : start + len(part)]
        here |= part[: len(here)]
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    source = docs.where("id is not null").select(F.xxhash64("id").alias("h"), "text").withColumn("slot", slot(F.col("h")))

    def run(batches):
        wanted = shared.value
        for batch in batches:
            at = batch.column(2).to_numpy()
            batch = batch.filter(pa.array((wanted[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)))
            texts = batch.column(1)
            for a, b in blocks(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), BLOCK):
                sets = shingle_sets(texts.slice(a, b - a), words)
                ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*sets, np.zeros(0, np.uint64)]).astype(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *map(pa.array, _digests(sets)), lists], ["h", "n", "high", "low", "items"])

    made = source.mapInArrow(run, "h long, n long, high long, low long, items array<long>")
    return made.join(nodes, ["h", "n", "high", "low"]).select("rep", "items").dropDuplicates(["rep"])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (hub, other, with sizes nh, no) whose sets overlap enough; the set of a busy hub is dealt in copies."""
    busy = pairs.groupBy("hub").agg(F.count(F.lit(1)).alias("c")).select(F.col("hub"), F.ceil(F.col("c") / HUB).cast("int").alias("copies"))
    hubs = sets.join(busy, sets["rep"] == busy["hub"]).select("hub", F.col("items").alias("left"), F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
    many = busy.where("copies > 1")
    many = F.broadcast(many) if many.count() <= SENT else many  # beyond that a join is left to the optimiser
    others = pairs.join(sets.select(F.col("rep").alias("other"), F.col("items").alias("right")), "other").join(many, "hub", "left")
    others = others.withColumn("copy", F.pmod(F.xxhash64("other"), F.coalesce("copies", F.lit(1))).cast("int"))
    both = F.size(F.array_intersect("left", "right"))
    return others.join(hubs, ["hub", "copy"]).where(100 * both >= percent * (F.col("nh") + F.col("no") - both)).select("hub", "other")


def verify_block(ids, component, sizes, flat, bands, at, side_a, side_b, percent: int) -> list[tuple[int, int]]:
    """Links between members of a block that lie in different components; only links that connect two of them.

    A member's set is marked in the block's vocabulary, and one pass over all sets counts what each shares
    with it. Pairs that meet in an earlier band are left to that band's bucket.
    """
    starts = np.cumsum(sizes) - sizes
    words, codes = np.unique(flat, return_inverse=True)
    root = {c: c for c in component.tolist()}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    links = []
    mark = np.zeros(len(words), np.int64)
    for i in range(len(ids) - 1):
        rest = slice(i + 1, None)
        other = (component[rest] != component[i]) & ((side_a[i] & side_b[rest]) | (side_b[i] & side_a[rest]))
        other &= 100 * np.minimum(sizes[rest], sizes[i]) >= percent * np.maximum(sizes[rest], sizes[i])
        if at and other.any():
            other[other] = ~(bands[rest][other, :at] == bands[i, :at]).any(axis=1)
        if not other.any():
            continue
        own = codes[starts[i] : starts[i] + sizes[i]]
        mark[own] = 1
        both = np.add.reduceat(mark[codes[starts[i + 1] :]], starts[rest] - starts[i + 1])
        mark[own] = 0
        hit = other & (100 * both >= percent * (sizes[rest] + sizes[i] - both))
        for j in (np.flatnonzero(hit) + i + 1).tolist():
            x, y = find(int(component[i])), find(int(component[j]))
            if x != y:
                root[max(x, y)] = min(x, y)
                links.append((int(ids[i]), int(ids[j])))
    return links


def _block_links(now: DataFrame, sets: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """src, dst of links between members of a bucket (bucket, rep, n, component) in different components.

    Members outside the bucket's largest component (side 0) meet all members (side 1). Both sides are cut by
    hash into cells of at most about CELL members and ITEMS set items, and each pair of cells is one block, so
    no task gathers a large bucket and no pair leaves its task.
    """
    spark = now.sparkSession
    parts = now.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("items"))
    size = parts.groupBy("bucket").agg(
        F.sum("c").alias("c"), F.sum("items").alias("items"), F.count(F.lit(1)).alias("components"), F.max(F.struct(F.col("c").alias("most"), F.col("component").alias("largest"), F.col("items").alias("inner"))).alias("top"),
    ).where("components > 1").select("*", "top.*")
    cells = lambda count, items: F.greatest(F.ceil(count / CELL), F.ceil(items / ITEMS), F.lit(1)).cast("int")
    size = size.select("bucket", "largest", cells(F.col("c"), F.col("items")).alias("all"), cells(F.col("c") - F.col("most"), F.col("items") - F.col("inner")).alias("outer"))
    dealt = now.join(size, "bucket").withColumn("h", F.xxhash64("rep", F.lit(1)))
    mine = lambda n: F.pmod("h", F.col(n)).cast("int")
    each = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    across = F.transform(each("outer"), lambda i: F.struct(i.alias("low"), mine("all").alias("high"), F.lit(1).alias("side")))
    down = F.when(F.col("component") != F.col("largest"), F.transform(each("all"), lambda i: F.struct(mine("outer").alias("low"), i.alias("high"), F.lit(0).alias("side"))))
    dealt = dealt.select("bucket", "rep", "component", F.explode(F.concat(across, F.coalesce(down, F.array().cast("array<struct<low:int,high:int,side:int>>")))).alias("at"))
    keys = ["bucket", "low", "high"]
    placed = dealt.select("bucket", "rep", "component", "at.*").join(sets, "rep").join(classes.select("rep", "bands"), "rep").select(*keys, "side", "rep", "component", "items", "bands")
    parts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = placed.repartition(parts, *keys).sortWithinPartitions(*keys)

    def block_numbers(t: pa.Table) -> np.ndarray:
        change = np.zeros(len(t), bool)
        for c in keys:
            v = t.column(c).to_numpy()
            change[1:] |= v[1:] != v[:-1]
        return np.cumsum(change)

    def judge(t: pa.Table, block: np.ndarray):
        t = t.combine_chunks()
        bucket, side, ids, component = (t.column(c).to_numpy() for c in ("bucket", "side", "rep", "component"))
        items, bands = t.column("items").chunk(0), t.column("bands").chunk(0)
        ends = items.offsets.to_numpy().astype(np.int64)
        ends = ends - ends[0]
        flat = items.flatten().to_numpy()
        bands = bands.flatten().to_numpy().reshape(len(t), -1)
        found = []
        bounds = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(t)]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if b - a > 1:
                at = int(np.argmax(bands[a] == bucket[a]))
                found += verify_block(ids[a:b], component[a:b], np.diff(ends[a : b + 1]), flat[ends[a] : ends[b]], bands[a:b], at, side[a:b] == 0, side[a:b] == 1, percent)
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in range(2)], ["src", "dst"])

    def run(batches):
        rest: pa.Table | None = None
        for batch in batches:
            new = pa.Table.from_batches([batch])
            rest = new if rest is None else pa.concat_tables([rest, new])
            block = block_numbers(rest)
            cut = int(np.searchsorted(block, block[-1])) if len(block) else 0
            if cut:
                yield from judge(rest.slice(0, cut), block[:cut])
                rest = rest.slice(cut)
        if rest is not None and len(rest):
            yield from judge(rest, block_numbers(rest))

    return placed.mapInArrow(run, "src long, dst long")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_column: str = "doc_id", text: str = "text", bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row; sets of ``percent`` % overlap or more are linked."""
    source = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    features = table(_features(source, words, bands, rows), "sketches")
    key = ["n", "high", "low"]
    classes = features.where("n > 0 and id is not null").groupBy(*key).agg(F.min("id").alias("low_id"), F.first("bands").alias("bands"))
    classes = table(classes.select(F.monotonically_increasing_id().alias("rep"), "*"), "classes")
    members = classes.select("rep", "n", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    members = members.join(shared, "bucket")
    degree = members.groupBy("rep").agg(F.sum("c").alias("degree"))
    members = table(members.drop("c").join(degree, "rep"), "buckets")
    nodes = classes.select("rep", F.xxhash64("low_id").alias("h"), *key).join(members.select("rep").distinct(), "rep", "left_semi")
    sets = table(_candidate_sets(source, nodes, words), "sets")
    # First turn: each member with the one of its bucket that meets most others.
    top = members.groupBy("bucket").agg(F.max(F.struct("degree", "rep", "n")).alias("top"))
    pairs = members.join(top, "bucket").where("rep <> top.rep and 100 * least(n, top.n) >= %d * greatest(n, top.n)" % percent)
    pairs = table(pairs.select(F.col("top.rep").alias("hub"), F.col("rep").alias("other"), F.col("top.n").alias("nh"), F.col("n").alias("no")).distinct(), "pairs")
    links = table(_verified(pairs, sets, percent).select(F.col("hub").alias("src"), F.col("other").alias("dst")), "links")
    labels = table(components(links), "labels")
    # Second turn: what is outside the largest component of a bucket, in blocks.
    now = members.join(labels, members["rep"] == labels["node"], "left").select("bucket", "rep", "n", F.coalesce("component", "rep").alias("component"))
    links = links.unionByName(table(_block_links(now, sets, classes, percent), "links"))
    labels = components(links).withColumnRenamed("node", "rep")
    found = table(classes.drop("bands").join(labels, "rep", "left").withColumn("component", F.coalesce("component", "rep")).drop("rep"), "found")
    lowest = found.groupBy("component").agg(F.min("low_id").alias("component_id"))
    found = found.join(lowest, "component").select(*key, "component_id")
    return (
        features.drop("bands").join(found, key, "left")
        .select(
            F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
            F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
