"""Embedding near-deduplication: random-hyperplane sign hashing, exact cosines, connected components.

Each vector gets one code of ``bits`` signs in each of several tables; the planes come from a seed. The
bits grow with the logarithm of the number of vectors, so that buckets stay small, and the tables with
them, so that a pair at the threshold shares a bucket with a probability of at least 1 - MISS. Vectors
that meet in a bucket are verified by cosine in double precision, in blocks of at most BLOCK x BLOCK; a
bucket larger than a block is dealt over pairs of its blocks. A pair that meets in several tables counts
in the first. What leaves a block is one row per vector (its links there, and the smallest vector that it
is connected to in the block), never the pairs.

Equal vectors are one class and enter once, with their number as weight, so copies are not compared. The
buckets are found on class numbers and codes alone. Of buckets with the same members only the first is
verified, and only then do vectors travel, packed. Vectors of each length are hashed and compared among
themselves (a cosine needs equal lengths).

Defined results: vectors that are null, empty, all zero, or that hold null or non-finite components link
with nothing and are kept. Rows with a null id have null component_id, n_links as others, and are kept;
they connect others. Ids are cast to long. Vectors of any finite size are compared, and those that differ
by a power of two alone are equal here. Rows that repeat an id are rows of their own: each counts the others it links with,
and component_id is the smallest id of all that are reachable. An empty table gives an empty result.
Extra columns are not kept.
"""

from __future__ import annotations

from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, table

THRESHOLD = 0.95
MISS = 1e-5
BLOCK = 1024
SEED = 20_240_229
#: Bits beyond log2 of the number of vectors.
SPARE = 3


def table_count(bits: int, threshold: float = THRESHOLD, miss: float = MISS) -> int:
    """Tables needed so that a pair at the threshold is missed with a probability of ``miss`` at most."""
    meet = (1 - acos(threshold) / pi) ** bits
    return max(1, ceil(log(miss) / log(1 - meet)))


def sign_codes(vectors: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """One code of ``bits`` bits for each vector and table."""
    planes = np.random.default_rng(SEED).standard_normal((vectors.shape[1], bits * tables))
    weights = (1 << np.arange(bits, dtype=np.int64))[:, None]
    out = np.empty((len(vectors), tables), np.int64)
    for i in range(0, len(vectors), 4096):
        signs = (vectors[i : i + 4096] @ planes >= 0).reshape(-1, tables, bits)
        out[i : i + 4096] = (signs @ weights)[:, :, 0]
    return out


def _labels(linked: np.ndarray) -> np.ndarray:
    """Index of the smallest row that each row of a symmetric link matrix is connected to."""
    label = np.arange(len(linked))
    while True:
        lowest = np.where(linked, label[None, :], len(label)).min(axis=1)
        new = np.minimum(label, lowest)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def verify_block(ids, weights, vectors, codes, at, side_a, side_b, threshold: float):
    """Links of one block of a bucket of table ``at``: (id, links, smallest connected id) of each linked vector.

    side_a and side_b mark the rows of the two sides; where they are the same rows, each pair counts once.
    """
    order = np.argsort(ids, kind="stable")
    ids, weights, vectors, codes, side_a, side_b = (x[order] for x in (ids, weights, vectors, codes, side_a, side_b))
    norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    linked = (vectors @ vectors.T) / (norms[:, None] * norms[None, :]) >= threshold
    linked &= (side_a[:, None] & side_b[None, :]) | (side_b[:, None] & side_a[None, :])
    np.fill_diagonal(linked, False)
    if not linked.any():
        return ids[:0], weights[:0], ids[:0]
    i, j = np.nonzero(linked)
    first = np.ones(len(i), bool)
    left = np.flatnonzero(first)
    for t in range(at):  # a pair that met in an earlier table was counted there
        left = left[codes[i[left], t] != codes[j[left], t]]
        if not len(left):
            break
    first[:] = False
    first[left] = True
    links = np.bincount(i[first], weights[j[first]], minlength=len(ids)).astype(np.int64)
    label = _labels(linked)
    has = linked.any(axis=1)
    return ids[has], links[has], ids[label[has]]


def _classes(source: DataFrame, bits: int, tables: int) -> tuple[DataFrame, str]:
    """One row for each distinct vector: its keys, a unique number, smallest id, weight, length, and vector and codes packed."""
    grouped = source.where("ok").groupBy("k1", "k2").agg(F.min("id").alias("low_id"), F.count(F.lit(1)).alias("w"), F.first("v").alias("v"))
    named = grouped.select(F.monotonically_increasing_id().alias("rep"), "k1", "k2", "low_id", "w", "v")
    packed = "<u2" if bits <= 16 else "<u4" if bits <= 32 else "<u8"

    def hashed(batches):
        for batch in batches:
            lists = batch.column(5)
            sizes = np.diff(lists.offsets.to_numpy())
            for width in np.unique(sizes).tolist():
                at = pa.array(np.flatnonzero(sizes == width))
                part = batch.take(at)
                vectors = part.column(5).flatten().to_numpy().reshape(-1, width)
                codes = sign_codes(vectors, bits, tables)
                # Values that single precision holds exactly travel as such.
                single = (vectors.astype("<f4").astype("<f8") == vectors).all(axis=1).tolist()
                raw = [v.astype("<f4" if s else "<f8").tobytes() for v, s in zip(vectors, single, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in range(5)), pa.array(np.full(len(vectors), width, np.int32)), pa.array(raw, pa.binary()), pa.array([c.tobytes() for c in codes.astype(packed)], pa.binary())],
                    ["rep", "k1", "k2", "low_id", "w", "d", "v", "codes"],
                )

    return named.mapInArrow(hashed, "rep long, k1 long, k2 long, low_id long, w long, d int, v binary, codes binary"), packed


def _met(classes: DataFrame, packed: str) -> DataFrame:
    """rep, d, t and code of each vector and table."""

    def run(batches):
        for batch in batches:
            for start in range(0, len(batch), 2048):
                part = batch.slice(start, 2048)
                codes = np.frombuffer(b"".join(part.column(2).to_pylist()), packed).astype(np.int64)
                tables = len(codes) // max(1, len(part))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(part.column(k).to_numpy(), tables)) for k in range(2)] + [pa.array(np.tile(np.arange(tables, dtype=np.int32), len(part))), pa.array(codes)],
                    ["rep", "d", "t", "code"],
                )

    return classes.select("rep", "d", "codes").mapInArrow(run, "rep long, d int, t int, code long")


def near_duplicates(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id and kept for each row."""
    spark = rows.sparkSession
    source = rows.select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = F.col("v").isNotNull() & (F.size("v") > 0) & ~bad & F.exists("v", lambda x: x != 0)
    source = source.withColumn("ok", F.coalesce(good, F.lit(False)))
    # Vectors are scaled by a power of two (in two steps, as it can be out of range), so that squares neither vanish nor overflow.
    power = F.floor(F.log2(F.array_max(F.transform("v", F.abs))))
    source = source.withColumn("up", F.when(F.col("ok"), F.floor(-power / 2))).withColumn("rest", F.when(F.col("ok"), -power - F.col("up")))
    one, two = F.pow(F.lit(2.0), F.col("up")), F.pow(F.lit(2.0), F.col("rest"))
    source = source.withColumn("one", one).withColumn("two", two)
    # Equal vectors have equal keys; 0.0 and -0.0 are equal. Others are dealt by their id.
    source = source.withColumn("v", F.when(F.col("ok"), F.transform("v", lambda x: x * F.col("one") * F.col("two") + F.lit(0.0)))).drop("up", "rest", "one", "two")
    source = source.withColumn("k1", F.when(F.col("ok"), F.xxhash64("v")).otherwise(F.xxhash64("id")))
    source = table(source.withColumn("k2", F.when(F.col("ok"), F.xxhash64(F.lit("second"), "v", F.reverse("v"))).otherwise(0)), "vectors")
    count = source.where("ok").count()
    bits = max(4, min(60, ceil(log2(max(2, count))) + SPARE))
    classes, packed = _classes(source, bits, table_count(bits, threshold))
    classes = table(classes, "classes")
    met = _met(classes, packed)
    # Buckets with the same members are known by the mixed hashes of these; the first of them is verified.
    sizes = met.groupBy("d", "t", "code").agg(F.count(F.lit(1)).alias("c"), F.bit_xor(F.xxhash64("rep")).alias("x"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("y")).where("c > 1")
    first = F.min(F.struct("t", "code"))
    sizes = sizes.groupBy("d", "c", "x", "y").agg(first.alias("at")).select("d", "c", "at.*")
    cells = F.ceil(F.col("c") / F.lit(BLOCK)).cast("int")
    own = F.pmod(F.xxhash64("rep", F.lit(1)), F.col("cells")).cast("int")
    members = met.join(sizes, ["d", "t", "code"]).withColumn("cells", cells).withColumn("own", own)
    members = members.select("rep", "d", "t", "code", "own", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("other"))
    members = members.select("rep", "d", "t", "code", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    block_key = ["d", "t", "code", "low", "high"]
    placed = members.join(classes.select("rep", "w", "v", "codes"), "rep").select(*block_key, "own", "rep", "w", "v", "codes")
    parts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = placed.repartition(parts, *block_key).sortWithinPartitions(*block_key)

    def verified(batches):
        rest: pa.Table | None = None
        for batch in batches:
            rest = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            key = _block_numbers(rest)
            cut = int(np.flatnonzero(key != key[-1])[-1]) + 1 if (key != key[-1]).any() else 0
            if cut:
                yield from _verify(rest.slice(0, cut), key[:cut])
                rest = rest.slice(cut)
        if rest is not None and len(rest):
            yield from _verify(rest, _block_numbers(rest))

    def _block_numbers(t: pa.Table) -> np.ndarray:
        columns = [t.column(c).to_numpy() for c in block_key]
        change = np.zeros(len(t), bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        return np.cumsum(change)

    def _unpacked(raw: list[bytes], width: int) -> np.ndarray:
        out = np.empty((len(raw), width))
        single = np.array([len(x) == 4 * width for x in raw])
        for mask, kind in ((single, "<f4"), (~single, "<f8")):
            if mask.any():
                out[mask] = np.frombuffer(b"".join([raw[i] for i in np.flatnonzero(mask).tolist()]), kind).reshape(-1, width)
        return out

    def _verify(t: pa.Table, key: np.ndarray):
        width, at, low, high, own, rep, w = (t.column(c).to_numpy() for c in ("d", "t", "low", "high", "own", "rep", "w"))
        bounds = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
        found = []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            part = t.slice(a, b - a)
            vectors = _unpacked(part.column("v").to_pylist(), int(width[a]))
            codes = np.frombuffer(b"".join(part.column("codes").to_pylist()), packed).reshape(b - a, -1)
            found.append(verify_block(rep[a:b], w[a:b], vectors, codes, int(at[a]), own[a:b] == low[a:b], own[a:b] == high[a:b], threshold))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[k] for f in found])) for k in range(3)], ["rep", "links", "low"])

    links = table(placed.mapInArrow(verified, "rep long, links long, low long"), "links")
    degree = links.groupBy("rep").agg(F.sum("links").alias("links"))
    label = components(links.select(F.col("rep").alias("src"), F.col("low").alias("dst"))).withColumnRenamed("node", "rep")
    found = classes.select("k1", "k2", "rep", "w", "low_id").join(degree, "rep", "left").join(label, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    found = table(found.select("k1", "k2", "component", "low_id", (F.col("w") - 1 + F.coalesce("links", F.lit(0))).alias("links")), "found")
    # Classes are numbered, so the smallest id of a component is looked up.
    lowest = found.groupBy("component").agg(F.min("low_id").alias("component_id"))
    found = found.join(lowest, "component").select("k1", "k2", "links", "component_id")
    return (
        source.select("id", "ok", "k1", "k2").join(found, ["k1", "k2"], "left")
        .select(
            F.col("id").alias("vec_id"), F.when(F.col("ok"), F.col("links")).otherwise(0).cast("long").alias("n_links"),
            F.when(F.col("id").isNotNull(), F.when(F.col("ok"), F.col("component_id")).otherwise(F.col("id"))).alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
