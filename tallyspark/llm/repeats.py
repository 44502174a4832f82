"""Substring deduplication: windows of words as edges of a De Bruijn graph, compacted to paths.

An edge is a window of ``words`` words; it leads from its first to its last words - 1. Only edges that occur
more than once matter. So that not every edge is shuffled, a document's edges are cut into chunks: runs of
windows with the same minimizer at the same place, the first of the least hashes of their ``mini``-word parts. Equal windows have equal
minimizers, and those of a chunk differ, so

1. minimizers that occur once in the corpus hold unique edges only, and a bitmap drops their chunks;
2. of the other chunks, occurrences of the same words are counted, with the first of them (least id, then start);
3. where a minimizer has several distinct chunks, the edges of one occurrence of each are compared: an edge's
   count and first occurrence are those of all chunks that hold it;
4. edges that follow each other at their first occurrence, with equal counts, are joined to paths
   without branches, across chunks;
5. joining paths back to the chunks gives the source coordinates of every repeated span. A span is verified as whole when the
   pieces of its path all lie side by side there; where they do not, its pieces stand for themselves.

A word is removed if a window that covers it occurs earlier too. Identity is that of 128 bits of hashes
(64 of the minimizer, 64 of the chunk or window, both over 64-bit hashes of words).

Words are `[^\\x20\\x09-\\x0D]+`, unchanged. Defined results: a null or empty text has no words and keeps an
empty text; fewer words than a window are kept. Rows with a null id take no part and keep their words. Rows that share
an id are told apart by their texts but not ordered: a window occurs earlier at a smaller start, so at equal
starts both stay; rows equal in id and text get equal results. Ids may be of any type that can be ordered. An empty
table gives an empty result. Extra columns are not kept.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bitmap, in_bitmap, table
from .merges import _power_table, blocks, mix, word_codes

#: Words of a window, and of the parts of which a window's minimizer is the least.
WORDS, MINI = 20, 8
#: Bytes of text whose chunks are found at a time, and words of a slice of them.
BLOCK, SLICE = 1 << 20, 1 << 18
_U = np.uint64

_powers = lru_cache(maxsize=2)(lambda size: _power_table(size))


def find_chunks(counts: np.ndarray, hashes: np.ndarray, words: int, mini: int):
    """Chunks of texts whose word hashes lie one after the other, slice by slice.

    Yields, for each slice, the text, start, number of windows, minimizer and hash of every chunk, and a
    function that gives the hashes of the windows of the chunks that a mask chooses.
    """
    ends = np.cumsum(counts)
    begins = ends - counts
    owner = np.repeat(np.arange(len(counts)), counts)
    up, down = _powers(SLICE + words)
    for p in range(0, len(hashes), SLICE):
        own = mix(hashes[p : p + SLICE + words - 1])
        number = min(SLICE, len(own) - words + 1)
        if number <= 0:
            continue
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(own * up[: len(own)])])
        part = least = mix((sums[mini:] - sums[:-mini]) * down[: len(own) - mini + 1])
        width, wanted = 1, words - mini + 1
        while 2 * width <= wanted:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < wanted:
            least = np.minimum(least[: width - wanted], least[wanted - width :])
        text = owner[p : p + number]
        at = np.flatnonzero(p + np.arange(number) + words <= ends[text])
        if not len(at):
            continue
        value, text = least[at], text[at]
        # After a window that begins with its minimizer, the next has another one, if only by its place.
        passed = value == part[at]
        cuts = np.flatnonzero(np.r_[True, (value[1:] != value[:-1]) | (text[1:] != text[:-1]) | passed[:-1]])
        n = np.diff(np.r_[cuts, len(at)])
        first, text = at[cuts], text[cuts]
        whole = mix((sums[first + n + words - 1] - sums[first]) * down[first] + mix(n.astype(np.uint64)))

        def windows(chosen, first=first, n=n, sums=sums, down=down):
            size = n[chosen]
            i = np.repeat(first[chosen] - np.cumsum(size) + size, size) + np.arange(size.sum())
            return size, mix(((sums[i + words] - sums[i]) * down[i]) ^ _U(0x2545F4914F6CDD1D)).astype(np.int64)

        yield text, p + first - begins[text], n, value[cuts].astype(np.int64), whole.astype(np.int64), windows


def _scan(docs: DataFrame, words: int, mini: int, schema: str, emit) -> DataFrame:
    """Rows that ``emit`` makes of the chunks of docs (doc, tag, text)."""

    def run(batches):
        for batch in batches:
            texts = batch.column(2)
            for a, b in blocks(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), BLOCK):
                counts, hashes = word_codes(texts.slice(a, b - a), lower=False)
                for chunk in find_chunks(counts, hashes, words, mini):
                    yield emit(batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a).to_numpy(), *chunk)

    return docs.mapInArrow(run, schema)


def _place(tag, start, minimizer):
    """A long that names an occurrence of a chunk (of longs in numpy or of columns)."""
    return (start << 40) ^ tag ^ minimizer


def _compact(pieces: DataFrame) -> DataFrame:
    """Pieces (doc and at of their first occurrence, length, count) with the path they lie on: its start and length.

    All edges of a path without branches follow each other at their first occurrence, so it is a run of
    adjacent pieces there with equal counts.
    """
    distinct = pieces.select("doc", "at", "length", "count").distinct()
    order = Window.partitionBy("doc").orderBy("at", "length")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    apart = F.coalesce((F.col("at") > F.max(F.col("at") + F.col("length")).over(before)) | (F.col("count") != F.lag("count").over(order)), F.lit(True))
    numbered = distinct.withColumn("apart", apart).withColumn("path", F.max(F.when(F.col("apart"), F.col("at"))).over(order))
    ends = numbered.groupBy("doc", "path", "count").agg(F.max(F.col("at") + F.col("length")).alias("end"))
    paths = numbered.select("doc", "at", "length", "count", "path").join(ends, ["doc", "path", "count"])
    return paths.select("doc", "at", "length", "count", F.col("path").alias("path_start"), (F.col("end") - F.col("path")).alias("path_length"))


def _prepared(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    source = docs.select(F.col(f"`{id_column}`").alias("doc"), F.col(f"`{text}`").cast("string").alias("text"))
    return source.select("doc", F.xxhash64("doc", "text").alias("tag"), "text")


def repeated_spans(docs: DataFrame, words: int = WORDS, id_column: str = "doc_id", text: str = "text", mini: int = MINI) -> DataFrame:
    """Spans of windows that occur more than once: one row for each occurrence.

    doc and tag (a hash of id and text) name the row; start and windows are where the span begins and how many windows it has
    (it covers windows + words - 1 words); source and source_start are the first occurrence of the span, occurrences how often it
    occurs, whole whether all of its path lies there, and first whether the occurrence is the first.
    """
    if not 0 < mini < words <= 1 << 10:
        raise ValueError("parts of windows must be shorter than windows, and these of 1,024 words at most")
    source = _prepared(docs, id_column, text)
    known = source.where(F.col("doc").isNotNull())
    spark, kind = docs.sparkSession, source.schema["doc"].dataType.simpleString()
    minimizers = _scan(known, words, mini, "m long", lambda ids, tags, t, start, n, m, s, windows: pa.RecordBatch.from_arrays([pa.array(m)], ["m"]))
    repeated = table(minimizers.groupBy("m").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("m"), "minimizers")
    sieve = spark.sparkContext.broadcast(bitmap(repeated, "m")[0])

    def occurrences(ids, tags, t, start, n, m, s, windows):
        keep = np.flatnonzero(in_bitmap(sieve.value, m))
        t = t[keep]
        return pa.RecordBatch.from_arrays([ids.take(pa.array(t)), pa.array(tags[t]), *map(pa.array, (start[keep].astype(np.int32), n[keep].astype(np.int32), m[keep], s[keep]))], ["doc", "tag", "start", "n", "m", "s"])

    chunks = table(_scan(known, words, mini, f"doc {kind}, tag long, start int, n int, m long, s long", occurrences), "chunks")
    first = F.min(F.struct("doc", "start", "tag"))
    distinct = table(chunks.groupBy("m", "s").agg(F.count(F.lit(1)).alias("c"), first.alias("first"), F.max("n").alias("n")), "distinct-chunks")
    alone = distinct.groupBy("m").agg(F.count(F.lit(1)).alias("k"), F.sum("c").alias("all")).where("all > 1")
    held = table(distinct.join(alone, "m").withColumn("place", _place_column()), "repeated-chunks")
    contested = held.where("k > 1")
    places = spark.sparkContext.broadcast(bitmap(contested.select("place"), "place")[0])

    def edges(ids, tags, t, start, n, m, s, windows):
        chosen = in_bitmap(places.value, _place(tags[t], start.astype(np.int64), m))
        size, e = windows(chosen)
        lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(size)].astype(np.int32)), pa.array(e))
        return pa.RecordBatch.from_arrays([pa.array(tags[t[chosen]]), *map(pa.array, (start[chosen].astype(np.int32), m[chosen], s[chosen])), lists], ["tag", "start", "m", "s", "edges"])

    seen = _scan(known, words, mini, "tag long, start int, m long, s long, edges array<long>", edges)
    at = [seen["m"] == contested["m"], seen["s"] == contested["s"], seen["tag"] == contested["first.tag"], seen["start"] == contested["first.start"]]
    one = contested.join(seen.dropDuplicates(["tag", "start", "m", "s"]), at).select(contested["m"], contested["s"], "c", "first", "edges")
    one = table(one.select("m", "s", "c", F.col("first.doc").alias("doc"), F.col("first.start").alias("start"), F.posexplode("edges").alias("j", "e")), "edges")
    known_edges = one.groupBy("m", "e").agg(F.sum("c").alias("count"), F.min(F.struct("doc", (F.col("start") + F.col("j")).alias("at"))).alias("first")).where("count > 1")
    # Of a chunk, windows that follow each other at their first occurrence too are a piece.
    line = Window.partitionBy("m", "s").orderBy("j")
    steps = one.select("m", "s", "j", "e").join(known_edges, ["m", "e"])
    last = F.lag(F.struct("j", "count", "first")).over(line)
    follows = (last["j"] + 1 == F.col("j")) & (last["count"] == F.col("count")) & (last["first"]["doc"] == F.col("first.doc")) & (last["first"]["at"] + 1 == F.col("first.at"))
    steps = steps.withColumn("apart", ~F.coalesce(follows, F.lit(False))).withColumn("piece", F.max(F.when(F.col("apart"), F.col("j"))).over(line))
    cut = steps.groupBy("m", "s", "piece").agg(F.count(F.lit(1)).cast("int").alias("length"), F.min(F.struct("j", "count", "first")).alias("x"))
    cut = cut.select("m", "s", F.col("piece").alias("j"), "length", F.col("x.count").alias("count"), F.col("x.first.doc").alias("doc"), F.col("x.first.at").alias("at"))
    whole = held.where("k = 1").select("m", "s", F.lit(0).alias("j"), F.col("n").alias("length"), F.col("c").alias("count"), F.col("first.doc").alias("doc"), F.col("first.start").alias("at"))
    pieces = table(whole.unionByName(cut), "pieces")
    paths = _compact(pieces)
    placed = pieces.join(paths, ["doc", "at", "length", "count"])
    placed = placed.select("m", "s", F.struct("j", "length", "count", F.col("doc").alias("source"), "at", "path_start", "path_length").alias("p"))
    met = chunks.select("doc", "tag", "start", "m", "s").join(placed, ["m", "s"])
    met = met.select("doc", "tag", (F.col("start") + F.col("p.j")).alias("start"), "p.length", "p.source", "p.count", (F.col("p.at") - F.col("p.path_start")).alias("offset"), "p.path_start", "p.path_length")
    # Pieces of a path that lie as on the path are one span; if any is missing they stand for themselves.
    met = met.withColumn("shift", F.col("start") - F.col("offset")).repartition("doc", "tag")
    span = ["doc", "tag", "source", "path_start", "path_length", "count", "shift"]
    spans = met.groupBy(*span).agg(F.collect_set(F.struct("start", F.col("length").alias("windows"))).alias("parts"))
    full = F.aggregate("parts", F.lit(0), lambda n, x: n + x["windows"]) >= F.col("path_length")
    one_span = F.array(F.struct(F.col("shift").alias("start"), F.col("path_length").cast("int").alias("windows")))
    spans = spans.select("doc", "tag", "source", "path_start", "shift", full.alias("whole"), F.col("count").alias("occurrences"), F.explode(F.when(full, one_span).otherwise(F.col("parts"))).alias("x"))
    spans = spans.select("doc", "tag", "x.start", "x.windows", "source", (F.col("path_start") + F.col("x.start") - F.col("shift")).alias("source_start"), "occurrences", "whole")
    return spans.withColumn("first", (F.col("doc") == F.col("source")) & (F.col("start") == F.col("source_start")))


def _place_column():
    return F.shiftleft(F.col("first.start").cast("long"), 40).bitwiseXOR(F.col("first.tag")).bitwiseXOR(F.col("m"))


def remove_repeats(docs: DataFrame, words: int = WORDS, id_column: str = "doc_id", text: str = "text", mini: int = MINI) -> DataFrame:
    """doc_id, n_words, n_removed and kept: each text without the words of windows that occur earlier too."""
    spans = repeated_spans(docs, words, id_column, text, mini).where("not first")
    spans = table(spans.groupBy("doc", "tag").agg(F.collect_list(F.struct("start", "windows")).alias("spans")), "spans")
    source = _prepared(docs, id_column, text)
    spark, kind = docs.sparkSession, source.schema["doc"].dataType.simpleString()
    sieve = spark.sparkContext.broadcast(bitmap(spans, "tag")[0])

    def some(batch, wanted):
        return batch.filter(pa.array(in_bitmap(sieve.value, batch.column(1).to_numpy()) == wanted))

    def split(batches):
        for batch in batches:
            yield some(batch, True)

    def cut(batches):
        """Kept words of rows (doc, text, spans), block by block."""
        for batch in batches:
            for a, b in blocks(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist(), BLOCK):
                total, gone, kept = [], [], []
                texts = pc.fill_null(batch.column(1).slice(a, b - a), "").cast(pa.binary())
                for t, found in zip(texts, batch.column(2).slice(a, b - a).to_pylist(), strict=True):
                    own = t.as_py().split()  # bytes are split at \x20 and \x09-\x0D
                    total.append(len(own))
                    if found:
                        keep = np.ones(len(own), bool)
                        for x in found:
                            keep[x["start"] : x["start"] + x["windows"] + words - 1] = False
                        own = [w for w, k in zip(own, keep.tolist(), strict=True) if k]
                    gone.append(total[-1] - len(own))
                    kept.append(b" ".join(own))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], ["doc", "n_words", "n_removed", "kept"])

    def uncut(batches):
        for batch in batches:
            found = some(batch, False)
            yield from cut([pa.RecordBatch.from_arrays([found.column(0), found.column(2), pa.nulls(len(found))], ["doc", "text", "spans"])])

    shape = f"doc {kind}, tag long, text string"
    kinds = f"doc {kind}, n_words long, n_removed long, kept string"
    clean = source.mapInArrow(uncut, kinds)
    # Rows of a null id have no spans; rows that the bitmap lets through by chance have none either.
    touched = source.mapInArrow(split, shape).join(spans, ["doc", "tag"], "left").select("doc", "text", "spans")
    made = clean.unionByName(touched.mapInArrow(cut, kinds))
    return made.select(F.col("doc").alias("doc_id"), "n_words", "n_removed", "kept")
