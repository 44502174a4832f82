"""Hard-negative mining by threshold joins with bounds of norms (L2AP), in blocks of anchors and rows.

Scores are inner products of whole-numbered vectors. An anchor's positives are its best rows of the same label; for
each positive, a window of scores is a share of the positive's, and its best rows of other labels within the
window are the hard negatives. Both are searches for the first K of a window, done in blocks: a block of rows
is indexed without the leading dimensions that alone reach a tenth of the least threshold at most; partial
scores over the rest are summed, and rows whose partial score plus the product of the remaining norms stays
below an anchor's threshold are pruned; what is left is scored in full. A window that holds its K rows
already asks for no less than the K-th; one that does not begins high and lowers its threshold until the block
fills it or its low end is reached. Results do not depend on blocks or levels.

Anchors are dealt over chunks of at most about CHUNK and rows over spans of at most about SPAN by hashes of
their ids, and each pair of a chunk and a span is one stream, in which a task holds the chunk with its best rows so far
and reads the span block by block. Positives are searched among rows of a label, which is part of the key there.

Defined results: rows with a null id, label or vector, an empty vector, or a component that is null or not
finite take no part. Of rows that repeat an id the first by label, then vector takes part. Only vectors of equal
length are compared. Scores beyond the range of a long are held at its ends. An anchor without other rows of
its label has no positives and gives no rows; an empty table gives an empty result. Extra columns are not kept.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table

#: Anchors of a chunk, rows of a span, and anchors and rows of a block.
CHUNK, SPAN = 1 << 16, 1 << 22
ANCHORS, ROWS = 256, 4096
#: Share of the least threshold that the dimensions left out of an index can reach.
OMITTED = 0.1
#: Shares of a window at which thresholds start and go on.
LEVELS = (0.6, 0.3, 0.0)
_MIN, _MAX = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def _exact(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole-numbered doubles as longs."""
    most = (np.abs(a).sum(axis=1).max(initial=0.0)) * np.abs(x).max(initial=0.0)
    if most < 2**53:
        return (a @ x.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    full = whole(a) @ whole(x).T
    return np.clip(full, _MIN, _MAX).astype(np.int64)


def _kth(scores: np.ndarray, chosen: np.ndarray, keep: int) -> np.ndarray:
    """Of each row's chosen scores only the first ``keep``: higher ones, of equal ones those further left."""
    many = np.flatnonzero(chosen.sum(axis=1) > keep)
    if len(many):
        part = np.where(chosen[many], scores[many], _MIN)
        least = np.partition(part, part.shape[1] - keep, axis=1)[:, -keep][:, None]
        above = chosen[many] & (part > least)
        equal = chosen[many] & (part == least)
        equal &= np.cumsum(equal, axis=1) <= keep - above.sum(axis=1)[:, None]
        chosen[many] = above | equal
    return chosen


class Search:
    """The first ``keep`` rows of each window (low to high) of each anchor, among rows of its label or of others."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, low: np.ndarray, high: np.ndarray, keep: int, same: bool):
        self.ids, self.labels, self.vectors, self.low, self.high, self.keep, self.same = ids, labels, vectors, low, high, keep, same
        self.score = np.full((*low.shape, keep), _MIN)
        self.found = np.full((*low.shape, keep), _MAX)

    def meet(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        """Take a block of rows into account."""
        order = np.argsort(ids, kind="stable")
        ids, labels, vectors = ids[order], labels[order], vectors[order]
        for start in range(0, len(self.ids), ANCHORS):
            left = np.arange(start, min(start + ANCHORS, len(self.ids)))
            for level in LEVELS:
                if len(left):
                    left = self._level(left, ids, labels, vectors, level)

    def _level(self, at: np.ndarray, ids, labels, vectors, level: float) -> np.ndarray:
        """Search at thresholds of one level; the anchors whose windows it does not settle."""
        anchors = self.vectors[at]
        norms = np.sqrt(np.einsum("ij,ij->i", anchors, anchors))
        # Nothing scores beyond the product of norms, so windows end there.
        reach = norms * np.sqrt(np.einsum("ij,ij->i", vectors, vectors).max(initial=0.0)) * (1 + 1e-9) + 1
        reach = np.clip(reach, 0, 2.0**62).astype(np.int64)[:, None]
        low, high = np.maximum(self.low[at], -reach), np.minimum(self.high[at], reach)
        # A level lies between the ends of a window; the last is its low end itself, also where it lies beyond reach.
        begin = np.maximum(low, (low * (1 - level) + np.maximum(low, high) * level).astype(np.int64)) if level else self.low[at]
        full = self.found[at, :, -1] != _MAX
        begin = np.where(full, np.maximum(self.score[at, :, -1], self.low[at]), begin)
        asked = begin.min(axis=1)
        columns = self._candidates(anchors, vectors, asked)
        scores = _exact(anchors, vectors[columns])
        fits = (self.labels[at][:, None] == labels[columns][None, :]) == self.same
        fits &= self.ids[at][:, None] != ids[columns][None, :]
        settled = full | (begin <= self.low[at])
        chosen = []
        for w in range(low.shape[1]):
            fit = fits & (scores >= begin[:, w][:, None]) & (scores <= self.high[at, w][:, None])
            settled[:, w] |= fit.sum(axis=1) >= self.keep
            chosen.append(fit)
        done = settled.all(axis=1)
        for w, fit in enumerate(chosen):
            self._merge(at[done], w, scores[done], _kth(scores[done], fit[done], self.keep), ids[columns])
        return at[~done]

    @staticmethod
    def _candidates(anchors: np.ndarray, vectors: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """Rows that may reach the threshold of an anchor, by partial scores and remaining norms."""
        least = float(asked.min())
        if least <= 0 or not len(vectors):
            return np.arange(len(vectors))
        dims = np.argsort(np.einsum("ij,ij->j", vectors, vectors), kind="stable")
        a, x = anchors[:, dims], vectors[:, dims]
        na = np.sqrt(np.c_[np.zeros(len(a)), np.cumsum(a * a, axis=1)])
        nx = np.sqrt(np.c_[np.zeros(len(x)), np.cumsum(x * x, axis=1)])
        slack = 1 + 1e-9
        # The leading dimensions of a row that reach a small share of the least threshold at most are left out of its index.
        omitted = (nx * na.max(axis=0)[None, :] * slack < OMITTED * least).sum(axis=1) - 1
        indexed = np.where(np.arange(x.shape[1])[None, :] >= omitted[:, None], x, 0.0)
        partial = a @ indexed.T
        rest = na[:, omitted] * nx[np.arange(len(x)), omitted][None, :]
        bound = partial + (rest + np.abs(partial) * 1e-9) * slack + na[:, -1:] * nx[:, -1][None, :] * 1e-9
        # A bound beyond the range of doubles is no number and prunes nothing.
        return np.flatnonzero((~(bound < asked[:, None])).any(axis=0))

    def _merge(self, at: np.ndarray, w: int, scores: np.ndarray, chosen: np.ndarray, ids: np.ndarray) -> None:
        row, column = np.nonzero(chosen)
        if not len(row):
            return
        place = np.arange(len(row)) - np.searchsorted(row, row)
        new_score = np.full((len(at), self.keep), _MIN)
        new_id = np.full((len(at), self.keep), _MAX)
        new_score[row, place], new_id[row, place] = scores[row, column], ids[column]
        touched = np.unique(row)
        both_score = np.concatenate([self.score[at[touched], w], new_score[touched]], axis=1)
        both_id = np.concatenate([self.found[at[touched], w], new_id[touched]], axis=1)
        # Places without a row come last, also after rows with the least possible score.
        order = np.lexsort((both_id, ~both_score, both_id == _MAX), axis=1)[:, : self.keep]
        self.score[at[touched], w] = np.take_along_axis(both_score, order, axis=1)
        self.found[at[touched], w] = np.take_along_axis(both_id, order, axis=1)


def share(score: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest whole number n with low * score <= 100 n <= high * score."""
    q, r = np.divmod(score, 100)
    return low * q - (-low * r) // 100, high * q + (high * r) // 100


def _pack(vectors: DataFrame) -> DataFrame:
    """id, label, d, anchor and the vector as bytes: two for a component where they suffice, else eight."""

    def run(batches):
        for batch in batches:
            lists = batch.column(3)
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            raw = []
            for n, end in zip(sizes.tolist(), ends.tolist(), strict=True):
                v = flat[end - n : end]
                raw.append(v.astype("<i2" if np.abs(v).max() < 1 << 15 else "<f8").tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sizes.astype(np.int32)), pa.array(raw, pa.binary())], ["id", "label", "anchor", "d", "v"])

    return vectors.select("id", "label", "anchor", "v").mapInArrow(run, "id long, label long, anchor boolean, d int, v binary")


def _unpacked(raw: list[bytes], width: int) -> np.ndarray:
    out = np.empty((len(raw), width))
    small = np.fromiter((len(r) == 2 * width for r in raw), bool, len(raw))
    for mask, kind in ((small, "<i2"), (~small, "<f8")):
        if mask.any():
            out[mask] = np.frombuffer(b"".join([raw[i] for i in np.flatnonzero(mask).tolist()]), kind).reshape(-1, width)
    return out


def _search(rows: DataFrame, anchors: DataFrame, key: list[str], keep: int, same: bool, low: int, high: int, sizes: tuple[int, int]) -> DataFrame:
    """anchor, positive (id, score; null in a search for positives), id and score of the best rows of each pair of a chunk and a span.

    ``anchors`` have the columns of rows and ``positives``, an array of (score, id) or null.
    """
    spark = rows.sparkSession
    parts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    n, count = sizes
    chunks, spans = max(1, ceil(count / CHUNK)), max(1, ceil(n / SPAN), min(parts, ceil(n / ROWS)))
    own = lambda number, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(number)).cast("int")
    every = lambda number: F.explode(F.sequence(F.lit(0), F.lit(number - 1)))
    columns = ["id", "label", "d", "v"]
    left = anchors.select(*columns, "positives", F.lit(0).alias("side"), own(chunks, 1).alias("chunk"), every(spans).alias("span"))
    right = rows.select(*columns, F.lit(None).cast(anchors.schema["positives"].dataType).alias("positives"), F.lit(1).alias("side"), own(spans, 2).alias("span"), every(chunks).alias("chunk"))
    dealt = left.unionByName(right).repartition(parts, *key, "chunk", "span").sortWithinPartitions(*key, "chunk", "span", "side")
    stream = [*key, "chunk", "span"]

    def results(search: Search, positives: list) -> pa.RecordBatch:
        i, w, k = np.nonzero(search.found != _MAX)
        pos = [(positives[a][b]["id"], positives[a][b]["score"]) if positives[a] else (None, None) for a, b in zip(i.tolist(), w.tolist(), strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array(search.ids[i]), pa.array([p[0] for p in pos], pa.int64()), pa.array([p[1] for p in pos], pa.int64()), pa.array(search.found[i, w, k]), pa.array(search.score[i, w, k])],
            ["anchor", "positive", "positive_score", "id", "score"],
        )

    def begin(waiting: list[pa.RecordBatch]) -> tuple[Search, list]:
        t = pa.Table.from_batches(waiting)
        positives = t.column("positives").to_pylist()
        width = max((len(p) for p in positives if p), default=1)
        floor, top = np.full((len(t), width), _MAX), np.full((len(t), width), _MIN)  # windows that nothing fits
        for i, p in enumerate(positives):
            if p:
                floor[i, : len(p)], top[i, : len(p)] = share(np.array([x["score"] for x in p], np.int64), low, high)
            else:
                floor[i], top[i] = _MIN, _MAX
        vectors = _unpacked(t.column("v").to_pylist(), t.column("d")[0].as_py())
        return Search(t.column("id").to_numpy(), t.column("label").to_numpy(), vectors, floor, top, keep, same), positives

    def run(batches):
        now, search, positives, waiting = None, None, [], []
        for batch in batches:
            change = np.zeros(len(batch), bool)
            for c in [*stream, "side"]:
                v = batch.column(batch.schema.get_field_index(c)).to_numpy()
                change[1:] |= v[1:] != v[:-1]
            bounds = [0, *np.flatnonzero(change).tolist(), len(batch)]
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                here = tuple(part.column(part.schema.get_field_index(c))[0].as_py() for c in stream)
                if here != now:
                    if search is not None:
                        yield results(search, positives)
                    now, search, waiting = here, None, []
                if part.column(part.schema.get_field_index("side"))[0].as_py() == 0:
                    waiting.append(part)
                    continue
                if search is None and waiting:
                    (search, positives), waiting = begin(waiting), []
                if search is None:
                    continue  # no anchors in this stream
                for c in range(0, len(part), ROWS):
                    piece = part.slice(c, ROWS)
                    get = lambda name: piece.column(piece.schema.get_field_index(name))  # noqa: B023, E731
                    search.meet(get("id").to_numpy(), get("label").to_numpy(), _unpacked(get("v").to_pylist(), get("d")[0].as_py()))
        if search is not None:
            yield results(search, positives)

    return dealt.select(*stream, "side", "id", *[c for c in ("label", "d") if c not in stream], "v", "positives").mapInArrow(run, "anchor long, positive long, positive_score long, id long, score long")


def hard_negatives(rows: DataFrame, anchor: Column, id_column: str = "vec_id", label: Column | str = "label", vector: Column | str = "embedding", positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``anchor`` marks the anchors, ``vector`` is an array of whole numbers; negatives score ``low`` to ``high`` % of a positive.
    """
    named = rows.select(F.col(id_column).cast("long").alias("id"), (F.col(label) if isinstance(label, str) else label).alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"), (F.col(vector) if isinstance(vector, str) else vector).cast("array<double>").alias("v"))
    if dict(named.dtypes)["label"] not in ("tinyint", "smallint", "int", "bigint"):
        named = named.withColumn("label", F.when(F.col("label").isNotNull(), F.xxhash64("label")))
    named = named.withColumn("label", F.col("label").cast("long"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    named = named.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & ~bad)
    # One row of an id: the first by label and vector. Anchors are marked by id alone or by row; the first row decides.
    first = named.groupBy("id").agg(F.min(F.struct("label", "v", "anchor")).alias("r")).select("id", "r.*")
    source = table(_pack(first), "vectors")
    sizes = source.agg(F.count(F.lit(1)), F.count_if("anchor")).first()
    anchors = source.where("anchor")
    none = F.lit(None).cast("array<struct<score:bigint,id:bigint>>").alias("positives")
    best = lambda df, n, *keys: df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "id"))).where(F.col("rank") <= n)
    found = _search(source, anchors.select("*", none), ["d", "label"], positives, True, low, high, sizes)
    found = best(found, positives, "anchor").groupBy("anchor").agg(F.collect_list(F.struct("score", "id")).alias("positives"))
    chosen = table(anchors.join(found, anchors["id"] == found["anchor"]).drop(found["anchor"]).select("id", "label", "d", "v", "positives"), "anchors")
    found = _search(source, chosen, ["d"], negatives, False, low, high, sizes)
    return best(found, negatives, "anchor", "positive").select(F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
