"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; the unlabelled texts are a sample of all training texts, whatever
their labels, as the risk supposes. A
linear classifier on the presence of words and word beginnings is fitted with numpy so as to minimise
the non-negative corrected risk

    prior * R_positive(+1)  +  max(0, R_unlabelled(-1) - prior * R_positive(-1)),

where the second term's gradient is reversed whenever it would fall under zero. Only features that occur
in positives far more often than in unlabelled texts enter; they are chosen on the training sample.

The training sample is bounded: about POSITIVES toxic and UNLABELLED texts, a share of the distinct texts by
their hash, and of a text longer than LONGEST characters a passage of that length, from a place that its hash picks. The class prior, if not given, is the share of
toxic rows among the labelled training rows.

Defined results: null and empty texts, and texts without known features, get the score of the intercept.
Without positives, or without training rows, every score is that of an intercept of -40, under 1e-17. Repeated rows get equal scores. Extra columns are kept, those with
the names of the results are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import lgamma

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .merges import blocks, mix, word_hashes

POSITIVES = 2000
UNLABELLED = 6000
LONGEST = 8000
FEATURES = 2048
#: Word beginnings of these lengths are features besides whole words.
STARTS = (4, 5, 6)
#: Least texts and share of the positives with a feature, least share of toxic texts among all texts with it, and
#: the chance that any feature enters by accident.
LEAST_TEXTS, LEAST_SHARE, PURITY, CHANCE = 3, 0.015, 0.5, 0.01
THRESHOLD = 0.7
BLOCK = 4 << 20
#: Texts whose words are held at a time.
SLICE = 200


@dataclass
class Model:
    features: list[str]
    weights: np.ndarray
    bias: float
    prior: float


def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Row, distinct words, and index of the word, for each run of letters in lower case."""
    lists = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[^\p{L}]+")
    offsets = lists.offsets.to_numpy()
    found = lists.flatten().dictionary_encode()
    return np.repeat(np.arange(len(texts)), np.diff(offsets)), found.dictionary, found.indices.to_numpy()


def features_of(words: pa.Array) -> list[pa.Array]:
    """The features of each word: itself and its beginnings, null where the word is too short."""
    found = [pc.binary_join_element_wise("=", words, "")]
    for n in STARTS:
        start = pc.utf8_slice_codeunits(words, 0, n)
        long = pc.greater_equal(pc.utf8_length(words), n)
        found.append(pc.binary_join_element_wise(pa.array([str(n) if x else None for x in long.to_pylist()], pa.string()), start, ""))
    return found


def presences(texts: pa.Array, features: pa.Array) -> Iterator[np.ndarray]:
    """row * len(features) + feature of the given features in the texts, each once, a slice of texts at a time."""
    for start in range(0, len(texts), SLICE):
        rows, words, index = words_of(texts.slice(start, SLICE))
        pairs = []
        for values in features_of(words):
            at = pc.fill_null(pc.index_in(values, features), -1).to_numpy(zero_copy_only=False)
            hit = at[index]
            keep = hit >= 0
            pairs.append(np.unique((rows[keep] + start) * len(features) + hit[keep]))
        yield np.unique(np.concatenate(pairs))


def presence(texts: pa.Array, features: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) pairs, each once, of the given features in the texts."""
    both = np.concatenate([np.zeros(0, np.int64), *presences(texts, features)])
    return both // max(1, len(features)), both % max(1, len(features))


def texts_with(texts: pa.Array, features: pa.Array) -> np.ndarray:
    """How many of the texts have each feature; pairs are counted slice by slice, so that they are not all held at once."""
    n = np.zeros(len(features), np.int64)
    for pairs in presences(texts, features):
        n += np.bincount(pairs % len(features), minlength=len(features))
    return n


def without_copies(texts: pa.Array, hashes: int = 8, alike: int = 5) -> pa.Array:
    """The texts of the sample without near copies of earlier ones, by minima of word hashes.

    The rare words of a text that was copied many times would else pass for signs of its label.
    """
    minima = np.full((hashes, len(texts)), ~np.uint64(0))
    for start in range(0, len(texts), SLICE):
        rows, words, index = words_of(texts.slice(start, SLICE))
        values = word_hashes(words)
        for k in range(hashes):
            np.minimum.at(minima[k], rows + start, mix(values + np.uint64(k + 1))[index])
    seen: list[dict[int, list[int]]] = [{} for _ in range(hashes)]
    kept = []
    for i in range(len(texts)):
        found = Counter(j for k in range(hashes) for j in seen[k].get(int(minima[k, i]), ()))
        if not found or max(found.values()) < alike:
            kept.append(i)
            for k in range(hashes):
                seen[k].setdefault(int(minima[k, i]), []).append(i)
    return texts.take(pa.array(kept, pa.int64()))


def choose_features(positive: pa.Array, unlabelled: pa.Array, prior: float) -> list[str]:
    """Features that occur in positives far more often than in unlabelled texts, the strongest first."""
    support = max(min(LEAST_TEXTS, len(positive)), LEAST_SHARE * len(positive))
    rows, words, index = words_of(positive)
    names, a, tried = [], [], 0
    for values in features_of(words):
        coded = values.dictionary_encode()
        at = pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False)[index]
        keep = at >= 0
        width = max(1, len(coded.dictionary))
        n = np.bincount(np.unique(rows[keep] * width + at[keep]) % width, minlength=width)
        tried += len(coded.dictionary)
        often = np.flatnonzero(n >= support)
        names += coded.dictionary.take(pa.array(often)).to_pylist()
        a += n[often].tolist()
    a = np.array(a, float)
    if not names:
        return []
    expected = len(positive) * (texts_with(unlabelled, pa.array(names, pa.string())) + 0.5) / max(1, len(unlabelled))
    # Chance of so many positives with the feature if it were as common there as among unlabelled texts.
    log_chance = _log_poisson_tail(a, expected)
    keep = (log_chance + np.log(max(1, tried)) < np.log(CHANCE)) & (a >= PURITY / prior * expected)
    order = sorted(np.flatnonzero(keep).tolist(), key=lambda i: (log_chance[i], names[i]))[:FEATURES]
    return [names[i] for i in order]


def _log_poisson_tail(k: np.ndarray, expected: np.ndarray) -> np.ndarray:
    """log of the chance that a Poisson variable reaches k."""
    log_first = -expected + k * np.log(expected) - np.array([lgamma(x + 1) for x in k.tolist()])
    total, term = np.ones(len(k)), np.ones(len(k))
    for j in range(1, 200):
        term = term * expected / (k + j)
        total += term
    return np.minimum(log_first + np.log(total), 0.0)


def _sparse_dot(row: np.ndarray, column: np.ndarray, weights: np.ndarray, rows: int) -> np.ndarray:
    return np.bincount(row, weights[column], minlength=rows)


def train(positive: pa.Array, unlabelled: pa.Array, prior: float, rounds: int = 400, rate: float = 0.3, penalty: float = 1e-4) -> Model:
    """Non-negative positive-unlabelled risk with the logistic loss, by gradient descent with momentum."""
    positive, unlabelled = without_copies(positive), without_copies(unlabelled)
    features = choose_features(positive, unlabelled, prior)
    values = pa.array(features, pa.string())
    data = [presence(x, values) for x in (positive, unlabelled)]
    sizes = [len(positive), len(unlabelled)]
    w, bias = np.zeros(len(features)), -2.0
    mean_w, mean_b = np.zeros(len(features)), 0.0
    square_w, square_b = np.zeros(len(features)), 0.0
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
    loss = lambda x: np.logaddexp(0, -x)
    for step in range(1, rounds + 1):
        zp, zu = (_sparse_dot(r, c, w, n) + bias for (r, c), n in zip(data, sizes, strict=True))
        negative = loss(-zu).mean() - prior * loss(-zp).mean()
        gp = -prior * sigmoid(-zp) / sizes[0]  # of prior * R_positive(+1)
        gu = sigmoid(zu) / sizes[1]
        gn = -prior * sigmoid(zp) / sizes[0]
        if negative >= 0:
            on_p, on_u = gp + gn, gu
        else:  # the corrected negative risk is under zero: only it is stepped back
            on_p, on_u = -gn, -gu
        grad = sum(np.bincount(c, g[r], minlength=len(features)) for (r, c), g in zip(data, (on_p, on_u), strict=True)) + penalty * w
        grad_b = on_p.sum() + on_u.sum()
        mean_w, mean_b = 0.9 * mean_w + 0.1 * grad, 0.9 * mean_b + 0.1 * grad_b
        square_w, square_b = 0.99 * square_w + 0.01 * grad**2, 0.99 * square_b + 0.01 * grad_b**2
        scale = rate * (1 - step / (rounds + 1))
        w -= scale * (mean_w / (1 - 0.9**step)) / (np.sqrt(square_w / (1 - 0.99**step)) + 1e-8)
        bias -= scale * (mean_b / (1 - 0.9**step)) / (np.sqrt(square_b / (1 - 0.99**step)) + 1e-8)
    return Model(features, w, float(bias), prior)


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", toxic: str = "toxic", prior: float | None = None) -> Model:
    """Fit on training documents: those with toxic = 1 in ``labels`` are confirmed positives, all others unlabelled.

    Labels are joined to ids and hashes of texts; only the texts of the sample leave their place.
    """
    hashed = docs.where(F.col(text).isNotNull()).select(F.col(id_column).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    marks = labels.groupBy(F.col(id_column).alias("id")).agg(F.max(toxic).alias("toxic"))
    keys = hashed.select("id", "h").join(marks, "id", "left")
    keys = keys.select("h", (F.coalesce("toxic", F.lit(0)) == 1).alias("p"), F.col("toxic").isNotNull().alias("known"))
    # One row of a text: whether any copy is toxic, and how many labelled and toxic rows it has.
    keys = table(keys.groupBy("h").agg(F.max("p").alias("p"), F.count_if("known").alias("known"), F.count_if("p").alias("marked")), "text-keys")
    facts = keys.agg(F.sum("marked") / F.expr("nullif(sum(known), 0)"), F.count_if("p"), F.count(F.lit(1))).first()
    if prior is None:
        prior = min(0.9, max(0.001, facts[0] or 0.0))
    # The shares of distinct texts wanted are taken by hashes of the text, so copies count once and nothing is sorted.
    part = lambda h, most, n: F.pmod(h, F.lit(1_000_000)) < F.lit(1e6 * most / max(1, n))
    roles = F.array(F.when(F.col("p") & part(F.col("h"), POSITIVES, facts[1]), 0), F.when(part(F.xxhash64("h"), UNLABELLED, facts[2]), 1))
    chosen = keys.select("h", F.explode(F.filter(roles, lambda x: x.isNotNull())).alias("role"))
    chosen = table(chosen.distinct(), "sample-keys")
    over = F.length("text") - LONGEST
    passage = F.when(over <= 0, F.col("text")).otherwise(F.substring("text", F.pmod(F.xxhash64("text", F.lit(1)), F.greatest(over, F.lit(1))).cast("int") + 1, F.lit(LONGEST)))
    texts = hashed.join(F.broadcast(chosen.select("h").distinct()), "h").select("h", passage.alias("text")).groupBy("h").agg(F.min("text").alias("text"))
    # The sample comes as Arrow, not as rows and strings of Python, which the driver would hold besides.
    sample = texts.join(chosen, "h").select("role", "h", "text").orderBy("role", "h").toArrow()
    positive, unlabelled = (pc.cast(sample.filter(pc.equal(sample["role"], role))["text"], pa.string()).combine_chunks() for role in (0, 1))
    del sample
    if not len(positive) or not len(unlabelled):
        return Model([], np.zeros(0), -40.0, prior)
    return train(positive, unlabelled, prior)


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Add score (0 to 1) and predicted (1 from the threshold on) to each row."""
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    source = docs.select(*kept)
    at = kept.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        features = pa.array(m.features, pa.string())
        for batch in batches:
            column = batch.column(at)
            for a, b in blocks(pc.fill_null(pc.binary_length(column), 0).to_pylist(), BLOCK):
                part = batch.slice(a, b - a)
                if len(features):
                    rows, columns = presence(column.slice(a, b - a), features)
                    z = np.bincount(rows, m.weights[columns], minlength=b - a) + m.bias
                else:
                    z = np.full(b - a, m.bias)
                value = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(value), pa.array((value >= threshold).astype(np.int32))], [*kept, "score", "predicted"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema), "score double, predicted int"])
    return source.mapInArrow(run, schema)
