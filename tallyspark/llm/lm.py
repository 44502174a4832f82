"""Language-model scoring by Katz backoff over words.

Counts are discounted by Good-Turing (counts of up to REACH), and what is discounted goes to the next
lower order through backoff weights that make every distribution sum to one over the V known words and
one unknown word:

    p(w | h) = d(c(h, w)) c(h, w) / c(h)          if the pair was seen,
               a(h) p(w)                          otherwise,
    p(w)     = d(c(w)) c(w) / N                   if the word was seen,
               what is left                       for the unknown word.

All pairs of the training texts are counted, by the 64-bit hashes of both words. Words and pairs stay in
tables that are dealt by hash into buckets, as many as the input needs, and are looked up there: a block of
texts sends each bucket its distinct keys, each once, and gets back what is stored of them; its tokens wait
for the answers in a row of their own. So neither a frequent word nor a frequent pair makes a bucket large;
where more texts are scored than were learned from, the blocks that ask one bucket are salted.
The words that make up at least the share COMMON of the training tokens are also broadcast, to save
requests; by arithmetic there are at most 1 / COMMON. A pair is counted in the bucket of its second word
where that is not common (such a word has few pairs), or else in the bucket of the pair.
Keys, counts and tokens travel and are stored packed: differences of sorted keys and byte planes of numbers,
compressed. A stored pair is named by log2(training tokens) + SURE bits of its hash (64 at most), so an unseen
pair is taken for a seen one with a chance of 2^-SURE at most, whatever the size of the corpus.

Tokens are the words `[^\\x20\\x09-\\x0D]+`, A-Z in lower case, and one end for each text.

Defined results: a null or empty text is the end alone. Without training texts N and V are 0 and every
token is unknown with probability 1. A context whose seen pairs would leave less than HALF a count for
unseen words is scaled to leave that. Repeated rows get equal scores. Extra columns are not kept.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .merges import blocks, mix, word_codes

REACH = 5
#: Share of the training tokens from which a word is broadcast.
COMMON = 1e-5
HALF = 0.5
#: Bytes of text that are counted or scored at a time.
BLOCK = 24 << 20
SURE = 24
#: Sums of probabilities travel as whole numbers of 1 / UNITS, which pack better than floats. A sum is off by half
#: a unit for each bucket at most: 2e-13 for 100 buckets, 3e-9 for 1.6 million (100 TB of text).
UNITS = float(1 << 48)
#: Times that a word occurs in a block to be numbered by its frequency.
OFTEN = 4
#: Bytes of text for each bucket.
SHARE = 64 << 20
#: Keys of one row of a stored table.
CHUNK = 1 << 16
#: The hash that stands for the end of a text.
END = np.uint64(0x656E64206F662074)
#: The hash that stands for the start of a text, which is a history only.
START = np.uint64(0x7374617274206F66)
#: Stands for a null id on the way.
_NO_ID = -(2**63)
_U = np.uint64

_NAMES = ["kind", "bucket", "block", "keys", "tokens", "sizes", "counts", "a", "b"]
_KEYED = "kind int, bucket int, block string, keys binary, tokens binary, sizes binary, counts binary, a binary, b binary"


def pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on, or floats: their byte planes, compressed."""
    import zstandard

    if values.dtype.kind == "f":
        planes = np.ascontiguousarray(values, "<f8").view(np.uint8).reshape(-1, 8)
        width = 9  # marks floats
    else:
        most = int(values.max(initial=0))
        width = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4 if most < 1 << 32 else 8
        planes = values.astype(f"<u{width}").view(np.uint8).reshape(-1, width)
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes.T).tobytes())


def unpack(data: bytes) -> np.ndarray:
    """What ``pack`` was given, as uint64, int64 or float64 by its width."""
    import zstandard

    width = min(8, data[0])
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8)
    values = np.ascontiguousarray(raw.reshape(width, -1).T).reshape(-1).view("<f8" if data[0] == 9 else f"<u{width}")
    return values if data[0] == 9 or width == 8 else values.astype(np.int64)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys by their differences."""
    return pack(np.diff(keys, prepend=np.zeros(1, np.uint64)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data).astype(np.uint64), dtype=np.uint64)


@dataclass
class Model:
    """Tables and the bounded part of a fitted model."""

    words: DataFrame  # bucket, keys, counts, alpha, factor
    pairs: DataFrame  # bucket, keys, counts
    buckets: int
    tokens: int
    distinct: int
    discount: np.ndarray  # of word counts 0 to REACH
    scale: float
    unknown: float
    key_bits: int
    pair_discount: np.ndarray | None = None
    common: np.ndarray | None = None  # sorted hashes of the broadcast words, the start of a text among them
    common_counts: np.ndarray | None = None
    common_alpha: np.ndarray | None = None  # log10 backoff weight after each of them
    common_factor: np.ndarray | None = None  # scale of the discounted counts after each of them

    def word_log(self, counts: np.ndarray) -> np.ndarray:
        """log10 p(w) of words by their counts."""
        discounted = counts * np.where(counts <= REACH, self.discount[np.minimum(counts, REACH)], 1.0) * self.scale
        return np.log10(np.where(counts > 0, discounted / max(1, self.tokens), self.unknown))


def good_turing(frequencies: np.ndarray, reach: int = REACH) -> np.ndarray:
    """Discounts of counts 0 to ``reach`` from the numbers of types seen 1 to reach + 1 times.

    Katz's formula; where the numbers do not allow it (a discount outside (0, 1)), absolute discounting
    with n1 / (n1 + 2 n2) instead.
    """
    n = np.r_[0.0, frequencies[: reach + 1]]
    r = np.arange(1, reach + 1)
    if (n[1:] > 0).all():
        common = (reach + 1) * n[reach + 1] / n[1]
        d = ((r + 1) * n[2:] / (r * n[1:-1]) - common) / (1 - common) if common < 1 else np.zeros(reach)
        if ((d > 0) & (d < 1)).all():
            return np.r_[1.0, d]
    off = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.0
    return np.r_[1.0, (r - min(off, 0.99)) / r]


def _deal(keys: np.ndarray, buckets: int, bits: int = 64):
    """Order of the keys, and where each bucket starts in it: buckets are ranges of keys, which are hashes."""
    order = np.argsort(keys)
    return order, np.searchsorted(_bucket(keys, buckets, bits)[order], np.arange(buckets + 1))


def _count_rows(keys: np.ndarray, counts: np.ndarray, buckets: int) -> pa.RecordBatch:
    order, starts = _deal(keys, buckets)
    full = np.flatnonzero(np.diff(starts)).tolist()
    spans = [order[starts[b] : starts[b + 1]] for b in full]
    return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array([pack_keys(keys[x]) for x in spans], pa.binary()), pa.array([pack(counts[x]) for x in spans], pa.binary())], ["bucket", "keys", "counts"])


def _joined(column, how=unpack, kind=np.int64) -> np.ndarray:
    """The packed arrays of a column one after the other."""
    return np.concatenate([np.zeros(0, kind), *map(how, column)])


def _seen(counts: np.ndarray) -> np.ndarray:
    """How many of the counts are 1, 2, ... REACH + 1."""
    return np.bincount(np.minimum(counts, REACH + 2), minlength=REACH + 3)[1 : REACH + 2]


def _summed(rows: DataFrame) -> DataFrame:
    """Total count of each key by bucket, in rows of at most CHUNK keys, with the numbers of keys seen 1, 2, ... times."""

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        keys, inverse = np.unique(_joined(frame["keys"], unpack_keys, np.uint64), return_inverse=True)
        counts = np.bincount(inverse, _joined(frame["counts"]), minlength=len(keys)).astype(np.int64)
        out = []
        for i in range(0, len(keys), CHUNK):
            c = counts[i : i + CHUNK]
            out.append((int(frame["bucket"].iloc[0]), pack_keys(keys[i : i + CHUNK]), pack(c), len(c), int(c.sum()), _seen(c)))
        return pd.DataFrame(out, columns=["bucket", "keys", "counts", "n", "total", "seen"])

    return rows.groupBy("bucket").applyInPandas(merge, "bucket int, keys binary, counts binary, n long, total long, seen array<long>")


def _block_words(texts: pa.Array):
    """Tokens of a block, the end of each text among them: sizes, hash of each distinct token, index of each token."""
    counts, words = word_codes(texts)
    index, distinct = pd.factorize(words)
    sizes = counts + 1
    ends = np.cumsum(sizes)
    tokens = np.full(ends[-1] if len(ends) else 0, len(distinct))
    inner = np.ones(len(tokens), bool)
    inner[ends - 1] = False
    tokens[inner] = index
    hashes = np.r_[distinct, END]
    # Frequent words first, the commonest before, so that most tokens are small numbers; the others by their hash.
    times = np.bincount(tokens, minlength=len(hashes))
    order = np.lexsort((hashes, -times * (times >= OFTEN)))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return sizes, hashes[order], place[tokens]


def _index(hashes: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Place of each hash among sorted ones, -1 for those not there."""
    if not len(among):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(among, hashes), len(among) - 1)
    return np.where(among[at] == hashes, at, -1)


def _pair_keys(histories: np.ndarray, words: np.ndarray, bits: int = 64) -> np.ndarray:
    return mix(mix(histories) * _U(0x9E3779B97F4A7C15) + words) >> _U(64 - bits)


def pack_names(names: np.ndarray, common: np.ndarray) -> bytes:
    """Hashes of words, first common ones and then others, each sorted; common ones by their numbers."""
    at = _index(names, common)
    numbers = pack(np.diff(at[at >= 0], prepend=0))
    return len(numbers).to_bytes(4, "little") + numbers + pack_keys(names[at < 0])


def unpack_names(data: bytes, common: np.ndarray) -> np.ndarray:
    cut = 4 + int.from_bytes(data[:4], "little")
    return np.r_[common[np.cumsum(unpack(data[4:cut]))], unpack_keys(data[cut:])]


def _bucket(keys: np.ndarray, buckets: int, bits: int = 64) -> np.ndarray:
    """The bucket of keys of ``bits`` bits: equal ranges of them, in order."""
    return ((keys << _U(64 - bits) >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64)


def _block_pairs(sizes: np.ndarray, tokens: np.ndarray, width: int):
    """Distinct pairs of a block: index of the history (``width`` for the start of a text) and of the word, and the pair at each token."""
    before = np.r_[np.int64(width), tokens[:-1]]
    before[np.cumsum(sizes) - sizes] = width
    inverse, codes = pd.factorize(before[: len(tokens)] * width + tokens)
    return codes // width, codes % width, inverse


def _bytes(df: DataFrame) -> tuple[int, int]:
    """Bytes of all texts, and their number."""
    found = df.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    return found[0] or 0, found[1]


def _each_block(batches, column: int = 0):
    for batch in batches:
        texts = batch.column(column)
        for a, b in blocks(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), BLOCK):
            yield batch.slice(a, b - a), texts.slice(a, b - a)


def _at_least(words: DataFrame, least: float, columns: list[str]) -> list[np.ndarray]:
    """Hashes (sorted) and columns of the words of a count of at least ``least``, and of the start of a text."""

    def find(batches):
        for batch in batches:
            for i in range(len(batch)):
                keys = unpack_keys(batch.column(0)[i].as_py())
                values = [unpack(batch.column(k + 1)[i].as_py()) for k in range(len(columns))]
                at = np.flatnonzero((values[0] >= least) | (keys == START))
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array(keys[at].view(np.int64)), *(pa.array(v[at].astype(np.float64)) for v in values)], ["keys", *columns])

    found = words.select("keys", *columns).mapInArrow(find, ", ".join(["keys long", *(f"{c} double" for c in columns)])).collect()
    hashes = np.array([r[0] % (1 << 64) for r in found], np.uint64)
    order = np.argsort(hashes)
    return [hashes[order], *(np.array([r[k + 1] for r in found], float)[order] for k in range(len(columns)))]


def fit(train: DataFrame, text: str = "text", buckets: int | None = None) -> Model:
    """Count words and pairs of all training texts, and weigh them."""
    spark = train.sparkSession
    source = train.select(F.col(text).alias("text"))
    # After the start of a text come as many tokens as there are texts.
    size, texts_all = _bytes(source)
    buckets = buckets or max(8, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARE))

    def count_words(batches):
        for _, texts in _each_block(batches):
            _, hashes, tokens = _block_words(texts)
            counts = np.bincount(tokens, minlength=len(hashes))
            hashes, counts = hashes[counts > 0], counts[counts > 0]
            yield _count_rows(hashes, counts, buckets)

    words = table(_summed(source.mapInArrow(count_words, "bucket int, keys binary, counts binary")), "lm-words")
    seen = [F.sum(F.element_at("seen", r)).alias(f"n{r}") for r in range(1, REACH + 2)]
    facts = words.agg(F.sum("total").alias("N"), F.sum("n").alias("V"), *seen).first()
    tokens, distinct = facts["N"] or 0, facts["V"] or 0
    types = np.array([facts[f"n{r}"] or 0 for r in range(1, REACH + 2)], float)
    discount = good_turing(types)
    taken = float(sum(r * types[r - 1] * (1 - discount[r]) for r in range(1, REACH + 1)))
    unknown = max(taken / tokens, 1 / (tokens + distinct + 1)) if tokens else 1.0
    scale = (1 - unknown) / (1 - taken / tokens) if tokens > taken else 1.0

    # By arithmetic at most 1 / COMMON words reach this share.
    least = max(1, COMMON * tokens)
    common, common_counts = _at_least(words, least, ["counts"])
    common_counts = common_counts.astype(np.int64)
    bits = min(64, tokens.bit_length() + SURE)
    model = Model(words, words, buckets, tokens, distinct, discount, scale, unknown, bits)
    word_log = _alone(model).word_log
    known = spark.sparkContext.broadcast((common, common_counts))
    pair_columns = "bucket int, histories binary, keys binary, history binary, word binary, counts binary"

    def count_pairs(batches):
        common, _ = known.value
        for _, texts in _each_block(batches):
            sizes, hashes, tokens = _block_words(texts)
            history, word, inverse = _block_pairs(sizes, tokens, len(hashes))
            counts = np.bincount(inverse, minlength=len(word))
            named = np.r_[hashes, START]
            # Common words first and the rest after them, each by hash: the order in which names are packed.
            rare = _index(named, common) < 0
            order = np.lexsort((named, rare))
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            bucket = np.where(rare[word], _bucket(named, buckets)[word], _bucket(_pair_keys(named[history], named[word]), buckets))
            named, history, word = named[order], rank[history], rank[word]
            by = np.argsort((bucket * len(named) + word) * len(named) + history) if buckets * len(named) ** 2 < 1 << 62 else np.lexsort((history, word, bucket))
            starts = np.searchsorted(bucket[by], np.arange(buckets + 1))
            full = np.flatnonzero(np.diff(starts)).tolist()
            rows: list[list[bytes]] = [[], [], [], [], []]
            for b in full:
                # The words of the bucket's pairs once each, and the pairs by their places among them.
                span = by[starts[b] : starts[b + 1]]
                made = []
                for values in (history[span], word[span]):
                    present = np.zeros(len(named), bool)
                    present[values] = True
                    made += [pack_names(named[present], common), (np.cumsum(present) - 1)[values]]
                for out, x in zip(rows, (made[0], made[2], pack(made[1]), pack(np.diff(made[3], prepend=0)), pack(counts[span])), strict=True):
                    out.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), *(pa.array(x, pa.binary()) for x in rows)], [c.split()[0] for c in pair_columns.split(", ")])

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        """Totals of the pairs of a bucket (part 1), and what each history has in it (part 2)."""
        common, common_counts = known.value
        stored = frame["histories"].isna()
        columns = ["part", "bucket", "keys", "counts", "seen", "lower"]
        if stored.all():
            return pd.DataFrame([], columns=columns)
        here, here_counts = _joined(frame.loc[stored, "keys"], unpack_keys, np.uint64), _joined(frame.loc[stored, "counts"])
        order = np.argsort(here)
        here, here_counts = here[order], here_counts[order]
        sent = frame[~stored]
        history = np.concatenate([unpack_names(k, common)[unpack(p)] for k, p in zip(sent["histories"], sent["history"], strict=True)])
        word = np.concatenate([unpack_names(k, common)[np.cumsum(unpack(p))] for k, p in zip(sent["keys"], sent["word"], strict=True)])
        inverse, keys = pd.factorize(_pair_keys(history, word))
        first = np.empty(len(keys), np.int64)
        first[inverse[::-1]] = np.arange(len(inverse))[::-1]
        counts = np.bincount(inverse, _joined(sent["counts"]), minlength=len(keys)).astype(np.int64)
        history, word = history[first], word[first]
        at, rare = _index(word, common), _index(word, here)
        of = np.zeros(len(word), np.int64)
        of[at >= 0] = common_counts[at[at >= 0]]
        of[at < 0] = here_counts[rare[at < 0]]
        out = []
        keys = keys >> _U(64 - bits)
        order, starts = _deal(keys, buckets, bits)
        for b in np.flatnonzero(np.diff(starts)):
            for i in range(starts[b], starts[b + 1], CHUNK):
                span = order[i : min(i + CHUNK, starts[b + 1])]
                out.append((1, int(b), pack_keys(keys[span]), pack(counts[span]), _seen(counts[span]), None))
        # Of each history: pairs seen 1 to REACH times, occurrences in the others, and the sum of p(w).
        owner, owners = pd.factorize(history)
        low = counts <= REACH
        several = np.bincount(owner[low] * (REACH + 1) + counts[low] - 1, minlength=len(owners) * (REACH + 1)).reshape(-1, REACH + 1).astype(np.int64)
        several[:, REACH] = np.bincount(owner[~low], counts[~low], minlength=len(owners))
        lower = np.bincount(owner, 10 ** word_log(of), minlength=len(owners))
        order, starts = _deal(owners, buckets)
        for b in np.flatnonzero(np.diff(starts)):
            span = order[starts[b] : starts[b + 1]]
            out.append((2, int(b), pack_keys(owners[span]), pack(several[span].T.ravel()), None, pack(np.rint(lower[span] * UNITS).astype(np.int64))))
        return pd.DataFrame(out, columns=columns)

    none = F.lit(None).cast("binary")
    listed = words.select("bucket", none.alias("histories"), "keys", none.alias("history"), none.alias("word"), "counts")
    both = source.mapInArrow(count_pairs, pair_columns).unionByName(listed)
    merged = table(both.groupBy("bucket").applyInPandas(merge, "part int, bucket int, keys binary, counts binary, seen array<long>, lower binary"), "lm-pairs")
    facts = merged.where("part = 1").agg(*seen).first()
    pair_discount = good_turing(np.array([facts[f"n{r}"] or 0 for r in range(1, REACH + 2)], float))
    starts_all = texts_all if tokens else 0

    def weigh(frame: pd.DataFrame) -> pd.DataFrame:
        """Words of a bucket with the log10 backoff weight after each and the scale of its discounted pairs."""
        own = frame["lower"].isna()
        bucket = int(frame["bucket"].iloc[0])
        keys, totals = _joined(frame.loc[own, "keys"], unpack_keys, np.uint64), _joined(frame.loc[own, "counts"])
        if bucket == _bucket(np.array([START]), buckets)[0]:
            keys, totals = np.r_[keys, START], np.r_[totals, starts_all]
        order = np.argsort(keys)
        keys, totals = keys[order], totals[order]
        history = _joined(frame.loc[~own, "keys"], unpack_keys, np.uint64)
        kept = np.concatenate([np.zeros((0, REACH + 1), np.int64), *(unpack(x).reshape(REACH + 1, -1).T for x in frame.loc[~own, "counts"])])
        at = np.searchsorted(keys, history)
        mass = np.bincount(at, kept @ np.r_[np.arange(1, REACH + 1) * pair_discount[1:], 1.0], minlength=len(keys))
        lower = np.bincount(at, _joined(frame.loc[~own, "lower"]).astype(float) / UNITS, minlength=len(keys))
        most = np.maximum(totals - HALF, 0)
        factor = np.where(mass > most, most / np.maximum(mass, 1e-300), 1.0)
        alpha = np.where(mass > 0, np.log10((1 - mass * factor / np.maximum(totals, 1)) / (1 - lower)), 0.0)
        out = [(bucket, *(how(x[i : i + CHUNK]) for how, x in ((pack_keys, keys), (pack, totals), (pack, alpha), (pack, factor)))) for i in range(0, len(keys), CHUNK)]
        return pd.DataFrame(out, columns=["bucket", "keys", "counts", "alpha", "factor"])

    parts = words.select("bucket", "keys", "counts", none.alias("lower")).unionByName(merged.where("part = 2").select("bucket", "keys", "counts", "lower"))
    model.words = table(parts.groupBy("bucket").applyInPandas(weigh, "bucket int, keys binary, counts binary, alpha binary, factor binary"), "lm-weights")
    model.pairs, model.pair_discount = merged.where("part = 1").select("bucket", "keys", "counts"), pair_discount
    model.common, model.common_counts, model.common_alpha, model.common_factor = _at_least(model.words, least, ["counts", "alpha", "factor"])
    return model


def _alone(model: Model) -> Model:
    """The model without its tables, which can be sent to tasks."""
    return replace(model, words=None, pairs=None)


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, base_score (add-one words) and score (the model) of each text, in log10."""
    spark = docs.sparkSession
    buckets, bits = model.buckets, model.key_bits
    total = model.tokens + model.distinct + 1
    shared = spark.sparkContext.broadcast(_alone(model))
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def requests(kind, block, keys, bits=64):
        """One row for each bucket: its keys."""
        order, starts = _deal(keys, buckets, bits)
        full = np.flatnonzero(np.diff(starts)).tolist()
        n = len(full)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, kind, np.int32)), pa.array(full, pa.int32()), pa.array([block] * n, pa.string()), pa.array([pack_keys(keys[order[starts[b] : starts[b + 1]]]) for b in full], pa.binary())]
            + [pa.nulls(n, pa.binary())] * 5,
            _NAMES,
        )

    def ask(batches):
        from pyspark import TaskContext

        common = shared.value.common
        part = TaskContext.get().partitionId()
        for number, (rows, texts) in enumerate(_each_block(batches, 1)):
            block = f"{part}-{number}"
            sizes, hashes, tokens = _block_words(texts)
            history, word, _ = _block_pairs(sizes, tokens, len(hashes))
            # What waits for the answers: kind 0, the ids and then the hashes.
            ids = pc.fill_null(rows.column(0), _NO_ID).to_numpy()
            often = int((np.bincount(tokens, minlength=len(hashes)) >= OFTEN).sum())
            held = (pack(np.r_[ids.view(np.uint64), hashes[:often]]), pack(tokens), pack(sizes), pack_keys(hashes[often:]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([0], pa.int32()), pa.array([number], pa.int32()), pa.array([block]), *(pa.array([x], pa.binary()) for x in held)] + [pa.nulls(1, pa.binary())] * 2, _NAMES
            )
            yield requests(1, block, hashes[_index(hashes, common) < 0])
            named = np.r_[hashes, START]
            yield requests(2, block, _pair_keys(named[history], named[word], bits), bits)

    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        kind = frame["kind"].iloc[0]
        if kind == 0:
            return frame[_NAMES]
        stored = frame["block"].isna()
        keys = _joined(frame.loc[stored, "keys"], unpack_keys, np.uint64)
        order = np.argsort(keys)
        keys = keys[order]
        columns = ["counts", "a", "b"] if kind == 1 else ["counts"]
        values = [np.r_[_joined(frame.loc[stored, c], kind=float if c in "ab" else np.int64)[order], 0] for c in columns]
        out = []
        for r in frame[~stored].itertuples(index=False):
            at = _index(unpack_keys(r.keys), keys)  # -1 takes the 0 at the end
            got = [pack(v[at]) for v in values]
            out.append((kind, r.bucket, r.block, None, None, None, got[0], *(got[1:] or (None, None))))
        return pd.DataFrame(out, columns=_NAMES)

    def finish(frame: pd.DataFrame) -> pd.DataFrame:
        m = shared.value
        own = frame[frame["kind"] == 0].iloc[0]
        sizes, tokens = unpack(own["sizes"]).astype(np.int64), unpack(own["tokens"]).astype(np.int64)
        both = unpack(own["keys"]).astype(np.uint64)
        ids, hashes = both[: len(sizes)].view(np.int64), np.r_[both[len(sizes) :], unpack_keys(own["counts"])]
        history, word, inverse = _block_pairs(sizes, tokens, len(hashes))
        replies = {kind: frame[frame["kind"] == kind].sort_values("bucket") for kind in (1, 2)}

        def replied(kind, column, keys):
            """Answers in the order of the keys."""
            out = np.zeros(len(keys))
            if len(keys):
                out[np.argsort(keys)] = _joined(replies[kind][column], kind=float)
            return out

        named = np.r_[hashes, START]
        at = _index(named, m.common)
        rare = np.flatnonzero(at[:-1] < 0)
        facts = []
        for column, mine in (("counts", m.common_counts), ("a", m.common_alpha), ("b", m.common_factor)):
            values = np.zeros(len(named))
            values[at >= 0] = mine[at[at >= 0]]
            values[rare] = replied(1, column, hashes[rare])
            facts.append(values)
        counts, alpha, factor = facts
        pair = replied(2, "counts", _pair_keys(named[history], named[word], bits))
        discounted = pair * np.where(pair <= REACH, m.pair_discount[np.minimum(pair, REACH).astype(np.int64)], 1.0)
        logs = m.word_log(counts.astype(np.int64))
        with np.errstate(divide="ignore", invalid="ignore"):
            of_pair = np.where(pair > 0, np.log10(discounted * factor[history] / counts[history]), alpha[history] + logs[word])
        owner = np.repeat(np.arange(len(sizes)), sizes)
        score = np.bincount(owner, of_pair[inverse], minlength=len(sizes))
        base = np.bincount(owner, np.log10((counts + 1) / total)[tokens], minlength=len(sizes))
        n_known = np.bincount(owner, (counts > 0)[tokens], minlength=len(sizes)).astype(np.int64)
        shown = pd.array(ids, dtype="Int64")
        shown[ids == _NO_ID] = pd.NA
        return pd.DataFrame({"doc_id": shown, "n_tokens": sizes, "n_known": n_known, "base_score": base, "score": score})

    none = F.lit(None).cast("binary")
    blank = [F.lit(None).cast("string").alias("block"), none.alias("tokens"), none.alias("sizes")]
    stored = model.words.select(F.lit(1).alias("kind"), "bucket", *blank, "keys", "counts", F.col("alpha").alias("a"), F.col("factor").alias("b"))
    stored = stored.unionByName(model.pairs.select(F.lit(2).alias("kind"), "bucket", *blank, "keys", "counts", none.alias("a"), none.alias("b")))
    # To the nearest: the texts to score are a little more than those that set the buckets, which needs no second copy of the model.
    salts = max(1, round(_bytes(source)[0] / (buckets * SHARE)))
    stored = stored.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    asked = source.mapInArrow(ask, _KEYED).withColumn("salt", (F.crc32(F.col("block").cast("binary")) % salts).cast("int"))
    # Kind 0 rows go by their block, the others by their bucket and the salt of the block.
    dealt = F.when(F.col("kind") == 0, F.col("block")).otherwise(F.concat_ws("-", "bucket", "salt"))
    answered = stored.unionByName(asked).groupBy("kind", dealt.alias("dealt")).applyInPandas(answer, _KEYED)
    return answered.groupBy("block").applyInPandas(finish, "doc_id long, n_tokens long, n_known long, base_score double, score double")
