"""Best-fit packing by patterns of few lengths, fitted to the length histogram by non-negative least squares.

Documents become token pieces of at most ``capacity`` tokens. Only the histogram of piece lengths (at most
``capacity`` numbers, whatever the corpus) reaches the driver, where the plan is made: patterns of one to
three lengths that fill a sequence are enumerated, their repeat counts are fitted to the histogram by
non-negative least squares, rounded down, and what is left is packed by best-fit decreasing on counts of
equal lengths. A piece then finds its place from its length and its gapless rank among equal lengths.

Defined results: a null or empty text is a document of the end token alone. Documents longer than
``capacity`` are cut into pieces of ``capacity``; the last may be shorter. Rows with null or repeated
doc_id are packed like others. An empty table gives an empty result. Extra columns are not kept.
"""

from __future__ import annotations

import bisect
import json
import os
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gapless_rank, table
from .merges import PairTable, SegmentCoder, blocks, cut_bytes, merge_rounds

CAPACITY = 2048
END = 0
#: Patterns that the least squares may use.
PATTERNS = 6000
#: Words whose ids a worker keeps.
CACHE = 200_000
#: Bytes of text that are coded at a time.
BLOCK = 5 << 20


class WordTokenizer:
    """Ids of whole texts from a tokenizers file, with the ids of words kept.

    A text is cut at white space, where the file's pre-tokenizer always cuts too and drops the white
    space. So the ids of a text are those of its words one after the other. The file lowers case, so A to
    Z are lowered first. Words of Latin letters, with or without ASCII marks after them, are merged in
    vectorised rounds; all others go through the library, and so do whole texts that quote one of the file's
    added tokens, which the library finds anywhere in a text, before any other step.
    """

    plain = "^[a-zß-öø-ÿÀ-ÖØ-Þ]+[!-&(-/:-@\\[-`{-~]*$"

    def __init__(self, raw: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(raw)
        stated = json.loads(raw)
        model = stated["model"]
        self.added = "|".join(re.escape(t["content"]) for t in stated["added_tokens"])
        ids, self.suffix = model["vocab"], model["end_of_word_suffix"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        pairs = {}
        for rank, (a, b) in enumerate(merges):
            pairs.setdefault((ids[a], ids[b]), (ids[a + b], rank))
        self.table = PairTable(pairs, len(ids) + 1)
        shown = _shown_bytes()
        self.first = np.array([ids[c] for c in shown])
        self.last = np.array([ids[c + self.suffix] for c in shown])
        self.coder = SegmentCoder(self._code, CACHE)

    def _merge(self, words: pa.Array) -> list[bytes]:
        """Ids of words of Latin letters that may end in marks: the letters are one unit, the marks another."""
        words = pc.utf8_lower(words)
        sizes = pc.binary_length(words).to_numpy().astype(np.int64)
        values = np.frombuffer("".join(words.to_pylist()).encode(), np.uint8)
        letter = (values >= 97) & (values <= 122) | (values >= 128)
        last = letter & ~np.r_[letter[1:], False]
        last[np.cumsum(sizes) - 1] = True
        symbols = np.where(last, self.last[values], self.first[values])
        return cut_bytes(*merge_rounds(symbols, sizes, self.table), len(sizes))

    def _code(self, words: list[str]) -> list[bytes]:
        words = pa.array(words, pa.string())
        plain = pc.match_substring_regex(words, self.plain)
        other = words.filter(pc.invert(plain)).to_pylist()
        made = iter(self._merge(words.filter(plain)))
        rest = iter(np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(other, add_special_tokens=False))
        return [next(made if p else rest) for p in plain.to_pylist()]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of ids of each (null: none)."""
        texts = pc.fill_null(texts, "")
        quoted = np.zeros(len(texts), bool)
        if self.added:
            quoted = pc.match_substring_regex(texts, self.added, ignore_case=True).to_numpy(zero_copy_only=False)
        if not quoted.any():
            return self._encode(texts)
        whole = [np.array(e.ids, np.int64) for e in self.tokenizer.encode_batch(texts.filter(pa.array(quoted)).to_pylist(), add_special_tokens=False)]
        ids, sizes = self._encode(texts.filter(pa.array(~quoted)))
        order = np.argsort(np.r_[np.flatnonzero(~quoted), np.flatnonzero(quoted)])
        flat, sizes = np.concatenate([ids, *whole]), np.r_[sizes, list(map(len, whole))].astype(np.int64)
        starts = (np.cumsum(sizes) - sizes)[order]
        sizes = sizes[order]
        take = np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
        return flat[take].astype("<i4"), sizes

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = pc.ascii_lower(texts)
        for space in "\n\t\r":
            texts = pc.replace_substring(texts, space, " ")
        return self.coder.rows(pc.split_pattern(texts, " "))


def _shown_bytes() -> list[str]:
    """The character by which byte-level vocabularies show each byte: itself if printable, else one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in printable else next(rest)) for b in range(256)]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_column: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if wanted, ids (little-endian binary)."""
    kind = docs.schema[id_column].dataType.simpleString()
    with open(tokenizer, "rb") as f:  # a few megabytes, sent to the workers
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    end = np.array([END], "<u4").tobytes()
    wide = 4 * capacity

    def run(batches):
        coder = None
        for batch in batches:
            coder = coder or WordTokenizer(shared.value)
            texts = batch.column(1)
            for a, b in blocks(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), BLOCK):
                at, piece, start, length, crc, ids = [], [], [], [], [], []
                flat, sizes = coder.encode(texts.slice(a, b - a))
                flat, stops = flat.tobytes(), [0, *(4 * np.cumsum(sizes)).tolist()]
                for row in range(a, b):
                    coded = flat[stops[row - a] : stops[row - a + 1]] + end
                    for k, i in enumerate(range(0, len(coded), wide)):
                        part = coded[i : i + wide]
                        at.append(row)
                        piece.append(k)
                        start.append(i // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        if with_ids:
                            ids.append(part)
                columns = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(ids, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def enumerate_patterns(histogram: dict[int, int], capacity: int, most: int = PATTERNS) -> list[tuple[int, ...]]:
    """Patterns of one to three lengths that fill a sequence exactly, those of the commonest lengths first."""
    lengths = sorted(histogram)
    found = [(capacity,)] if capacity in histogram else []
    found += [(capacity - b, b) for b in lengths if capacity - b in histogram and 2 * b <= capacity]
    common = sorted(lengths, key=lambda x: (-histogram[x], x))[:160]
    triples = set()
    for i, b in enumerate(common):
        for c in common[i:]:
            a = capacity - b - c
            if a > 0 and a in histogram:
                triples.add(tuple(sorted((a, b, c), reverse=True)))
    weight = lambda p: min(histogram[x] / n for x, n in Counter(p).items())
    found += sorted(triples, key=lambda p: (-weight(p), p))[: max(0, most - len(found))]
    return found


def fit_counts(patterns: list[tuple[int, ...]], histogram: dict[int, int], sweeps: int = 40) -> np.ndarray:
    """Non-negative repeat counts x that minimise |A x - histogram|, by cyclic coordinate descent."""
    size = max(histogram, default=0) + 1
    rest = np.zeros(size)
    rest[list(histogram)] = list(histogram.values())
    rest = rest.tolist()
    counted = [(tuple(Counter(p).items()), sum(n * n for n in Counter(p).values())) for p in patterns]
    x = [0.0] * len(patterns)
    for _ in range(sweeps):
        moved = 0.0
        for j, (cells, square) in enumerate(counted):
            step = sum(n * rest[v] for v, n in cells) / square
            step = max(step, -x[j])
            if step:
                x[j] += step
                moved = max(moved, abs(step))
                for v, n in cells:
                    rest[v] -= n * step
        if moved < 0.5:
            break
    return np.array(x)


def plan_sequences(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, tuple[int, ...]]]:
    """(repeats, lengths) of sequences that hold the whole histogram."""
    left, plan = dict(histogram), []
    patterns = enumerate_patterns(left, capacity)
    for p, x in sorted(zip(patterns, fit_counts(patterns, left), strict=True), key=lambda y: -y[1]):
        need = Counter(p)
        n = min(int(x), *(left[v] // k for v, k in need.items()))
        if n > 0:
            plan.append((n, p))
            for v, k in need.items():
                left[v] -= n * k
    # Best-fit decreasing of the residual, on bins of equal content: a run of equal bins is one entry.
    open_bins: dict[int, list[tuple[int, tuple[int, ...]]]] = defaultdict(list)
    room: list[int] = []
    for length in sorted((v for v, n in left.items() if n > 0), reverse=True):
        n = left[length]
        while n:
            i = bisect.bisect_left(room, length)
            if i < len(room):
                free = room[i]
                have, content = open_bins[free].pop()
                if not open_bins[free]:
                    del open_bins[free], room[i]
                used = min(n, have)
                if used < have:
                    if free not in open_bins:
                        bisect.insort(room, free)
                    open_bins[free].append((have - used, content))
            else:
                free, content, each = capacity, (), max(1, capacity // length)
                # New bins take as many of this length as fit, as best-fit would give them one by one.
                full, rest = divmod(n, each)
                if full and each > 1:
                    used, packed = full, (length,) * each
                    left_room = capacity - length * each
                    if left_room:
                        if left_room not in open_bins:
                            bisect.insort(room, left_room)
                        open_bins[left_room].append((used, packed))
                    else:
                        plan.append((used, packed))
                    n = rest
                    continue
                used = n if each == 1 else 1
            free -= length
            content = (*content, length)
            if free:
                if free not in open_bins:
                    bisect.insort(room, free)
                open_bins[free].append((used, content))
            else:
                plan.append((used, content))
            n -= used
    plan += [b for bins in open_bins.values() for b in bins]
    return plan


def place_table(plan: list[tuple[int, tuple[int, ...]]]) -> np.ndarray:
    """Rows (length, first rank, repeats, times, first sequence, offset): where the ranks of a length go."""
    used: Counter = Counter()
    rows, sequence = [], 0
    for repeats, lengths in plan:
        offset = 0
        for length, times in Counter(lengths).items():
            rows.append((length, used[length], repeats, times, sequence, offset))
            used[length] += repeats * times
            offset += length * times
        sequence += repeats
    return np.array(sorted(rows), np.int64).reshape(-1, 6)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, piece, length, ...). ``pieces`` is read more than once."""
    spark = pieces.sparkSession
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    places = place_table(plan_sequences(histogram, capacity))
    shared = spark.sparkContext.broadcast(places)

    def find(batches):
        rows = shared.value
        keys = rows[:, 0] * (1 << 44) + rows[:, 1]
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "_rank"))
            at = rows[np.searchsorted(keys, length * (1 << 44) + rank, side="right") - 1]
            turn, lap = (rank - at[:, 1]) % at[:, 2], (rank - at[:, 1]) // at[:, 2]
            kept = [i for i, f in enumerate(batch.schema) if f.name != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in kept), pa.array(at[:, 4] + turn), pa.array(at[:, 5] + lap * length)],
                [*(batch.schema.field(i).name for i in kept), "sequence_id", "offset"],
            )

    order = [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")]
    ranked = gapless_rank(pieces, ["length"], F.struct("doc_id", "piece"), order, "_rank")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "_rank")
    return ranked.mapInArrow(find, schema + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokenize and pack ``docs``: one row per piece with its sequence and its offset there."""
    return pack(table(token_pieces(docs, tokenizer, capacity, id_column, text), "pieces"), capacity)


def sequences(docs: DataFrame, packed: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (array), and doc_ids and lengths in order.

    doc_id must be unique here. A sequence gathers at most ``capacity`` ids.
    """
    pieces = token_pieces(docs, tokenizer, capacity, with_ids=True).select("doc_id", "piece", "ids")
    def decode(batches):
        for batch in batches:
            ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "piece", "ids"])

    kind = pieces.schema["doc_id"].dataType.simpleString()
    plain = pieces.mapInArrow(decode, f"doc_id {kind}, piece int, ids array<int>")
    parts = packed.join(plain, ["doc_id", "piece"]).groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "length", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"), F.col("parts.length").alias("lengths"))
