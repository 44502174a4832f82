"""Language identification by compression: the dictionary that shortens a text most names its language.

For each language a raw-content zstandard dictionary is made of training sentences. A text is reduced to
lower-case letters and single spaces and cut into pieces of PIECE bytes, each piece is compressed with
every dictionary, and the sums are compared; pieces keep a dictionary's help the same at the end of a long
text as at its start. The whole text counts. A
text whose best sum is not smaller than the second by MIN_MARGIN of it is rejected as uncertain.

The training sample is bounded: of each language about SAMPLE texts, a share of its distinct texts by their hash, and
of a text longer than LONGEST characters a passage of that length, from a place that its hash picks; copies of
a text count once. The languages are taken to be a few hundred at most.

Defined results: a null text, or one without any letter, is ``und`` with score 0 and rejected; without any
labelled training row every text is. Ties go to the language that sorts first. Training rows with null text or
language are left out. A language none of whose sentences is clean keeps those it has; one without any
letter has no dictionary and competes with plain compression. Equal texts get equal results. Extra columns
are kept, those with the names of the results replaced.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .merges import blocks

SAMPLE = 300
#: Most languages that are sent to all tasks.
FEW = 100_000
LONGEST = 4000
#: Bytes of each dictionary.
DICTIONARY = 48 << 10
PIECE = 4096
#: Shorter sentences are not judged when dictionaries are cleaned.
SHORT = 12
MIN_MARGIN = 0.002
#: ASCII marks and digits become spaces.
_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
_SENTENCE = re.compile(r"(?<=[.!?]) |\n")
UNKNOWN = "und"
BLOCK = 4 << 20


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """The dictionary of each language, from a bounded sample of labelled texts."""
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")
    rows = rows.where("text <> ''")
    # Distinct texts are counted, and the share of them that is wanted is taken by their hash, so copies count once.
    counts = table(rows.select("lang", F.xxhash64("text").alias("h")).distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    # Few languages are sent to where the texts lie; of very many values the texts go to them.
    counts = F.broadcast(counts) if counts.count() <= FEW else counts
    share = F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < F.lit(1e6 * SAMPLE) / F.col("n")
    over = F.length("text") - LONGEST
    passage = F.when(over <= 0, F.col("text")).otherwise(F.substring("text", F.pmod(F.xxhash64("text", F.lit(1)), F.greatest(over, F.lit(1))).cast("int") + 1, F.lit(LONGEST)))
    texts: dict[str, dict[int, str]] = {}
    for r in rows.join(counts, "lang").where(share).select("lang", F.xxhash64("text").alias("h"), passage.alias("text")).groupBy("lang", "h").agg(F.min("text").alias("text")).collect():
        texts.setdefault(r["lang"], {})[r["h"]] = r["text"]
    return build(texts)


def build(texts: dict[str, dict[int, str]]) -> dict[str, bytes]:
    """Dictionaries from sample texts by language and hash.

    Sentences that occur twice in the sample (boilerplate, quoted passages) are left out; then, with
    dictionaries of what remains, sentences that another language's dictionary shortens more are too. A
    language that would be left without any keeps what it had.
    """
    given = {name: [s for _, t in sorted(texts[name].items()) for s in _SENTENCE.split(t.lower()) if s] for name in sorted(texts)}
    times = Counter(s for found in given.values() for s in found)
    pieces = {name: _some([s for s in found if times[s] == 1 or len(s) < SHORT], found) for name, found in given.items()}
    if len(pieces) > 1:
        judge = Compressors(_joined(pieces))
        for own, name in enumerate(judge.names):
            pieces[name] = _some([s for s in pieces[name] if len(s) < SHORT or _own_is_least(judge.sizes(s), own)], pieces[name])
    return _joined(pieces)


def _some(clean: list[str], all_of_them: list[str]) -> list[str]:
    """The clean sentences, or all where none of the clean ones has a letter."""
    return clean if any(map(plain_bytes, clean)) else all_of_them


def _own_is_least(sizes: list[int], own: int) -> bool:
    return sizes[own] <= min(sizes)


def _joined(pieces: dict[str, list[str]]) -> dict[str, bytes]:
    made = {}
    for name, found in pieces.items():
        joined, size = [], 0
        for s in found:
            raw = plain_bytes(s)
            if size + len(raw) < DICTIONARY:
                joined.append(raw)
                size += len(raw) + 1
        made[name] = b" ".join(joined)
    return made


def plain_bytes(text: str) -> bytes:
    """The text in lower case, with runs of ASCII marks, digits and white space as one space."""
    return b" ".join(text.lower().encode().translate(_LETTERS).split())


class Compressors:
    def __init__(self, dictionaries: dict[str, bytes]):
        import zstandard

        self.names, self.coders = sorted(dictionaries), []
        # Greedy search for matches of three bytes on; frames without sizes, sums or ids.
        how = zstandard.ZstdCompressionParameters(
            window_log=18, hash_log=17, chain_log=17, search_log=4, min_match=3, strategy=zstandard.STRATEGY_GREEDY, write_content_size=0, write_checksum=0, write_dict_id=0
        )
        for name in self.names:
            if not dictionaries[name]:
                self.coders.append(zstandard.ZstdCompressor(compression_params=how))
                continue
            d = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=how)
            self.coders.append(zstandard.ZstdCompressor(dict_data=d, compression_params=how))

    def sizes(self, text: str) -> list[int]:
        raw = plain_bytes(text)
        parts = [raw[i : i + PIECE] for i in range(0, len(raw), PIECE)]
        return [sum(len(c.compress(p)) for p in parts) for c in self.coders]

    def judge(self, text: str | None) -> tuple[str, float, bool]:
        """Language, margin of the best sum to the second as a share of the second, and whether it is rejected."""
        if not text or not self.names or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        sizes = self.sizes(text)
        best = int(np.argmin(sizes))
        if len(sizes) == 1:
            return self.names[0], 1.0, False
        second = min(s for i, s in enumerate(sizes) if i != best)
        margin = (second - sizes[best]) / second
        return self.names[best], margin, margin < MIN_MARGIN


def identify(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text") -> DataFrame:
    """Add lang_pred, score (the margin, 0 to 1) and rejected to each row."""
    results = "lang_pred string, score double, rejected boolean"
    names = [x.split()[0] for x in results.split(", ")]
    kept = [c for c in docs.columns if c not in names]
    source = docs.select(*kept)
    at = kept.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def run(batches):
        judge = None
        for batch in batches:
            judge = judge or Compressors(shared.value).judge
            column = batch.column(at)
            for a, b in blocks(pc.fill_null(pc.binary_length(column), 0).to_pylist(), BLOCK):
                part = batch.slice(a, b - a)
                found = [judge(t) for t in column.slice(a, b - a).to_pylist()]
                made = [pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], [*kept, *names])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema), results])
    return source.mapInArrow(run, schema)
