"""SentencePiece encoding and decoding by vectorised merge rounds.

A text is cut before each run of spaces, where no piece of the model can cross (this is checked when the
model is loaded). The distinct segments of a block of texts are then merged together on
flat numpy arrays: each round finds the best pair of every segment, merges its leftmost occurrence in all
segments at once, and drops the segments that have no pair left; very long segments are merged apart, all
occurrences of their best pair in a round. Ids of a text are those of its segments. The model file is read
on the driver and its bytes go to the workers.

Defined results: a null or empty text has no ids and decodes to the empty string; characters that the
model lacks become byte pieces. Rows are independent, so repeated rows give equal results; extra columns
are kept, those with the names of the results are replaced.
"""

from __future__ import annotations

import codecs
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .merges import PairTable, SegmentCoder, blocks, cut_bytes, merge_rounds

SPACE = "▁"
#: Segments whose ids a worker keeps.
CACHE = 200_000
#: Bytes of text that are coded at a time.
BLOCK = 5 << 20

_NORMAL, _BYTE, _CONTROL, _UNKNOWN, _USER, _UNUSED = 1, 6, 3, 2, 4, 5


class PieceModel:
    """The tables of a byte-fallback BPE model: symbols, pair merges and the bytes of each piece."""

    def __init__(self, raw: bytes):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(raw)
        spec, norm = model.trainer_spec, model.normalizer_spec
        if spec.model_type != 2 or not spec.byte_fallback or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix:
            raise ValueError("expected a BPE model with byte fallback and no normalisation")
        size = len(model.pieces)
        ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == _NORMAL}
        if any(p.type in (_USER, _UNUSED) for p in model.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        if any(SPACE in p.lstrip(SPACE) for p in ids):
            raise ValueError("a piece crosses the places where texts are cut")
        self.symbol = np.full(0x110000, -1, np.int64)
        self.bytes_of = [b""] * size
        self.byte_id = np.zeros(256, np.int64)
        for i, p in enumerate(model.pieces):
            if p.type == _NORMAL:
                self.bytes_of[i] = p.piece.replace(SPACE, " ").encode()
                if len(p.piece) == 1:
                    self.symbol[ord(p.piece)] = i
            elif p.type == _BYTE:
                self.bytes_of[i] = bytes([int(p.piece[3:5], 16)])
                self.byte_id[int(p.piece[3:5], 16)] = i
            elif p.type == _UNKNOWN:
                self.bytes_of[i] = spec.unk_surface.encode()
        self.is_byte = np.array([p.type == _BYTE for p in model.pieces])
        # The better the score of the piece that a pair makes, the lower its rank; equal scores share one.
        rank = {score: k for k, score in enumerate(sorted({model.pieces[i].score for i in ids.values()}, reverse=True))}
        pairs = {}
        for piece, i in ids.items():
            for cut in range(1, len(piece)):
                a, b = ids.get(piece[:cut]), ids.get(piece[cut:])
                if a is not None and b is not None:
                    pairs[a, b] = (i, rank[model.pieces[i].score])
        self.table = PairTable(pairs, size)

    def merge(self, segments: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each segment (spaces already written as the model's space mark)."""
        chars = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)
        symbols = self.symbol[chars]
        # A character that the model lacks is held as a negative code, which no pair has.
        symbols = np.where(symbols < 0, -chars.astype(np.int64) - 2, symbols)
        symbols, owner = merge_rounds(symbols, np.fromiter(map(len, segments), np.int64, len(segments)), self.table)
        lacking = symbols < 0
        if lacking.any():
            raw = [self.byte_id[np.frombuffer(chr(-s - 2).encode(), np.uint8)] for s in symbols[lacking].tolist()]
            times = np.ones(len(symbols), np.int64)
            times[lacking] = list(map(len, raw))
            flat = np.repeat(symbols, times)
            flat[np.repeat(lacking, times)] = np.concatenate(raw)
            symbols, owner = flat, np.repeat(owner, times)
        return cut_bytes(symbols, owner, len(segments))


class PieceCoder:
    """Encodes and decodes columns of texts."""

    cut = staticmethod(re.compile(" *[^ ]+| +").findall)

    def __init__(self, raw: bytes):
        self.model = PieceModel(raw)
        self.coder = SegmentCoder(self._code, CACHE)
        lengths = np.fromiter(map(len, self.model.bytes_of), np.int64, len(self.model.bytes_of))
        self.piece_size, self.piece_start = lengths, np.cumsum(lengths) - lengths
        self.piece_bytes = np.frombuffer(b"".join(self.model.bytes_of), np.uint8)

    def _code(self, words: list[str]) -> list[bytes]:
        """Ids of words: a word stands for itself after a space, one that begins with a mark for just what follows."""
        return self.model.merge([w[1:].replace(" ", SPACE) if w[:1] == SPACE else SPACE + w for w in words])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of ids of each (null: none)."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, f"^$|^ |  | $|{SPACE}").to_numpy(zero_copy_only=False)
        if not odd.any():
            return self.coder.rows(pc.split_pattern(texts, " "))
        # Empty texts and texts with runs of spaces are cut in Python, so that a run stays with the word that follows.
        rows = [[SPACE + s for s in self.cut(" " + t.replace(SPACE, " "))] if t else [] for t in texts.filter(pa.array(odd)).to_pylist()]
        ids, sizes = self.coder.rows(pc.split_pattern(texts.filter(pa.array(~odd)), " "))
        odd_ids, odd_sizes = self.coder.rows(pa.array(rows, pa.list_(pa.string())))
        order = np.argsort(np.r_[np.flatnonzero(~odd), np.flatnonzero(odd)])
        both, sizes = np.r_[ids, odd_ids], np.r_[sizes, odd_sizes]
        starts = (np.cumsum(sizes) - sizes)[order]
        sizes = sizes[order]
        take = np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
        return both[take], sizes

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        """Texts of flat ids that lie one text after the other, ``sizes`` ids each."""
        if not len(ids):
            return [""] * len(sizes)
        lengths = self.piece_size[ids]
        ends = np.cumsum(lengths)
        take = np.arange(ends[-1]) + np.repeat(self.piece_start[ids] - (ends - lengths), lengths)
        raw = self.piece_bytes[take].tobytes()
        last = np.cumsum(sizes)
        cuts = np.r_[0, np.where(last > 0, ends[np.maximum(last, 1) - 1], 0)].tolist()
        first = ids[np.minimum(last - sizes, len(ids) - 1)]
        # The mark that encoding put before the text goes; a byte that is no character becomes one mark each.
        drop = (sizes > 0) & (self.piece_size[first] > 0) & (self.piece_bytes[np.minimum(self.piece_start[first], len(self.piece_bytes) - 1)] == 32) & ~self.model.is_byte[first]
        return [_text(raw[a + d : b]) for a, b, d in zip(cuts[:-1], cuts[1:], drop.tolist(), strict=True)]


# A byte that is no part of a character becomes one mark, and decoding goes on with the next byte.
codecs.register_error("one-mark-a-byte", lambda e: ("\ufffd", e.start + 1))


def _text(raw: bytes) -> str:
    return raw.decode("utf-8", "one-mark-a-byte")


def _lists(ids: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(ids.astype(np.int32)))


def _mapped(df: DataFrame, results: str, make) -> DataFrame:
    """mapInArrow that keeps the columns of df but those it replaces."""
    names = [x.split()[0] for x in results.split(", ")]
    kept = df.select(*[c for c in df.columns if c not in names], *[F.col(c).alias(f"_in_{c}") for c in df.columns if c in names])
    plain = [f for f in kept.schema if not f.name.startswith("_in_")]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in plain), results])
    return kept.mapInArrow(make(names, [f.name for f in plain]), schema)


def _shared(df: DataFrame, path: str):
    """The bytes of a model file (about half a megabyte), broadcast."""
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(df: DataFrame, model: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the ids of each text as array<int>; ``model`` is the path of the model file."""
    shared = _shared(df, model)

    def make(names, plain):
        def run(batches):
            coder = None
            for batch in batches:
                coder = coder or PieceCoder(shared.value)
                texts = batch.column(batch.schema.get_field_index(text))
                for a, b in blocks(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), BLOCK):
                    part = batch.slice(a, b - a)
                    yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in plain), _lists(*coder.encode(texts.slice(a, b - a)))], [*plain, ids])

        return run

    return _mapped(df, f"{ids} array<int>", make)


def decode(df: DataFrame, model: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text that each list of ids stands for (null ids: the empty string)."""
    shared = _shared(df, model)

    def make(names, plain):
        def run(batches):
            coder = None
            for batch in batches:
                coder = coder or PieceCoder(shared.value)
                lists = batch.column(batch.schema.get_field_index(ids))
                sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64) if lists.null_count == 0 else np.array([len(x or ()) for x in lists.to_pylist()], np.int64)
                for a, b in blocks((sizes * 4).tolist(), BLOCK):
                    part = batch.slice(a, b - a)
                    flat = part.column(part.schema.get_field_index(ids)).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in plain), pa.array(coder.decode(flat, sizes[a:b]), pa.string())], [*plain, text])

        return run

    return _mapped(df, f"{text} string", make)
