"""Periodic runs in texts: block convolution by number-theoretic transforms, extended from where blocks occur again.

A run is a longest stretch of consecutive words in which words ``period`` apart are identical, for its
smallest period, of at least ``exponent`` periods and ``least`` words. At the scale of B words (8, 16, 32 ...)
texts are cut into blocks of B, and the sums of squared differences between a block and all windows that begin
B to 2B words later (1 to 2B at the first scale) come from one transform of each block in the integers modulo
a prime: a block occurs at a distance where its sum is zero. A run of period B to 2B holds a whole block and
its next occurrence, so no run is missed; a zero is a seed only, which extension word by word confirms. Blocks with
a word that does not come again within 2B words can't occur again and are left out before the transform.
Seeds inside a run of which their distance is a multiple say nothing new and are dropped.

Texts of an Arrow batch are handled one after the other in one array (their words are told apart by text), so
a batch costs as much as its words, and memory is bounded by a block of texts or the longest text.

Words are `[^\\x20\\x09-\\x0D]+`. Defined results: a null or empty text, or one without words, has no runs,
no words and an empty collapsed text. Rows with null or repeated ids are rows like others, and equal texts get equal
results; an empty table gives an empty result. Extra columns are kept; those with the names of the results
are replaced.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .merges import blocks

#: Least words of a run, and least periods.
LEAST, EXPONENT = 24, 3
#: Words of a block at the first scale: runs of LEAST words and EXPONENT periods hold a whole block and the next occurrence.
FIRST = 8
#: Bytes of text that are handled at a time, and places of a batch of transforms.
BLOCK, PLACES = 4 << 20, 1 << 17

# A prime with roots of unity of every power of two up to 2^30, and a generator of its residues.
PRIME, GENERATOR = 3 * 2**30 + 1, 5
_P, _32 = np.uint64(PRIME), np.uint64(32)
_roots: dict[tuple[int, bool], tuple[np.ndarray, np.ndarray]] = {}


def _powers(half: int, inverse: bool) -> tuple[np.ndarray, np.ndarray]:
    """The first ``half`` powers of a root of unity of order 2 half, and their quotients for the multiplication."""
    if (half, inverse) not in _roots:
        root = pow(GENERATOR, (PRIME - 1) // (2 * half), PRIME)
        root = pow(root, -1, PRIME) if inverse else root
        w = np.ones(1, np.uint64)
        while len(w) < half:
            w = np.concatenate([w, w * np.uint64(pow(root, len(w), PRIME)) % _P])
        made = w, (w << _32) // _P
        if half > PLACES:
            return made
        _roots[half, inverse] = made
    return _roots[half, inverse]


def _times(x: np.ndarray, w: np.ndarray, quotient: np.ndarray) -> np.ndarray:
    """x w modulo the prime, with the quotient of w by the prime times 2^32 known beforehand."""
    r = x * w - (x * quotient >> _32) * _P
    return np.minimum(r, r - _P)


def transform(x: np.ndarray) -> np.ndarray:
    """Transforms of the rows of x (below the prime; a power of two wide); results are in bit-reversed order."""
    rows, size = x.shape
    x = x.copy()
    half = size // 2
    while half:
        pair = x.reshape(rows, -1, 2, half)
        a, b = pair[:, :, 0], pair[:, :, 1]
        total, apart = a + b, a + (_P - b)
        pair[:, :, 0] = np.minimum(total, total - _P)
        pair[:, :, 1] = _times(np.minimum(apart, apart - _P), *_powers(half, False)) if half > 1 else np.minimum(apart, apart - _P)
        half //= 2
    return x


def inverse(x: np.ndarray) -> np.ndarray:
    """What ``transform`` made each row from, times the width."""
    rows, size = x.shape
    x = x.copy()
    half = 1
    while half < size:
        pair = x.reshape(rows, -1, 2, half)
        a, b = pair[:, :, 0], pair[:, :, 1]
        b = _times(b, *_powers(half, True)) if half > 1 else b
        total, apart = a + b, a + (_P - b)
        pair[:, :, 0], pair[:, :, 1] = np.minimum(total, total - _P), np.minimum(apart, apart - _P)
        half *= 2
    return x


def _opposite(size: int) -> np.ndarray:
    """Where the transform at the negated frequency lies, in bit-reversed order."""
    at = np.arange(size)
    top = 1 << (np.maximum(at, 1).astype(np.float64).view(np.int64) >> 52) - 1023
    return np.where(at > 1, 3 * top - 1 - at, at)


def block_matches(codes: np.ndarray, chosen: np.ndarray, size: int, near: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(start, distance) where the chosen blocks of ``size`` codes occur ``size`` to 2 size places on (near: 1 to size).

    Zeros are taken modulo the prime: every occurrence is given, and with a chance of about 1/PRIME a place that is none.
    """
    value = np.zeros((len(codes) // size + 4) * size, np.uint64)
    value[: len(codes)] = codes
    squares = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value * value % _P)])
    opposite = _opposite(2 * size)
    twice = np.uint64(2 * pow(2 * size, -1, PRIME) % PRIME)
    quotient = (twice << _32) // _P
    starts, distances = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    shift = 0 if near else 1
    step = max(1, PLACES // (2 * size))
    for i in range(0, len(chosen), step):
        own = chosen[i : i + step]
        needed, where = np.unique(np.concatenate([own, own + shift, own + shift + 1]), return_inverse=True)
        padded = np.zeros((len(needed), 2 * size), np.uint64)
        padded[:, :size] = value.reshape(-1, size)[needed]
        spectra = transform(padded)
        block, first, second = (spectra[w] for w in where.reshape(3, -1))
        low = first[:, :size] + second[:, :size]
        high = first[:, size:] + (_P - second[:, size:])
        window = np.concatenate([np.minimum(low, low - _P), np.minimum(high, high - _P)], axis=1)
        product = _times(inverse(block[:, opposite] * window % _P)[:, : size + 1], twice, quotient)
        begin = (own * size)[:, None]
        at = begin + shift * size + np.arange(size + 1)[None, :]
        sums = (squares[begin + size] - squares[begin]) + (squares[at + size] - squares[at])
        row, e = np.nonzero(sums % _P == product)
        starts.append(own[row] * size)
        distances.append(e + shift * size)
    start, distance = np.concatenate(starts), np.concatenate(distances)
    return start[distance > 0], distance[distance > 0]


def _agreement(codes: np.ndarray, begin: int, end: int, distance: int, limit: int, forward: bool) -> int:
    """How far codes ``distance`` apart agree onwards from ``end`` (or back from ``begin``), up to the limit."""
    done, step = 0, 64
    while True:
        if forward:
            a = codes[end + done : min(end + done + step, limit - distance)]
            differs = a != codes[end + done + distance : end + done + distance + len(a)]
        else:
            low = max(limit, begin - done - step)
            a = codes[low : begin - done][::-1]
            differs = a != codes[low + distance : begin - done + distance][::-1]
        if differs.any():
            return done + int(np.argmax(differs))
        done += len(a)
        if len(a) < step:
            return done
        step *= 2


def find_runs(codes: np.ndarray, counts: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of all runs of each text, by start and period.

    ``codes`` holds the words of all texts one after the other; equal codes mean equal words of the same text.
    """
    ends = np.cumsum(counts)
    found: list[dict[int, tuple[list[int], list[int]]]] = [{} for _ in counts]  # of each text, by period: starts and ends
    n = len(codes)
    if n:
        order = np.argsort(codes, kind="stable")
        again = np.full(n, n, np.int64)
        same = codes[order[1:]] == codes[order[:-1]]
        again[order[:-1][same]] = np.diff(order)[same]
        size, longest = FIRST, int(counts.max())
        while exponent * size <= longest or size == FIRST:
            whole = n // size
            chosen = np.flatnonzero(again[: whole * size].reshape(whole, size).max(axis=1, initial=0) <= 2 * size)
            start, distance = block_matches(codes, chosen, size)
            if size == FIRST:
                near = block_matches(codes, chosen, size, near=True)
                start, distance = np.concatenate([start, near[0]]), np.concatenate([distance, near[1]])
            text = np.searchsorted(ends, start, side="right")
            order = np.lexsort((start, distance, text))
            text, distance, start = text[order], distance[order], start[order]
            cuts = [0, *(np.flatnonzero((np.diff(text) != 0) | (np.diff(distance) != 0)) + 1).tolist(), len(start)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True) if len(start) else ():
                _extend(codes, start[a:b], size, int(distance[a]), int(ends[text[a]] - counts[text[a]]), int(ends[text[a]]), found[text[a]], exponent)
            size *= 2
    out = []
    for runs, end, count in zip(found, ends.tolist(), counts.tolist(), strict=True):
        begin = end - count
        rows = [(a - begin, b - a, period) for period, (starts, stops) in runs.items() for a, b in zip(starts, stops, strict=True) if b - a >= least]
        out.append(sorted(rows, key=lambda r: (r[0], r[2])))
    return out


def _extend(codes: np.ndarray, seeds: np.ndarray, size: int, distance: int, low: int, high: int, runs: dict, exponent: int) -> None:
    """Extend blocks that occur again at ``distance`` in the text from low to high, and keep what is long enough."""
    for period, (starts, stops) in runs.items():
        if distance % period == 0 and len(seeds):
            at = np.searchsorted(starts, seeds, side="right") - 1
            seeds = seeds[(at < 0) | (seeds + distance + size > np.asarray(stops)[at])]
    reached = -1
    for s in seeds.tolist():
        if s + size <= reached:
            continue
        if s < low or s + distance + size > high or (codes[s : s + size] != codes[s + distance : s + distance + size]).any():
            continue
        a = s - _agreement(codes, s, s + size, distance, low, False)
        reached = s + size + _agreement(codes, s, s + size, distance, high, True)
        if reached + distance - a >= exponent * distance:
            starts, stops = runs.setdefault(distance, ([], []))
            at = bisect_right(starts, a)
            if not at or starts[at - 1] != a:
                starts.insert(at, a)
                stops.insert(at, reached + distance)


def _strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest exact length / period; ties: the smallest start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def periodic_runs(docs: DataFrame, text: str = "text", least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """The columns of docs with n_words, runs (start, length, period), strongest run, and the collapsed text.

    A collapsed text is its words joined by single spaces, without those that a run holds beyond its first period.
    """
    if exponent < EXPONENT or least < LEAST:
        raise ValueError(f"runs of at least {LEAST} words and {EXPONENT} periods are found")
    made = ("n_words", "runs", "strongest", "collapsed")
    kept = [c for c in docs.columns if c not in made]
    source = docs.select(*[f"`{c}`" for c in kept], docs[f"`{text}`"].cast("string").alias("_whole"))
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = pc.fill_null(batch.column(len(kept)), "").cast(pa.binary()).to_pylist()
        words, codes, counts = [], [], []
        base = 0
        for t in texts:
            own = t.split()  # bytes are split at \x20 and \x09-\x0D
            known = dict.fromkeys(own)
            known = dict(zip(known, range(base, base + len(known)), strict=True))
            codes.extend(map(known.__getitem__, own))
            base += len(known)
            words.append(own)
            counts.append(len(own))
        runs = find_runs(np.array(codes, np.int64), np.array(counts, np.int64), least, exponent)
        collapsed = []
        for own, rows in zip(words, runs, strict=True):
            if rows:
                keep = np.ones(len(own), bool)
                for start, length, period in rows:
                    keep[start + period : start + length] = False
                own = [w for w, k in zip(own, keep.tolist(), strict=True) if k]
            collapsed.append(b" ".join(own))
        cells = lambda r: dict(zip(("start", "length", "period"), r, strict=True))
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(counts, pa.int64()), pa.array([[cells(r) for r in rows] for rows in runs], pa.list_(run)), pa.array([(b := _strongest(rows)) and cells(b) for rows in runs], run), pa.array(collapsed, pa.binary()).cast(pa.string())],
            names=[*kept, *made],
        )

    def work(batches):
        for batch in batches:
            for a, b in blocks(pc.fill_null(pc.binary_length(batch.column(len(kept))), 0).to_pylist(), BLOCK):
                yield one(batch.slice(a, b - a))

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != "_whole")
    shape = "struct<start:long,length:long,period:long>"
    return source.mapInArrow(work, f"{types}{', ' if types else ''}n_words long, runs array<{shape}>, strongest {shape}, collapsed string")
