"""Vectorised merge rounds for byte-pair vocabularies, and coding of whole blocks of texts by their segments."""

from __future__ import annotations

import gc
import heapq
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash


class PairTable:
    """Which pairs of symbols merge: the symbol each makes, and its rank (lower merges first)."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]], width: int):
        keys = np.array([a * width + b for a, b in pairs], np.int64)
        order = np.argsort(keys)
        values = np.array(list(pairs.values()), np.int64).reshape(-1, 2)[order]
        self.width, self.keys, self.made, self.rank = width, keys[order], values[:, 0], np.r_[values[:, 1], np.iinfo(np.int64).max]
        # Ranks whose pairs can't all merge at once: a pair with a symbol that they make may come before them.
        soonest = np.full(width, self.rank[-1])
        for part in (self.keys // width, self.keys % width):
            np.minimum.at(soonest, part, values[:, 1])
        self.early = set(np.unique(values[soonest[values[:, 0]] <= values[:, 1], 1]).tolist())

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Row of each pair in the table, -1 if the pair does not merge. Negative symbols never merge."""
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), at, -1)


#: Symbols from which a segment is merged on its own.
LONG = 2000


def merge_long(symbols: np.ndarray, table: PairTable) -> np.ndarray:
    """Merge one long segment: a round merges all non-overlapping pairs of the least rank, from the left.

    Places wait by rank and symbols are linked, so a round costs what it merges and not the whole segment.
    Where a merge brings forth a pair that comes before the rest, the round ends with it.
    """
    n = len(symbols)
    symbols = np.r_[symbols, -1]  # the end, which never merges
    after, before = np.arange(1, n + 2), np.arange(-1, n)
    row = np.full(n + 1, -1, np.int64)
    row[: n - 1] = table.find(symbols[: n - 1], symbols[1:n])
    waiting: dict[int, list[np.ndarray]] = {}
    ranks: list[int] = []

    def add(places: np.ndarray) -> None:
        places = places[row[places] >= 0]
        rank = table.rank[row[places]]
        order = np.argsort(rank, kind="stable")
        rank, places = rank[order], places[order]
        starts = np.flatnonzero(np.r_[True, rank[1:] != rank[:-1]]) if len(rank) else []
        for r, part in zip(rank[starts].tolist() if len(rank) else (), np.split(places, starts[1:]) if len(rank) else (), strict=True):
            if r not in waiting:
                waiting[r] = []
                heapq.heappush(ranks, r)
            waiting[r].append(part)

    add(np.arange(n))
    alive = np.ones(n + 1, bool)
    while ranks:
        r = heapq.heappop(ranks)
        at = np.unique(np.concatenate(waiting.pop(r)))
        at = at[alive[at] & (table.rank[row[at]] == r)]
        if not len(at):
            continue
        # Of pairs that overlap in a run, every other one from its left.
        rest, place = at[:0], np.arange(len(at))
        begins = np.r_[True, after[at[:-1]] != at[1:]]
        at = at[(place - np.maximum.accumulate(np.where(begins, place, 0))) % 2 == 0]
        gone = after[at]
        if r in table.early:
            # Up to the first that brings forth a pair that comes before the rest.
            made, left = table.made[row[at]], before[at]
            beside = np.r_[False, gone[:-1] == left[1:]]
            sym = np.where(beside, np.r_[-1, made[:-1]], np.where(left >= 0, symbols[left], -1))
            sooner = np.minimum(table.rank[table.find(sym, made)], table.rank[table.find(made, symbols[after[gone]])]) <= r
            if sooner.any():
                n = int(np.argmax(sooner)) + 1
                at, gone, rest = at[:n], gone[:n], at[n:]
        symbols[at] = table.made[row[at]]
        alive[gone] = False
        row[gone] = -1
        after[at] = after[gone]
        before[after[at]] = at
        left = before[at]
        changed = np.unique(np.r_[at, left[left >= 0]])
        row[changed] = table.find(symbols[changed], symbols[after[changed]])
        add(np.r_[changed, rest])
    return symbols[:-1][alive[:-1]]


def merge_rounds(symbols: np.ndarray, sizes: np.ndarray, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Merge segments that lie one after the other in ``symbols``; returns their symbols and owners.

    Each round takes the least rank among the pairs of every segment, merges the leftmost such pair in all
    segments at once, and compacts the arrays; segments without a pair leave. Segments of LONG symbols or
    more are merged apart.
    """
    owner, ends = np.repeat(np.arange(len(sizes)), sizes), np.cumsum(sizes)
    done_symbols, done_owner = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i in np.flatnonzero(sizes >= LONG).tolist():
        made = merge_long(symbols[ends[i] - sizes[i] : ends[i]], table)
        done_symbols.append(made)
        done_owner.append(np.full(len(made), i))
    if len(done_owner) > 1:
        short = sizes[owner] < LONG
        symbols, owner = symbols[short], owner[short]
    pair = np.full(len(symbols), -1, np.int64)
    if len(symbols) > 1:
        same = np.flatnonzero(owner[1:] == owner[:-1])
        pair[same] = table.find(symbols[same], symbols[same + 1])
    none = table.rank[-1]
    while len(symbols):
        rank = table.rank[pair]
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        counts = np.diff(np.r_[starts, len(symbols)])
        best = np.minimum.reduceat(rank, starts)
        active = best < none
        if not active.all():
            out = np.repeat(~active, counts)
            done_symbols.append(symbols[out])
            done_owner.append(owner[out])
            symbols, owner, pair, rank = (x[~out] for x in (symbols, owner, pair, rank))
            counts, best = counts[active], best[active]
            if not len(symbols):
                break
        hit = np.flatnonzero(rank == np.repeat(best, counts))
        at = hit[np.r_[True, owner[hit[1:]] != owner[hit[:-1]]]]  # the leftmost of each segment
        symbols[at] = table.made[pair[at]]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        moved = at - np.arange(len(at))  # places after compaction: one symbol went before each
        symbols, owner, pair = symbols[keep], owner[keep], pair[keep]
        for left in (moved - 1, moved):
            left = left[left >= 0]
            right = np.minimum(left + 1, len(symbols) - 1)
            joined = (right > left) & (owner[left] == owner[right])
            pair[left] = np.where(joined, table.find(symbols[left], symbols[right]), -1)
    symbols, owner = np.concatenate(done_symbols), np.concatenate(done_owner)
    order = np.argsort(owner, kind="stable")
    return symbols[order], owner[order]


def cut_bytes(symbols: np.ndarray, owner: np.ndarray, segments: int) -> list[bytes]:
    """Little-endian 32-bit ids of each segment."""
    bounds = [0, *(4 * np.cumsum(np.bincount(owner, minlength=segments))).tolist()]
    raw = symbols.astype("<i4").tobytes()
    return [raw[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


class SegmentCoder:
    """Ids of rows of segments. A block's distinct segments are coded once, and those first met are kept for later blocks.

    Kept are at most ``keep`` segments of at most SHORT characters, so what a worker holds is bounded in bytes.
    """

    SHORT = 48

    def __init__(self, code: Callable[[list[str]], list[bytes]], keep: int):
        self.code, self.keep, self.known = code, keep, {}

    def rows(self, lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after the other, and the number of ids of each row."""
        # Nothing here makes reference cycles, and passes over many small objects cost more than they free.
        collecting = gc.isenabled()
        gc.disable()
        try:
            return self._rows(lists)
        finally:
            if collecting:
                gc.enable()

    def _rows(self, lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        offsets = lists.offsets.to_numpy()
        found = lists.flatten().dictionary_encode()
        words = found.dictionary.to_pylist()
        coded = list(map(self.known.get, words))
        missing = [i for i, c in enumerate(coded) if c is None]
        for start in range(0, len(missing), 50_000):
            part = missing[start : start + 50_000]
            new = [words[i] for i in part]
            made = self.code(new)
            for i, ids in zip(part, made, strict=True):
                coded[i] = ids
            if len(self.known) < self.keep:
                self.known.update((w, ids) for w, ids in zip(new, made, strict=True) if len(w) <= self.SHORT)
        sizes = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        ids = np.frombuffer(b"".join(coded), "<i4")
        index = found.indices.to_numpy()
        counts = sizes[index]
        ends = np.r_[0, np.cumsum(counts)]
        take = np.repeat((np.cumsum(sizes) - sizes)[index] - ends[:-1], counts)
        take += np.arange(ends[-1])
        return ids[take], np.diff(ends[offsets - offsets[0]])


def blocks(sizes, most: int):
    """(start, end) of runs of rows whose sizes sum to about ``most``; what a run took is given back before the next."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        total += n
        if total >= most:
            yield start, i + 1
            start, total = i + 1, 0
            pa.default_memory_pool().release_unused()
    if start < len(sizes):
        yield start, len(sizes)
        pa.default_memory_pool().release_unused()


#: Bytes of text whose words are hashed at a time.
SPAN = 1 << 18
_FACTOR = 0x9E3779B97F4A7C15F39CC0605CEDC835 % (1 << 64)  # odd, so it has an inverse
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)])
_EACH_BYTE = np.random.default_rng(20_241_128).integers(0, 1 << 64, 256, dtype=np.uint64)
_OF_BYTE = _EACH_BYTE[_LOWER]
_IS_SPACE = np.isin(np.arange(256), (32, *range(9, 14)))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_table(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the factor and of its inverse modulo 2^64; those of the usual size are kept."""
    if size not in _powers:
        made = tuple(np.cumprod(np.r_[np.uint64(1), np.full(size, f, np.uint64)]) for f in (np.uint64(_FACTOR), np.uint64(pow(_FACTOR, -1, 1 << 64))))
        if size != SPAN:
            return made
        _powers[size] = made
    return _powers[size]


def word_codes(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The number of words `[^\\x20\\x09-\\x0D]+` of each text (null: none), and the 64-bit hash of each word, A-Z as a-z.

    A word's hash is a sum of random values of its bytes times powers of a factor, taken as a difference of
    running sums over the text, and scrambled. Without ``lower``, A-Z and a-z differ.
    """
    values = _OF_BYTE if lower else _EACH_BYTE
    texts = pc.fill_null(texts, "")
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    offsets -= offsets[0]
    apart = np.ones(len(data) + 1, bool)  # whether a word can't go on at a byte
    apart[1:-1] = _IS_SPACE[data[:-1]]
    apart[offsets] = True
    inside = ~_IS_SPACE[data]
    starts = np.flatnonzero(inside & apart[:-1])
    stop = np.r_[_IS_SPACE[data[1:]], True] if len(data) else np.zeros(0, bool)
    stop |= apart[1:]
    ends = np.flatnonzero(inside & stop) + 1
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        begin = starts[at]
        upto = max(at + 1, int(np.searchsorted(ends, begin + SPAN, side="right")))
        size = int(ends[upto - 1] - begin)
        up, down = _power_table(SPAN if size <= SPAN else size)
        total = np.zeros(size + 1, np.uint64)
        np.cumsum(values[data[begin : begin + size]] * up[:size], out=total[1:])
        s, e = starts[at:upto] - begin, ends[at:upto] - begin
        out[at:upto] = mix((total[e] - total[s]) * down[s])
        at = upto
    return np.diff(np.searchsorted(starts, offsets)), out


def word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hash of each word."""
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.cast(pa.binary()).to_pylist()), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
