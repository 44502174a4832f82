"""Substring deduplication, periodic runs and hard negatives against plain Python."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import negatives, periodic, queries, repeats

DOCS = "doc_id long, text string"


def sha(x: str) -> str:
    return hashlib.sha256(x.encode()).hexdigest()


def brute_repeats(rows, size):
    """(id, words, removed, kept) of each row by a dictionary of all windows."""
    first = {}
    for doc, text in rows:
        words = (text or "").encode().split()
        for i in range(len(words) - size + 1):
            if doc is not None:
                key = tuple(words[i : i + size])
                first[key] = min(first.get(key, (doc, i)), (doc, i))
    out = []
    for doc, text in rows:
        words = (text or "").encode().split()
        keep = [True] * len(words)
        for i in range(len(words) - size + 1):
            if doc is not None and first[tuple(words[i : i + size])] < (doc, i):
                keep[i : i + size] = [False] * size
        kept = b" ".join(w for w, k in zip(words, keep, strict=True) if k).decode()
        out.append((doc, len(words), keep.count(False), kept))
    return sorted(out, key=repr)


def noisy_rows(seed, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(15, 90))] for _ in range(6)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 5)):
            kind = rng.random()
            if kind < 0.4:
                part = rng.choice(passages)
                a = rng.randint(0, len(part) - 1)
                words += part[a : a + rng.randint(1, 90)]
            elif kind < 0.5:
                unit = rng.sample(vocabulary, rng.randint(1, 5))
                words += unit * rng.randint(1, 20)
            else:
                words += [rng.choice(vocabulary) for _ in range(rng.randint(1, 60))]
        if rows and rng.random() < 0.2:
            words = (rng.choice(rows)[1] or "").split(" ")
            if words and rng.random() < 0.5:
                words[rng.randrange(len(words))] = "odd"
        rows.append((i * 3 + 1, rng.choice([" ", "\n", " \t "]).join(words)))
    return rows


@pytest.mark.parametrize(("size", "mini", "seed"), [(20, 8, 1), (20, 8, 2), (5, 2, 3)])
def test_repeats_equal_a_dictionary_of_windows(spark, size, mini, seed):
    rows = noisy_rows(seed)
    made = repeats.remove_repeats(spark.createDataFrame(rows, DOCS).repartition(5), words=size, mini=mini)
    assert sorted(map(tuple, made.collect()), key=repr) == brute_repeats(rows, size)


def test_repeats_slices_of_long_texts(spark, monkeypatch):
    rows = noisy_rows(4, 20)
    counts = np.array([len((t or "").split()) for _, t in rows])
    hashes = np.random.default_rng(5).integers(0, 40, counts.sum()).astype(np.uint64)
    every = lambda: [set(zip(t.tolist(), (s + 0).tolist(), n.tolist(), strict=True)) for t, s, n, *_ in repeats.find_chunks(counts, hashes, 6, 3)]
    windows = lambda chunks: sorted((t, s + k) for c in chunks for t, s, n in c for k in range(n))
    whole = windows(every())
    monkeypatch.setattr(repeats, "SLICE", 100)
    assert windows(every()) == whole == sorted((t, s) for t, n in enumerate(counts.tolist()) for s in range(n - 5))


def test_repeats_odd_rows(spark):
    text = " ".join(f"x{i}" for i in range(30))
    rows = [(1, None), (2, ""), (3, " \n "), (4, "too short"), (None, text), (7, text), (7, text), (7, "y " + text), (9, text + " " + text)]
    made = repeats.remove_repeats(spark.createDataFrame([(d, t, 1) for d, t in rows], DOCS + ", kept int"))
    assert sorted(map(tuple, made.collect()), key=repr) == brute_repeats(rows, 20)
    assert repeats.remove_repeats(spark.createDataFrame([], DOCS)).count() == 0


def test_repeats_spans_name_their_source(spark):
    passage = [f"p{i}" for i in range(60)]
    rows = [(1, " ".join(["a", "b", *passage, "c"])), (2, " ".join(["d", *passage, "e"])), (3, " ".join(["f", *passage[:40]]))]
    spans = repeats.repeated_spans(spark.createDataFrame(rows, DOCS)).collect()
    found = {(s["doc"], s["start"], s["windows"], s["source"], s["source_start"], s["occurrences"]) for s in spans if not s["first"]}
    # The windows that three documents share and those that two share are paths of their own.
    assert found == {(2, 1, 21, 1, 2, 3), (2, 22, 20, 1, 23, 2), (3, 1, 21, 1, 2, 3)}
    assert all(s["whole"] for s in spans)


def test_repeats_of_a_group_of_copies(spark):
    text = " ".join(f"w{i % 97}x{i % 89}" for i in range(300))
    rows = [(i, text if i % 3 else text.replace("w5x5", f"new{i}")) for i in range(200)]
    made = repeats.remove_repeats(spark.createDataFrame(rows, DOCS).repartition(7))
    assert sorted(map(tuple, made.collect()), key=repr) == brute_repeats(rows, 20)


def test_repeats_query(spark, tmp_path):
    rows = noisy_rows(6)
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    made = queries.op11_repeats(spark, str(tmp_path)).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, made), key=repr) == sorted(((d, n, g, sha(k)) for d, n, g, k in brute_repeats(rows, 20)), key=repr)


def brute_runs(words, least=24, exponent=3):
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            a = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i > a and i + q - a >= max(least, exponent * q):
                found.setdefault((a, i + q), q)
            i += 1
    return sorted(((a, e - a, q) for (a, e), q in found.items()), key=lambda r: (r[0], r[2]))


def periodic_text(rng):
    words = []
    while rng.random() < 0.85:
        kind = rng.random()
        if kind < 0.3:
            words += [rng.randint(0, 3) for _ in range(rng.randint(1, 30))]
        elif kind < 0.9:
            unit = [rng.randint(0, rng.choice([1, 2, 50])) for _ in range(rng.randint(1, rng.choice([3, 12, 70])))]
            words += [unit[i % len(unit)] for i in range(rng.randint(1, 6 * len(unit)))]
        else:
            words += range(1000, 1000 + rng.randint(1, 40))
    return [str(w) for w in words]


def test_transforms_and_block_matches():
    x = np.random.default_rng(0).integers(0, periodic.PRIME, (3, 32)).astype(np.uint64)
    back = periodic.inverse(periodic.transform(x)) * np.uint64(pow(32, -1, periodic.PRIME)) % np.uint64(periodic.PRIME)
    assert (back == x).all()
    codes = np.random.default_rng(1).integers(0, 2, 400)
    start, distance = periodic.block_matches(codes, np.arange(50), 8)
    wanted = {(s, d) for s in range(0, 400, 8) for d in range(8, 17) if s + d + 8 <= 400 and (codes[s : s + 8] == codes[s + d : s + d + 8]).all()}
    assert {p for p in zip(start.tolist(), distance.tolist(), strict=True) if sum(p) + 8 <= 400} == wanted


def test_runs_equal_brute_force():
    rng = random.Random(11)
    for _ in range(80):
        texts = [periodic_text(rng) for _ in range(rng.randint(1, 5))]
        names = {}
        codes = [names.setdefault((i, w), len(names)) for i, t in enumerate(texts) for w in t]
        assert periodic.find_runs(np.array(codes, np.int64), np.array([len(t) for t in texts])) == [brute_runs(t) for t in texts]


def test_long_periods_and_one_word():
    rng = random.Random(3)
    unit = [rng.randint(0, 10**6) for _ in range(5000)]
    codes = np.array(unit * 3 + unit[:7] + [-1], np.int64)
    assert periodic.find_runs(codes - codes.min(), np.array([len(codes)])) == [[(0, 15007, 5000)]]
    assert periodic.find_runs(np.zeros(20_000, np.int64), np.array([20_000])) == [[(0, 20_000, 1)]]


def test_periodic_odd_rows(spark):
    rows = [(1, None, 0), (2, "", 0), (None, "a " * 30, 1), (3, "a b " * 15, 2), (3, "a b " * 15, 2), (4, " x\ty\n" * 12 + "z", 3)]
    made = periodic.periodic_runs(spark.createDataFrame(rows, DOCS + ", runs int")).drop("text")
    got = sorted((tuple(r) for r in made.select("doc_id", "n_words", "collapsed", F.transform("runs", lambda x: F.concat_ws(",", "x.start".replace("x.", "x.") and x["start"], x["length"], x["period"]))).collect()), key=repr)
    assert got == sorted([(1, 0, "", []), (2, 0, "", []), (None, 30, "a", ["0,30,1"]), (3, 30, "a b", ["0,30,2"]), (3, 30, "a b", ["0,30,2"]), (4, 25, "x y z", ["0,24,2"])], key=repr)
    assert periodic.periodic_runs(spark.createDataFrame([], DOCS)).count() == 0


def test_periodic_query(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, " ".join(periodic_text(rng) + [str(rng.random()) for _ in range(rng.randint(0, 90))])) for i in range(150)] + [(None, "a b c"), (900, None)]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    wanted = []
    for doc, text in rows:
        words = (text or "").split()
        n = len(words)
        h = None if doc is None else zlib.crc32(str(doc).encode())
        if h is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = brute_runs(words)
        keep = [True] * n
        for s, length, q in runs:
            keep[s + q : s + length] = [False] * (length - q)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        collapsed = " ".join(w for w, k in zip(words, keep, strict=True) if k)
        wanted.append((doc, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha(lines), sha(collapsed)))
    made = queries.op12_periodic(spark, str(tmp_path)).select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()
    assert sorted(map(tuple, made), key=repr) == sorted(wanted, key=repr)
    assert sum(w[1] for w in wanted) > 20


def brute_negatives(rows, positives=5, negatives=10, low=30, high=90):
    """rows: (id, label, whole numbers, anchor)."""
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    out = []
    for a in (r for r in rows if r[3]):
        others = sorted(((-score(a[2], r[2]), r[0], r[1]) for r in rows if r[0] != a[0] and len(r[2]) == len(a[2])))
        for p, pid, label in [o for o in others if o[2] == a[1]][:positives]:
            fits = [o for o in others if o[2] != a[1] and low * -p <= 100 * -o[0] <= high * -p][:negatives]
            out += [(a[0], pid, k + 1, o[1], -p, -o[0]) for k, o in enumerate(fits)]
    return sorted(out)


@pytest.mark.parametrize(("n", "width", "labels", "spread"), [(900, 16, 5, 300), (700, 3, 3, 3), (60, 8, 40, 100), (300, 4, 2, 10**9)])
def test_negatives_equal_brute_force(spark, monkeypatch, n, width, labels, spread):
    rng = random.Random(n)
    centres = [[rng.randint(-spread, spread) for _ in range(width)] for _ in range(labels)]
    rows = []
    for i in range(n):
        label = rng.randrange(labels)
        centre = centres[rng.randrange(labels) if rng.random() < 0.4 else label]
        rows.append((i, label, [c + rng.randint(-spread // 3, spread // 3) for c in centre], i % 10 == 0))
    rows += [(n + i, 1, rows[7][2], False) for i in range(40)]  # many equal vectors
    monkeypatch.setattr(negatives, "ROWS", 64)
    monkeypatch.setattr(negatives, "CHUNK", 32)
    df = spark.createDataFrame([(i, label, [float(x) for x in v], a) for i, label, v, a in rows], "vec_id long, label long, embedding array<double>, a boolean").repartition(4)
    made = negatives.hard_negatives(df, F.col("a"))
    assert sorted(map(tuple, made.collect())) == brute_negatives(rows)


def test_negatives_odd_rows(spark):
    rows = [(0, 1, [1.0, 2.0], True), (1, 1, [2.0, 2.0], False), (2, 2, [1.0, 1.0], False), (3, None, [1.0, 1.0], False), (4, 2, None, False), (5, 2, [1.0, None], False), (6, 2, [float("nan"), 1.0], False),
            (7, 2, [1.0], False), (8, 2, [], True), (None, 2, [1.0, 1.0], True), (9, 3, [1.0, 0.0], True), (2, 2, [1.0, 1.0], False), (10, 2, [1e300, 1e300], False), (11, 3, [0.0, 0.0], False)]
    df = spark.createDataFrame([(*r, 5) for r in rows], "vec_id long, label int, embedding array<double>, a boolean, anchor int")
    made = sorted(map(tuple, negatives.hard_negatives(df, F.col("a")).collect()))
    # 9 has a positive of score 0, so its window is 0 alone, which nothing of another label scores.
    assert made == [(0, 1, 1, 2, 6, 3)]
    assert negatives.hard_negatives(df.limit(0), F.col("a")).count() == 0


def test_share_rounds_inwards():
    low, high = negatives.share(np.array([7, 0, -7, 101, 2**62], np.int64), 30, 90)
    assert low.tolist() == [3, 0, -2, 31, -(-30 * 2**62 // 100)]
    assert high.tolist() == [6, 0, -7, 90, 90 * 2**62 // 100]


def test_pruning_omits_dimensions_and_keeps_all_that_reach():
    rng = np.random.default_rng(2)
    rows = np.rint(rng.normal(size=(500, 12)) * np.r_[np.full(6, 1000), np.full(6, 10)])
    anchors = rows[:5]
    exact = anchors @ rows.T
    asked = np.sort(exact, axis=1)[:, -20]
    kept = negatives.Search._candidates(anchors, rows, asked.astype(np.int64))
    assert set(np.flatnonzero((exact >= asked[:, None]).any(axis=0)).tolist()) <= set(kept.tolist())
    assert len(kept) < 300


def test_search_of_extreme_magnitudes_equals_brute_force():
    """Scores beyond a long are held at its ends, and norms beyond a double prune nothing."""
    rng = np.random.default_rng(0)
    least, most, keep = -(2**63), 2**63 - 1, 12
    whole = np.vectorize(int, otypes=[object])
    with np.errstate(over="ignore", invalid="ignore"):
        assert negatives.Search._candidates(np.array([[1e200, 1e200]]), np.array([[2e200, -1e200]]), np.array([1])).tolist() == [0]
    for _ in range(60):
        n = 40
        v = np.floor(rng.normal(size=(n, 3)) * 10.0 ** rng.choice([0, 5, 80, 160, 200], (n, 1)) * 9)
        v[rng.random((n, 3)) < 0.2] = 0
        v[rng.random(n) < 0.1] = 0
        ids, labels = np.arange(n), rng.integers(0, 2, n)
        full = np.clip(whole(v) @ whole(v).T, least, most)
        lows = np.array([[least, -5], [1, 10], [10**9, 2**62]])[rng.integers(0, 3)]
        low = rng.choice(lows, (n, 2))
        search = negatives.Search(ids, labels, v, low, np.full((n, 2), most), keep, False)
        with np.errstate(over="ignore", invalid="ignore"):
            for c in range(0, n, 15):
                search.meet(ids[c : c + 15], labels[c : c + 15], v[c : c + 15])
        for a in range(n):
            for w in range(2):
                want = sorted((-int(full[a, j]), j) for j in range(n) if labels[j] != labels[a] and full[a, j] >= low[a, w])[:keep]
                assert [(-int(s), int(i)) for s, i in zip(search.score[a, w], search.found[a, w], strict=True) if i != most] == want
