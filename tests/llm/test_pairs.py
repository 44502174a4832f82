"""MinHash and embedding near-dedup, and the language model, against brute force."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import embeddings, lm, minhash

SF = "/root/testdata/sf0.001"


def _components(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def _words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x20\x09-\x0d]+", low)


def _shingles(text, k):
    w = _words(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def _check_minhash(spark, rows, k):
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(3)
    got = {r["doc_id"]: r for r in minhash.near_duplicates(docs, words=k).collect()}
    sets = [_shingles(t, k) for _, t, _ in rows]
    order = sorted(range(len(rows)), key=lambda i: rows[i][0])
    place = {i: p for p, i in enumerate(order)}
    links = [(place[i], place[j]) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    comp = _components(len(rows), links)
    for i, (doc, _, _) in enumerate(rows):
        want = rows[order[comp[place[i]]]][0]
        assert (got[doc]["n_shingles"], got[doc]["component_id"], got[doc]["kept"]) == (len(sets[i]), want, want == doc), rows[i]


def test_minhash_brute_force_on_documents(spark):
    rows = [(r["doc_id"], r["text"], 1) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    _check_minhash(spark, rows, 4)


def test_minhash_groups_ties_and_odd_texts(spark):
    rng = np.random.default_rng(3)
    rows = []
    for g in range(6):  # chains: each text changes a little of the one before
        words = [f"w{x}" for x in rng.integers(0, 5000, 120)]
        for _ in range(25):
            rows.append((len(rows) * 7 % 1009, " ".join(words), 0))
            words = list(words)
            words[int(rng.integers(0, 120))] = f"v{rng.integers(0, 10**6)}"
    for t in (None, "", " \t\n", "one", "ONE", "one two", "one  two", "one two three", "É a b c d", "é a b c d", "a " * 300, "a " * 301):
        rows.append((2000 + len(rows), t, 0))
    _check_minhash(spark, rows, 4)
    _check_minhash(spark, rows, 5)


def test_minhash_empty_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(empty).count() == 0
    docs = spark.createDataFrame([(None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (9, "a b c d e f")], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs).collect())
    assert got == [(0, None, True), (5, 5, True), (5, 5, True), (9, 5, False)]


def _by_row(rows, links, extra):
    """(id, extra, smallest id reachable, kept) of rows (id, ...) with links between row numbers; sorted."""
    comp = _components(len(rows), links)
    least = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            least[comp[i]] = min(least.get(comp[i], row[0]), row[0])
    out = []
    for i, row in enumerate(rows):
        want = least.get(comp[i]) if row[0] is not None else None
        out.append((-1 if row[0] is None else row[0], extra[i], -1 if want is None else want, row[0] == want))
    return sorted(out)


def test_minhash_repeated_ids_keep_links(spark):
    rng = np.random.default_rng(8)
    rows = []
    for g in range(12):
        words = [f"g{g}w{x}" for x in range(60)]
        for k in range(6):
            changed = list(words)
            changed[int(rng.integers(0, 60))] = f"x{k}"
            rows.append((int(rng.integers(1, 25)), " ".join(changed)))
    rows += [(1, "a b c d e f g"), (1, "h i j k l m n"), (2, "a b c d e f g"), (3, "h i j k l m n"), (4, None), (4, ""), (None, "a b c d e f g")]
    rows += rows[:9]
    sets = [_shingles(t, 5) for _, t in rows]
    near = lambda x, y: x and y and 100 * len(x & y) >= 80 * len(x | y)
    links = [(i, j) for i in range(len(rows)) for j in range(i) if rows[i][0] is not None and rows[j][0] is not None and near(sets[i], sets[j])]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_shingles"], -1 if r["component_id"] is None else r["component_id"], r["kept"]) for r in got) == _by_row(rows, links, list(map(len, sets)))


def test_minhash_busy_bucket(spark, monkeypatch):
    """Hubs, cells and copies of sets far below the sizes of a bucket."""
    monkeypatch.setattr(minhash, "HUB", 3)
    monkeypatch.setattr(minhash, "CELL", 4)
    rng = np.random.default_rng(9)
    rows = []
    base = [f"b{x}" for x in range(40)]
    for _ in range(120):
        words = list(base)
        for at in rng.integers(0, 40, 2):
            words[int(at)] = f"v{rng.integers(0, 3)}"
        rows.append((len(rows), " ".join(words), 0))
    _check_minhash(spark, rows, 2)
    _check_minhash(spark, rows, 4)


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 2**63, 400, dtype=np.uint64))
    other = np.r_[base[:300], rng.integers(0, 2**63, 100, dtype=np.uint64)]
    s = minhash.sketches([base, np.unique(other), base[:1], base[:0]], 512)
    assert abs((s[0] == s[1]).mean() - 300 / 500) < 0.1
    assert (s[2] != ~np.uint64(0)).all() and (s[3] == ~np.uint64(0)).all()


def _check_vectors(spark, rows):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, label int").repartition(3)
    got = {r["vec_id"]: r for r in embeddings.near_duplicates(df).collect()}
    good = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    m = np.array([np.array(rows[i][1], np.float32).astype(float) for i in good])
    unit = np.sqrt((m * m).sum(1))
    linked = (m @ m.T) / np.outer(unit, unit) >= 0.95
    np.fill_diagonal(linked, False)
    links = [(good[a], good[b]) for a, b in zip(*np.nonzero(linked), strict=True)]
    comp = _components(len(rows), links)  # ids here rise with the row
    n = Counter(a for a, _ in links)
    assert len(got) == len(rows)
    for i, (vec, _) in enumerate(rows):
        r = got[vec]
        assert (r["n_links"], r["component_id"], r["kept"]) == (n[i], rows[comp[i]][0], rows[comp[i]][0] == vec), vec


def test_embeddings_brute_force(spark):
    _check_vectors(spark, [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()])


def test_embeddings_hot_groups_and_bad_vectors(spark):
    rng = np.random.default_rng(5)
    centre = rng.standard_normal(16)
    rows = [[centre + 0.03 * rng.standard_normal(16)] for _ in range(1500)] + [[centre] for _ in range(80)] + [[rng.standard_normal(16)] for _ in range(300)]
    rows = [(i, [float(np.float32(x)) for x in r[0]]) for i, r in enumerate(rows)]
    for v in (None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [-0.0, 1.0] * 8, [0.0, 1.0] * 8):
        rows.append((len(rows), v))
    _check_vectors(spark, rows)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embeddings.near_duplicates(empty).count() == 0


def test_embeddings_lengths_repeated_and_null_ids(spark):
    """Each length is compared among itself; rows that repeat an id or have none are rows of their own."""
    rng = np.random.default_rng(7)
    rows = [(None, [1.0, 0.0, 0.0]), (None, [0.0, 1.0, 0.0]), (None, [1.0, 0.001, 0.0]), (1, [3.0, 4.0]), (2, [3.0, 4.001]), (3, [6.0, 8.0]), (None, None)]
    rows += [(1, [0.0, 0.0, 1.0]), (1, [0.0, 0.01, 1.0]), (5, [0.0, 0.0, 2.0]), (4, [0.0, 1.0, 0.01])]
    centre = rng.standard_normal((8, 5))
    for _ in range(120):
        v = centre[int(rng.integers(0, 8))] + 0.15 * rng.standard_normal(5)
        rows.append((int(rng.integers(10, 60)), [float(np.float32(x)) for x in v]))
    rows += rows[-20:]
    good = [i for i, (_, v) in enumerate(rows) if v]
    cosine = lambda a, b: float(np.dot(a, b) / math.sqrt(np.dot(a, a) * np.dot(b, b)))
    links = [(i, j) for i in good for j in good if j < i and len(rows[i][1]) == len(rows[j][1]) and cosine(rows[i][1], rows[j][1]) >= 0.95]
    n = Counter(x for pair in links for x in pair)
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, rep string").repartition(3)
    got = embeddings.near_duplicates(df).collect()
    assert sorted((-1 if r["vec_id"] is None else r["vec_id"], r["n_links"], -1 if r["component_id"] is None else r["component_id"], r["kept"]) for r in got) == _by_row(rows, links, [n[i] for i in range(len(rows))])


def _scores(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    model = lm.fit(docs.where(~held), buckets=5)
    return model, {r["doc_id"]: r for r in lm.score(docs, model).collect()}


def _brute_model(train):
    ones, twos = Counter(), Counter()
    for t in train:
        tokens = [*_words(t), None]
        ones.update(tokens)
        twos.update(zip(["<s>", *tokens[:-1]], tokens, strict=True))
    n, v = sum(ones.values()), len(ones)
    seen = lambda counts: lm.good_turing(np.array([sum(c == r for c in counts.values()) for r in range(1, lm.REACH + 2)], float))
    d1, d2 = seen(ones), seen(twos)
    disc = lambda c, d: c * (d[c] if c <= lm.REACH else 1.0)
    taken = sum(c - disc(c, d1) for c in ones.values())
    unknown = max(taken / n, 1 / (n + v + 1))
    scale = (1 - unknown) / (1 - taken / n)
    p1 = {w: disc(c, d1) * scale / n for w, c in ones.items()}
    total = {h: (len(train) if h == "<s>" else ones[h]) for h in [*ones, "<s>"]}
    by = defaultdict(dict)
    for (h, w), c in twos.items():
        by[h][w] = disc(c, d2)
    alpha, p2 = {}, {}
    for h, row in by.items():
        mass = sum(row.values())
        factor = min(1.0, max(total[h] - lm.HALF, 0) / mass)
        for w, c in row.items():
            p2[h, w] = c * factor / total[h]
        alpha[h] = (1 - mass * factor / total[h]) / (1 - sum(p1[w] for w in row))
    return ones, n, v, p1, unknown, p2, alpha


def test_word_codes_name_words(monkeypatch):
    """Equal words have equal hashes and different ones different hashes, wherever texts and spans are cut."""
    import pyarrow as pa

    from tallyspark.llm import merges

    r = np.random.default_rng(2)
    letters = list("abAB\u00e9\u6f22 \t\n\x0b\x0c\r\x1c\u00a0.") + [" "] * 6
    texts = ["".join(r.choice(letters, int(n))) for n in r.integers(0, 90, 300)] + [None, "", " ", "x" * 5000, "y" * 5000 + " z", "\x00", "a", "A"]
    whole = pa.array(["left out", *texts, "too"])
    for span in (1 << 20, 16):
        monkeypatch.setattr(merges, "SPAN", span)
        counts, hashes = merges.word_codes(whole.slice(1, len(texts)))
        words = [w for t in texts for w in _words(t)]
        assert counts.tolist() == [len(_words(t)) for t in texts]
        of = dict(zip(words, hashes.tolist(), strict=True))
        assert [of[w] for w in words] == hashes.tolist() and len(set(of.values())) == len(of)
    assert [len(x) for x in merges.word_codes(pa.array([], pa.string()))] == [0, 0]


def test_packed_numbers_come_back():
    rng = np.random.default_rng(1)
    for most in (1, 255, 256, 2**16, 2**32, 2**63):
        values = rng.integers(0, most, 1000, dtype=np.uint64)
        assert (lm.unpack(lm.pack(values)).astype(np.uint64) == values).all() and (lm.unpack_keys(lm.pack_keys(np.sort(values))) == np.sort(values)).all()
    assert (lm.unpack(lm.pack(np.array([0.5, -1e300, 0.0]))) == [0.5, -1e300, 0.0]).all()
    assert len(lm.unpack(lm.pack(np.zeros(0, np.int64)))) == 0 == len(lm.unpack_keys(lm.pack_keys(np.zeros(0, np.uint64))))


def test_language_model_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + [(10**6, None), (10**6 + 1, ""), (10**6 + 2, "zzz qqq zzz")]
    model, got = _scores(spark, rows)
    train = [t for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    ones, n, v, p1, unknown, p2, alpha = _brute_model(train)
    assert (model.tokens, model.distinct) == (n, v)
    for i, t in rows:
        tokens = [*_words(t), None]
        base = sum(math.log10((ones[w] + 1) / (n + v + 1)) for w in tokens)
        score = sum(
            math.log10(p2[h, w] if (h, w) in p2 else alpha.get(h, 1.0) * p1.get(w, unknown)) for h, w in zip(["<s>", *tokens[:-1]], tokens, strict=True)
        )
        r = got[i]
        assert (r["n_tokens"], r["n_known"]) == (len(tokens), sum(ones[w] > 0 for w in tokens))
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] == pytest.approx(score, rel=1e-9)
    # Every distribution sums to one over the known words and the unknown one.
    assert sum(p1.values()) + unknown == pytest.approx(1)
    for h in list(alpha)[:20]:
        assert sum(p2.get((h, w), alpha[h] * p1[w]) for w in p1) + alpha[h] * unknown == pytest.approx(1)


def test_language_model_counts_all_pairs(spark, monkeypatch):
    """Pairs of words that are rare in a training table of over 100,000 tokens count like any other; words that are not broadcast too."""
    monkeypatch.setattr(lm, "COMMON", 1e-3, raising=False)
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"w{x}" for x in rng.zipf(1.3, 900) % 20_000) + (f" ada{i // 9} lovelace{i // 9}" * 2)) for i in range(140)]
    model, got = _scores(spark, rows)
    ones, n, v, p1, unknown, p2, alpha = _brute_model([t for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2])
    assert n > 100_000 and sum(len(lm.unpack(r["counts"])) for r in model.pairs.collect()) == len(p2)
    for i, t in rows:
        tokens = [*_words(t), None]
        score = sum(math.log10(p2[h, w] if (h, w) in p2 else alpha.get(h, 1.0) * p1.get(w, unknown)) for h, w in zip(["<s>", *tokens[:-1]], tokens, strict=True))
        assert got[i]["score"] == pytest.approx(score, rel=1e-9)


def test_language_model_spreads_a_hot_word(spark, monkeypatch):
    """A word that is a third of all tokens makes no group of requests large, and groups do not grow with the texts."""
    from pyspark.sql.classic.dataframe import DataFrame

    monkeypatch.setattr(lm, "BLOCK", 1 << 15)
    monkeypatch.setattr(lm, "SHARE", 1 << 15, raising=False)
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(f"hot w{a} w{b}" for a, b in rng.integers(0, 3000, (150, 2)))) for i in range(200)]
    grouped, group_by = [], DataFrame.groupBy
    monkeypatch.setattr(DataFrame, "groupBy", lambda df, *keys: (grouped.append((df, keys)) if "kind" in df.columns and "kind" in keys else None) or group_by(df, *keys))
    _, got = _scores(spark, rows)
    df, keys = grouped[-1]
    sizes = Counter()
    for r in df.where("kind = 2 and block is not null").select(F.struct(*keys).alias("at"), "keys").collect():
        sizes[r["at"]] += len(lm.unpack(r["keys"]))
    sizes = list(sizes.values())
    assert max(sizes) < 2.5 * np.mean(sizes) and max(sizes) < 20_000
    ones, n, v, p1, unknown, p2, alpha = _brute_model([t for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2])
    for i, t in rows[:40]:
        tokens = [*_words(t), None]
        score = sum(math.log10(p2[h, w] if (h, w) in p2 else alpha.get(h, 1.0) * p1.get(w, unknown)) for h, w in zip(["<s>", *tokens[:-1]], tokens, strict=True))
        assert got[i]["score"] == pytest.approx(score, rel=1e-9)


def test_language_model_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    model = lm.fit(empty, buckets=3)
    assert (model.tokens, model.distinct) == (0, 0) and lm.score(empty, model).count() == 0
    one = spark.createDataFrame([(None, "a b"), (1, None), (1, None)], "doc_id long, text string")
    rows = lm.score(one, model).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"], r["n_known"], r["score"]) for r in rows) == [(0, 3, 0, 0.0), (1, 1, 0, 0.0), (1, 1, 0, 0.0)]
    fitted = lm.fit(one, buckets=3)
    assert fitted.tokens == 5 and lm.score(empty, fitted).count() == 0


def test_good_turing_falls_back():
    assert (lm.good_turing(np.array([4.0, 0, 0, 0, 0, 0])) <= 1).all()
    d = lm.good_turing(np.array([1000.0, 400, 200, 120, 80, 55]))
    assert ((d[1:] > 0) & (d[1:] < 1)).all()
