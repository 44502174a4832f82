"""Coding, packing, sharding, URL rules, classifiers and TIFF, against libraries and brute force."""

import hashlib
import random
import struct
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import language, merges, packing, pieces, queries, sharding, tiff, toxicity, url_filter
from tallyspark.llm.queries import PIECES, WORDS

SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "  a  b ", "\n", "a\nb\t c", "▁x▁", "é漢字😀 <s> </s> <0x0A> <unk> <|endoftext|>", "word.,!!  'tis don't 1999", "Ünïcode ÉCOLE", "x" * 5000, "hello <|endoftext|> world", "a<|startoftext|>b<|EndOfText|>c", "<|endoftext|>", "a " * 3000, "\x00\x0b\x1c"]


def _docs(spark, extra=()):
    rows = [(r["doc_id"], r["text"], "t") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    return spark.createDataFrame(rows + [(10**6 + i, t, "t") for i, t in enumerate([*ODD, *extra])], "doc_id long, text string, ids string").repartition(3)


def test_sentencepiece_equals_library(spark):
    import sentencepiece

    path = PIECES
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    got = pieces.decode(pieces.encode(_docs(spark), path), path).collect()
    assert len(got) == 200 + len(ODD)
    for r in got:
        want = library.encode(r["text"] or "")
        assert list(r["ids"]) == want and r["decoded"] == library.decode(want)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pieces.decode(pieces.encode(empty, path), path).count() == 0


def test_long_words_equal_the_libraries(spark):
    """Words far beyond LONG characters, with runs, repeats and characters that the model lacks."""
    import sentencepiece
    from tokenizers import Tokenizer

    r = random.Random(5)
    long = ["a" * 60_001, "ab" * 30_000, "".join(r.choices("etaoinshrdlu", k=80_000)), "".join(r.choices("abcé漢😀-.,0", k=20_000)), "the" * 9000 + "\u2581" * 50, "x" * 2000, "=-" * 2500]
    sp, library = sentencepiece.SentencePieceProcessor(model_file=PIECES), Tokenizer.from_file(WORDS)
    coder, words = pieces.PieceCoder(open(PIECES, "rb").read()), packing.WordTokenizer(open(WORDS, "rb").read())
    import pyarrow as pa

    ids, sizes = coder.encode(pa.array(long))
    assert coder.decode(ids.astype(np.int64), sizes) == [sp.decode(sp.encode(t)) for t in long]
    other, others = words.encode(pa.array(long))
    at = np.r_[0, np.cumsum(sizes)], np.r_[0, np.cumsum(others)]
    for k, text in enumerate(long):
        assert ids[at[0][k] : at[0][k + 1]].tolist() == sp.encode(text)
        assert other[at[1][k] : at[1][k + 1]].tolist() == library.encode(text, add_special_tokens=False).ids
    assert coder.coder.known.keys().isdisjoint(long)


def test_sentencepiece_decodes_any_ids(spark):
    import sentencepiece

    path = PIECES
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    r = random.Random(4)
    lists = [[r.randrange(3, 32_000) if r.random() < 0.5 else r.randrange(3, 259) for _ in range(r.randrange(9))] for _ in range(400)] + [None]
    got = pieces.decode(spark.createDataFrame([(x,) for x in lists], "ids array<int>"), path).collect()
    assert all(g["decoded"] == library.decode(list(g["ids"] or [])) for g in got)


def test_packing_places_every_piece_once(spark):
    from tokenizers import Tokenizer

    path = WORDS
    library = Tokenizer.from_file(path)
    docs = _docs(spark)
    rows = packing.pack_documents(docs, path).collect()
    ids = {r["doc_id"]: [*library.encode(r["text"] or "", add_special_tokens=False).ids, 0] for r in docs.collect()}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert by_doc.keys() == ids.keys()
    for doc, found in by_doc.items():
        at = 0
        for k, r in enumerate(sorted(found, key=lambda r: r["piece"])):
            part = ids[doc][at : at + r["length"]]
            assert (r["piece"], r["start"]) == (k, at) and r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            assert r["length"] == min(2048, len(ids[doc]) - at)
            at += r["length"]
        assert at == len(ids[doc])
    for found in by_sequence.values():
        at = 0
        for r in sorted(found, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    assert len(by_sequence) <= -(-sum(map(len, ids.values())) // 2048) * 1.02 + 1
    made = packing.sequences(docs, spark.createDataFrame(rows), path).collect()
    for r in made[:20]:
        assert list(r["ids"]) == [i for p in sorted(by_sequence[r["sequence_id"]], key=lambda p: p["offset"]) for i in ids[p["doc_id"]][p["start"] : p["start"] + p["length"]]]
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string"), path).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plan_holds_the_histogram(seed):
    r = random.Random(seed)
    histogram = Counter(min(64, 1 + int(r.expovariate(0.06))) for _ in range(3000))
    plan = packing.plan_sequences(dict(histogram), 64)
    assert all(sum(p) <= 64 for _, p in plan)
    held = Counter()
    for n, p in plan:
        for v in p:
            held[v] += n
    assert held == histogram
    assert sum(n for n, _ in plan) <= 1.02 * sum(v * n for v, n in histogram.items()) / 64 + 2
    places = packing.place_table(plan)
    seen = set()
    for length, first, repeats, times, sequence, offset in places.tolist():
        for k in range(repeats * times):
            spot = (sequence + k % repeats, offset + k // repeats * length)
            assert spot not in seen and first >= 0
            seen.add(spot)
    assert len(seen) == sum(histogram.values())


def test_sharding_keeps_groups_and_balances(spark):
    docs = _docs(spark, ["same text here"] * 60 + ["copies " * 400] * 90)
    rows = sharding.shard(docs, 8).collect()
    assert len(rows) == docs.count()
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    total, slots, groups = Counter(), defaultdict(list), defaultdict(set)
    for r in rows:
        raw = (text[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
        total[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        groups[text[r["doc_id"]]].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(total) <= set(range(8))
    assert max(total.values()) - min(total.values()) < 0.02 * max(total.values())
    share = sum(total.values()) / 8
    sizes = Counter()
    for r in rows:
        sizes[text[r["doc_id"]]] += r["size"]
    assert all(len(s) == 1 for t, s in groups.items() if sizes[t] < share)
    assert sharding.shard(spark.createDataFrame([], "doc_id long, text string"), 8).count() == 0


def test_sharding_takes_null_and_repeated_ids_and_clashing_columns(spark):
    rows = [(None, "a b", "x", "y"), (None, "a b", "x", "y"), (1, "c", "p", "q"), (1, "d", "r", "s"), (2, None, "t", "u"), (3, "", "v", "w")] * 30
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string, group string, shard string"), 4).collect()
    assert Counter((r["doc_id"], r["size"], r["group"]) for r in got) == Counter((i, len((t or "").encode()) + 16, g) for i, t, g, _ in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(4))


def test_runs_are_packed_as_single_items():
    r = random.Random(3)
    runs = sorted(((r.randrange(1, 90), r.randrange(1, 40)) for _ in range(60)), reverse=True)
    one = sharding.best_fit_decreasing([s for s, n in runs for _ in range(n)], 200)
    by_run = [Counter(), Counter()]
    at = 0
    for k, (_, n) in enumerate(runs):
        for b in one[at : at + n]:
            by_run[0][k, b] += 1
        at += n
    for k, b, n in sharding.best_fit_runs(runs, 200):
        by_run[1][k, b] += n
    assert by_run[0] == by_run[1]


def test_best_fit_takes_the_tightest_bin():
    assert sharding.best_fit_decreasing([6, 5, 4, 3, 2], 10) == [0, 1, 0, 1, 1]
    assert sharding.best_fit_decreasing([6, 6], 10, most=1) is None
    r = random.Random(2)
    sizes = sorted((r.randrange(1, 1000) for _ in range(3000)), reverse=True)
    places = sharding.pack_bins([(s, 1) for s in sizes], 40)
    load = Counter()
    for number, p, _ in places:
        load[p] += sizes[number]
    assert len(load) == 40 and max(load.values()) <= 1.002 * sum(sizes) / 40


def _judge(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    end = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    tail = rest[end:]
    stop = min([i for i in map(tail.find, "?#") if i >= 0], default=len(tail))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    path = tail[:stop]
    fits = [(len(h) + len(p), a, h + p) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fits:
        return host, path, None, "allow"
    _, action, name = max(fits)
    return host, path, name, action


@pytest.mark.parametrize("shapes", [16, 0])
def test_url_rules_brute_force(spark, monkeypatch, shapes):
    monkeypatch.setattr(url_filter, "SHAPES", shapes)
    r = random.Random(8)
    hosts = ["com", "Example.COM", "a.b.example.com", "notexample.com", "net", "x.net", "example.net", "org", "\u00d6.org", "", "a" * 5000 + ".com"]
    paths = ["", "/", "/en/", "/en/7", "/en/77?x", "/de/8#t", "/de/", "/es/1", "/e", "?q=/en/7", "#/en/"]
    urls = [f"http{r.choice(['', 's'])}://{r.choice(hosts)}{r.choice(paths)}" for _ in range(400)] + [None, "", "com/en/", "x://y://com/en/", "://com/en/7", "http://.com/en/", "http://COM\n/en/", "http://com./en/"]
    urls += urls[:20]
    extra = ["_best", "_lead", "rule", "lead", "full", "key", "digest", "size", "full_0", "row", "best", "action"]
    frame = spark.createDataFrame([(i, u, *extra) for i, u in enumerate(urls)], ", ".join(["page_id long", "url string", *(f"{x} string" for x in extra)]))
    rules = queries.URL_RULES + [("com", "/en/", "allow"), ("example.com", None, "allow"), (None, "/x", "block"), ("", "/en/", "block")]
    given = spark.createDataFrame(rules, "host string, path string, action string")
    want = [(h, p or "", a) for h, p, a in rules if h]
    judged = url_filter.filter_urls(frame, given)
    got = {x["page_id"]: x for x in judged.collect()}
    assert set(judged.columns) == {"page_id", "url", *extra, "host", "path", "rule", "verdict"}
    for i, u in enumerate(urls):
        x = got[i]
        assert (x["host"], x["path"], x["rule"], x["verdict"]) == _judge(u, want), u
        assert all(x[c] == c for c in extra if c != "rule")
    assert url_filter.filter_urls(frame.limit(0), given).count() == 0
    assert {x["verdict"] for x in url_filter.filter_urls(frame, given.limit(0)).collect()} == {"allow"}


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op1_language(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == 1000 and sum(r["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got) and sum(r["rejected"] for r in got) < 20


def test_language_edges(spark):
    frame = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "12 34 !!", "x"), (4, "the cat", "x")], "doc_id long, text string, score string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"], r["rejected"]) for r in language.identify(frame, {}).collect()}
    assert set(got.values()) == {("und", 0.0, True)}
    model = {"en": b"the cat sat on the mat and the dog ran", "fr": "le chat est assis sur le tapis éclair".encode()}
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(frame, model).collect()}
    assert got == {1: "und", 2: "und", 3: "und", 4: "en"}
    assert language.fit(frame.limit(0).select("doc_id", "text", F.col("score").alias("lang"))) == {}


def test_language_brute_force(spark):
    """Each text judged again on its own, straight from the fitted dictionaries."""
    import zstandard

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    extra = [(10**6, "Le chat " * 60_000, None), (10**6 + 1, "LE CHAT", None), (10**6 + 1, "LE CHAT", None), (10**6 + 2, None, "en"), (10**6 + 3, "12!", "en"), (10**6 + 4, "\u00e9", None)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema)).withColumn("lang_pred", F.lit("x"))
    model = language.fit(docs.where("doc_id % 4 <> 2"))
    assert set(model) == {r["lang"] for r in docs.collect() if r["lang"]}
    how = zstandard.ZstdCompressionParameters(window_log=18, hash_log=17, chain_log=17, search_log=4, min_match=3, strategy=zstandard.STRATEGY_GREEDY, write_content_size=0, write_checksum=0, write_dict_id=0)
    coders = {n: zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=how) for n, d in model.items()}
    want = {}
    for r in docs.collect():
        text = r["text"] or ""
        if not any(c.isalpha() for c in text):
            want[r["doc_id"]] = ("und", 0.0, True)
            continue
        raw = "".join(c if ord(c) >= 128 or c.isalpha() else " " for c in text.lower())
        raw = b" ".join(x for x in raw.encode().split(b" ") if x)
        sizes = sorted((sum(len(c.compress(raw[i : i + language.PIECE])) for i in range(0, len(raw), language.PIECE)), n) for n, c in coders.items())
        margin = (sizes[1][0] - sizes[0][0]) / sizes[1][0]
        want[r["doc_id"]] = (sizes[0][1], margin, margin < language.MIN_MARGIN)
    rows = language.identify(docs, model).collect()
    assert len(rows) == 206 and all((r["lang_pred"], r["score"], r["rejected"]) == want[r["doc_id"]] for r in rows)


def test_language_model_is_never_empty(spark):
    """One text under two languages, languages of long texts alone, and a language without letters still have a prediction."""
    same = spark.createDataFrame([(1, "the cat sat here", "en"), (2, "the cat sat here", "fr")], "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in language.identify(same, language.fit(same)).collect()} == {"en"}
    long = spark.createDataFrame([(1, "un deux trois quatre cinq. " * 900, "fr"), (2, "one two three four five. " * 900, "en"), (3, "1 2 3", "xx")], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(long, language.fit(long)).collect()}
    assert got == {1: "fr", 2: "en", 3: "und"}
    only = spark.createDataFrame([(1, "1 2 3", "xx"), (2, "abc", None)], "doc_id long, text string, lang string")
    assert {r["doc_id"]: r["lang_pred"] for r in language.identify(only, language.fit(only)).collect()} == {1: "und", 2: "xx"}


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op8_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    toxic, clean = ([r["score"] for r in got if r["toxic"] == k] for k in (1, 0))
    assert min(len(toxic), len(clean)) > 100
    assert np.mean([s >= 0.7 for s in toxic]) > 0.8 and np.mean([s >= 0.7 for s in clean]) < 0.03


def test_toxicity_brute_force(spark):
    """Each text scored again on its own from the fitted weights; long and repeated texts and clashing columns among them."""
    import regex

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(docs, labels)
    assert model.features and 0 < model.prior < 1
    weight = dict(zip(model.features, model.weights.tolist(), strict=True))
    rows = [(r["doc_id"], r["text"], "p", 2.5) for r in docs.limit(300).collect()]
    sign = next(f[1:] for f in model.features if f[0] == "=")
    rows += [(10**6, None, "p", 0.0), (10**6 + 1, "", "p", 0.0), (10**6 + 2, f"{sign.upper()} 1{sign} " * 90_000, "p", 0.0)] + rows[:5]
    got = toxicity.score(spark.createDataFrame(rows, "doc_id long, text string, predicted string, score double"), model).collect()
    assert len(got) == len(rows)
    for r in got:
        words = set(regex.split(r"[^\p{L}]+", (r["text"] or "").lower()))
        found = {f"={w}" for w in words} | {f"{n}{w[:n]}" for w in words for n in toxicity.STARTS if len(w) >= n}
        z = sum(weight.get(f, 0.0) for f in found) + model.bias
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-z)), rel=1e-9) and r["predicted"] == int(r["score"] >= 0.7)


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(docs, none)
    assert {r["predicted"] for r in toxicity.score(docs, model).collect()} == {0}
    assert max(r["score"] for r in toxicity.score(docs, model).collect()) < 1e-17
    assert toxicity.score(docs.limit(0), model).count() == 0
    assert not toxicity.fit(docs.limit(0), none).features


def _entry(tag, kind, values):
    return tag, kind, values


def _tiff(pages, order="<"):
    """A TIFF from (tags, data blocks) pages; the offsets tag holds indexes into the blocks."""
    out = bytearray(struct.pack(order + "2sHI", b"II" if order == "<" else b"MM", 42, 0))
    link = 4
    for tags, blocks in pages:
        places = []
        for b in blocks:
            places.append(len(out))
            out += b
        tags = {**tags}
        key = 324 if 324 in tags else 273
        tags[key] = (4, places)
        tags[key + (1 if key == 324 else 6)] = (4, [len(b) for b in blocks])
        entries = b""
        for tag in sorted(tags):
            kind, values = tags[tag]
            code = {3: "H", 4: "I"}[kind]
            raw = struct.pack(f"{order}{len(values)}{code}", *values)
            if len(raw) > 4:
                place = len(out)
                out += raw
                raw = struct.pack(order + "I", place)
            entries += struct.pack(order + "HHI", tag, kind, len(values)) + raw.ljust(4, b"\0")
        out += b"\0" * (len(out) % 2)
        struct.pack_into(order + "I", out, link, len(out))
        out += struct.pack(order + "H", len(tags)) + entries
        link = len(out)
        out += struct.pack(order + "I", 0)
    return bytes(out)


def _pack_bits(data):
    out = bytearray()
    for i in range(0, len(data), 100):
        part = data[i : i + 100]
        if len(set(part)) == 1 and len(part) > 1:
            out += bytes([257 - len(part), part[0]])
        else:
            out += bytes([len(part) - 1]) + part
    return bytes(out) + b"\x80"


def _pack_lzw(data):
    codes, width, table, run = [(256, 9)], 9, {bytes([i]): i for i in range(256)}, b""
    n = 258
    for b in data:
        nxt = run + bytes([b])
        if nxt in table:
            run = nxt
            continue
        codes.append((table[run], width))
        table[nxt] = n
        n += 1
        run = bytes([b])
        if n == 4094:
            codes.append((256, width))
            table, n, width = {bytes([i]): i for i in range(256)}, 258, 9
        else:
            width = 9 if n < 512 else 10 if n < 1024 else 11 if n < 2048 else 12
    if run:
        codes.append((table[run], width))
        n += 1
        width = 9 if n < 512 else 10 if n < 1024 else 11 if n < 2048 else 12
    codes.append((257, width))
    bits = "".join(format(c, f"0{w}b") for c, w in codes)
    bits += "0" * (-len(bits) % 8)
    return int(bits, 2).to_bytes(len(bits) // 8, "big")


def test_tiff_decodes_what_it_lists(spark):
    rng = np.random.default_rng(2)
    gray = rng.integers(0, 8, (70, 90), dtype=np.uint8)
    gray[10:30] = 5
    head = {256: (3, [90]), 257: (3, [70]), 258: (3, [8]), 262: (3, [1])}
    strips = [gray[i : i + 16].tobytes() for i in range(0, 70, 16)]
    pages = [
        ({**head, 259: (3, [1]), 278: (3, [16])}, strips),
        ({**head, 259: (3, [32773]), 278: (3, [16])}, [_pack_bits(s) for s in strips]),
        ({**head, 259: (3, [5]), 278: (3, [16])}, [_pack_lzw(s) for s in strips]),
        ({**head, 259: (3, [8]), 278: (3, [16])}, [zlib.compress(s) for s in strips]),
    ]
    change = gray.copy()
    change[:, 1:] -= gray[:, :-1]
    pages.append(({**head, 259: (3, [8]), 317: (3, [2]), 278: (3, [70])}, [zlib.compress(change.tobytes())]))
    tiles = []
    padded = np.zeros((96, 96), np.uint8)
    padded[:70, :90] = gray
    for y in range(0, 96, 32):
        for x in range(0, 96, 32):
            tiles.append(_pack_lzw(padded[y : y + 32, x : x + 32].tobytes()))
    pages.append(({**head, 259: (3, [5]), 322: (3, [32]), 323: (3, [32]), 324: (4, [])}, tiles))
    for order in "<>":
        wide = rng.integers(0, 60000, (20, 30, 3)).astype(order + "u2")
        colour = {256: (3, [30]), 257: (3, [20]), 258: (3, [16, 16, 16]), 259: (3, [1]), 277: (3, [3]), 278: (3, [20])}
        planes = [np.ascontiguousarray(wide[:, :, k]).tobytes() for k in range(3)]
        floats = rng.standard_normal((8, 10)).astype(np.float32)
        raw = np.frombuffer(floats.astype(">f4").tobytes(), np.uint8).reshape(8, 10, 4).transpose(0, 2, 1).reshape(8, 40)
        moved = raw.copy()
        moved[:, 1:] -= raw[:, :-1]
        real = {256: (3, [10]), 257: (3, [8]), 258: (3, [32]), 259: (3, [8]), 278: (3, [8]), 317: (3, [3]), 339: (3, [3])}
        every = [*pages, (colour, [wide.tobytes()]), ({**colour, 284: (3, [2])}, planes), (real, [zlib.compress(moved.tobytes())])]
        frame = spark.createDataFrame([(1, bytearray(_tiff(every, order)), 0)], "id long, media binary, page int")
        got = sorted(tiff.tiff_pages(frame).collect(), key=lambda r: r["page"])
        assert [r["error"] for r in got] == [None] * len(every)
        assert all(bytes(r["pixels"]) == gray.tobytes() for r in got[:6])
        assert all(bytes(r["pixels"]) == wide.astype("<u2").tobytes() for r in got[6:8])
        assert np.allclose(np.frombuffer(bytes(got[8]["pixels"]), "<f4").reshape(8, 10), floats)


def test_tiff_bilevel_and_small_samples(spark):
    """Samples of 1, 2 and 4 bits in strips and tiles, packed and not, with both fill orders."""
    rng = np.random.default_rng(3)
    pages, want = [], []

    def packed(image, bits):
        spread = np.unpackbits(image[:, :, None].astype(np.uint8), axis=2)[:, :, 8 - bits :]
        return np.packbits(spread.reshape(len(image), -1), axis=1).tobytes()

    for bits in (1, 2, 4):
        image = rng.integers(0, 1 << bits, (21, 37), dtype=np.uint8)
        image[3:9] = 0
        head = {256: (3, [37]), 257: (3, [21]), 258: (3, [bits]), 262: (3, [0])}
        if bits == 1:
            del head[258]  # the format's default
        strips = [packed(image[i : i + 8], bits) for i in range(0, 21, 8)]
        pages.append(({**head, 259: (3, [32773]), 278: (3, [8])}, [_pack_bits(x) for x in strips]))
        turned = [np.packbits(np.unpackbits(np.frombuffer(x, np.uint8), bitorder="little")).tobytes() for x in strips]
        pages.append(({**head, 259: (3, [1]), 266: (3, [2]), 278: (3, [8])}, turned))
        padded = np.zeros((32, 48), np.uint8)
        padded[:21, :37] = image
        tiles = [zlib.compress(packed(padded[y : y + 16, x : x + 16], bits)) for y in range(0, 32, 16) for x in range(0, 48, 16)]
        pages.append(({**head, 259: (3, [8]), 322: (3, [16]), 323: (3, [16]), 324: (4, [])}, tiles))
        want += [image.tobytes()] * 3
    got = sorted(tiff.tiff_pages(spark.createDataFrame([(bytearray(_tiff(pages, ">")),)], "media binary")).collect(), key=lambda r: r["page"])
    assert [r["error"] for r in got] == [None] * 9 and [bytes(r["pixels"]) for r in got] == want


def test_tiff_any_damage_is_an_error_row(spark):
    """Sizes of 0, sizes beyond the data, a deflate bomb, repeated directories and random damage: rows, never a crash."""
    head = {256: (3, [8]), 257: (3, [4]), 258: (3, [8]), 259: (3, [1])}
    raw = bytes(range(32))
    bad = [
        _tiff([({**head, 278: (3, [4]), 256: (3, [0])}, [raw])]),
        _tiff([({**head, 322: (3, [0]), 323: (3, [16]), 324: (4, [])}, [raw])]),
        _tiff([({**head, 323: (3, [16]), 324: (4, [])}, [raw])]),
        _tiff([({**head, 278: (3, [4]), 256: (4, [2**31]), 257: (4, [2**31])}, [raw])]),
        _tiff([({**head, 322: (4, [2**30]), 323: (4, [2**30]), 324: (4, [])}, [raw])]),
        _tiff([({**head, 278: (3, [4]), 258: (3, [3])}, [raw])]),
    ]
    rows = tiff.tiff_pages(spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(bad)], "id long, media binary")).collect()
    assert len(rows) == len(bad) and all(r["error"] and r["pixels"] is None for r in rows)
    whole = _tiff([({**head, 278: (3, [0])}, [raw])])
    assert next(tiff.read_tiff(whole))[0].tobytes() == raw
    bomb = _tiff([({**head, 259: (3, [8]), 278: (3, [4])}, [zlib.compress(b"\0" * (64 << 20))])])
    assert next(tiff.read_tiff(bomb))[0].tobytes() == b"\0" * 32
    r = random.Random(6)
    good = _tiff([({**head, 278: (3, [2])}, [raw[:16], raw[16:]]), ({**head, 259: (3, [5]), 278: (3, [4])}, [_pack_lzw(raw)])])
    for _ in range(3000):
        data = bytearray(good)
        for _ in range(r.randrange(1, 4)):
            data[r.randrange(len(data))] = r.randrange(256)
        try:
            list(tiff.read_tiff(bytes(data[: r.randrange(8, len(data) + 1)])))
        except ValueError:
            pass


def test_tiff_long_texts_repeats_and_clashing_columns(spark):
    text = "long text \u00e9 " * 400_000
    frame = spark.createDataFrame([(1, text, 5, "p"), (2, "x", 6, "q"), (2, "x", 6, "q")], "doc_id long, text string, n_bytes int, pixels string")
    got = sorted(tiff.tiff_pages(tiff.store_texts(frame)).collect(), key=lambda r: r["doc_id"])
    assert [r["n_bytes"] for r in got] == [len(text.encode()), 1, 1] and got[1] == got[2]
    assert bytes(got[0]["pixels"])[: got[0]["n_bytes"]] == text.encode() and {r["error"] for r in got} == {None}


def test_tiff_long_lzw_and_packbits():
    rng = np.random.default_rng(9)
    data = rng.integers(0, 40, 60_000, dtype=np.uint8).tobytes() + b"\0" * 5000
    assert tiff.unpack_lzw(_pack_lzw(data)) == data and tiff.unpack_bits(_pack_bits(data)) == data


def test_tiff_round_trip_and_damage(spark):
    frame = _docs(spark).select("doc_id", "text")
    stored = tiff.store_texts(frame)
    got = {r["doc_id"]: r for r in tiff.tiff_pages(stored).collect()}
    for r in frame.collect():
        raw = (r["text"] or "").encode()
        payload = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
        g = got[r["doc_id"]]
        assert g["n_bytes"] == len(raw) and bytes(g["pixels"]) == payload and g["error"] is None
        assert hashlib.sha256(bytes(g["media"])).digest() == hashlib.sha256(tiff.write_tiff(payload)).digest()
    good = tiff.write_tiff(b"x" * 640)
    bad = [None, b"", b"II*\0", good[:60], b"JUNK" + good[4:], good[:-40] + b"\xff" * 40]
    rows = tiff.tiff_pages(spark.createDataFrame([(i, bytearray(b) if b is not None else None) for i, b in enumerate(bad)], "id long, media binary")).collect()
    assert all(r["error"] and r["pixels"] is None for r in rows if r["id"] != 2) and 0 not in {r["id"] for r in rows}


def test_gapless_rank_and_components(spark):
    from tallyspark.llm.common import components, gapless_rank

    rows = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).alias("k"), "id")
    by = defaultdict(list)
    for r in gapless_rank(rows, ["k"], F.col("id"), [F.col("id")], "rank", 16).collect():
        by[r["k"]].append(r["rank"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    chain = spark.createDataFrame([(i, i + 1) for i in range(120)] + [(500, 400), (400, 400), (500, 600)], "src long, dst long")
    assert {r["node"]: r["component"] for r in components(chain).collect()} == {**{i: 0 for i in range(121)}, 400: 400, 500: 400, 600: 400}
    assert components(chain.limit(0)).count() == 0
    assert list(merges.blocks([5, 1, 9, 2], 6)) == [(0, 2), (2, 3), (3, 4)]


def test_url_rules_of_the_contract(spark, tmp_path):
    """The query judges by the contract's rules, written out here apart from the code's list."""
    cases = [
        ("http://a.com/en/1", "com/en/", "block"),
        ("http://example.com/en/7x", "example.com/en/7", "allow"),
        ("http://x.net/de/1", "net/de/", "allow"),
        ("http://EXAMPLE.net/de/1", "net/de/", "allow"),
        ("http://a.example.net/de/8", "example.net/de/8", "block"),
        ("http://a.org/es/", "org/es/", "block"),
        ("http://a.org/de/", None, "allow"),
    ]
    spark.createDataFrame([(i, u) for i, (u, *_) in enumerate(cases)], "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in queries.op7_url_filter(spark, str(tmp_path)).collect()}
    assert got == {i: tuple(c[1:]) for i, c in enumerate(cases)}


def test_toxicity_features_are_counted_without_holding_all_pairs():
    """3,000 texts with 400 words give 4.8 million pairs of text and feature (38 MB); the driver holds those of a slice only."""
    letters = "abcdefghijklmnopqrst"
    common = [f"{a}{b}vwxyz" for a in letters for b in letters]
    positive, unlabelled = pa.array([" ".join(["signword", *common])] * 60), pa.array([" ".join(common)] * 3000)
    tracemalloc.start()
    try:
        found = toxicity.choose_features(positive, unlabelled, 0.1)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found == ["4sign", "5signw", "6signwo", "=signword"]
    assert peak < 40e6
