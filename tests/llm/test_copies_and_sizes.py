"""Classes made of copies or of long texts, vectors of extreme size, pages of many megabytes, long segments."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import embeddings, language, merges, tiff, toxicity

GERMAN = ["der Hund und die Katze gehen heute nicht über die Straße, weil es regnet", "wir haben gestern ein neues Haus gesehen und möchten es kaufen"]


def _words(rng, n, letters="abcdefghijklmnop"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(3, 8))) for _ in range(n))


def test_language_of_many_copies(spark):
    rng = random.Random(1)
    english = [(f"the dog and the cat do not go over the street today because of {_words(rng, 5)}", "en") for _ in range(200)]
    docs = spark.createDataFrame(english, "text string, lang string").unionByName(spark.range(20_000).select(F.element_at(F.array(*map(F.lit, GERMAN)), (F.col("id") % 2 + 1).cast("int")).alias("text"), F.lit("de").alias("lang")))
    model = language.fit(docs)
    assert set(model) == {"de", "en"} and model["de"]
    made = language.identify(spark.createDataFrame([(g,) for g in [*GERMAN, english[0][0]]], "text string"), model).collect()
    assert [r["lang_pred"] for r in made] == ["de", "de", "en"]


@pytest.mark.parametrize("kind", ["copies", "long"])
def test_toxic_class_of_copies_or_long_texts(spark, kind):
    rng = random.Random(2)
    clean = [_words(rng, 40) for _ in range(400)]
    if kind == "copies":
        toxic = [f"zzvile zzfoul {_words(rng, 20)}" for _ in range(2)] * 3000
    else:
        toxic = [" ".join(f"zzvile zzfoul {_words(rng, 5)}" for _ in range(250)) for _ in range(120)]
        assert min(map(len, toxic)) > toxicity.LONGEST
    rows = [(i, t, int(i < len(toxic))) for i, t in enumerate(toxic + clean)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"), prior=0.3)
    assert model.features
    made = {r["text"]: r["predicted"] for r in toxicity.score(docs.select("text").distinct(), model).collect()}
    assert all(made[t] == 1 for t in toxic) and sum(made[t] for t in clean) <= 4


def test_vectors_of_extreme_size(spark):
    rows = [(1, [1e-200, 1e-200]), (2, [1.0, 1.0]), (3, [1e-200, 1.0001e-200]), (4, [1e200, 1e200]), (5, [1e-200, -1e-200]), (6, [5e-324, 5e-324]), (7, [1.7e308, -1.7e308]), (8, [1e-300, 1e300])]
    made = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    alike = {1, 2, 3, 4, 6}
    assert {i: made[i] for i in alike} == {i: (4, 1) for i in alike}
    assert made[5] == made[7] == (1, 5)
    assert made[8] == (0, 8)


def test_large_pages_of_one_batch(spark, tmp_path):
    # 17 pages of 128 MB: over 2 GiB of pixels in media of 2 MB.
    media = tiff.write_tiff(b"a" * (128 << 20))
    path = str(tmp_path / "media")
    spark.range(17).coalesce(1).select("id", F.lit(media).alias("media")).write.parquet(path)
    made = tiff.tiff_pages(spark.read.parquet(path)).select("id", "error", F.octet_length("pixels").alias("n"), "feature").collect()
    assert sorted(r["id"] for r in made) == list(range(17))
    assert {(r["error"], r["n"]) for r in made} == {(None, 128 << 20)}
    assert len({r["feature"] for r in made}) == 1


def test_features_by_slices(monkeypatch):
    rng = np.random.default_rng(3)
    for kind in (np.uint8, np.uint16, np.float32):
        pixels = (rng.random((37, 53, 3)) * 200).astype(kind)
        whole = tiff.page_feature(pixels)
        with monkeypatch.context() as m:
            m.setattr(tiff, "SLICE", 50)
            assert tiff.page_feature(pixels) == whole
        step = np.abs(np.diff(pixels.astype(float), axis=1)).mean()
        assert f"step={step:.6f}" in whole and f"mean={pixels.astype(float).mean():.6f}" in whole


def test_many_long_segments_take_time_by_their_size():
    rng = np.random.default_rng(4)
    table = merges.PairTable({(0, 1): (2, 0), (2, 2): (3, 1)}, 4)
    took = []
    for n in (100, 800):
        symbols = rng.integers(0, 2, n * merges.LONG)
        began = time.process_time()
        made, owner = merges.merge_rounds(symbols, np.full(n, merges.LONG), table)
        took.append(time.process_time() - began)
        first = merges.merge_long(symbols[: merges.LONG].copy(), table)
        assert (made[owner == 0] == first).all() and len(np.unique(owner)) == n
    assert took[1] < 24 * took[0] + 1
