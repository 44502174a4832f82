"""The pipeline: each stage on odd rows, the order of the stages, and near-dedup against brute force."""

import re

import corpus_pipeline
import numpy as np
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    text = "the same words again and again in one short text of some length"
    odd = [(None, text, "en", "s", 9), (10**6, None, None, None, None), (10**6 + 1, "", "en", "s", 0), (10**6 + 1, "", "en", "s", 0), (10**6 + 2, " ", "en", "s", 1), (10**6 + 3, "word " * 50_000, "en", "s", 9)]
    odd += [(10**6 + 4, text, "en", "s", 9), (10**6 + 4, text, "en", "s", 9), (10**6 + 4, "a wholly different text that shares its id with another one", "en", "s", 9), (None, text, "en", "s", 9)]
    return given.unionByName(spark.createDataFrame(odd, given.schema))


def test_stages_are_as_dealt():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language ID", "toxicity", "MinHash near-dedup", "best-fit packing"]
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_each_stage_takes_odd_and_empty_tables(spark, docs, name, stage):
    out = stage(spark, docs, SF)
    if name != "best-fit packing":
        assert out.columns == docs.columns
        kept = {tuple(r) for r in out.collect()}
        assert kept <= {tuple(r) for r in docs.collect()} and len(kept) > 100
    empty = stage(spark, docs.limit(0), SF)
    assert empty.columns == out.columns and empty.count() == 0


def test_near_dedup_keeps_one_of_each_group(spark, docs):
    rows = [tuple(r) for r in docs.collect()]

    def shingles(text):
        words = re.findall("[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())

    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    group = [find(i) for i in range(len(rows))]
    got = [tuple(r) for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()]
    left = list(got)
    for i, r in enumerate(rows):
        if not sets[i]:  # without words: no group, so all stay
            left.remove(r)
    taken = set()
    for r in left:
        at = next(group[i] for i, x in enumerate(rows) if x == r and sets[i])
        assert at not in taken
        taken.add(at)
    assert taken == {g for g, s in zip(group, sets, strict=True) if s}
    ids = {}
    for i, r in enumerate(rows):
        if sets[i] and r[0] is not None:
            ids[group[i]] = min(ids.get(group[i], r[0]), r[0])
    by_group = {next(group[i] for i, x in enumerate(rows) if x == r and sets[i]): r[0] for r in left}
    assert all(by_group[g] in (None, low) for g, low in ids.items())
    # Which row stays does not depend on how the rows are dealt.
    again = corpus_pipeline.drop_near_duplicates(spark, docs.repartition(5), SF)
    assert sorted(map(str, got)) == sorted(str(tuple(r)) for r in again.collect())


def test_run_equals_its_stages(spark, docs, tmp_path):
    for name in ("documents", "labels"):
        frame = docs if name == "documents" else spark.read.parquet(f"{SF}/labels.parquet")
        frame.write.parquet(str(tmp_path / f"{name}.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:3]:
        now = stage(spark, now, str(tmp_path))
    left = {r["doc_id"] for r in now.collect()}
    assert {r["doc_id"] for r in out} == left
    at = {}
    for r in sorted(out, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == at.get(r["sequence_id"], 0) and r["length"] <= 2048
        at[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(at.values()) <= 2048 and np.mean(list(at.values())) > 1500


def test_columns_with_any_name_are_kept(spark, docs):
    """A column that has the name of the helper column keeps its values."""
    given = docs.limit(120).withColumn("_row", docs["doc_id"]).withColumn("_row_", docs["text"])
    out = corpus_pipeline.drop_near_duplicates(spark, given, SF)
    assert out.columns == given.columns
    assert all(r["_row"] == r["doc_id"] and r["_row_"] == r["text"] for r in out.collect())
