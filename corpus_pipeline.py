"""A corpus pipeline: language ID, toxicity, near-deduplication and packing, each on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import language, minhash, packing, toxicity
from tallyspark.llm.common import table
from tallyspark.llm.queries import WORDS

#: Models learn from documents whose crc32(doc_id) has another remainder than the second number by the first.
LANGUAGE_HELD_OUT, TOXICITY_HELD_OUT = (4, 2), (3, 1)


def _training(docs: DataFrame, held_out: tuple[int, int]) -> DataFrame:
    return docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % held_out[0] != held_out[1])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the compressor is sure of."""
    model = language.fit(_training(docs, LANGUAGE_HELD_OUT))
    return language.identify(docs, model).where(~F.col("rejected")).select(docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not take for toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(_training(docs.select("doc_id", "text"), TOXICITY_HELD_OUT), labels)
    return toxicity.score(docs, model).where("predicted = 0").select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, 0.8): the one with the smallest id.

    Rows are known by doc_id and a hash of all columns, so rows that share an id, or have none, are documents
    of their own. Rows that agree in every column are one document if their text has words; without words they
    belong to no group and all stay.
    """
    row = "_row"
    while row in docs.columns:
        row += "_"
    named = docs.withColumn(row, F.struct("doc_id", F.xxhash64(*docs.columns).alias("hash")))
    found = table(minhash.near_duplicates(named.select(row, "text"), words=5, percent=80, id_column=row), "near")
    gone = found.where("not kept").select(F.col("doc_id.doc_id").alias("id"), F.col("doc_id.hash").alias("hash")).distinct()
    again = found.where("kept and n_shingles > 0").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("doc_id.doc_id").alias("id"), F.col("doc_id.hash").alias("hash"))
    same = lambda x: named[row]["doc_id"].eqNullSafe(x["id"]) & (named[row]["hash"] == x["hash"])
    kept = named.join(gone, same(gone), "left_anti")
    again = table(again, "repeated-rows")
    if again.isEmpty():
        return kept.select(docs.columns)
    once = kept.join(again, same(again), "left_semi").groupBy(row).agg(*[F.first(F.col(f"`{c}`")).alias(c) for c in docs.columns])
    return kept.join(again, same(again), "left_anti").select(docs.columns).unionByName(once.select(docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences that hold the remaining documents."""
    return packing.pack_documents(docs.select("doc_id", "text"), WORDS)


STAGES = [
    ("language ID", language_id),
    ("toxicity", drop_toxic),
    ("MinHash near-dedup", drop_near_duplicates),
    ("best-fit packing", pack),
]

#: Learned models and tokenizers have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
