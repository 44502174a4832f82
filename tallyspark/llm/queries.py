"""The queries opN_<name> over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import embeddings, language, lm, minhash, negatives, packing, periodic, pieces, repeats, sharding, tiff, toxicity, url_filter

#: Paths of the public tokenizer files.
PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")

#: (host, path, action) of the URL rules.
URL_RULES = [
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
]


def _read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def _bucket(divisor: int):
    """crc32 of doc_id as text, modulo divisor."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = language.fit(docs.where(_bucket(4) != 2))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (_bucket(4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents", "doc_id", "text")
    coded = pieces.encode(docs, PIECES).drop("text")
    return pieces.decode(coded, PIECES).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents", "doc_id", "text")
    model = lm.fit(docs.where(_bucket(7) != 2))
    return lm.score(docs, model).select(
        "doc_id", (_bucket(7) == 2).alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(_read(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents", "doc_id", "text")
    return sharding.shard(docs, 40).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack_documents(docs, WORDS)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages", "page_id", "url")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return url_filter.filter_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents", "doc_id", "text")
    labels = _read(spark, sf_dir, "labels", "doc_id", "toxic")
    model = toxicity.fit(docs.where(_bucket(3) != 1), labels)
    return toxicity.score(docs, model).select("doc_id", (_bucket(3) == 1).alias("held_out"), "score", "predicted")


def op9_tiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents", "doc_id", "text")
    pages = tiff.tiff_pages(tiff.store_texts(docs))
    return pages.select(
        "doc_id",
        "n_bytes",
        F.octet_length("pixels").cast("long").alias("payload_bytes"),
        F.sha2("pixels", 256).alias("payload_sha256"),
        F.crc32(F.substring("pixels", -64, 64)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
    )


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_read(spark, sf_dir, "documents", "doc_id", "text"), words=4, percent=80)


def _with_periods(docs: DataFrame) -> DataFrame:
    """A tenth of the documents get a periodic end: from word a on, word i becomes word a + (i - a) % p."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    found = docs.withColumn("h", h).withColumn("words", F.when(F.col("h") % 10 == 0, words))
    g, n = F.floor(F.col("h") / 10).cast("long"), F.size("words").cast("long")
    found = found.withColumn("a", F.when(n > 0, g % n)).withColumn("left", n - F.col("a"))
    p = (1 + F.floor(F.col("left") / (3 + g % 8))).cast("int")
    a, left = F.col("a").cast("int"), F.col("left").cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("words", a + 1, p), F.ceil(left / p).cast("int"))), F.lit(1), left)
    made = F.array_join(F.concat(F.slice("words", F.lit(1), a), tail), " ")
    return found.select("doc_id", F.when(n > 0, made).otherwise(F.col("text")).alias("text"))


def op11_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(_read(spark, sf_dir, "documents", "doc_id", "text"), words=20)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(_with_periods(_read(spark, sf_dir, "documents", "doc_id", "text"))).drop("text")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"strongest.{c}").alias(c) for c in ("start", "length", "period")],
        F.floor(F.col("strongest.length") * 1000 / F.col("strongest.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("double"))
    whole = F.when(~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), whole)
    return negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0, label=label, vector=whole)


QUERIES = {
    "op1_language": op1_language,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_tiff": op9_tiff,
    "op10_minhash": op10_minhash,
    "op2_sentencepiece": op2_sentencepiece,
    "op5_sharding": op5_sharding,
    "op6_packing": op6_packing,
    "op7_url_filter": op7_url_filter,
    "op11_repeats": op11_repeats,
    "op12_periodic": op12_periodic,
    "op13_negatives": op13_negatives,
}

_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in URL_RULES)

ORACLE_SQL = {
    "op11_repeats": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM w WHERE len(words) >= 20),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS g FROM starts)
  QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later),
each AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY 1)
SELECT w.doc_id, len(words)::BIGINT AS n_words, len(words)::BIGINT - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
""",
    "op13_negatives": """
WITH valid AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same, list_dot_product(a.v, r.v)::BIGINT AS score
  FROM valid a JOIN valid r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
positives AS (
  SELECT anchor_id, id, score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id)::INTEGER AS rank,
  s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) <= 10
""",
    "op7_url_filter": f"""
WITH rules(rule_host, rule_path, action) AS (VALUES {_RULE_ROWS}),
cut AS (
  SELECT page_id, coalesce(CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END, '') AS rest
  FROM pages),
parts AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
fits AS (
  SELECT page_id, rule_host || rule_path AS rule, action,
    row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host) + length(rule_path) DESC, action DESC) AS k
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.action, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON p.page_id = f.page_id AND f.k = 1
""",
}
