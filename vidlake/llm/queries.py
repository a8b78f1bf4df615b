"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vidlake.llm import (
    align,
    decontam,
    hmm,
    htmltext,
    knn,
    licenses,
    neardup,
    packing,
    pii,
    quality,
    token_counts,
    toxicity,
    treap,
)
from vidlake.llm.common import read


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.drop(decontam.TEXT_HASH)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = str(public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(read(spark, sf_dir, "documents"), path)


def op3_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(read(spark, sf_dir, "documents"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(read(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(read(spark, sf_dir, "documents"))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.main_text(read(spark, sf_dir, "pages"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    return token_counts.counts(read(spark, sf_dir, "documents"), path)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read(spark, sf_dir, "documents"))


def op10_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treap.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.nearest(read(spark, sf_dir, "embeddings"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    path_a, path_b = (str(public_tokenizers.path(name)) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align.align(read(spark, sf_dir, "documents"), path_a, path_b)


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_packing": op2_packing,
    "op3_hmm": op3_hmm,
    "op4_licenses": op4_licenses,
    "op5_pii": op5_pii,
    "op6_main_text": op6_main_text,
    "op7_toxicity": op7_toxicity,
    "op8_token_counts": op8_token_counts,
    "op9_quality": op9_quality,
    "op10_neardup": op10_neardup,
    "op11_ranked_search": op11_ranked_search,
    "op12_nearest": op12_nearest,
    "op13_alignment": op13_alignment,
}
ORACLES: dict[str, str] = {
    "op11_ranked_search": r"""
WITH lowered AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
corpus AS (SELECT count(*) AS docs, sum(len(terms)) AS total FROM lowered WHERE len(terms) > 0),
asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark) GROUP BY ALL),
postings AS (
  SELECT doc_id, n, term, count(*) AS tf FROM (
    SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM lowered) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w
  FROM postings, corpus GROUP BY term, docs),
scored AS (
  SELECT item_id, doc_id, CAST(sum(times * w *
    ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * docs) // total::BIGINT))))) AS BIGINT) AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term), corpus GROUP BY item_id, doc_id),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
    doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
""",
    "op12_nearest": """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, x -> floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, x -> x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT query_id,
    CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
""",
}
