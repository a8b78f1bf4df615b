"""Raw documents to packed training sequences, in five stages.

Each stage reads what its predecessor wrote. The first four return documents, the
last one the pieces of the packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vidlake.llm import decontam, neardup, packing, pii, toxicity
from vidlake.llm.common import read, released, save


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5."""
    return toxicity.without_toxic(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return neardup.without_copies(docs)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.without_leaks(docs, read(spark, sf_dir, "benchmark"))


def pseudonymised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by pseudonyms."""
    return pii.pseudonymise(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences, sources in proportion in every window."""
    return packing.pack(docs, str(public_tokenizers.path("word_bpe_49k.json")))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_copies),
    ("decontamination", without_leaks),
    ("pii", pseudonymised),
    ("packing", packed),
]
# SQL cannot express hashed classifiers, tokenizers and the like; the tests hold the
# stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    *earlier, (_, last) = STAGES
    for name, stage in earlier:
        with released():
            docs = save(stage(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)
