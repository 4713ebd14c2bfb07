"""A training-data pipeline over ``documents``: language, near-duplicates, benchmark, mix, packing.

Each stage works on the rows that the one before kept and returns the columns of ``documents``; the
last returns packed rows. Between stages the rows are stored as Parquet in the shared folder, so a lost
executor costs no more than its part of one stage.

Rows with NULLs in any column, empty and very long texts, repeated rows and empty tables pass every
stage: a text without a letter is rejected by the first stage, repeated rows are near-duplicates in
the second, NULL sources are a source of their own in the fourth, and extra columns are carried along
to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import decontaminate, language_id, mixing, packing, simhash
from panelspark.llm.common import quoted, ship_package, stored, word_count
from panelspark.llm.queries import table, vocabulary


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; those without a letter (``und``) go."""
    ship_package(spark)
    model = language_id.fit(docs)
    return language_id.known_language(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints link within 2 bits (3-word shingles)."""
    return simhash.keep_one(docs, words=3, max_distance=2)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, up to twice."""
    # The row travels as one value, so its columns cannot clash with those of the mix.
    sized = docs.select(
        "doc_id",
        "source",
        word_count(F.col("text")).alias("size"),
        F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("__document"),
    )
    return mixing.emitted(mixing.mix(sized)).select("__document.*")


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of token ids with segment lengths and position resets."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("packing", pack_tokens),
]

#: SQL has neither the hash of the fingerprints nor the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
