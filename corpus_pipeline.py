"""A training corpus from raw documents, stage by stage.

``STAGES`` lists the stages in order; each takes (spark, docs, sf_dir) and
returns a table. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm import exact, langid, minhash, mix, pack
from flowlens.llm.common import ship, written
from flowlens.llm.queries import tokenizer_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language is rejected (no letters, or unlike all languages learned)."""
    ship(spark)
    model = langid.fit(langid.learning_part(docs), F.col("doc_id"))
    judged = docs.withColumn("__judged", langid.identify(docs, model))
    return judged.where(~F.col("__judged.rejected")).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text stays (equal up to the case of A-Z)."""
    return exact.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (five-word shingles, 0.8)."""
    ship(spark)
    return minhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources meet their target weights."""
    return mix.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 ids."""
    ship(spark)
    return pack.pack_documents(docs, tokenizer_path())


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("source_mix", mix_sources),
    ("packing", pack_sequences),
]

#: Language models and packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        table = written(stage(spark, table, sf_dir))
    return STAGES[-1][1](spark, table, sf_dir)
