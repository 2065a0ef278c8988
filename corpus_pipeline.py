"""The corpus pipeline: documents without toxic ones, near copies and secrets, mixed and packed.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written before the next stage reads it. All but
the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import catalog, mixing, packing, secret_scans, simhash, toxicity
from millrace.session import materialise


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return toxicity.reject(docs, catalog.toxicity_model(docs, spark, sf_dir))


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints linked by two bits or fewer, of 3-word shingles."""
    return simhash.keep_one(docs, shingle=3, radius=2)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, a mark in place of each secret."""
    return secret_scans.redact(docs, secret_scans.train_on(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it."""
    return mixing.mixed(docs, quality=catalog.quality_weights(spark, sf_dir))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token windows that lexically near documents fill together."""
    return packing.pack(docs, catalog.tokenizer_files())


STAGES = [
    ("toxicity", remove_toxic),
    ("simhash", remove_near_copies),
    ("secret scans", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

#: models are trained and texts hashed on the way, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over the table documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
