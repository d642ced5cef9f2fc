"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; ``run``
writes what a stage returns to the shared folder and reads it again for the next. All
stages but the last return the columns of the documents they got.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from acuity.llm import langid, mixing, packing, secrets, simhash
from acuity.session import stored

#: hundredths of the tokens that the mix gives out, each document at most once
MIX_SHARE, MIX_EPOCHS = 90, 1
SEQUENCE = 2048


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the corpus' languages; texts without letters go."""
    return langid.accept(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced by a mark."""
    return secrets.cleaned(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the target weights of domains, languages and sources leave room for."""
    return mixing.mix(docs, MIX_SHARE, MIX_EPOCHS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents placed in sequences: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(docs, path, SEQUENCE).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", near_dedup),
    ("secret scans", secret_scan),
    ("mixing to target weights", mix),
    ("best-fit packing", pack),
]

#: learned profiles, fingerprints and packing are beyond SQL; the tests hold a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.lower().replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
