"""From documents to token files: five stages, each one operator of `terrazzo.llm`.

Every stage works on all that its predecessor kept. All but the last return the columns of documents.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from terrazzo.llm import decontam, grammar, langid, mixing, neardup  # noqa: E402
from terrazzo.session import staged  # noqa: E402


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or with a text that the network takes for none of its languages, go."""
    return langid.accepted(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles with a similarity of 0.8 or more the one with the least id stays."""
    return neardup.deduplicated(docs, shingle=5, percent=80)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold 0.8 or more of a benchmark item's five-word shingles go."""
    return decontam.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), shingle=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at weights 5, 2, 1, ... and 1.5 times all words: a document stands as often as the mix takes it, twice at most."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, and what is read back from them: doc_id, start, n_tokens, ids_crc32 of every document of the mix."""
    return grammar.tokens_of(docs)


STAGES = [
    ("language ID", language),
    ("near-copies", near_copies),
    ("benchmark decontamination", benchmark),
    ("mixing", mix),
    ("token files", tokens),
]

# the network of the first stage and the tokenizer of the last have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over all documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
