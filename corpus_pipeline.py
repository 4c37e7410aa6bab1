"""Corpus pipeline: from raw documents to token ids, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as
Parquet and read again as the next one's documents. All but the last return the columns of
their input; the last returns each document's ids and digests. Tables other than the
documents come from ``sf_dir``. Empty documents, null texts and repeated rows are treated
as the operators' docstrings say.
"""

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from hazeline.llm import bpe, decontaminate, neardup, quality, secret_scan
from hazeline.llm.common import table
from hazeline.llm.queries import tokenizer_path
from hazeline.session import write_in_scope


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: shingles of five words, a similarity of 0.8 or more."""
    return neardup.deduplicated(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A mark takes the place of each secret."""
    return secret_scan.redacted(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of ids and decoded text."""
    return bpe.encoded(spark, docs, tokenizer_path(), keep_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", keep_good),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark),
    ("secret_scan", mask_secrets),
    ("bpe_encode", encode),
]

#: The classifier and the Markov models are fitted, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next begins, when the tables it needed go."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_in_scope(spark, partial(stage, spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
