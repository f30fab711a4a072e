"""Preparing a training corpus: five stages over ``documents``, each written and read again.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame over everything its predecessor kept.
All but the last return the columns of ``documents``. ``ORACLE_SQL`` is None: learnt scores, fingerprints and
the vocabulary are beyond SQL; the tests compare every stage with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.llm.bpe import bpe_encode
from tiermill.llm.common import stored, table
from tiermill.llm.decontaminate import drop_leaks
from tiermill.llm.lines import RUN_WORDS, dedup_lines
from tiermill.llm.simhash import representatives
from tiermill.llm.toxicity import drop_toxic

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half."""
    return drop_toxic(docs, table(spark, sf_dir, "labels")).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their later copies of line runs, and of long passages in fewer lines.

    Every document stays, if need be empty.
    """
    return dedup_lines(docs, words=RUN_WORDS).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of every near-duplicate group."""
    return representatives(docs, shingle=4, radius=4).select(*COLUMNS)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of the ids and of the decoded text."""
    return bpe_encode(docs, ids=True).drop("decoded")


STAGES = [
    ("toxicity", drop_toxic_documents),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("BPE encoding and decoding", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
