"""The corpus pipeline: ``documents`` through five of the dealt operators.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes each result as Parquet in the shared folder and hands the table read
back to the next stage, so a lost executor costs one stage's tasks at most.
All stages but the last return the columns of ``documents``; the last adds
what the mix takes of each document (size, source_size, target, taken).

An empty table passes through all stages; nulls, repeated rows and blank texts
are as each operator's module says.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from txnlab.llm import decontaminate, mixing, pii, quality, simhash
from txnlab.llm.queries import ship
from txnlab.session import materialize


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_classifier(spark, docs, sf_dir):
    """Operator 1: documents that the classifier rejects go."""
    return quality.keep_good(docs, _read(spark, sf_dir, "labels"))


def simhash_near_dedup(spark, docs, sf_dir):
    """Operator 8: one document of each group stays, that of the smallest id."""
    ship(spark)
    return simhash.drop_near_duplicates(docs, k=3, radius=3)


def benchmark_decontamination(spark, docs, sf_dir):
    """Operator 6: documents that hold a benchmark item go."""
    return decontaminate.decontaminate(docs, _read(spark, sf_dir, "benchmark"))


def pii_sanitisation(spark, docs, sf_dir):
    """Operator 9: personal data and terms that give it away are replaced."""
    return pii.sanitise(docs, z=pii.CAUTION)


def mix_sources(spark, docs, sf_dir):
    """Operator 5: the words that the mix takes of each document."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii_sanitisation", pii_sanitisation),
    ("mix_sources", mix_sources),
]

# The classifier's fit and the fingerprints can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
