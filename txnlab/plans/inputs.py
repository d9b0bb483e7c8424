"""Shared inputs for the registered queries: all derived by Spark from the
tables in ``sf_dir`` (the transactions view, its kept rows, the fixed scorer,
the deterministic split)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlab import config as C
from txnlab.functions.columns import fixed_score
from txnlab.operators.features import drop_null_rows, feature_table, select_types
from txnlab.operators.sampling import hash_split
from txnlab.session import materialize
from txnlab.sources.transactions import transactions_from_tables


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyed transactions view (``txn_key`` + the eleven columns)."""
    return transactions_from_tables(spark, sf_dir)


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eleven transaction columns only, as the input file has them."""
    return transactions(spark, sf_dir).drop(C.KEY)


def kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_types(transactions_from_tables(spark, sf_dir, C.KEPT_TYPES))


def scored_fixed(df: DataFrame) -> DataFrame:
    """``txn_key, label, score`` by the fixed scorer (no trained model)."""
    return df.select(C.KEY, F.col(C.LABEL).cast("int").alias("label"), fixed_score().alias("score"))


def fixed_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_fixed(kept(spark, sf_dir))


def fixed_scored_split(spark: SparkSession, sf_dir: str, written: bool = True) -> DataFrame:
    """The fixed-scored kept rows with their split, written once to the shared
    scratch folder: tau* on validation and every test metric then read this
    small table instead of re-running the four-table join."""
    s = hash_split(fixed_scored(spark, sf_dir))
    return materialize(s, "scored-split") if written else s


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the ordered feature table of the kept rows (nulls kept)."""
    return feature_table(transactions(spark, sf_dir))


def model_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature rows without nulls, with the deterministic split column."""
    return hash_split(drop_null_rows(features(spark, sf_dir)))


def part(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col("split") == name)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (results are compared at 6 digits)."""
    return df.select(
        *[F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
          for f in df.schema.fields]
    )
