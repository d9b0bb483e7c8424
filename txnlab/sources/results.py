"""Result tables and fitted pipelines on shared storage.

Result tables are small by construction (their size is fixed by the operator's
parameters), so ``write_result`` coalesces to one file; large tables should be
written with their own partitioning instead (``single_file=False``).
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


def write_result(df: DataFrame, path: str, fmt: str = "csv", single_file: bool = True) -> str:
    """Overwrite ``path`` with ``df`` as headered CSV, JSON or parquet."""
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "json":
        writer.json(path)
    else:
        writer.format(fmt).save(path)
    return path


def read_result(spark: SparkSession, path: str, fmt: str = "csv", schema=None) -> DataFrame:
    """Read a written result directory back (every part file, not the first one only)."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        if schema is None:
            reader = reader.option("inferSchema", True)
        return reader.option("header", True).csv(path)
    if fmt == "json":
        return reader.json(path)
    return reader.format(fmt).load(path)


def save_model(model: PipelineModel, path: str) -> str:
    """Save a fitted pipeline, replacing what is there."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
