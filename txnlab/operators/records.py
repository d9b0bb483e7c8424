"""Run record and caching of re-used splits."""

from __future__ import annotations

import resource
from collections.abc import Callable
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from txnlab import config as C
from txnlab.functions.columns import ratio6
from txnlab.session import shared_dir


def partition_sizes(df: DataFrame, name: str) -> DataFrame:
    """Rows per partition of ``df`` (grouped on the executors)."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("frame"), "partition", "rows"
    )


def driver_memory(spark: SparkSession) -> dict:
    """The driver's memory: what was asked for, the JVM's limit and use, and the peak
    of this Python process, in MB."""
    jvm = spark.sparkContext._jvm.java.lang.Runtime.getRuntime()
    return {"driver_memory": spark.conf.get("spark.driver.memory", "1g"),
            "driver_jvm_max_mb": jvm.maxMemory() >> 20,
            "driver_jvm_used_mb": (jvm.totalMemory() - jvm.freeMemory()) >> 20,
            "driver_python_peak_mb": resource.getrusage(resource.RUSAGE_SELF).ru_maxrss >> 10}


def write_observed(spark: SparkSession, source: str, derive: Callable[[DataFrame], DataFrame], name: str,
                   measures: dict[str, Column]) -> tuple[DataFrame, dict]:
    """``derive`` of the parquet table ``source``, written, and ``measures`` (aggregates
    of its rows) taken while it is written: no job of their own.

    It runs in a session of its own with the settings of ``spark``: a session that
    has observed can't send a fitted model with its training summary to tasks."""
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if k.startswith(("spark.sql.", "spark.txnlab.")) and spark.conf.isModifiable(k):
            own.conf.set(k, v)
    seen, path = Observation(name), shared_dir(spark, name)
    out = derive(own.read.parquet(source))
    out.observe(seen, *[m.alias(k) for k, m in measures.items()]).write.parquet(path)
    return spark.read.parquet(path), seen.get


def split_measures(names=C.SPLIT_NAMES, label: str = C.LABEL, split: str = "split") -> dict[str, Column]:
    """Rows, positives and rows without a label of each split, for ``write_observed``."""
    out = {}
    for s in names:
        here = F.col(split) == s
        out[f"{s}_rows"] = F.count_if(here)
        out[f"{s}_positives"] = F.count_if(here & (F.col(label) == 1))
        out[f"{s}_nulls"] = F.count_if(here & F.col(label).isNull())
    return out


def split_counts_of(spark: SparkSession, seen: dict, names=C.SPLIT_NAMES) -> DataFrame:
    """A13 from what ``split_measures`` saw: ``split, rows, positives, pos_ratio``."""
    rows = [(s, seen[f"{s}_rows"], seen[f"{s}_positives"]) for s in names if seen[f"{s}_rows"]]
    df = spark.createDataFrame(rows, "split string, rows long, positives long")
    return df.withColumn("pos_ratio", F.coalesce(ratio6("positives", "rows"), F.lit(0.0)))


def run_record(spark: SparkSession, frames: dict[str, DataFrame], fit_seconds: float | None = None,
               with_timestamp: bool = True) -> DataFrame:
    """Master, default parallelism, partitions and rows per partition
    summary of each named frame, driver memory and the fit time.  One row per frame."""
    sc = spark.sparkContext
    memory = driver_memory(spark)
    out = None
    for name, df in frames.items():
        sizes = partition_sizes(df, name).agg(
            F.count(F.lit(1)).alias("nonempty_partitions"),
            F.coalesce(F.min("rows"), F.lit(0)).alias("min_partition_rows"),
            F.coalesce(F.max("rows"), F.lit(0)).alias("max_partition_rows"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        )
        row = sizes.select(
            F.lit(sc.master).alias("spark_master"),
            F.lit(sc.defaultParallelism).alias("default_parallelism"),
            F.lit(name).alias("frame"),
            F.lit(df.rdd.getNumPartitions()).alias("partitions"),
            "nonempty_partitions", "min_partition_rows", "max_partition_rows", "rows",
            F.lit(fit_seconds).cast("double").alias("fit_seconds"),
            *[F.lit(v).alias(k) for k, v in memory.items()],
        )
        out = row if out is None else out.unionByName(row)
    if with_timestamp:
        out = out.withColumn("timestamp", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss"))
    return out


@contextmanager
def cached(*frames: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Persist frames that several actions re-use, and always release them.

    Cached blocks lost with an executor are recomputed from lineage.
    """
    held = [f.persist(level) for f in frames]
    try:
        yield held if len(held) != 1 else held[0]
    finally:
        for f in held:
            f.unpersist()
