"""A2 over a table that grows load by load: duplicates within a load and against
all earlier ones, without the old rows being read again.

Beside the data stands a table of the distinct row hashes (128 bits), by load and
hash prefix, and a Bloom filter in blocks of 4 KB: a hash belongs to one block and
sets ``PROBES`` of its bits.  A new load is hashed and grouped (a hot row is one
row per task before any shuffle); its hashes meet the merged blocks, two bytes per
old row, and only those that may be stored meet the hash table, of which prefixes
without any are pruned.  What the filter lets through wrongly is sorted out
there, so ``capacity`` sets its size and error, never the answer.

A load's hashes and blocks are written under its name and count only once its
report is there, which is written last: a load that broke off is written anew.
Loads are merged one after another.  Equal rows are those equal in all columns,
null equal to null; two rows with one 128-bit hash would count as equal.
"""

from __future__ import annotations

import math
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlab.session import materialize

PREFIXES = 64
BLOCK_BITS = 32_768  # what bitmap_construct_agg builds
PROBES = 4
BITS_PER_ROW = 16
REPORT = "load string, rows long, repeated_within long, repeated_earlier long"


def row_hashes(df: DataFrame, cols=None) -> DataFrame:
    """``h1, h2, n``: the distinct row hashes and how many rows have each."""
    cols = [F.col(f"`{c}`") for c in (cols or df.columns)]
    # hashing passes over nulls, so where they stand is hashed too
    nulls = F.array(*[c.isNull() for c in cols])
    hashed = df.select(F.xxhash64(*cols, nulls).alias("h1"), F.xxhash64(F.lit("2"), nulls, *cols).alias("h2"))
    return hashed.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"))


def n_blocks(capacity: int) -> int:
    return max(1, math.ceil(capacity * BITS_PER_ROW / BLOCK_BITS))


def _block(blocks: int) -> Column:
    return F.pmod("h2", F.lit(blocks)).alias("block")


def _probe(i: int) -> Column:
    """15 bits of the first hash."""
    return F.shiftrightunsigned("h1", 15 * i).bitwiseAND(BLOCK_BITS - 1).cast("int")


def filter_blocks(hashes: DataFrame, blocks: int) -> DataFrame:
    """``block, bits``: the Bloom filter of ``hashes``; blocks without a hash have no row."""
    at = hashes.select(_block(blocks), F.explode(F.array(*[_probe(i) for i in range(PROBES)])).alias("at"))
    return at.groupBy("block").agg(F.bitmap_construct_agg(F.col("at")).alias("bits"))


def maybe_stored(hashes: DataFrame, filters: DataFrame, blocks: int) -> DataFrame:
    """The rows of ``hashes`` that the merged filters don't rule out."""
    merged = filters.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits")).withColumnRenamed("block", "_block")
    here = F.lit(True)
    for i in range(PROBES):
        byte = F.conv(F.hex(F.substring("bits", (F.shiftright(_probe(i), 3) + 1), F.lit(1))), 16, 10).cast("int")
        here = here & (F.call_function("getbit", byte, _probe(i).bitwiseAND(7)) == 1)
    return hashes.withColumn("_b", _block(blocks)).join(merged, (F.col("_b") == F.col("_block")) & here, "left_semi").drop("_b")


def _stored(spark: SparkSession, store: str, kind: str, schema: str, loads: list[str]) -> DataFrame:
    if not loads:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(os.path.join(store, kind)).filter(F.col("load").isin(loads))


def load_report(spark: SparkSession, store: str) -> DataFrame:
    """``load, rows, repeated_within, repeated_earlier``: one row per merged load.  The
    sum of the last two is A2 of all loads together."""
    try:
        return spark.read.schema(REPORT).parquet(os.path.join(store, "report"))
    except Exception as e:  # no load yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], REPORT)


def merge_load(df: DataFrame, store: str, load: str, cols=None, capacity: int = 1_000_000_000) -> DataFrame:
    """Count the duplicates of the load ``df`` and add its new rows' hashes to ``store``;
    the report of all loads so far.  A load that is there already is not merged again.

    ``capacity``: distinct rows that the store's filter is made for, the same for all
    of its loads."""
    spark, blocks = df.sparkSession, n_blocks(capacity)
    done = [r.load for r in load_report(spark, store).select("load").collect()]  # a row per load
    if load in done:
        return load_report(spark, store)
    prefix = F.pmod("h1", F.lit(PREFIXES)).cast("int").alias("prefix")
    own = materialize(row_hashes(df, cols).select("*", prefix), "load-hashes")
    known = _stored(spark, store, "hashes", "h1 long, h2 long, load string, prefix int", done)
    filters = _stored(spark, store, "filter", "block long, bits binary, load string", done)
    maybe = materialize(maybe_stored(own, filters, blocks), "load-candidates")
    found = materialize(maybe.join(known, ["prefix", "h1", "h2"], "left_semi").select("h1", "h2"), "load-found")
    fresh = own.join(found, ["h1", "h2"], "left_anti")

    def put(table: DataFrame, kind: str, *by: str):
        table.write.mode("overwrite").partitionBy(*by).parquet(os.path.join(store, kind, f"load={load}"))
    put(fresh.select("h1", "h2", "prefix").repartition("prefix", F.pmod("h2", F.lit(8))), "hashes", "prefix")
    filter_blocks(fresh, blocks).write.mode("overwrite").parquet(os.path.join(store, "filter", f"load={load}"))
    counts = own.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
                     F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeated_within"))
    earlier = found.agg(F.count(F.lit(1)).alias("repeated_earlier"))
    counts = counts.select("rows", "repeated_within", earlier.scalar().alias("repeated_earlier"))
    counts.coalesce(1).write.mode("overwrite").parquet(os.path.join(store, "report", f"load={load}"))
    return load_report(spark, store)
