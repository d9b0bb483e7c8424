"""Stored, mergeable profiles: quantiles, distinct counts and overlaps of tables
that grow load by load.

A load is profiled once, in one aggregation without an Expand: a KLL sketch
(quantiles), and HyperLogLog and theta sketches (distinct values) for every column
and part.  The rows of sketches are appended to a table beside the data; any set
of parts is then answered by merging some kilobytes a part, and a new load
adds its own rows without the old ones being read again.

Errors: a KLL sketch of parameter k is off by about 2.3 / k of the rank (k = 800:
0.3 %); a HyperLogLog sketch of 2^17 registers and a theta sketch of 2^17 entries
by about 0.3 % of the count (the latter is exact below that many values), an
overlap by that of the union.  Null and NaN are no values, as in the exact
operators; a column without values has a sketch of none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlab.functions.columns import ratio6
from txnlab.operators.ranking import number

KLL_K = 800
HLL_BITS = 17
THETA_BITS = 17


def profile_sketches(df: DataFrame, numeric=(), ids=(), by: Column | None = None) -> DataFrame:
    """``part, column, n, kll, hll, theta``: one row per part (``by``; one part without
    it) and column; numeric columns have a KLL sketch, ids the other two."""
    part = (F.lit("all") if by is None else by.cast("string")).alias("part")
    aggs, items = [], []
    none = F.lit(None).cast("binary")
    for i, c in enumerate(numeric):
        x = number(f"`{c}`")
        aggs += [F.count(x).alias(f"n{i}"), F.kll_sketch_agg_double(x, F.lit(KLL_K)).alias(f"k{i}")]
        items.append(F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n"), F.col(f"k{i}").alias("kll"),
                              none.alias("hll"), none.alias("theta")))
    for i, c in enumerate(ids):
        x = F.col(f"`{c}`").cast("string")
        aggs += [F.count(x).alias(f"d{i}"), F.hll_sketch_agg(x, F.lit(HLL_BITS)).alias(f"h{i}"),
                 F.theta_sketch_agg(x, F.lit(THETA_BITS)).alias(f"t{i}")]
        items.append(F.struct(F.lit(c).alias("column"), F.col(f"d{i}").alias("n"), none.alias("kll"),
                              F.col(f"h{i}").alias("hll"), F.col(f"t{i}").alias("theta")))
    wide = df.groupBy(part).agg(*aggs)
    return wide.select("part", F.explode(F.array(*items)).alias("x")).select("part", "x.*")


def append_sketches(sketches: DataFrame, path: str) -> str:
    """Add a load's rows to the stored profile."""
    sketches.write.mode("append").parquet(path)
    return path


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("part string, column string, n long, kll binary, hll binary, theta binary").parquet(path)


def merged_quantiles(sketches: DataFrame, probs) -> DataFrame:
    """A5: ``column, prob, n, value`` over all given parts."""
    probs = [float(p) for p in probs]
    used = sketches.filter("kll IS NOT NULL").groupBy("column").agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double(F.when(F.col("n") > 0, F.col("kll"))).alias("kll"))
    at = F.array(*[F.lit(p) for p in probs])
    q = F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("kll", at))
    out = used.select("column", "n", F.posexplode_outer(q).alias("i", "value"))
    whole = used.select("column", "n", F.posexplode(at).alias("i", "prob"))
    return whole.join(out.select("column", "i", "value"), ["column", "i"], "left").select("column", "prob", "n", "value")


def merged_cardinality(sketches: DataFrame) -> DataFrame:
    """``column, n, distinct_count, distinct_ratio`` over all given parts."""
    d = sketches.filter("hll IS NOT NULL").groupBy("column").agg(F.sum("n").alias("n"), F.hll_union_agg("hll").alias("hll"))
    d = d.select("column", "n", F.hll_sketch_estimate("hll").alias("distinct_count"))
    return d.withColumn("distinct_ratio", ratio6("distinct_count", "n"))


def merged_overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    """``column, distinct_a, distinct_b, in_both, in_either``: distinct ids of two
    sets of parts, and how many they share."""
    def side(s, name):
        return s.filter("theta IS NOT NULL").groupBy("column").agg(F.theta_union_agg("theta", F.lit(THETA_BITS)).alias(name))
    both = side(a, "a").join(side(b, "b"), "column")
    est = F.theta_sketch_estimate
    return both.select("column", est("a").alias("distinct_a"), est("b").alias("distinct_b"),
                       est(F.theta_intersection("a", "b")).alias("in_both"),
                       est(F.theta_union("a", "b", F.lit(THETA_BITS))).alias("in_either"))
