"""A join whose heavy keys are split (the contingency for skewed data).

The keys of the large side are counted first (partial sums: a hot key is one row
per task).  A key is heavy with more than ``1 / HEAVY`` of all rows, so there are
fewer than ``HEAVY`` of them and their table may be broadcast whatever the input.
Each heavy key gets as many salts as its rows make tasks of average size; its rows
are dealt over the salts, and the other side's rows of that key are repeated once
for each.  All other keys join as ever.  A large row meets each of its matches in
one place, so inner, left, left_semi and left_anti joins give the plain result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAVY = 1_000
_SALT, _N = "_salt", "_salts"


def heavy_keys(df: DataFrame, keys: list[str], tasks: int, heavy: int = HEAVY) -> DataFrame:
    """``keys`` and how many salts each heavy one gets: its share of ``tasks``, and one more."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = df.count()
    return counts.filter(F.col("_n") > total / heavy).select(
        *keys, (F.ceil(F.col("_n") * tasks / max(1, total)) + 1).cast("int").alias(_N))


def salted_join(large: DataFrame, other: DataFrame, keys: str | list[str], how: str = "inner",
                tasks: int | None = None, heavy: int = HEAVY) -> DataFrame:
    """``large.join(other, keys, how)`` with heavy keys of ``large`` dealt over tasks.

    Rows are dealt by their place in the input; read a written table, so that a
    lost task deals them alike when it runs again.  Null keys match nothing, and
    are dealt too where the join keeps them."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unknown join {how!r}")
    keys = [keys] if isinstance(keys, str) else list(keys)
    spark = large.sparkSession
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    salts = heavy_keys(large, keys, tasks, heavy)
    renamed = salts.select(*[F.col(k).alias(f"_k_{k}") for k in keys], _N)
    same = None
    for k in keys:
        eq = F.col(f"`{k}`").eqNullSafe(F.col(f"_k_{k}"))
        same = eq if same is None else same & eq
    # fewer than `heavy` rows
    left = large.join(F.broadcast(renamed), same, "left")
    place = F.pmod(F.monotonically_increasing_id(), F.coalesce(_N, F.lit(1))).cast("int")
    left = left.withColumn(_SALT, place).drop(_N, *[f"_k_{k}" for k in keys])
    right = other.join(F.broadcast(salts), keys, "left")
    each = F.explode(F.sequence(F.lit(0), F.coalesce(_N, F.lit(1)) - 1))
    right = right.withColumn(_SALT, each).drop(_N)
    return left.join(right, [*keys, _SALT], how).drop(_SALT)
