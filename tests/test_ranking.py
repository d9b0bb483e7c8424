"""Two-level running totals and exact quantiles equal their one-task definitions."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from txnlab.operators.ranking import exact_quantiles, running_totals


@pytest.mark.parametrize("k", [1, 2, 7, 25])
@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_match_global_window(spark, k, descending):
    df = spark.range(0, 3000).select(
        (F.col("id") % 3).cast("string").alias("g"),
        (F.sin(F.col("id")) * 1000).alias("v"),
        (F.col("id") % 5).cast("double").alias("w"),
    ).dropDuplicates(["g", "v"])
    got = running_totals(df, "v", ["w"], group_cols=["g"], descending=descending, n_buckets=k)
    order = F.col("v").desc() if descending else F.col("v").asc()
    w = Window.partitionBy("g").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("g", "v", F.sum("w").over(w).alias("want"))
    j = got.join(want, ["g", "v"])
    assert j.count() == df.count()
    assert j.filter(F.abs(F.col("cum_w") - F.col("want")) > 1e-9).count() == 0


@pytest.mark.parametrize("k", [1, 5])
def test_exact_quantiles_match_percentile(spark, k):
    df = spark.range(0, 2001).select(
        (F.col("id") % 97).cast("double").alias("a"), (F.col("id") * 1.5 - 100).alias("b")
    )
    probs = [0.0, 0.01, 0.5, 0.9, 0.99, 1.0]
    got = {(r.column, r.prob): r.value for r in exact_quantiles(df, ["a", "b"], probs, n_buckets=k).collect()}
    for c in ("a", "b"):
        want = df.agg(F.percentile(c, probs).alias("p")).first().p
        for p, v in zip(probs, want):
            assert abs(got[(c, p)] - v) < 1e-9, (c, p)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(min_value=-50, max_value=50), min_size=1, max_size=60),
       st.sampled_from([0.0, 0.25, 0.5, 0.75, 0.9, 1.0]))
def test_exact_quantile_property(spark, values, p):
    import numpy as np

    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = exact_quantiles(df, ["x"], [p], n_buckets=3).first().value
    assert abs(got - float(np.quantile(np.array(values, dtype=float), p))) < 1e-9
