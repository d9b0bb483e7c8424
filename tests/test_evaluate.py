"""Evaluation operators: edge inputs (FIXTURES F6) and properties."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from txnlab.functions.columns import grid_bucket
from txnlab.operators import evaluate as E

SCHEMA = "score double, label int"


def scored(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def brute_curve(rows, c_fp=1.0, c_fn=25.0):
    out = []
    for i in range(1, 100):
        t = i / 100
        fp = sum(1 for s, y in rows if s >= t and y == 0)
        fn = sum(1 for s, y in rows if s < t and y == 1)
        out.append((t, fp, fn, fp * c_fp + fn * c_fn))
    return out


def test_grid_points_fall_in_their_own_bucket(spark):
    vals = [0.29, 0.57, 0.58, 0.01, 0.99, 1.0, 0.0, 0.285, 0.5799999]
    df = spark.createDataFrame([(v,) for v in vals], "s double")
    got = {r.s: r.b for r in df.select("s", grid_bucket("s").alias("b")).collect()}
    for v in vals:
        assert got[v] == sum(1 for i in range(1, 100) if i / 100 <= v)


def test_cost_curve_matches_brute_force(spark):
    rows = [(0.29, 0), (0.29, 1), (0.57, 0), (0.58, 1), (0.5, 0), (0.5, 1), (0.95, 1), (0.05, 0), (1.0, 0)]
    got = [tuple(r) for r in E.cost_curve(scored(spark, rows)).orderBy("threshold").collect()]
    assert got == brute_curve(rows)


def test_best_threshold_ties_go_low_and_empty_gives_no_row(spark):
    rows = [(0.9, 1), (0.1, 0)]
    b = E.best_threshold(E.cost_curve(scored(spark, rows), with_rows=True)).first()
    assert b.tau_star == 0.11 and b.min_cost == 0.0
    empty = scored(spark, [])
    assert E.best_threshold(E.cost_curve(empty, with_rows=True)).count() == 0


def test_confusion_and_zero_predicted_positives(spark):
    rows = [(0.1, 1), (0.2, 0), (0.3, 0)]
    c = E.prf(E.confusion(scored(spark, rows), 0.5)).first()
    assert (c.tp, c.fp, c.tn, c.fn) == (0, 0, 2, 1)
    assert (c.precision, c.recall, c.f1) == (0.0, 0.0, 0.0)


def test_auc_with_ties_and_one_class(spark):
    rows = [(0.5, 1), (0.5, 0), (0.9, 1), (0.1, 0)]
    r = E.auc_metrics(scored(spark, rows)).first()
    # pairs: (0.9 vs 0.5) 1, (0.9 vs 0.1) 1, (0.5 vs 0.5) 0.5, (0.5 vs 0.1) 1 -> 3.5 / 4
    assert r.roc_auc == pytest.approx(0.875)
    one = E.auc_metrics(scored(spark, [(0.2, 1), (0.4, 1)])).first()
    assert one.roc_auc is None and one.pr_auc is None


def test_auc_matches_mllib_exact(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    df = spark.range(0, 4000).select(
        (F.abs(F.sin("id")) * 0.999).alias("score"),
        (F.abs(F.cos(F.col("id") * 7)) > 0.8).cast("int").alias("label"),
    ).withColumn("score", F.round("score", 3))
    ours = E.auc_metrics(df, n_buckets=5).first()
    raw = df.select(F.array(1 - F.col("score"), F.col("score")).alias("a"), F.col("label").cast("double").alias("label"))
    from pyspark.ml.functions import array_to_vector

    raw = raw.select(array_to_vector("a").alias("rawPrediction"), "label")
    ev = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction", numBins=0)
    assert ours.roc_auc == pytest.approx(ev.setMetricName("areaUnderROC").evaluate(raw), abs=1e-6)
    assert ours.pr_auc == pytest.approx(ev.setMetricName("areaUnderPR").evaluate(raw), abs=1e-6)


def test_roc_points_are_monotone_and_anchored(spark):
    df = spark.range(0, 500).select((F.col("id") % 37 / 37.0).alias("score"),
                                    (F.col("id") % 3 == 0).cast("int").alias("label"))
    pts = sorted((r.fpr, r.tpr) for r in E.roc_points(df, n_buckets=4).collect())
    assert pts[0] == (0.0, 0.0) and pts[-1] == (1.0, 1.0)
    assert all(b[1] >= a[1] for a, b in zip(pts, pts[1:]))


def test_weighted_curve_scales_negatives(spark):
    df = spark.createDataFrame([(0.9, 0, 10.0), (0.2, 1, 1.0)], "score double, label int, w double")
    c = E.cost_curve(df, weight_col="w").filter(F.col("threshold") == 0.5).first()
    assert (c.fp_count, c.fn_count, c.total_cost) == (10.0, 1.0, 35.0)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 100), st.integers(0, 1)), min_size=1, max_size=40))
def test_curve_properties(spark, pairs):
    rows = [(s / 100.0, y) for s, y in pairs]
    curve = [tuple(r) for r in E.cost_curve(scored(spark, rows)).orderBy("threshold").collect()]
    assert curve == brute_curve(rows)
    fps = [c[1] for c in curve]
    fns = [c[2] for c in curve]
    assert fps == sorted(fps, reverse=True) and fns == sorted(fns)


def test_auc_invariant_under_increasing_map(spark):
    df = spark.range(0, 800).select((F.abs(F.sin("id"))).alias("score"),
                                    (F.col("id") % 4 == 0).cast("int").alias("label"))
    a = E.roc_auc(df).first().roc_auc
    b = E.roc_auc(df.withColumn("score", F.col("score") * F.col("score") * 0.5 + 0.1)).first().roc_auc
    assert a == b


def test_metrics_record_and_targets(spark):
    rows = [(0.9, 1), (0.8, 0), (0.3, 1), (0.1, 0)]
    rec = E.metrics_record(scored(spark, rows), 0.5).first()
    assert (rec.tp, rec.fp, rec.tn, rec.fn) == (1, 1, 1, 1)
    t = {r.metric: r.met for r in E.targets(E.metrics_long(E.metrics_record(scored(spark, rows), 0.5))).collect()}
    assert t == {"roc_auc": False, "recall": False, "precision": False}


def test_hot_score_value_a_third_of_rows(spark):
    """One score holding a third of all rows is one row after the per-score
    grouping; AUC and curve still equal brute force."""
    import random

    rng = random.Random(7)
    rows = [(0.0, rng.random() < 0.05) for _ in range(3000)]
    rows += [(round(rng.random(), 3), rng.random() < 0.2) for _ in range(6000)]
    rows = [(s, int(y)) for s, y in rows]
    df = scored(spark, rows)
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert E.roc_auc(df, n_buckets=4).first().roc_auc == pytest.approx(wins / (len(pos) * len(neg)), abs=1e-6)
    got = [tuple(r) for r in E.cost_curve(df).orderBy("threshold").collect()]
    assert got == brute_curve(rows)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 100), st.integers(0, 1)), min_size=1, max_size=50))
def test_confusion_totals_property(spark, pairs):
    rows = [(s / 100.0, y) for s, y in pairs]
    P = sum(y for _, y in rows)
    N = len(rows) - P
    for r in E.threshold_counts(scored(spark, rows)).collect():
        assert r.tp + r.fn == P and r.fp + r.tn == N


def test_ratios_with_fractional_weights(spark):
    df = spark.createDataFrame([(0.9, 1, 1 / 0.3), (0.9, 0, 1 / 0.3), (0.1, 1, 1.0)], "score double, label int, w double")
    c = E.prf(E.confusion(df, 0.5, weight_col="w")).first()
    # tp = fp = 3.333..., fn = 1
    assert c.precision == 0.5
    assert c.recall == pytest.approx(round((1 / 0.3) / (1 / 0.3 + 1), 6))


def test_binned_split_counts_keep_grid_confusion(spark):
    from txnlab.plans import decide as DP

    df = spark.range(0, 5000).select(
        F.when(F.col("id") % 2 == 0, "validation").otherwise("test").alias("split"),
        (F.abs(F.sin(F.col("id") * 1.7))).alias("score"),
        (F.abs(F.cos(F.col("id"))) > 0.9).cast("int").alias("label"),
    )
    exact = DP.validate_then_test(DP.split_counts_table(df)).first()
    pooled = DP.validate_then_test(DP.split_counts_table(df, bins=1_000_000)).first()
    assert (exact.tau_star, exact.tp, exact.fp, exact.tn, exact.fn) == \
        (pooled.tau_star, pooled.tp, pooled.fp, pooled.tn, pooled.fn)
    assert abs(exact.roc_auc - pooled.roc_auc) < 1e-4


def test_cost_curve_at_given_thresholds(spark):
    rows = [(0.29, 0), (0.29, 1), (0.57, 0), (0.58, 1), (0.5, 0), (0.5, 1), (0.95, 1), (0.05, 0), (1.0, 0)]
    taus = [0.57, 0.29, 0.5, 0.999]
    got = [tuple(r) for r in E.cost_curve(scored(spark, rows), taus=taus).orderBy("threshold").collect()]
    want = []
    for t in sorted(taus):
        fp = sum(1 for s, y in rows if s >= t and y == 0)
        fn = sum(1 for s, y in rows if s < t and y == 1)
        want.append((t, fp, fn, fp * 1.0 + fn * 25.0))
    assert got == want


def test_best_threshold_by_ratio_matches_brute_force(spark):
    rows = [(0.15, 1), (0.35, 0), (0.55, 1), (0.75, 0), (0.95, 1), (0.05, 0), (0.62, 0)]
    got = {r.fn_cost_ratio: (r.tau_star, r.min_cost) for r in
           E.best_threshold_by_ratio(scored(spark, rows), ratios=(1.0, 3.0, 50.0)).collect()}
    for ratio in (1.0, 3.0, 50.0):
        curve = brute_curve(rows, 1.0, ratio)
        best = min(curve, key=lambda c: (c[3], c[0]))
        assert got[ratio] == (best[0], best[3])


def test_pooled_scores_never_cross_grid_thresholds(spark):
    import math

    vals = []
    for i in range(1, 100):
        t = i / 100
        vals += [t, math.nextafter(t, 0.0), math.nextafter(t, 1.0)]
    rows = [(v, k % 2) for k, v in enumerate(vals)]
    df = scored(spark, rows)
    pooled = E.counts_as_rows(E.score_counts(df, mode="binned", bins=1_000_000))
    a = [tuple(r) for r in E.threshold_counts(df).orderBy("threshold").collect()]
    b = [tuple(r) for r in E.threshold_counts(pooled, weight_col="n").orderBy("threshold").collect()]
    assert a == b
