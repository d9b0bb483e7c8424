"""Pooled blocks: isotonic calibration and the thresholds that are best at some cost ratio."""

import math
import random

import numpy as np
import pytest

from txnlab.operators import hull as H

SCHEMA = "score double, label int"


def plain_pav(rows):
    """Value of each distinct score: the least squares non-decreasing fit, by the
    min-max formula on running sums."""
    per = {}
    for x, y in rows:
        n, p = per.get(x, (0, 0))
        per[x] = (n + 1, p + y)
    xs = sorted(per)
    w = np.concatenate([[0], np.cumsum([per[x][0] for x in xs])])
    s = np.concatenate([[0], np.cumsum([per[x][1] for x in xs])])
    out = {}
    for i, x in enumerate(xs):
        worst = [min((s[k + 1] - s[j]) / (w[k + 1] - w[j]) for k in range(i, len(xs))) for j in range(i + 1)]
        out[x] = max(worst)
    return out


def blocks_of(df, **kw):
    return sorted(tuple(r) for r in H.score_blocks(df, **kw).select("lo", "hi", "n", "pos").collect())


def odd_scores():
    rng = random.Random(4)
    rows = [(round(rng.random(), 2), int(rng.random() < 0.3)) for _ in range(400)]
    return rows + [(0.5, 1)] * 200 + [(-0.0, 0), (0.0, 1), (math.inf, 1), (-math.inf, 0)]


@pytest.mark.parametrize("ranges", [1, 5, 200])
def test_blocks_are_the_isotonic_fit(spark, ranges):
    rows = odd_scores()
    df = spark.createDataFrame(rows + [(None, 1), (math.nan, 1), (0.4, None)], SCHEMA)
    got = blocks_of(df, n_buckets=ranges)
    assert sum(b[2] for b in got) == len(rows) and sum(b[3] for b in got) == sum(y for _, y in rows)
    rates = [p / n for _, _, n, p in got]
    assert all(a < b for a, b in zip(rates, rates[1:]))
    for x, v in plain_pav([(x + 0.0, y) for x, y in rows]).items():
        block = [b for b in got if b[0] <= x <= b[1]]
        assert len(block) == 1 and abs(block[0][3] / block[0][2] - v) < 1e-12


def test_a_hundred_thousand_scores_in_a_tree(spark, monkeypatch):
    """Many ranges and several levels give the blocks of one stack."""
    monkeypatch.setattr(H, "FAN", 4)
    df = spark.range(100_000).selectExpr("id / 100000D AS score", "CAST(pmod(xxhash64(id), 1000) < id / 150 AS int) AS label")
    rows = sorted((r.score, r.label) for r in df.collect())
    want = [tuple(b) for b in H.pool((x, x, 1, y) for x, y in rows)]
    assert len(want) > 20
    assert blocks_of(df, n_buckets=40) == want


def test_weights_and_empty(spark):
    df = spark.createDataFrame([(0.1, 1, 3), (0.1, 0, 1), (0.7, 1, 2), (0.9, 0, 0)], "score double, label int, n int")
    assert blocks_of(df, weight_col="n") == [(0.1, 0.1, 4, 3), (0.7, 0.7, 2, 2)]
    none = spark.createDataFrame([(None, 1)], SCHEMA)
    assert blocks_of(none) == []
    out = H.apply_isotonic_steps(H.score_blocks(none), spark.createDataFrame([(0.3, 1)], SCHEMA))
    assert [tuple(r) for r in out.collect()] == [(None, 1)]
    assert H.optimal_thresholds(H.score_blocks(none)).collect() == []


@pytest.mark.parametrize("at_once", [10**6, 2])
def test_calibration_is_drawn_between_blocks(spark, at_once):
    fit = spark.createDataFrame([(0.2, 0), (0.2, 1), (0.3, 0), (0.6, 1), (0.6, 0), (0.6, 1), (0.9, 1), (0.95, 1)], SCHEMA)
    blocks = H.score_blocks(fit)
    x, y = [0.2, 0.3, 0.6, 0.6, 0.9, 0.95], [1 / 3, 1 / 3, 2 / 3, 2 / 3, 1, 1]
    asked = [0.0, 0.2, 0.25, 0.3, 0.45, 0.6, 0.7, 0.9, 0.93, 2.0, 0.45, None, math.nan]
    scored = spark.createDataFrame([(i, s, "k") for i, s in enumerate(asked)], "id int, score double, _x string")
    out = {r.id: r for r in H.apply_isotonic_steps(blocks, scored, at_once=at_once).collect()} if at_once > 2 else {
        r.id: r for r in H.apply_isotonic_steps(blocks, scored.drop("_x"), at_once=at_once).collect()}
    for i, s in enumerate(asked):
        if s is None:
            assert out[i].score is None
        elif s != s:
            assert out[i].score is None or out[i].score != out[i].score
        else:
            assert abs(out[i].score - np.interp(s, x, y)) < 1e-12


def test_thresholds_agree_with_brute_force_at_a_thousand_ratios(spark):
    rows = [r for r in odd_scores() if math.isfinite(r[0])]
    corners = H.optimal_thresholds(H.score_blocks(spark.createDataFrame(rows, SCHEMA)))
    ratios = sorted({round(1.013 ** i / 50, 4) for i in range(1000)})
    got = {r.ratio: r for r in H.best_threshold_at(corners, ratios).collect()}
    assert len(got) == len(ratios)
    every = sorted({x for x, _ in rows})
    counts = [(x, sum(s >= x and y == 0 for s, y in rows), sum(s < x and y == 1 for s, y in rows)) for x in every]
    counts.append((None, 0, sum(y for _, y in rows)))
    for ratio in ratios:
        least = min(fp + ratio * fn for _, fp, fn in counts)
        assert abs(got[ratio].cost - least) < 1e-9
        assert (got[ratio].threshold, got[ratio].fp_count, got[ratio].fn_count) in counts
    whole = sorted((r.ratio_from, math.inf if r.ratio_to is None else r.ratio_to) for r in corners.collect())
    assert whole[0][0] == 0 and whole[-1][1] == math.inf  # without gaps
    assert all(a[1] == b[0] for a, b in zip(whole, whole[1:]))


def test_thresholds_without_positives_or_negatives(spark):
    only = H.optimal_thresholds(H.score_blocks(spark.createDataFrame([(0.1, 0), (0.2, 0)], SCHEMA))).collect()
    assert [(r.threshold, r.fn_count, r.ratio_from, r.ratio_to) for r in only] == [(None, 0, 0.0, None)]
    only = H.optimal_thresholds(H.score_blocks(spark.createDataFrame([(0.1, 1), (0.2, 1)], SCHEMA))).collect()
    assert [(r.threshold, r.fp_count, r.fn_count, r.ratio_from, r.ratio_to) for r in only] == [(0.1, 0, 0, 0.0, None)]
