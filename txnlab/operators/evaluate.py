"""Threshold choice and evaluation as distributed aggregations.

Input convention: a *scored* frame with ``score`` (double) and ``label``
(0/1 int), optionally a per-row ``weight`` (e.g. ``1/fraction`` after D4).

* Cost curve, best threshold and the confusion counts at every grid point come
  from one aggregation to at most ``2 x steps`` (bucket, label) counts; the
  scan over the grid runs on that tiny table, never on rows.
* ROC/PR points and exact AUCs come from per-score counts and two-level
  running totals (``ranking.running_totals``): no global sort in one task and
  nothing collected.
* Table-wide numbers (tau*, totals) enter other plans as scalar subqueries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnlab import config as C
from txnlab.functions.columns import exact_floor, grid_bucket, r6, ratio6
from txnlab.operators.ranking import running_totals
from txnlab.session import materialize

SCORE, LABEL = "score", "label"


def _w(weight_col: str | None) -> Column:
    # a weight keeps its type: an integral multiplicity (``counts_as_rows``)
    # gives integral counts, a fractional weight (1/fraction) gives doubles
    return F.col(weight_col) if weight_col else F.lit(1)


def _pos(label: str, weight_col: str | None) -> Column:
    return F.sum(F.when(F.col(label) == 1, _w(weight_col)).otherwise(F.lit(0)))


def _neg(label: str, weight_col: str | None) -> Column:
    return F.sum(F.when(F.col(label) == 0, _w(weight_col)).otherwise(F.lit(0)))


def scored_rows(scored: DataFrame, score: str = SCORE) -> DataFrame:
    """The rows every evaluation operator counts: those whose score is a number.

    A null or NaN score is no score: such rows are in no bucket, no confusion
    cell and no curve, at any input size; ``unscored_count`` reports them.
    """
    s = F.col(score).cast("double")
    return scored.filter(s.isNotNull() & ~F.isnan(s))


def unscored_count(scored: DataFrame, score: str = SCORE) -> DataFrame:
    """Rows, and those left out of every metric because their score is null or NaN."""
    s = F.col(score).cast("double")
    return scored.agg(F.count(F.lit(1)).alias("rows"), F.count_if(s.isNull() | F.isnan(s)).alias("unscored_rows"))


# --------------------------------------------------------------------- E1, E2
def threshold_counts(scored: DataFrame, steps: int = C.GRID_STEPS, score: str = SCORE, label: str = LABEL,
                     weight_col: str | None = None, taus=None) -> DataFrame:
    """TP/FP/TN/FN at every grid threshold i/steps, i = 1..steps-1, or at the
    given sorted thresholds ``taus``.

    One aggregation to (bucket) counts; bucket b holds scores with exactly b
    thresholds <= score.  At threshold i the positives are buckets >= i.
    """
    scored = scored_rows(scored, score)
    if taus is not None:
        from pyspark.ml.feature import Bucketizer

        taus = sorted({float(t) for t in taus})
        splits = [float("-inf")] + taus + [float("inf")]
        b = Bucketizer(splits=splits, inputCol="_s", outputCol="_b", handleInvalid="keep").transform(
            scored.withColumn("_s", F.col(score).cast("double")))
        keyed = b.withColumn("bucket", F.col("_b").cast("int"))
        n_buckets = len(taus) + 1
    else:
        keyed = scored.withColumn("bucket", grid_bucket(score, steps))
        n_buckets = steps
    counts = keyed.groupBy("bucket").agg(
        _pos(label, weight_col).alias("pos"), _neg(label, weight_col).alias("neg")
    )
    spark = scored.sparkSession
    grid = spark.range(0, n_buckets).select(F.col("id").cast("int").alias("bucket"))
    # at most `steps` bucket rows: a proven bound, so broadcast
    full = grid.join(F.broadcast(counts), "bucket", "left").na.fill(0, ["pos", "neg"])
    # at most `steps` rows: a single ordered window is bounded by the grid size
    order = Window.partitionBy(F.lit(0)).orderBy("bucket")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    zero = F.lit(0)
    curve = full.select(
        "bucket",
        F.coalesce(F.sum("pos").over(after), zero).alias("tp"),
        F.coalesce(F.sum("neg").over(after), zero).alias("fp"),
        F.coalesce(F.sum("neg").over(before), zero).alias("tn"),
        F.coalesce(F.sum("pos").over(before), zero).alias("fn"),
    )
    if taus is not None:
        threshold = F.element_at(F.array(*[F.lit(t) for t in taus]), F.col("bucket"))
    else:
        threshold = F.round(F.col("bucket").cast("double") / F.lit(float(steps)), 6)
    return curve.filter(F.col("bucket") >= 1).select(threshold.alias("threshold"), "tp", "fp", "tn", "fn")


def cost_curve(scored: DataFrame, c_fp: float = C.COST_FP, c_fn: float = C.COST_FN, steps: int = C.GRID_STEPS,
               score: str = SCORE, label: str = LABEL, weight_col: str | None = None,
               with_rows: bool = False, taus=None) -> DataFrame:
    """``threshold, fp_count, fn_count, total_cost`` (cost = c_fp FP + c_fn FN).

    ``with_rows`` keeps a ``_rows`` column so ``best_threshold`` can tell an
    empty scored set from a perfect one.
    """
    tc = threshold_counts(scored, steps, score, label, weight_col, taus)
    out = tc.select(
        "threshold",
        F.col("fp").alias("fp_count"),
        F.col("fn").alias("fn_count"),
        r6(F.col("fp") * F.lit(float(c_fp)) + F.col("fn") * F.lit(float(c_fn))).alias("total_cost"),
        (F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")).alias("_rows"),
    )
    return out if with_rows else out.drop("_rows")


def best_threshold(curve: DataFrame) -> DataFrame:
    """The threshold of least cost; ties go to the lowest threshold.

    An empty scored set gives no row (not a made-up threshold).
    """
    used = curve.filter(F.col("_rows") > 0) if "_rows" in curve.columns else curve
    best = used.agg(
        F.min_by(F.struct("threshold", "total_cost", "fp_count", "fn_count"),
                 F.struct("total_cost", "threshold")).alias("b")
    )
    return best.select(
        F.col("b.threshold").alias("tau_star"),
        F.col("b.total_cost").alias("min_cost"),
        F.col("b.fp_count").alias("fp_count"),
        F.col("b.fn_count").alias("fn_count"),
    ).filter(F.col("tau_star").isNotNull())


def best_threshold_by_ratio(scored: DataFrame, ratios=(1.0, 5.0, 25.0, 100.0), c_fp: float = C.COST_FP,
                            steps: int = C.GRID_STEPS, **kw) -> DataFrame:
    """E1 + E2 for several FN:FP cost ratios from one aggregation: the grid
    counts are computed once, then each ratio's cost is a column on the
    99-row table.  One row per ratio: ``fn_cost_ratio, tau_star, min_cost,
    fp_count, fn_count``."""
    tc = threshold_counts(scored, steps, **kw).filter(F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn") > 0)
    per = tc.select("threshold", "fp", "fn", F.explode(F.array(*[F.lit(float(r)) for r in ratios])).alias("ratio"))
    per = per.withColumn("cost", r6(F.col("fp") * F.lit(float(c_fp)) + F.col("fn") * F.col("ratio")))
    best = per.groupBy("ratio").agg(
        F.min_by(F.struct("threshold", "cost", "fp", "fn"), F.struct("cost", "threshold")).alias("b"))
    return best.select(F.col("ratio").alias("fn_cost_ratio"), F.col("b.threshold").alias("tau_star"),
                       F.col("b.cost").alias("min_cost"), F.col("b.fp").alias("fp_count"),
                       F.col("b.fn").alias("fn_count"))


def tau_star(scored: DataFrame, c_fp: float = C.COST_FP, c_fn: float = C.COST_FN, **kw) -> Column:
    """tau* of a scored set as a scalar-subquery Column (lazy, nothing collected)."""
    return best_threshold(cost_curve(scored, c_fp, c_fn, with_rows=True, **kw)).select("tau_star").scalar()


# --------------------------------------------------------------------- E3-E5, E10
def confusion(scored: DataFrame, tau, score: str = SCORE, label: str = LABEL,
              weight_col: str | None = None) -> DataFrame:
    """``tp, fp, tn, fn`` at ``tau`` (float or Column) in one aggregation."""
    scored = scored_rows(scored, score)
    t = tau if isinstance(tau, Column) else F.lit(float(tau))
    # decide in a projection, then aggregate plain columns (tau may be a
    # subquery over a model-scored, non-deterministic plan)
    decided = scored.select(
        (F.col(score) >= t).alias("_yhat"), (F.col(label) == 1).alias("_y"), _w(weight_col).alias("_w")
    )
    yhat, y, w = F.col("_yhat"), F.col("_y"), F.col("_w")

    def cnt(cond):
        return F.coalesce(F.sum(F.when(cond, w).otherwise(F.lit(0))), F.lit(0))

    return decided.agg(
        cnt(yhat & y).alias("tp"), cnt(yhat & ~y).alias("fp"), cnt(~yhat & ~y).alias("tn"), cnt(~yhat & y).alias("fn")
    )


def _prf_cols(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    """Precision, recall and F1 (= 2TP / (2TP + FP + FN)) as exact count
    ratios rounded to 6 digits; 0 when undefined."""
    zero = F.lit(0.0)
    return {
        "precision": F.coalesce(ratio6(tp, tp + fp), zero),
        "recall": F.coalesce(ratio6(tp, tp + fn), zero),
        "f1": F.coalesce(ratio6(2 * tp, 2 * tp + fp + fn), zero),
    }


def prf(conf: DataFrame) -> DataFrame:
    """Precision, recall, F1; 0 when undefined."""
    return conf.withColumns(_prf_cols(F.col("tp"), F.col("fp"), F.col("fn")))


def fbeta(conf: DataFrame, beta: float = 2.0) -> DataFrame:
    """E5: F-beta = (1+b^2) TP / ((1+b^2) TP + b^2 FN + FP); beta = 2 weighs recall higher."""
    b2 = float(beta) ** 2
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    name = f"f{beta:g}".replace(".", "_")
    if b2.is_integer():
        k = int(b2)
        fb = ratio6((1 + k) * tp, (1 + k) * tp + k * fn + fp)
    else:
        fb = r6(F.try_divide((1 + b2) * tp, (1 + b2) * tp + b2 * fn + fp))
    return conf.withColumn(name, F.coalesce(fb, F.lit(0.0)))


def cost_at(conf: DataFrame, c_fp: float = C.COST_FP, c_fn: float = C.COST_FN) -> DataFrame:
    """Business cost at the threshold the confusion counts were taken at."""
    return conf.withColumn("cost", r6(F.col("fp") * F.lit(float(c_fp)) + F.col("fn") * F.lit(float(c_fn))))


# --------------------------------------------------------------------- E6-E9
def score_counts(scored: DataFrame, score: str = SCORE, label: str = LABEL, weight_col: str | None = None,
                 mode: str = "exact", bins: int = 1000, group_cols=()) -> DataFrame:
    """Positives and negatives per distinct score (``binned``: per score bin),
    optionally per group (e.g. per split).  Partial aggregation combines a
    hot score map-side; the table has at most one row per distinct score."""
    scored = scored_rows(scored, score)
    s = F.col(score).cast("double")
    if mode == "binned":
        # exact floor on the 1/bins grid: a pooled score never crosses a
        # threshold that lies on that grid (the 0.01 grid does for bins % 100 == 0)
        s = exact_floor(s, bins).cast("double") / F.lit(float(bins))
    elif mode != "exact":
        raise ValueError(f"unknown mode {mode!r}")
    return scored.groupBy(*group_cols, s.alias("score")).agg(
        _pos(label, weight_col).cast("double").alias("pos"), _neg(label, weight_col).cast("double").alias("neg")
    )


def counts_as_rows(counts: DataFrame, integral: bool = True, out: str = "n") -> DataFrame:
    """``score, pos, neg`` -> ``score, label, n``: one row per score and class
    with its multiplicity, so every row-level operator (curve, confusion,
    prevalence) runs on the counts with ``weight_col="n"``."""
    keep = [c for c in counts.columns if c not in ("score", "pos", "neg")]
    rows = counts.select(*keep, "score", F.explode(F.array(
        F.struct(F.lit(1).alias("label"), F.col("pos").alias(out)),
        F.struct(F.lit(0).alias("label"), F.col("neg").alias(out)),
    )).alias("r")).select(*keep, "score", "r.label", f"r.{out}").filter(F.col(out) > 0)
    return rows.withColumn(out, F.col(out).cast("long")) if integral else rows


def _curve(scored: DataFrame, n_buckets: int | None = None, counts: DataFrame | None = None,
           group_cols=(), **kw) -> tuple[DataFrame, Column]:
    # the per-score table feeds three jobs (range boundaries, totals, running
    # sums): write it once so the scoring lineage runs once
    if counts is None:
        counts = materialize(score_counts(scored, group_cols=group_cols, **kw), "score-counts")
    rt = running_totals(counts, "score", ["pos", "neg"], group_cols, descending=True, n_buckets=n_buckets)
    totals = counts.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).select(F.struct("P", "N").alias("t")).scalar()
    return rt, totals


def roc_points(scored: DataFrame, n_buckets: int | None = None, **kw) -> DataFrame:
    """One ``(fpr, tpr)`` point per distinct score, plus (0,0) and (1,1)."""
    rt, t = _curve(scored, n_buckets, **kw)
    P, N = t.getField("P"), t.getField("N")
    pts = rt.select(
        r6(F.coalesce(F.try_divide(F.col("cum_neg"), N), F.lit(0.0))).alias("fpr"),
        r6(F.coalesce(F.try_divide(F.col("cum_pos"), P), F.lit(0.0))).alias("tpr"),
    )
    anchors = scored.sparkSession.range(1).select(
        F.explode(F.array(F.struct(F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")),
                          F.struct(F.lit(1.0).alias("fpr"), F.lit(1.0).alias("tpr")))).alias("a")
    ).select("a.*")
    return anchors.unionByName(pts)


def _precision(tp: Column, cnt: Column) -> Column:
    return F.when(cnt > 0, tp / cnt).otherwise(F.lit(1.0))


def pr_points(scored: DataFrame, n_buckets: int | None = None, **kw) -> DataFrame:
    """One ``(recall, precision)`` point per distinct score, plus (0, first precision)."""
    rt, t = _curve(scored, n_buckets, **kw)
    P = t.getField("P")
    pts = rt.select(
        F.col("score"),
        F.coalesce(F.try_divide(F.col("cum_pos"), P), F.lit(0.0)).alias("recall"),
        _precision(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
    )
    first = pts.agg(F.max_by("precision", "score").alias("precision")).filter(F.col("precision").isNotNull())
    anchor = first.select(F.lit(0.0).alias("recall"), "precision")
    return anchor.unionByName(pts.select("recall", "precision")).select(r6("recall").alias("recall"),
                                                                        r6("precision").alias("precision"))


def _auc_aggregate(rt: DataFrame, tau: Column | None = None, group_cols=()) -> DataFrame:
    """One aggregation over the running totals (per group): the ROC and PR sums,
    the class totals, and (with ``tau``) the confusion counts at tau."""
    prev_pos = F.col("cum_pos") - F.col("pos")
    prev_cnt = prev_pos + F.col("cum_neg") - F.col("neg")
    prec = _precision(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg"))
    prev_prec = F.when(prev_cnt > 0, prev_pos / prev_cnt).otherwise(prec)
    cols = [
        (F.col("neg") * (F.col("cum_pos") - F.col("pos") / 2.0)).alias("_roc"),
        (F.col("pos") * (prec + prev_prec) / 2.0).alias("_pr"),
        "pos", "neg",
    ]
    if tau is not None:
        # decide in the projection; tau may be a subquery
        cols.append((F.col("score") >= tau).alias("_yhat"))
    terms = rt.select(*group_cols, *cols)
    aggs = [F.sum("_roc").alias("roc_num"), F.sum("_pr").alias("pr_num"),
            F.coalesce(F.sum("pos"), F.lit(0.0)).alias("P"), F.coalesce(F.sum("neg"), F.lit(0.0)).alias("N")]
    if tau is not None:
        yh = F.col("_yhat")
        aggs += [F.coalesce(F.sum(F.when(yh, F.col("pos"))), F.lit(0.0)).alias("tp"),
                 F.coalesce(F.sum(F.when(yh, F.col("neg"))), F.lit(0.0)).alias("fp"),
                 F.coalesce(F.sum(F.when(~yh, F.col("neg"))), F.lit(0.0)).alias("tn"),
                 F.coalesce(F.sum(F.when(~yh, F.col("pos"))), F.lit(0.0)).alias("fn")]
    agg = terms.groupBy(*group_cols).agg(*aggs)
    ok = (F.col("P") > 0) & (F.col("N") > 0)
    return agg.withColumns({
        "roc_auc": r6(F.when(ok, F.col("roc_num") / (F.col("P") * F.col("N")))),
        "pr_auc": r6(F.when(ok, F.col("pr_num") / F.col("P"))),
    })


def auc_metrics(scored: DataFrame | None, n_buckets: int | None = None, group_cols=(), **kw) -> DataFrame:
    """E6 + E7: exact ``roc_auc`` (ties count one half) and ``pr_auc``
    (trapezoids over the E9 points, as MLlib's areaUnderPR), one aggregation
    over the running totals (class totals included).  Null when a class is
    absent.  One row per group, if ``group_cols`` are given."""
    rt, _ = _curve(scored, n_buckets, group_cols=group_cols, **kw)
    return _auc_aggregate(rt, group_cols=group_cols).select(*group_cols, "roc_auc", "pr_auc")


def roc_auc(scored: DataFrame, **kw) -> DataFrame:
    """Exact ROC AUC as a one-row frame."""
    return auc_metrics(scored, **kw).select("roc_auc")


def pr_auc(scored: DataFrame, **kw) -> DataFrame:
    """PR AUC as a one-row frame."""
    return auc_metrics(scored, **kw).select("pr_auc")


def as_raw_prediction(scored: DataFrame, score: str = SCORE, out: str = "rawPrediction") -> DataFrame:
    """A score column as the two-class raw-prediction vector MLlib's evaluator reads."""
    from pyspark.ml.functions import array_to_vector

    return scored.withColumn(out, array_to_vector(F.array(1 - F.col(score), F.col(score))))


def evaluator_auc(predictions: DataFrame, label: str = LABEL, raw: str = "rawPrediction",
                  num_bins: int = 1000) -> dict[str, float]:
    """MLlib's ``BinaryClassificationEvaluator`` (distributed sort), for parity
    with the numbers MLlib reports.  Returns two floats."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw, numBins=num_bins)
    return {
        "roc_auc": ev.setMetricName("areaUnderROC").evaluate(predictions),
        "pr_auc": ev.setMetricName("areaUnderPR").evaluate(predictions),
    }


# --------------------------------------------------------------------- E11-E16
def threshold_robustness(curve: DataFrame, width: float = C.ROBUSTNESS_WIDTH, tol: float = C.ROBUSTNESS_TOL) -> DataFrame:
    """Cost change of the grid points within tau* +- width, against a bound."""
    best = best_threshold(curve).select(F.struct("tau_star", "min_cost").alias("b")).scalar()
    tau, mn = best.getField("tau_star"), best.getField("min_cost")
    near = curve.filter(F.abs(F.col("threshold") - tau) <= F.lit(width + 1e-9))
    rel = F.when(mn == 0, F.when(F.col("total_cost") == 0, F.lit(0.0))).otherwise(
        (F.col("total_cost") - mn) / mn
    )
    return near.select(
        "threshold", "total_cost", r6(rel).alias("rel_change"), F.coalesce(rel <= F.lit(tol), F.lit(False)).alias("within_tol")
    )


def random_baseline(scored: DataFrame, label: str = LABEL, weight_col: str | None = None) -> DataFrame:
    """The PR curve of a random scorer is flat at the prevalence."""
    w = _w(weight_col)
    return scored.agg(ratio6(F.sum(F.when(F.col(label) == 1, w).otherwise(F.lit(0))),
                             F.sum(F.when(F.col(label).isNotNull(), w))).alias("prevalence"))


def metrics_record(scored: DataFrame | None, tau, n_buckets: int | None = None,
                   counts: DataFrame | None = None, **kw) -> DataFrame:
    """``tau_star, roc_auc, pr_auc, precision, recall, f1, tp, fp, tn, fn``.

    The scored rows are read once, into per-score counts (or ``counts`` is
    given: ``score, pos, neg``); both AUCs, the class totals and the
    confusion counts at tau come from one aggregation over that table.
    """
    t = tau if isinstance(tau, Column) else F.lit(float(tau))
    rt, _ = _curve(scored, n_buckets, counts=counts, **kw)
    agg = _auc_aggregate(rt, t)
    if not kw.get("weight_col"):
        agg = agg.withColumns({c: F.col(c).cast("long") for c in ("tp", "fp", "tn", "fn")})
    cols = _prf_cols(F.col("tp"), F.col("fp"), F.col("fn"))
    return agg.select(
        t.alias("tau_star"), "roc_auc", "pr_auc",
        cols["precision"].alias("precision"), cols["recall"].alias("recall"), cols["f1"].alias("f1"),
        "tp", "fp", "tn", "fn",
    )


def metrics_long(record: DataFrame, metrics=("roc_auc", "pr_auc", "precision", "recall", "f1")) -> DataFrame:
    """A wide metrics record as ``metric, value`` rows."""
    items = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
    return record.select(F.explode(F.array(*items)).alias("r")).select("r.*")


def metric_parity(a: DataFrame, b: DataFrame, tolerances: dict | None = None) -> DataFrame:
    """``metric, a, b, delta, tolerance, ok`` for two long metric sets; a
    metric that one side lacks is reported with ``ok`` false."""
    tolerances = tolerances or C.PARITY_TOLERANCES
    tol = None
    for m, v in tolerances.items():
        tol = F.when(F.col("metric") == m, F.lit(float(v))) if tol is None else tol.when(F.col("metric") == m, F.lit(float(v)))
    j = a.select("metric", F.col("value").alias("a")).join(
        b.select("metric", F.col("value").alias("b")), "metric", "full")
    j = j.filter(F.col("metric").isin(*tolerances.keys()))
    delta = F.col("b") - F.col("a")
    return j.select("metric", r6("a").alias("a"), r6("b").alias("b"), r6(delta).alias("delta"),
                    tol.alias("tolerance"), F.coalesce(F.abs(F.round(delta, 9)) <= tol, F.lit(False)).alias("ok"))


def targets(metrics: DataFrame, goals: dict | None = None) -> DataFrame:
    """``metric, value, goal, met`` for the declared minimums (an undefined
    metric meets none)."""
    goals = goals or C.TARGETS
    goal = None
    for m, v in goals.items():
        goal = F.when(F.col("metric") == m, F.lit(float(v))) if goal is None else goal.when(F.col("metric") == m, F.lit(float(v)))
    return metrics.filter(F.col("metric").isin(*goals.keys())).select(
        "metric", r6("value").alias("value"), goal.alias("goal"),
        F.coalesce(F.col("value") >= goal, F.lit(False)).alias("met")
    )


def threshold_record(curve: DataFrame, rows_total: DataFrame, rows_used: DataFrame,
                     c_fp: float = C.COST_FP, c_fn: float = C.COST_FN, sampled: bool = False,
                     seed: int = C.SEED, steps: int = C.GRID_STEPS, with_timestamp: bool = True) -> DataFrame:
    """The record of how tau* was chosen (always says whether it sampled)."""
    n_all = rows_total.agg(F.count(F.lit(1))).scalar()
    n_used = rows_used.agg(F.count(F.lit(1))).scalar()
    rec = best_threshold(curve).select(
        "tau_star", "min_cost",
        F.lit(float(c_fp)).alias("fp_cost"), F.lit(float(c_fn)).alias("fn_cost"),
        "fp_count", "fn_count",
        n_all.alias("validation_rows"), n_used.alias("validation_rows_used"),
        F.lit(steps - 1).alias("scan_points"), F.lit(bool(sampled)).alias("sampled"), F.lit(int(seed)).alias("seed"),
    )
    if with_timestamp:
        rec = rec.withColumn("timestamp", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss"))
    return rec


# --------------------------------------------------------------------- L1, L5
def ordered(df: DataFrame, cols=(C.TYPE, C.LABEL)) -> DataFrame:
    """L1: a result ordered for display."""
    return df.orderBy(*cols)


def top_alerts(scored: DataFrame, k: int = 100, key: str = C.KEY, score: str = SCORE) -> DataFrame:
    """The k highest-risk rows (ties by key): a top-k plan, one partial
    top-k per partition merged once."""
    return scored.orderBy(F.col(score).desc(), F.col(key).asc()).limit(k)
