"""MLlib pipelines, scoring, calibration and ensembles.

Fitting is MLlib's own distributed work (one summary pass for the scaler, one
gradient pass per L-BFGS step, tree statistics per level).  Everything around
the fit -- weights, scoring, thresholds, metrics -- stays in DataFrames; loops
here run over a parameter grid or a list of variants whose length the caller
fixes, never over rows.
"""

from __future__ import annotations

import time
from multiprocessing.pool import ThreadPool
from typing import Iterable

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlab import config as C
from txnlab.functions.columns import exact_floor, grid_bucket, mean6, r6, ratio6
from txnlab.operators import evaluate as E
from txnlab.operators.sampling import class_weights, downsample
from txnlab.operators.features import with_weight
from txnlab.session import materialize


# --------------------------------------------------------------------- M1-M5
def feature_stages(cols=C.FEATURES, scale: bool = True, raw_col: str = "unscaled_features",
                   out_col: str = "features", center: bool = False) -> list:
    """M1/M2: assemble the ordered features; scale to unit (sample) std, centred
    only on request."""
    if not scale:
        return [VectorAssembler(inputCols=list(cols), outputCol=out_col)]
    return [
        VectorAssembler(inputCols=list(cols), outputCol=raw_col),
        StandardScaler(inputCol=raw_col, outputCol=out_col, withMean=center, withStd=True),
    ]


def lr_stage(reg: float = C.REG_PARAM, max_iter: int = C.MAX_ITER, elastic: float = C.ELASTIC_NET,
             weight_col: str | None = "weight", label: str = C.LABEL, tol: float = 1e-6,
             standardization: bool = True) -> LogisticRegression:
    """M3: weighted L2 logistic regression.  ``standardization``: the optimiser's
    own scaling, by which the penalty doesn't depend on the features' units."""
    lr = LogisticRegression(featuresCol="features", labelCol=label, regParam=reg, maxIter=max_iter,
                            elasticNetParam=elastic, tol=tol, standardization=standardization)
    if weight_col:
        lr.setWeightCol(weight_col)
    return lr


def rf_stage(num_trees: int = 50, max_depth: int = 8, label: str = C.LABEL, weight_col: str | None = "weight",
             seed: int = C.SEED) -> RandomForestClassifier:
    """M8: random forest."""
    rf = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=num_trees, maxDepth=max_depth,
                                seed=seed)
    if weight_col:
        rf.setWeightCol(weight_col)
    return rf


def gbt_stage(max_iter: int = 30, max_depth: int = 5, label: str = C.LABEL, weight_col: str | None = "weight",
              seed: int = C.SEED) -> GBTClassifier:
    """M9: gradient boosted trees."""
    gbt = GBTClassifier(featuresCol="features", labelCol=label, maxIter=max_iter, maxDepth=max_depth, seed=seed)
    if weight_col:
        gbt.setWeightCol(weight_col)
    return gbt


def weighted(train: DataFrame, mode: str = "ratio", label: str = C.LABEL, eager: bool = True) -> DataFrame:
    """A14/A15 + P7: the training set with its class-weight column.

    A fit passes over its input several times; with ``eager`` the two weights
    (one row, fixed size) are computed once and attached as literals instead
    of a subquery that every pass would re-run.
    """
    weights = class_weights(train, label, mode)
    if not eager:
        return with_weight(train, weights, label)
    w = weights.first()
    return train.withColumn(
        "weight", F.when(F.col(label) == 1, F.lit(float(w.weight_pos))).otherwise(F.lit(float(w.weight_neg)))
    )


def train(df: DataFrame, stages: list) -> PipelineModel:
    """M4: fit the pipeline.

    MLlib's optimiser caches its own instance vectors when the input is not
    cached (faster than caching the rows, measured); callers should hand it a
    written or short lineage (the catalog writes the model input once).
    """
    return Pipeline(stages=list(stages)).fit(df)


def timed_train(df: DataFrame, stages: list) -> tuple[PipelineModel, float]:
    """M4 + R2: fit and the wall-clock seconds it took."""
    t0 = time.perf_counter()
    model = train(df, stages)
    return model, time.perf_counter() - t0


def score_label(pred: DataFrame, label: str = C.LABEL, keep=(C.KEY,)) -> DataFrame:
    """Positive-class probability as ``score`` and the label as int ``label``."""
    lead = [c for c in keep if c in pred.columns]
    return pred.select(*lead, vector_to_array("probability")[1].alias("score"),
                       F.col(label).cast("int").alias("label"))


def score(model: PipelineModel, df: DataFrame, label: str = C.LABEL, keep=(C.KEY,)) -> DataFrame:
    """M5: transform and reduce to ``score, label`` (plus key)."""
    return score_label(model.transform(df), label, keep)


# --------------------------------------------------------------------- M6, L2
def coefficients(model: PipelineModel, cols=C.FEATURES, intercept: bool = False) -> DataFrame:
    """M6: ``feature, coefficient, abs_coefficient`` of the last (linear) stage,
    ordered by absolute value.  Size is the number of features."""
    lr = model.stages[-1]
    rows = [(f, float(w), abs(float(w))) for f, w in zip(cols, lr.coefficients.toArray())]
    if intercept:
        rows.append(("intercept", float(lr.intercept), abs(float(lr.intercept))))
    spark = _spark()
    df = spark.createDataFrame(rows, "feature string, coefficient double, abs_coefficient double")
    return df.orderBy(F.col("abs_coefficient").desc(), F.col("feature"))


def scaler_std(model: PipelineModel, cols=C.FEATURES) -> DataFrame:
    """M2: the per-feature standard deviation the fitted scaler divides by
    (MLlib's unbiased sample std).  Size is the number of features."""
    from pyspark.ml.feature import StandardScalerModel

    sc = next(s for s in model.stages if isinstance(s, StandardScalerModel))
    rows = [(f, float(v)) for f, v in zip(cols, sc.std.toArray())]
    return _spark().createDataFrame(rows, "feature string, std double").select("feature", r6("std").alias("std"))


def top_coefficients(model: PipelineModel, k: int = 10, cols=C.FEATURES, intercept: bool = False) -> DataFrame:
    """L2: the k largest coefficients by absolute value."""
    return coefficients(model, cols, intercept).limit(k)


def _spark():
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


# --------------------------------------------------------------------- M7, M13
def fit_and_evaluate(train_df: DataFrame, val_df: DataFrame, stages: list, label: str = C.LABEL,
                     c_fp: float = C.COST_FP, c_fn: float = C.COST_FN, timed: bool = False) -> DataFrame:
    """Fit, score the validation set, and report AUCs and the cost at tau* (one
    row); ``timed`` adds ``fit_seconds``, the time of the fit alone."""
    model, seconds = timed_train(train_df, stages)
    # scored rows are reduced once to per-score counts; tau*, its cost and
    # both AUCs all read that table
    counts = materialize(E.score_counts(score(model, val_df, label)), "validation-score-counts")
    best = E.best_threshold(E.cost_curve(E.counts_as_rows(counts), c_fp, c_fn, weight_col="n", with_rows=True))
    b = best.select(F.struct("tau_star", "min_cost").alias("b")).scalar()
    out = E.auc_metrics(None, counts=counts).select(
        "roc_auc", "pr_auc", b.getField("tau_star").alias("tau_star"), b.getField("min_cost").alias("min_cost")
    )
    return out.withColumn("fit_seconds", F.lit(round(seconds, 3))) if timed else out


PARALLEL_FITS = 2  # each holds its own copy of the training vectors


def _fit_settings(rows: DataFrame, settings: list[dict], label: str) -> list:
    """The model of each setting, fitted on ``rows`` (features, label, weight).

    Settings that differ in ``maxIter`` alone take the same steps until one of them
    stops, so a fit that ends before its ``maxIter`` is that of the larger ones too;
    one that doesn't is followed by a fit of its own for the next.
    """
    alike: dict = {}
    for i, p in enumerate(settings):
        alike.setdefault(tuple((k, v) for k, v in sorted(p.items()) if k != "maxIter"), []).append(i)
    steps = [int(p.get("maxIter", C.MAX_ITER)) for p in settings]

    def fits(members):
        out, model, ended = {}, None, False
        for i in sorted(members, key=steps.__getitem__):
            if not ended:
                p = settings[i]
                model = lr_stage(reg=p.get("regParam", C.REG_PARAM), max_iter=steps[i], elastic=p.get("elasticNetParam", 0.0),
                                 tol=p.get("tol", 1e-6), label=label).fit(rows)
                # without steps (one class only) there is nothing that more steps could change
                ended = not model.hasSummary or len(model.summary.objectiveHistory) - 1 < steps[i]
            out[i] = model
        return out

    found: dict = {}
    tasks = [inheritable_thread_target(rows.sparkSession)(lambda m=m: fits(m)) for m in alike.values()]
    with ThreadPool(max(1, min(PARALLEL_FITS, len(tasks)))) as pool:
        for part in pool.imap_unordered(lambda f: f(), tasks):
            found.update(part)
    return [found[i] for i in range(len(settings))]


def fit_and_evaluate_all(train_df: DataFrame, val_df: DataFrame, settings: list[dict], label: str = C.LABEL,
                         c_fp: float = C.COST_FP, c_fn: float = C.COST_FN) -> list[tuple]:
    """``fit_and_evaluate`` for several settings of the logistic regression on the
    same rows: (roc_auc, pr_auc, tau_star, min_cost) of each.

    The scaled training vectors are made once, the validation set is read once and
    scored by all models, and all metrics come from one table of per-score counts.
    """
    scaler = train(train_df, feature_stages())
    # kept in their partitions: a fit's sums, and so its last digits, depend on these
    rows = scaler.transform(train_df).select("features", label, "weight").persist(StorageLevel.DISK_ONLY)
    try:
        fitted = _fit_settings(rows, settings, label)
    finally:
        rows.unpersist()
    models = list(dict.fromkeys(fitted))
    scored = scaler.transform(val_df).select(F.col(label).cast("int").alias("label"), "features")
    for j, m in enumerate(models):
        m = m.copy().setProbabilityCol(f"_p{j}").setRawPredictionCol(f"_r{j}").setPredictionCol(f"_y{j}")
        scored = m.transform(scored).drop(f"_r{j}", f"_y{j}")
    scores = F.array(*[vector_to_array(f"_p{j}")[1] for j in range(len(models))])
    scored = scored.select("label", F.posexplode(scores).alias("model", "score"))
    counts = materialize(E.score_counts(scored, group_cols=["model"]), "validation-score-counts")
    auc = {r.model: (r.roc_auc, r.pr_auc) for r in E.auc_metrics(None, counts=counts, group_cols=["model"]).collect()}
    # a threshold's counts need only those of its grid cells: one score stands for a cell
    cells = materialize(counts.groupBy("model", grid_bucket("score", C.GRID_STEPS)).agg(
        F.min("score").alias("score"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg")), "validation-grid-counts")
    out = []
    for j in range(len(models)):
        rows_j = E.counts_as_rows(cells.filter(F.col("model") == j).select("score", "pos", "neg"))
        best = E.best_threshold(E.cost_curve(rows_j, c_fp, c_fn, weight_col="n", with_rows=True)).first()
        out.append((*auc.get(j, (None, None)), best and best.tau_star, best and best.min_cost))
    return [out[models.index(m)] for m in fitted]


def ablate(train_df: DataFrame, val_df: DataFrame, reg: float = C.REG_PARAM, label: str = C.LABEL) -> DataFrame:
    """M7: baseline; no weight column, on all rows and on a 1:1 sample of the
    classes; weaker L2; no scaling, of the features or inside the optimiser;
    centred features.  One row each."""
    w = weighted(train_df, "ratio", label)
    variants = {
        "baseline": (w, feature_stages() + [lr_stage(reg)]),
        "no_weight": (train_df, feature_stages() + [lr_stage(reg, weight_col=None)]),
        "weaker_l2": (w, feature_stages() + [lr_stage(reg / 10.0)]),
        "no_weight_balanced": (downsample(train_df, label, 1.0, salt="ablate"),
                               feature_stages() + [lr_stage(reg, weight_col=None)]),
        "no_scaler": (w, feature_stages(scale=False) + [lr_stage(reg, standardization=False)]),
        "centred": (w, feature_stages(center=True) + [lr_stage(reg)]),
    }
    out = None
    for name, (tr, stages) in variants.items():
        row = fit_and_evaluate(tr, val_df, stages, label).select(F.lit(name).alias("variant"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def grid_search(train_df: DataFrame, val_df: DataFrame, grid: dict | None = None, by: str = "cost",
                label: str = C.LABEL) -> DataFrame:
    """Every combination of the grid on a fixed validation set; one row per
    combination with ``rank`` (1 = best by business cost, or by ROC AUC)."""
    from itertools import product

    grid = grid or {"regParam": [0.01, 0.1], "elasticNetParam": [0.0, 0.5], "maxIter": [200, 500],
                    "tol": [1e-6, 1e-8]}
    keys = list(grid)
    combos = list(product(*[grid[k] for k in keys]))
    found = fit_and_evaluate_all(weighted(train_df, "ratio", label), val_df, [dict(zip(keys, x)) for x in combos], label)
    schema = ", ".join([*(f"`{k}` double" for k in keys), "roc_auc double", "pr_auc double", "tau_star double",
                        "min_cost double"])
    out = train_df.sparkSession.createDataFrame([(*map(float, x), *m) for x, m in zip(combos, found)], schema)
    from pyspark.sql import Window

    order = [F.col("min_cost").asc(), F.col("roc_auc").desc()] if by == "cost" else [F.col("roc_auc").desc()]
    # one row per grid point: a bounded window
    return out.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))


# --------------------------------------------------------------------- M10-M12
def platt(scored_val: DataFrame, label: str = "label") -> PipelineModel:
    """Platt scaling: a one-feature logistic regression on the score's logit."""
    df = _logit(scored_val)
    stages = [VectorAssembler(inputCols=["logit"], outputCol="features"),
              LogisticRegression(featuresCol="features", labelCol=label, regParam=0.0, maxIter=100)]
    return Pipeline(stages=stages).fit(df)


def _logit(df: DataFrame) -> DataFrame:
    eps = 1e-9
    s = F.least(F.greatest(F.col("score"), F.lit(eps)), F.lit(1 - eps))
    return df.withColumn("logit", F.log(s / (1 - s)))


def apply_platt(model: PipelineModel, scored: DataFrame) -> DataFrame:
    """Calibrated ``score`` from a Platt model; other columns kept."""
    out = model.transform(_logit(scored))
    keep = [c for c in scored.columns if c != "score"]
    return out.select(*keep, vector_to_array("probability")[1].alias("score"))


def reliability(scored: DataFrame, bins: int = 10, score: str = "score", label: str = "label") -> DataFrame:
    """Per equal-width score bin (bin i begins at i/bins): rows, mean score,
    observed positive rate; bins without rows have 0 rows and null rates."""
    b = F.least(exact_floor(score, bins), F.lit(bins - 1)).cast("int")
    per = E.scored_rows(scored, score).groupBy(b.alias("bin")).agg(        F.count(F.lit(1)).alias("rows"),
        mean6(score).alias("mean_score"),
        ratio6(F.count_if(F.col(label) == 1), F.count(F.lit(1))).alias("observed_rate"),
    )
    every = scored.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    # at most `bins` rows
    return every.join(F.broadcast(per), "bin", "left").select(
        "bin", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"), "mean_score", "observed_rate")


def isotonic(scored_val: DataFrame, bins: int = 1000, score: str = "score", label: str = "label"):
    """Isotonic calibration.  Scores are first pooled into ``bins`` bins
    (mean score, positive rate, row count as weight), so the final
    pool-adjacent-violators merge sees at most ``bins`` points however large
    the validation set is."""
    b = F.least(exact_floor(score, bins), F.lit(bins - 1)).cast("int")
    pooled = E.scored_rows(scored_val, score).groupBy(b.alias("bin")).agg(
        F.avg(score).alias("x"), F.avg(F.col(label).cast("double")).alias("y"), F.count(F.lit(1)).cast("double").alias("w")
    )
    return IsotonicRegression(featuresCol="x", labelCol="y", weightCol="w", isotonic=True).fit(pooled)


def apply_isotonic(model, scored: DataFrame, score: str = "score") -> DataFrame:
    keep = [c for c in scored.columns if c != score]
    out = model.setFeaturesCol(score).setPredictionCol("_iso").transform(scored)
    return out.select(*keep, F.col("_iso").alias(score))


# --------------------------------------------------------------------- M14, D7
def bag(train_df: DataFrame, k: int = 3, ratio: float = 1.0, label: str = C.LABEL, reg: float = C.REG_PARAM) -> list:
    """``k`` models, each fit on its own repeatable 1:ratio downsample."""
    models = []
    for i in range(k):
        part = downsample(train_df, label, ratio, salt=f"bag{i}")
        models.append(train(part, feature_stages() + [lr_stage(reg, weight_col=None)]))
    return models


def vote(models: Iterable[PipelineModel], df: DataFrame, label: str = C.LABEL, key: str = C.KEY) -> DataFrame:
    """Soft vote: mean positive-class probability across models.

    Each model appends its own probability column to the same rows (narrow
    transforms chained in one plan), so no join on the key is needed.
    """
    out = df
    names = []
    for i, m in enumerate(models):
        pred = m.transform(out)
        name = f"_p{i}"
        names.append(name)
        out = pred.withColumn(name, vector_to_array("probability")[1]).drop(
            "probability", "rawPrediction", "prediction", "features", "unscaled_features"
        )
    mean = sum((F.col(n) for n in names), F.lit(0.0)) / F.lit(float(len(names)))
    lead = [key] if key in df.columns else []
    return out.select(*lead, mean.alias("score"), F.col(label).cast("int").alias("label"))


def compare_sampling(train_df: DataFrame, val_df: DataFrame, ratios=C.DOWNSAMPLE_RATIOS, label: str = C.LABEL,
                     reg: float = C.REG_PARAM) -> DataFrame:
    """One row per 1:k downsampling ratio: rows used, fit seconds, AUCs, cost."""
    out = None
    for k in ratios:
        part = downsample(train_df, label, k, salt=f"cmp{k}")
        row = fit_and_evaluate(part, val_df, feature_stages() + [lr_stage(reg, weight_col=None)], label, timed=True)
        row = row.select(F.lit(int(k)).alias("ratio"), part.agg(F.count(F.lit(1))).scalar().alias("train_rows"), "*")
        out = row if out is None else out.unionByName(row)
    return out
