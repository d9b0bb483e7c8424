"""Every registered query: ``name -> fn(spark, sf_dir) -> DataFrame``.

Names follow SURVEY §2.  Each reads the tables in ``sf_dir`` (through the
transactions view) so its work grows with them; none runs on made-up input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlab import config as C
from txnlab.operators import evaluate as E
from txnlab.operators import features as P
from txnlab.operators import hull as H
from txnlab.operators import loads as L
from txnlab.operators import model as M
from txnlab.operators import profile as A
from txnlab.operators import records as R
from txnlab.operators import sampling as D
from txnlab.operators import search
from txnlab.operators import sketches as K
from txnlab.operators import skew
from txnlab.plans import decide as DP
from txnlab.plans.inputs import (
    features,
    fixed_scored,
    fixed_scored_split,
    kept,
    part,
    model_input as lazy_model_input,
    raw,
    round_doubles,
    transactions,
)
from txnlab.session import materialize, shared_dir
from txnlab.sources import models as V
from txnlab.sources import quarantine as Z
from txnlab.sources import results as S
from txnlab.sources import transactions as T
from txnlab.sources.results import read_result
from txnlab.sources.results import write_result as write_table
from txnlab.sources.transactions import TRANSACTION_SCHEMA

Query = Callable[[SparkSession, str], DataFrame]


def model_input(spark, sf):
    """The split feature rows, written once: every fit, score and metric of a
    model query reads this table instead of re-running the join."""
    return materialize(lazy_model_input(spark, sf), "model-input")


QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ============================================================ flagship
@query
def flagship(spark, sf):
    """F5 -> P1 -> fixed scorer -> E1 -> E2 -> E3 -> E4."""
    return DP.flagship(fixed_scored(spark, sf))


# ============================================================ S: sources, sinks
@query
def read_transactions(spark, sf):
    """The transactions written as headered CSV (one part per task) and read
    back under the pinned schema, with no inference pass."""
    path = shared_dir(spark, "transactions-csv")
    transactions(spark, sf).write.mode("overwrite").option("header", True).csv(path)
    return T.read_transactions(spark, path, "csv", keyed=True)


@query
def stored_by_type(spark, sf):
    """The view stored once partitioned by type; the kept-type read
    prunes partitions at the scan."""
    path = T.write_transactions(transactions(spark, sf), shared_dir(spark, "transactions-by-type"))
    return P.select_types(T.read_stored_transactions(spark, path))


@query
def schema_report(spark, sf):
    """S2."""
    return A.schema_report(raw(spark, sf), TRANSACTION_SCHEMA)


@query
def contract_report(spark, sf):
    """The transactions as text, one value in a hundred of ``amount`` not a
    number, a column too many and one missing, against the contract."""
    t = raw(spark, sf).drop("nameDest").withColumn("note", F.lit("x"))
    text = t.select(*[F.col(c).cast("string").alias(c) for c in t.columns])
    bad = F.when(F.col("step").cast("int") % 100 == 0, F.lit("n/a")).otherwise(F.col("amount"))
    return A.contract_report(text.withColumn("amount", bad), TRANSACTION_SCHEMA)


@query
def write_result(spark, sf):
    """S3 + S5: a result table written as one CSV file and read back."""
    path = shared_dir(spark, "type-label-counts")
    write_table(A.type_label_counts(raw(spark, sf)), path, "csv")
    return read_result(spark, path, "csv", schema="type string, isFraud int, count long")


@query
def write_record_json(spark, sf):
    """A one-row record written as JSON and read back."""
    path = shared_dir(spark, "flagship-json")
    write_table(DP.flagship(fixed_scored(spark, sf)), path, "json")
    schema = ("tau_star double, min_cost double, tp long, fp long, tn long, fn long, "
              "precision double, recall double, f1 double")
    return read_result(spark, path, "json", schema=schema)


@query
def save_model(spark, sf):
    """A fitted pipeline saved, loaded back, and used to score the test split."""
    mi = model_input(spark, sf)
    model = M.train(M.weighted(part(mi, "train")), M.feature_stages() + [M.lr_stage()])
    path = S.save_model(model, shared_dir(spark, "lr-pipeline"))
    return M.score(S.load_model(path), part(mi, "test"))


@query
def fingerprint(spark, sf):
    """S7."""
    return A.fingerprint(raw(spark, sf))


# ============================================================ P: row operators
@query
def select_types(spark, sf):
    """P1."""
    return P.select_types(transactions(spark, sf))


@query
def project(spark, sf):
    """P2 (with P1, P3, P4): the ordered feature table."""
    return round_doubles(features(spark, sf))


@query
def encode_type(spark, sf):
    """P3 over every type (unseen types get -1)."""
    return P.encode_type(transactions(spark, sf)).select(C.KEY, C.TYPE, "type_encoded")


@query
def log1p_cols(spark, sf):
    """P4 over every row (null outside the domain)."""
    out = P.log1p_cols(transactions(spark, sf))
    return round_doubles(out.select(C.KEY, *[f"{c}{C.LOG1P_SUFFIX}" for c in C.SKEWED_COLUMNS]))


@query
def validity_flags(spark, sf):
    """P5."""
    return P.validity_flags(transactions(spark, sf)).select(
        C.KEY, "amount_is_zero", "amount_is_negative", "any_negative", "any_null")


@query
def balance_flags(spark, sf):
    """P6."""
    return P.balance_flags(transactions(spark, sf)).select(C.KEY, "payer_ok", "payee_ok", "both_ok")


@query
def with_weight(spark, sf):
    """The A14 weights of the train split attached as one scalar subquery."""
    tr = part(lazy_model_input(spark, sf), "train")
    return round_doubles(P.with_weight(tr, D.class_weights(tr)).select(C.KEY, C.LABEL, "weight"))


@query
def score_label(spark, sf):
    """P8 (with M1-M5): trained pipeline's positive-class score on the test split."""
    mi = model_input(spark, sf)
    model = M.train(M.weighted(part(mi, "train")), M.feature_stages() + [M.lr_stage()])
    return M.score_label(model.transform(part(mi, "test")))


@query
def decide(spark, sf):
    """Test rows decided at the validation tau*."""
    s = fixed_scored_split(spark, sf, written=False)
    return P.decide(part(s, "test"), DP.validation_tau(_counts(spark, sf))).select(C.KEY, "score", "label", "yhat")


@query
def drop_null_rows(spark, sf):
    """P10."""
    return round_doubles(P.drop_null_rows(features(spark, sf)))


@query
def null_drop_report(spark, sf):
    """P10: how many feature rows the null drop removes, and why."""
    return P.null_drop_report(features(spark, sf), list(C.FEATURES) + [C.LABEL])


@query
def clip_quantile(spark, sf):
    """Amount clipped to [0, exact p99] on the kept rows."""
    return round_doubles(P.clip_quantile(kept(spark, sf), "amount").select(C.KEY, "amount_clipped"))


@query
def rule_flag(spark, sf):
    """P12."""
    return P.rule_flag(transactions(spark, sf)).select(C.KEY, C.TYPE, "amount", "rule_flag")


@query
def interactions(spark, sf):
    """P13 over the kept rows with their encoded type and log amount."""
    k = P.log1p_cols(P.encode_type(kept(spark, sf)), ["amount"])
    out = P.interactions(k)
    return round_doubles(out.select(C.KEY, "orig_delta", "dest_delta", "orig_delta_ratio", "dest_delta_ratio",
                                    "amount_to_orig_balance", "amount_log1p_x_type"))


# ============================================================ A: aggregations
@query
def null_counts(spark, sf):
    """A1."""
    return A.null_counts(raw(spark, sf))


@query
def duplicate_count(spark, sf):
    """A2."""
    return A.duplicate_count(raw(spark, sf))


@query
def negative_counts(spark, sf):
    """A3."""
    return A.negative_counts(raw(spark, sf))


@query
def zero_count(spark, sf):
    """A4."""
    return A.zero_count(raw(spark, sf))


@query
def quality_checks(spark, sf):
    """A1 + A3 + A4 + A8 in one scan."""
    return A.quality_checks(raw(spark, sf))


@query
def quantile_summary(spark, sf):
    """A5 (exact)."""
    return A.quantile_summary(raw(spark, sf), C.NUMERIC_COLUMNS)


@query
def quantile_summary_approx(spark, sf):
    """A5 (one-pass approximate)."""
    return A.quantile_summary(raw(spark, sf), C.NUMERIC_COLUMNS, exact=False)


@query
def describe_numeric(spark, sf):
    """A6."""
    return A.describe_numeric(raw(spark, sf))


@query
def skew_report(spark, sf):
    """A7."""
    return A.skew_report(raw(spark, sf))


@query
def balance_consistency(spark, sf):
    """A8."""
    return A.balance_consistency(raw(spark, sf))


@query
def type_label_counts(spark, sf):
    """A9."""
    return A.type_label_counts(raw(spark, sf))


@query
def type_label_pivot(spark, sf):
    """A10."""
    return A.type_label_pivot(raw(spark, sf))


@query
def fraud_rate_by_type(spark, sf):
    """A11."""
    return A.fraud_rate_by_type(raw(spark, sf))


@query
def selection_effect(spark, sf):
    """A12."""
    return A.selection_effect(raw(spark, sf))


@query
def split_counts(spark, sf):
    """A13 over the deterministic split of the model input."""
    return D.split_counts(lazy_model_input(spark, sf))


@query
def class_weights(spark, sf):
    """A14 + A15 on the train split."""
    tr = part(lazy_model_input(spark, sf), "train")
    return round_doubles(D.class_weights(tr, mode="ratio").unionByName(D.class_weights(tr, mode="balanced")))


@query
def histogram(spark, sf):
    """Raw amount clipped at p99, and log1p(amount), 60 bins each, all kept rows."""
    k = P.drop_null_rows(P.log1p_cols(kept(spark, sf), ["amount"]), ["amount", "amount_log1p"])
    raw_h = A.histogram(k, "amount", clip_q=C.CLIP_QUANTILE, name="amount_clipped")
    log_h = A.histogram(k, "amount_log1p")
    return raw_h.unionByName(log_h)


@query
def account_clearing(spark, sf):
    """A17."""
    return A.account_clearing(raw(spark, sf))


@query
def id_cardinality(spark, sf):
    """A18 (exact)."""
    return A.id_cardinality(raw(spark, sf), exact=True)


@query
def id_cardinality_approx(spark, sf):
    """A18 (HyperLogLog++)."""
    return A.id_cardinality(raw(spark, sf), exact=False)


@query
def flag_vs_label(spark, sf):
    """A19."""
    return A.flag_vs_label(raw(spark, sf))


@query
def profile_parity(spark, sf):
    """Train vs test split of the kept rows."""
    s = D.hash_split(kept(spark, sf))
    return A.profile_parity(part(s, "train"), part(s, "test"))


# ============================================================ D: sampling, splits
@query
def random_split(spark, sf):
    """D1."""
    return D.random_split(kept(spark, sf)).select(C.KEY, C.LABEL, "split")


@query
def hash_split(spark, sf):
    """D2."""
    return D.hash_split(transactions(spark, sf)).select(C.KEY, "split")


@query
def stratified_split(spark, sf):
    """D3."""
    return D.stratified_split(kept(spark, sf)).select(C.KEY, C.LABEL, "split")


@query
def exact_stratified_split(spark, sf):
    """D3 exact: each class cut at 70/15/15 by position in hash order."""
    return D.exact_stratified_split(kept(spark, sf)).select(C.KEY, C.LABEL, "split")


@query
def stratified_sample(spark, sf):
    """D4."""
    return D.stratified_sample(kept(spark, sf)).select(C.KEY, C.LABEL, "sample_weight")


@query
def sample_cap(spark, sf):
    """A 5% sample, of a smaller fraction where that would pass 300,000 rows."""
    return D.sample_cap(kept(spark, sf).select(C.KEY, "amount"), 0.05, 300_000)


@query
def downsample(spark, sf):
    """1:1 on the train split."""
    tr = part(lazy_model_input(spark, sf), "train")
    return D.downsample(tr, k=1.0).select(C.KEY, C.LABEL)


@query
def compare_sampling(spark, sf):
    """D7."""
    mi = model_input(spark, sf)
    return M.compare_sampling(part(mi, "train"), part(mi, "validation"))


# ============================================================ M: models
def _trained(spark, sf):
    mi = model_input(spark, sf)
    model, secs = M.timed_train(M.weighted(part(mi, "train")), M.feature_stages() + [M.lr_stage()])
    return mi, model, secs


@query
def train_score(spark, sf):
    """M1-M5 on the deterministic split: test-set metrics at the validation tau*."""
    mi, model, _ = _trained(spark, sf)
    held_out = M.score(model, mi.filter(F.col("split") != "train"), keep=("split",))
    return DP.validate_then_test(DP.split_counts_table(held_out))


@query
def scaler_std(spark, sf):
    """M2: the fitted scaler's per-feature std on the train split."""
    tr = part(lazy_model_input(spark, sf), "train")
    return M.scaler_std(M.train(tr, M.feature_stages()))


@query
def coefficients(spark, sf):
    """M6."""
    _, model, _ = _trained(spark, sf)
    return M.coefficients(model, intercept=True)


@query
def top_coefficients(spark, sf):
    """L2."""
    _, model, _ = _trained(spark, sf)
    return M.top_coefficients(model, 10)


@query
def ablate(spark, sf):
    """M7."""
    mi = model_input(spark, sf)
    return M.ablate(part(mi, "train"), part(mi, "validation"))


@query
def random_forest(spark, sf):
    """M8."""
    mi = model_input(spark, sf)
    return M.fit_and_evaluate(M.weighted(part(mi, "train")), part(mi, "validation"),
                              M.feature_stages(scale=False) + [M.rf_stage()])


@query
def gbt(spark, sf):
    """M9."""
    mi = model_input(spark, sf)
    return M.fit_and_evaluate(M.weighted(part(mi, "train")), part(mi, "validation"),
                              M.feature_stages(scale=False) + [M.gbt_stage()])


@query
def platt(spark, sf):
    """Platt scaling fitted on validation scores, reliability of the test scores."""
    mi, model, _ = _trained(spark, sf)
    cal = M.platt(M.score(model, part(mi, "validation")))
    return M.reliability(M.apply_platt(cal, M.score(model, part(mi, "test"))))


@query
def isotonic(spark, sf):
    """Isotonic calibration on binned validation scores, reliability of the test scores."""
    mi, model, _ = _trained(spark, sf)
    iso = M.isotonic(M.score(model, part(mi, "validation")))
    return M.reliability(M.apply_isotonic(iso, M.score(model, part(mi, "test"))))


@query
def polynomial_features(spark, sf):
    """The degree-2 polynomial terms of the features, one row per term
    (x1, x1 x1, x2, x1 x2, x2 x2, ...)."""
    mi = lazy_model_input(spark, sf)
    # no stage of this pipeline is fitted on rows
    stages = M.feature_stages(scale=False, out_col="unscaled_features") + [P.polynomial_stage()]
    out = M.train(mi, stages).transform(mi)
    from pyspark.ml.functions import vector_to_array

    terms = out.select(C.KEY, F.posexplode(vector_to_array("poly_features")).alias("term", "value"))
    return terms.select(C.KEY, "term", F.round("value", 3).alias("value"))


@query
def reliability(spark, sf):
    """M12 over the fixed scorer."""
    return M.reliability(fixed_scored(spark, sf))


@query
def grid_search(spark, sf):
    """M13."""
    mi = model_input(spark, sf)
    return M.grid_search(part(mi, "train"), part(mi, "validation"))


@query
def bagging(spark, sf):
    """Three 1:1 bags, soft vote, test metrics at the validation tau*."""
    mi = model_input(spark, sf)
    models = M.bag(part(mi, "train"), k=3)
    val = materialize(M.vote(models, part(mi, "validation")), "voted-validation")
    test = M.vote(models, part(mi, "test"))
    return E.metrics_record(test, E.tau_star(val))


# ============================================================ E: evaluation
@query
def cost_curve(spark, sf):
    """E1 over all kept rows."""
    return E.cost_curve(fixed_scored(spark, sf))


@query
def cost_curve_sampled(spark, sf):
    """E1 on a D4 sample, each kept negative counted 1/fraction times."""
    from txnlab.functions.columns import fixed_score

    s = D.stratified_sample(kept(spark, sf).select(C.KEY, C.LABEL, "amount", "newbalanceOrig"))
    # score and weight in one projection: no self-join on the key
    scored = s.select(F.col(C.LABEL).cast("int").alias("label"), fixed_score().alias("score"), "sample_weight")
    return E.cost_curve(scored, weight_col="sample_weight")


@query
def best_threshold(spark, sf):
    """E2."""
    return E.best_threshold(E.cost_curve(fixed_scored(spark, sf), with_rows=True))


@query
def best_threshold_by_ratio(spark, sf):
    """E1/E2 at FN:FP cost ratios 1, 5, 25 and 100 over all kept rows."""
    return E.best_threshold_by_ratio(fixed_scored(spark, sf))


def _counts(spark, sf):
    """Positives/negatives per (split, score) of the fixed scorer, written once."""
    return DP.split_counts_table(fixed_scored_split(spark, sf, written=False))


def _test_conf(spark, sf):
    c = _counts(spark, sf)
    return E.confusion(DP.rows_of(c, "test"), DP.validation_tau(c), weight_col="n")


@query
def confusion(spark, sf):
    """Test split at the validation tau*."""
    return _test_conf(spark, sf)


@query
def prf(spark, sf):
    """E4."""
    return E.prf(_test_conf(spark, sf))


@query
def fbeta(spark, sf):
    """E5 (beta = 2)."""
    return E.fbeta(_test_conf(spark, sf), 2.0)


@query
def cost_at(spark, sf):
    """E10."""
    return E.cost_at(_test_conf(spark, sf))


@query
def roc_auc(spark, sf):
    """E6 (exact)."""
    return E.roc_auc(fixed_scored(spark, sf))


@query
def pr_auc(spark, sf):
    """E7."""
    return E.pr_auc(fixed_scored(spark, sf))


@query
def mllib_auc(spark, sf):
    """E6/E7 as MLlib's evaluator reports them (1,000 bins, and exact) next to ours."""
    s = fixed_scored(spark, sf)
    pred = materialize(E.as_raw_prediction(s).withColumn("label", F.col("label").cast("double")), "raw-pred")
    binned = E.evaluator_auc(pred, num_bins=1000)
    exact = E.evaluator_auc(pred, num_bins=0)
    ours = E.auc_metrics(s)
    return ours.select(
        "roc_auc", "pr_auc",
        F.lit(round(binned["roc_auc"], 9)).alias("mllib_roc_auc_1000_bins"),
        F.lit(round(binned["pr_auc"], 9)).alias("mllib_pr_auc_1000_bins"),
        F.lit(round(exact["roc_auc"], 9)).alias("mllib_roc_auc_exact"),
        F.lit(round(exact["pr_auc"], 9)).alias("mllib_pr_auc_exact"),
    )


@query
def roc_points(spark, sf):
    """E8."""
    return E.roc_points(fixed_scored(spark, sf))


@query
def pr_points(spark, sf):
    """E9."""
    return E.pr_points(fixed_scored(spark, sf))


@query
def roc_points_binned(spark, sf):
    """E8 with scores pooled into 1,000 bins."""
    return E.roc_points(fixed_scored(spark, sf), mode="binned", bins=1000)


@query
def threshold_robustness(spark, sf):
    """E11 on the validation split."""
    c = _counts(spark, sf)
    return E.threshold_robustness(E.cost_curve(DP.rows_of(c, "validation"), with_rows=True, weight_col="n"))


@query
def random_baseline(spark, sf):
    """E12 on the test split."""
    return E.random_baseline(DP.rows_of(_counts(spark, sf), "test"), weight_col="n")


def _split_record(c, name):
    return E.metrics_record(None, DP.validation_tau(c), counts=DP.counts_of(c, name))


@query
def metric_parity(spark, sf):
    """Validation vs test metrics at the validation tau*."""
    c = _counts(spark, sf)
    return E.metric_parity(E.metrics_long(_split_record(c, "validation")), E.metrics_long(_split_record(c, "test")))


@query
def targets(spark, sf):
    """E14 on the test metrics."""
    return E.targets(E.metrics_long(_split_record(_counts(spark, sf), "test")))


@query
def threshold_record(spark, sf):
    """E15."""
    val = part(fixed_scored_split(spark, sf), "validation")
    return E.threshold_record(E.cost_curve(val, with_rows=True), val, val, with_timestamp=False)


@query
def metrics_record(spark, sf):
    """Test split at the validation tau*."""
    return DP.validate_then_test(_counts(spark, sf))


# ============================================================ L, R
@query
def ordered(spark, sf):
    """L1."""
    return E.ordered(A.type_label_counts(raw(spark, sf)))


@query
def top_alerts(spark, sf):
    """The 100 highest scores (ties by key)."""
    return E.top_alerts(fixed_scored(spark, sf), 100)


@query
def run_record(spark, sf):
    """R1/R2."""
    mi, _, secs = _trained(spark, sf)
    return R.run_record(spark, {n: part(mi, n) for n in C.SPLIT_NAMES}, fit_seconds=secs)


# ============================================================ calibration, thresholds over all scores
@query
def isotonic_steps(spark, sf):
    """Isotonic calibration over all distinct scores of the kept rows, block by block."""
    return H.isotonic_steps(H.score_blocks(fixed_scored(spark, sf)))


@query
def isotonic_scores(spark, sf):
    """Every kept row's calibrated score."""
    scored = materialize(fixed_scored(spark, sf), "scored")
    return round_doubles(H.apply_isotonic_steps(H.score_blocks(scored), scored))


@query
def optimal_thresholds(spark, sf):
    """The thresholds that are best at some cost ratio, each with its ratios."""
    return H.optimal_thresholds(H.score_blocks(fixed_scored(spark, sf)))


@query
def best_threshold_at_ratios(spark, sf):
    """E2 over all scores, not a grid, at ratios 1 to 1,000."""
    corners = materialize(H.optimal_thresholds(H.score_blocks(fixed_scored(spark, sf))), "corners")
    return H.best_threshold_at(corners, [float(r) for r in range(1, 1001)])


@query
def exact_sample(spark, sf):
    """1,000 of the kept rows by type and amount, which repeat: how many there are,
    and how many of them the table has too."""
    rows = materialize(kept(spark, sf).select(C.TYPE, F.round("amount", -4).alias("amount")), "sample-input")
    drawn = materialize(D.exact_sample(rows, 1000), "sample")
    n = lambda df: df.groupBy(C.TYPE, "amount").agg(F.count(F.lit(1)).alias("n"))
    have = n(rows).withColumnRenamed("n", "have")
    return n(drawn).join(have, [C.TYPE, "amount"], "left").agg(
        F.sum("n").alias("rows"), F.sum(F.least("n", F.coalesce("have", F.lit(0)))).alias("rows_in_table"))


# ============================================================ stored profiles
def _stored_profile(spark, sf):
    """Sketches of the transactions by type, each type appended as a load of its own."""
    path = shared_dir(spark, "sketches")
    t = materialize(raw(spark, sf), "profile-input")
    for types in (["TRANSFER", "CASH_OUT"], ["PAYMENT", "CASH_IN", "DEBIT"]):
        load = t.filter(F.col(C.TYPE).isin(types))
        K.append_sketches(K.profile_sketches(load, C.NUMERIC_COLUMNS, C.ID_COLUMNS, F.col(C.TYPE)), path)
    return t, K.read_sketches(spark, path)


@query
def stored_quantiles(spark, sf):
    """A5/A7 from stored sketches: which merged quantiles lie within 1 % of their rank."""
    t, sketches = _stored_profile(spark, sf)
    q = K.merged_quantiles(sketches, [0.01, 0.25, 0.5, 0.75, 0.99])
    at = {(r.column, r.prob): r.value for r in q.collect()}  # a row per column and quantile
    ranks = t.agg(*[F.count_if(F.col(c) < v).alias(f"{i}b") for i, ((c, _), v) in enumerate(at.items())],
                  *[F.count_if(F.col(c) <= v).alias(f"{i}u") for i, ((c, _), v) in enumerate(at.items())])
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(p).alias("prob"), F.col(f"{i}b").alias("below"),
                                        F.col(f"{i}u").alias("upto")) for i, (c, p) in enumerate(at)]))
    ranks = ranks.select(each.alias("x")).select("x.*")
    near = (F.col("below") <= (F.col("prob") + 0.01) * F.col("n")) & (F.col("upto") >= (F.col("prob") - 0.01) * F.col("n"))
    return q.join(ranks, ["column", "prob"]).select("column", "prob", "n", near.alias("within"))


@query
def stored_cardinality(spark, sf):
    """A18 from stored sketches: distinct ids over all loads, to 1 % of the exact count."""
    t, sketches = _stored_profile(spark, sf)
    exact = A.id_cardinality(t, exact=True).select("column", F.col("distinct_count").alias("exact"))
    near = F.abs(F.col("distinct_count") - F.col("exact")) <= 0.01 * F.col("exact")
    return K.merged_cardinality(sketches).join(exact, "column").select("column", "n", "exact", near.alias("within"))


@query
def id_overlap(spark, sf):
    """Ids of the train and test splits and how many both have (theta sketches)."""
    s = D.hash_split(kept(spark, sf))
    sketches = materialize(K.profile_sketches(s, ids=C.ID_COLUMNS, by=F.col("split")), "split-sketches")
    return K.merged_overlap(part_of(sketches, "train"), part_of(sketches, "test"))


def part_of(sketches, name):
    return sketches.filter(F.col("part") == name)


# ============================================================ loads, models, skew
@query
def quarantine_report(spark, sf):
    """The transactions as CSV, one amount in a hundred not a number, loaded with
    broken rows put aside: rows accepted, rejected and by reason."""
    src, out = shared_dir(spark, "quarantine-in"), shared_dir(spark, "quarantine")
    bad = F.when(F.col("step") % 100 == 0, F.lit("n/a")).otherwise(F.col("amount").cast("string"))
    raw(spark, sf).withColumn("amount", bad).write.option("header", True).csv(src)
    return Z.quarantine_report(spark, Z.load_with_quarantine(spark, src, out))


@query
def duplicates_by_load(spark, sf):
    """A2 load by load: payments between the same accounts of the same type, the
    days as three loads; repeated within a load, and against earlier ones."""
    cols, store = [C.TYPE, "nameOrig", "nameDest"], shared_dir(spark, "loads")
    t = materialize(raw(spark, sf).select("step", *cols), "loads-input")
    for i in range(3):
        load = t.filter(F.coalesce(F.expr("step div 24 % 3"), F.lit(0)) == i)
        report = L.merge_load(load, store, f"load-{i}", cols)
    return report


@query
def model_versions(spark, sf):
    """Two versions published and loaded: what their metadata say, and the largest
    difference between scores before and after."""
    mi, root, out = model_input(spark, sf), shared_dir(spark, "models"), None
    train = part(mi, "train")
    for reg in (C.REG_PARAM, 10 * C.REG_PARAM):
        model = M.train(M.weighted(train), M.feature_stages() + [M.lr_stage(reg)])
        n = V.publish(model, root, train.select(*C.FEATURES).schema, features=list(C.FEATURES), seed=C.SEED, reg_param=reg)
        loaded, meta = V.load_version(spark, root, n, train)
        a = M.score(model, part(mi, "test"), keep=(C.KEY,)).select(C.KEY, F.col("score").alias("a"))
        b = M.score(loaded, part(mi, "test"), keep=(C.KEY,)).select(C.KEY, F.col("score").alias("b"))
        row = a.join(b, C.KEY).agg(F.coalesce(F.max(F.abs(F.col("a") - F.col("b"))), F.lit(0.0)).alias("largest_difference"))
        row = row.select(F.lit(meta["version"]).alias("version"), F.lit(float(meta["reg_param"])).alias("reg_param"),
                         F.lit(len(meta["features"])).alias("features"), "largest_difference")
        out = row if out is None else out.unionByName(row)
    return out


@query
def salted_join(spark, sf):
    """Transactions with their type's positive rate, the heavy types dealt over tasks."""
    t = materialize(transactions(spark, sf), "salted-input")
    return skew.salted_join(t.select(C.KEY, C.TYPE), A.fraud_rate_by_type(t), C.TYPE, "left")


@query
def halving_search(spark, sf):
    """M13 by successive halving: every rung's settings, on more and more rows."""
    mi = model_input(spark, sf)
    return search.halving_search(part(mi, "train"), part(mi, "validation"))
