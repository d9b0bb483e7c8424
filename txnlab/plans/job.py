"""The whole job, end to end, writing the same result tables as the script it
replaces (FIXTURES F4) -- every step a distributed operator.

    python -m txnlab.plans.job --input data.csv --out outputs --models models
    python -m txnlab.plans.job --tables /root/testdata/sf0.01 --out outputs --models models

Order: read -> quality checks -> type x label -> features -> split -> class
weights -> fit -> coefficients -> tau* on validation -> test metrics, ROC and
PR points -> run record.  The split and the scored sets are written once to
the shared scratch folder; result tables are written to ``out``.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlab import config as C
from txnlab.operators import evaluate as E
from txnlab.operators import features as P
from txnlab.operators import model as M
from txnlab.operators import profile as A
from txnlab.operators import sampling as D
from txnlab.operators import records as R
from txnlab.session import materialize, shared_dir
from txnlab.sources.results import save_model, write_result
from txnlab.sources.transactions import (
    TRANSACTION_SCHEMA,
    add_row_key,
    read_transactions,
    transactions_from_tables,
)


def run_job(spark: SparkSession, transactions: DataFrame, out: str, models: str,
            reg: float = C.REG_PARAM, c_fp: float = C.COST_FP, c_fn: float = C.COST_FN,
            key: str = C.KEY, weights_mode: str = "ratio", split_mode: str = "hash",
            threshold_sample: dict | None = None) -> dict:
    """Run every step; returns the paths written, by table name.

    ``split_mode``: ``hash`` (D2, repeatable, default), ``stratified`` (D3,
    hash within class), ``exact_stratified`` (D3, exact proportions) or
    ``random`` (D1, ``randomSplit`` with the seed, as the original job).
    ``threshold_sample``: class -> fraction to sample the validation set for
    the threshold search (D4); each kept row then counts ``1/fraction``, so
    the FP cost is not under-counted, and the record says it sampled.
    """
    paths: dict[str, str] = {}

    def put(name: str, df: DataFrame, fmt: str = "csv", single_file: bool = True) -> None:
        # result tables are small and go to one file; a table that grows with
        # the data (one point per distinct score) keeps its partitioning
        paths[name] = write_result(df, os.path.join(out, name), fmt, single_file=single_file)

    # the input is parsed once; every check below reads the stored columns
    stored = shared_dir(spark, "job-input")
    add_row_key(transactions, key).write.parquet(stored)
    transactions = spark.read.parquet(stored)
    raw = transactions.drop(key) if key in transactions.columns else transactions
    # the schema as a tree (its size is the number of columns)
    paths["schema"] = os.path.join(out, "schema.txt")
    tree = spark.createDataFrame([(raw.schema.treeString(),)], "value string")
    tree.coalesce(1).write.mode("overwrite").text(paths["schema"])
    put("schema_report", A.schema_report(raw, TRANSACTION_SCHEMA))
    # quality checks and type x label (one scan each)
    put("quality_null_counts", A.null_counts(raw))
    put("quality_duplicates", A.duplicate_count(raw))
    put("quality_negative_value_counts", A.negative_counts(raw))
    put("quality_checks", A.quality_checks(raw))
    put("quality_amount_summary", A.quantile_summary(raw, ["amount"]))
    put("eda_type_by_label_counts", E.ordered(A.type_label_counts(raw)))
    put("eda_type_by_label_pivot", E.ordered(A.type_label_pivot(raw), [C.TYPE]))
    amounts = P.drop_null_rows(P.log1p_cols(P.select_types(raw), ["amount"]), ["amount", "amount_log1p"])
    put("eda_amount_histograms", A.histogram(amounts, "amount", clip_q=C.CLIP_QUANTILE, name="amount_clipped")
        .unionByName(A.histogram(amounts, "amount_log1p")))

    # features and the split, written once and counted while they are written
    splits = {"hash": lambda f: D.hash_split(f, key), "stratified": lambda f: D.stratified_split(f, key=key),
              "exact_stratified": lambda f: D.exact_stratified_split(f, key=key), "random": D.random_split}
    if split_mode not in splits:
        raise ValueError(f"unknown split_mode {split_mode!r}")
    split, seen = R.write_observed(
        spark, stored, lambda t: splits[split_mode](P.drop_null_rows(P.feature_table(t))), "job-split", R.split_measures())
    put("class_counts", R.split_counts_of(spark, seen))
    train = split.filter(F.col("split") == "train")
    val = split.filter(F.col("split") == "validation")
    test = split.filter(F.col("split") == "test")

    # fit, save, coefficients
    model, secs = M.timed_train(M.weighted(train, weights_mode), M.feature_stages() + [M.lr_stage(reg)])
    paths["model"] = save_model(model, os.path.join(models, "lr_pipeline"))
    put("lr_coefficients", M.coefficients(model))

    # tau* on validation, the held-out evaluation on test
    scored = materialize(M.score(model, split.filter(F.col("split") != "train"), keep=(key, "split")), "job-scored")
    s_val = scored.filter(F.col("split") == "validation")
    s_test = scored.filter(F.col("split") == "test")
    if threshold_sample:
        used = materialize(D.stratified_sample(s_val, "label", threshold_sample), "job-threshold-sample")
        curve = E.cost_curve(used, c_fp, c_fn, weight_col="sample_weight", with_rows=True)
    else:
        used = s_val
        curve = E.cost_curve(s_val, c_fp, c_fn, with_rows=True)
    put("cost_curve", curve.drop("_rows"))
    put("tau_star", E.threshold_record(curve, s_val, used, c_fp, c_fn, sampled=bool(threshold_sample)), "json")
    tau = E.best_threshold(curve).select("tau_star").scalar()
    # the test set's counts per score, written once for the metrics and both curves
    counts = materialize(E.score_counts(s_test), "job-test-counts")
    metrics = materialize(E.metrics_record(None, tau, counts=counts), "job-metrics")
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    put("metrics_test_at_tau", metrics.withColumn("timestamp", stamp), "json")
    put("metrics_test_at_tau_csv", metrics)
    put("roc_points", E.roc_points(s_test, counts=counts), single_file=False)
    put("pr_points", E.pr_points(s_test, counts=counts), single_file=False)
    put("dist_evidence", R.run_record(spark, {"train": train, "validation": val, "test": test}, fit_seconds=secs),
        "json")
    return paths


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description="cost-sensitive fraud job")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--input", help="headered transactions CSV (or parquet with --format parquet)")
    src.add_argument("--tables", help="folder with lineitem/orders/customer/supplier parquet")
    ap.add_argument("--format", default="csv")
    ap.add_argument("--out", required=True)
    ap.add_argument("--models", required=True)
    ap.add_argument("--reg", type=float, default=C.REG_PARAM)
    ap.add_argument("--c-fp", type=float, default=C.COST_FP)
    ap.add_argument("--c-fn", type=float, default=C.COST_FN)
    ap.add_argument("--weights", choices=["ratio", "balanced"], default="ratio")
    ap.add_argument("--split", choices=["hash", "stratified", "exact_stratified", "random"], default="hash")
    ap.add_argument("--sample-negatives", type=float, default=None,
                    help="fraction of validation negatives for the threshold search (positives all kept)")
    args = ap.parse_args(argv)

    from txnlab.session import build_session

    spark = build_session(app="txnlab-job")
    if args.input:
        tx = read_transactions(spark, args.input, args.format)
    else:
        tx = transactions_from_tables(spark, args.tables)
    sample = {0: args.sample_negatives, 1: 1.0} if args.sample_negatives else None
    paths = run_job(spark, tx, args.out, args.models, reg=args.reg, c_fp=args.c_fp, c_fn=args.c_fn,
                    weights_mode=args.weights, split_mode=args.split, threshold_sample=sample)
    for name, path in paths.items():
        print(f"{name}: {path}")
    spark.stop()


if __name__ == "__main__":
    main()
