"""The end-to-end job writes every result table; R3 and streaming helpers."""

import os


from txnlab.operators.records import cached
from txnlab.plans.inputs import transactions
from txnlab.plans.job import run_job
from txnlab.session import shared_dir
from txnlab.sources.results import read_result

from conftest import SF001


def test_job_writes_all_tables(spark):
    out, models = shared_dir(spark, "job-out"), shared_dir(spark, "job-models")
    paths = run_job(spark, transactions(spark, SF001), out, models)
    for name in ("quality_null_counts", "quality_duplicates", "eda_type_by_label_counts", "cost_curve",
                 "tau_star", "metrics_test_at_tau", "roc_points", "pr_points", "lr_coefficients", "dist_evidence"):
        assert os.path.isdir(paths[name]), name
    m = read_result(spark, paths["metrics_test_at_tau"], "json").first()
    assert m.tp + m.fp + m.tn + m.fn > 0 and 0 <= m.roc_auc <= 1
    curve = read_result(spark, paths["cost_curve"], "csv")
    assert curve.count() == 99
    t = read_result(spark, paths["tau_star"], "json").first()
    assert t.sampled is False and t.scan_points == 99 and t.validation_rows == t.validation_rows_used


def test_job_from_csv_without_key(spark):
    src = shared_dir(spark, "raw-csv")
    transactions(spark, SF001).drop("txn_key").write.option("header", True).csv(src)
    from txnlab.sources.transactions import read_transactions

    paths = run_job(spark, read_transactions(spark, src), shared_dir(spark, "o"), shared_dir(spark, "m"))
    assert read_result(spark, paths["class_counts"], "csv").count() == 3


def test_cached_releases(spark):
    df = spark.range(10)
    with cached(df) as d:
        assert d.count() == 10 and d.storageLevel.useMemory
    assert not df.storageLevel.useMemory


def test_hourly_alert_counts_batch_equivalent(spark):
    from txnlab.streaming import hourly_alert_counts

    scored = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (30, 1)], "step int, alert int")
    got = {r.hour.hour if r.hour.day == 1 else 24 + r.hour.hour: (r.rows, r.alerts)
           for r in hourly_alert_counts(scored).collect()}
    assert got == {1: (2, 1), 2: (1, 1), 30: (1, 1)}


def test_job_random_split_and_sampled_threshold(spark):
    out, models = shared_dir(spark, "job-out-rs"), shared_dir(spark, "job-models-rs")
    paths = run_job(spark, transactions(spark, SF001), out, models, split_mode="random",
                    threshold_sample={0: 0.5, 1: 1.0}, c_fn=5.0)
    t = read_result(spark, paths["tau_star"], "json").first()
    assert t.sampled is True and t.fn_cost == 5.0
    assert t.validation_rows_used < t.validation_rows
    assert read_result(spark, paths["class_counts"], "csv").count() == 3
