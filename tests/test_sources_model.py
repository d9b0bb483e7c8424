"""Round trips (S1, S3-S6), the model path (M1-M14) and streaming scoring."""

import os

import pytest
from pyspark.sql import functions as F

from txnlab import config as C
from txnlab.operators import evaluate as E
from txnlab.operators import model as M
from txnlab.operators import profile as A
from txnlab.plans.inputs import model_input, part
from txnlab.session import materialize, shared_dir
from txnlab.sources import read_result, read_transactions, write_result
from txnlab.sources.results import load_model, save_model

from conftest import SF001


@pytest.fixture(scope="module")
def mi(spark):
    return materialize(model_input(spark, SF001), "mi001")


@pytest.fixture(scope="module")
def fitted(mi):
    return M.train(M.weighted(part(mi, "train")), M.feature_stages() + [M.lr_stage()])


def test_csv_round_trip(spark, tx01):
    path = shared_dir(spark, "tx-csv")
    write_result(tx01.drop(C.KEY), path, "csv", single_file=False)
    back = read_transactions(spark, path, "csv")
    assert back.schema == read_transactions(spark, path).schema
    a, b = A.fingerprint(tx01.drop(C.KEY)).first(), A.fingerprint(back).first()
    assert tuple(a) == tuple(b)


def test_result_round_trip_reads_every_part(spark, tx01):
    path = shared_dir(spark, "tlc")
    res = A.type_label_counts(tx01)
    write_result(res.repartition(3), path, "csv", single_file=False)
    back = read_result(spark, path, "csv", schema="type string, isFraud int, count long")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, res.collect()))


def test_model_save_load_same_scores(spark, mi, fitted):
    path = save_model(fitted, shared_dir(spark, "model"))
    a = M.score(fitted, part(mi, "test")).withColumnRenamed("score", "a")
    b = M.score(load_model(path), part(mi, "test")).withColumnRenamed("score", "b")
    j = a.join(b, [C.KEY, "label"])
    assert j.count() == part(mi, "test").count()
    assert j.filter(F.abs(F.col("a") - F.col("b")) > 1e-12).count() == 0


def test_weight_modes_give_the_same_fit(mi):
    tr = part(mi, "train")
    a = M.train(M.weighted(tr, "ratio"), M.feature_stages() + [M.lr_stage()]).stages[-1]
    b = M.train(M.weighted(tr, "balanced"), M.feature_stages() + [M.lr_stage()]).stages[-1]
    assert max(abs(x - y) for x, y in zip(a.coefficients, b.coefficients)) < 1e-4


def test_coefficients_sorted(fitted):
    rows = M.coefficients(fitted, intercept=True).collect()
    assert len(rows) == len(C.FEATURES) + 1
    absvals = [r.abs_coefficient for r in rows]
    assert absvals == sorted(absvals, reverse=True)
    assert M.top_coefficients(fitted, 3).count() == 3


def test_scores_in_unit_interval_and_metrics(mi, fitted):
    s = M.score(fitted, part(mi, "test"))
    assert s.filter((F.col("score") < 0) | (F.col("score") > 1)).count() == 0
    rec = E.metrics_record(s, 0.5).first()
    assert rec.tp + rec.fp + rec.tn + rec.fn == s.count()


def test_isotonic_is_monotone(mi, fitted):
    s = M.score(fitted, part(mi, "validation"))
    iso = M.isotonic(s, bins=50)
    preds = list(iso.predictions)
    assert preds == sorted(preds)


def test_reliability_bins_cover_rows(mi, fitted):
    s = M.score(fitted, part(mi, "test"))
    rel = M.reliability(s, 10)
    assert rel.agg(F.sum("rows")).first()[0] == s.count()


def test_vote_averages(mi, fitted):
    v = M.vote([fitted, fitted], part(mi, "test"))
    s = M.score(fitted, part(mi, "test"))
    j = v.withColumnRenamed("score", "v").join(s, [C.KEY, "label"])
    assert j.filter(F.abs(F.col("v") - F.col("score")) > 1e-12).count() == 0


def test_stream_scoring_matches_batch(spark, fitted):
    from txnlab.plans.inputs import transactions
    from txnlab.streaming import read_transaction_stream, score_stream, start_alert_sink

    src = shared_dir(spark, "stream-src")
    transactions(spark, SF001).repartition(4).write.option("header", True).csv(src)
    stream = read_transaction_stream(spark, src, "csv", keyed=True, max_files_per_trigger=2)
    scored = score_stream(stream, fitted, 0.5)
    out, ck = shared_dir(spark, "alerts"), shared_dir(spark, "alerts-ckpt")
    q = start_alert_sink(scored, out, ck, available_now=True)
    q.awaitTermination(300)
    got = spark.read.parquet(out).count()
    batch = score_stream(read_transactions(spark, src, "csv", keyed=True), fitted, 0.5)
    assert got == batch.filter(F.col("alert") == 1).count()
    assert os.path.isdir(ck)


def test_step_does_not_depend_on_session_time_zone(spark):
    from txnlab.plans.inputs import transactions

    utc = transactions(spark, SF001).agg(F.sum("step"), F.min("step"), F.max("step")).first()
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        la = transactions(spark, SF001).agg(F.sum("step"), F.min("step"), F.max("step")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert tuple(utc) == tuple(la)


def test_read_parquet_under_pinned_schema(spark, tx01):
    path = shared_dir(spark, "tx-parquet")
    tx01.write.parquet(path)
    back = read_transactions(spark, path, "parquet", keyed=True)
    assert back.count() == tx01.count() and back.columns == tx01.columns


def test_hourly_alert_counts_on_a_stream(spark, fitted):
    from txnlab.plans.inputs import transactions
    from txnlab.streaming import hourly_alert_counts, read_transaction_stream, score_stream

    src = shared_dir(spark, "stream-src-hourly")
    transactions(spark, SF001).repartition(3).write.option("header", True).csv(src)
    stream = score_stream(read_transaction_stream(spark, src, "csv", max_files_per_trigger=1), fitted, 0.5)
    q = (hourly_alert_counts(stream, watermark="1000 days").writeStream.format("memory")
         .queryName("hourly_alerts").outputMode("complete").trigger(availableNow=True)
         .option("checkpointLocation", shared_dir(spark, "hourly-ckpt")).start())
    q.awaitTermination(300)
    got = {(r.hour, r.rows, r.alerts) for r in spark.sql("SELECT * FROM hourly_alerts").collect()}
    batch = score_stream(read_transactions(spark, src, "csv", keyed=True), fitted, 0.5)
    want = {(r.hour, r.rows, r.alerts) for r in hourly_alert_counts(batch).collect()}
    assert got == want and len(got) > 0


def test_type_partitioned_store_prunes(spark, tx01):
    from txnlab.operators.features import select_types
    from txnlab.sources import read_stored_transactions, write_transactions

    path = write_transactions(tx01, shared_dir(spark, "by-type"))
    kept = select_types(read_stored_transactions(spark, path))
    plan = spark._jvm.PythonSQLUtils.explainString(kept._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [" in plan and "TRANSFER" in plan.split("PartitionFilters")[1].split("\n")[0]
    assert kept.count() == 23809
    assert read_stored_transactions(spark, path).columns == tx01.columns
