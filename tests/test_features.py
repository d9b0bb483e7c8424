"""Row operators, profiles and splits on small hand-made inputs (FIXTURES F6)."""

import pytest
from pyspark.sql import functions as F

from txnlab import config as C
from txnlab.operators import features as P
from txnlab.operators import profile as A
from txnlab.operators import sampling as D
from txnlab.sources.transactions import TRANSACTION_SCHEMA

ROW = (1, "TRANSFER", 100.0, "C1", 100.0, 0.0, "M1", 0.0, 100.0, 1, 0)


def tx(spark, rows):
    return spark.createDataFrame(rows, TRANSACTION_SCHEMA)


def test_encode_unseen_type(spark):
    df = tx(spark, [ROW, (1, "CASH_OUT", *ROW[2:]), (1, "WIRE", *ROW[2:])])
    got = sorted(r.type_encoded for r in P.encode_type(df).collect())
    assert got == [-1, 0, 1]
    assert sorted(r.type_encoded for r in P.encode_type(df, unseen=0).collect()) == [0, 0, 1]


def test_log1p_policies(spark):
    df = spark.createDataFrame([(-1.0,), (-5.0,), (0.0,), (None,)], "x double")
    assert [r.x_log1p for r in P.log1p_cols(df, ["x"]).collect()] == [None, None, 0.0, None]
    assert [r.x_log1p for r in P.log1p_cols(df, ["x"], on_domain="clamp").collect()] == [0.0, 0.0, 0.0, None]
    with pytest.raises(Exception):
        P.log1p_cols(df, ["x"], on_domain="error").collect()


def test_null_counts_empty_and_nulls(spark):
    empty = tx(spark, [])
    assert all(r.null_count == 0 for r in A.null_counts(empty).collect())
    df = tx(spark, [ROW, (None, "TRANSFER", None, "C1", 1.0, 1.0, "M", 1.0, 1.0, 0, 0)])
    got = {r.column: r.null_count for r in A.null_counts(df).collect()}
    assert got["step"] == 1 and got["amount"] == 1 and got["type"] == 0


def test_duplicates_and_validity(spark):
    df = tx(spark, [ROW, ROW, ROW, (2, *ROW[1:])])
    assert A.duplicate_count(df).first().duplicate_rows == 2
    neg = tx(spark, [(1, "CASH_OUT", 0.0, "C", -5.0, 0.0, "M", 1.0, 1.0, 0, 0)])
    f = P.validity_flags(neg).first()
    assert f.amount_is_zero and f.any_negative and not f.any_null


def test_balance_flags(spark):
    f = P.balance_flags(tx(spark, [ROW])).first()
    assert f.payer_ok and f.payee_ok and f.both_ok


def test_schema_report_flags_type_drift(spark):
    df = tx(spark, [ROW]).withColumn("step", F.col("step").cast("string"))
    rep = {r.column: r for r in A.schema_report(df, TRANSACTION_SCHEMA).collect()}
    assert not rep["step"].type_ok and rep["amount"].type_ok


def test_fingerprint_is_order_free(spark):
    df = tx(spark, [ROW, (2, *ROW[1:]), ROW])
    a = A.fingerprint(df).first()
    b = A.fingerprint(df.orderBy(F.col("step").desc()).repartition(3)).first()
    assert tuple(a) == tuple(b)
    c = A.fingerprint(tx(spark, [(2, *ROW[1:])])).first()
    assert a.hash_sum != c.hash_sum  # xor alone would cancel the duplicate pair


def test_hash_split_disjoint_complete_repeatable(spark, tx01):
    s1 = D.hash_split(tx01)
    s2 = D.hash_split(tx01.repartition(5))
    j = s1.select(C.KEY, "split").join(s2.select(C.KEY, F.col("split").alias("s2")), C.KEY)
    assert j.count() == tx01.count()
    assert j.filter(F.col("split") != F.col("s2")).count() == 0
    counts = {r.split: r["count"] for r in s1.groupBy("split").count().collect()}
    assert set(counts) == {"train", "validation", "test"}
    assert abs(counts["train"] / tx01.count() - 0.7) < 0.02


def test_stratified_split_each_class_in_proportion(spark, tx01):
    k = P.select_types(tx01)
    s = D.stratified_split(k)
    for lab in (0, 1):
        part = s.filter(F.col(C.LABEL) == lab)
        n = part.count()
        tr = part.filter(F.col("split") == "train").count()
        assert abs(tr / n - 0.7) < 0.06


def test_downsample_keeps_all_positives(spark, tx01):
    k = P.select_types(tx01)
    d = D.downsample(k, k=1.0)
    pos = k.filter(F.col(C.LABEL) == 1).count()
    assert d.filter(F.col(C.LABEL) == 1).count() == pos
    neg = d.filter(F.col(C.LABEL) == 0).count()
    assert 0.7 * pos < neg < 1.3 * pos


def test_class_weights_modes_and_no_positives(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "isFraud int")
    r = D.class_weights(df, mode="ratio").first()
    assert (r.weight_neg, r.weight_pos) == (1.0, 3.0)
    b = D.class_weights(df, mode="balanced").first()
    assert b.weight_pos == pytest.approx(2.0) and b.weight_neg == pytest.approx(4 / 6)
    none = D.class_weights(spark.createDataFrame([(0,)], "isFraud int")).first()
    assert none.weight_pos == 1.0


def test_stratified_sample_weights(spark, tx01):
    s = D.stratified_sample(P.select_types(tx01), fractions={0: 0.1, 1: 1.0})
    ws = {r.isFraud: r.sample_weight for r in s.select("isFraud", "sample_weight").distinct().collect()}
    assert ws == {0: 10.0, 1: 1.0}


def test_histogram_closed_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (2.0,)], "v double")
    h = {r.bin: r["count"] for r in A.histogram(df, "v", bins=2).collect()}
    assert h == {1: 1, 2: 3}
    one = A.histogram(spark.createDataFrame([(5.0,)], "v double"), "v", bins=60)
    assert one.agg(F.sum("count")).first()[0] == 1


def test_clip_quantile_bounds(spark):
    df = spark.range(0, 101).select(F.col("id").cast("double").alias("x"))
    out = P.clip_quantile(df, "x", 0.9).agg(F.max("x_clipped"), F.min("x_clipped")).first()
    assert tuple(out) == (90.0, 0.0)


def test_clip_keeps_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "x double")
    got = [r.x_clipped for r in P.clip_quantile(df, "x", 0.5).orderBy(F.col("x").asc_nulls_first()).collect()]
    assert got == [None, 1.0, 2.0]


def test_duplicates_by_row_hash(spark):
    df = tx(spark, [ROW, ROW, ROW, (2, *ROW[1:])])
    assert A.duplicate_count(df, row_hash=True).first().duplicate_rows == 2


def test_histogram_fixed_range(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (0.5,), (1.0,), (3.0,)], "v double")
    h = {r.bin: (r["count"], r.bin_lo, r.bin_hi) for r in A.histogram(df, "v", bins=2, lo=0.0, hi=1.0).collect()}
    assert h == {1: (1, 0.0, 0.5), 2: (2, 0.5, 1.0)}


@pytest.mark.parametrize("method", ["two_phase", "rows", "hash"])
def test_duplicate_methods_agree(spark, method):
    rows = [ROW, ROW, ROW, (2, *ROW[1:]), (None, *ROW[1:]), (None, *ROW[1:]), (3, *ROW[1:])]
    assert A.duplicate_count(tx(spark, rows), method=method).first().duplicate_rows == 3
    assert A.duplicate_count(tx(spark, []), method=method).first().duplicate_rows == 0


@pytest.mark.parametrize("k", [None, 4])
def test_exact_stratified_split_proportions(spark, tx01, k):
    s = D.exact_stratified_split(P.select_types(tx01), n_buckets=k)
    assert s.count() == 23809
    for lab in (0, 1):
        part = s.filter(F.col(C.LABEL) == lab)
        n = part.count()
        got = {r.split: r["count"] for r in part.groupBy("split").count().collect()}
        # exact up to one hash group (keys are unique here, so one row)
        assert abs(got["train"] - 0.7 * n) <= 1 and abs(got["validation"] - 0.15 * n) <= 1.5


def test_interactions_with_spec(spark):
    df = tx(spark, [ROW, (1, "CASH_OUT", 0.0, "C", 5.0, 5.0, "M", 1.0, 1.0, 0, 0)])
    out = P.interactions(df, {"amount_sq": "amount * amount"}).orderBy("amount").collect()
    assert out[0].orig_delta_ratio is None  # zero amount: ratio undefined, not an error
    assert out[1].amount_sq == 10000.0 and out[1].orig_delta == 100.0
