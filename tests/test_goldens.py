"""Golden numbers at sf0.01 (FIXTURES F5), measured independently."""

from pyspark.sql import functions as F

from txnlab import config as C
from txnlab.operators import evaluate as E
from txnlab.operators import features as P
from txnlab.operators import profile as A
from txnlab.plans import decide
from txnlab.plans.inputs import scored_fixed


def test_row_counts(tx01):
    r = tx01.agg(F.count(F.lit(1)).alias("n"), F.sum("isFraud").alias("fraud"),
                 F.sum("isFlaggedFraud").alias("flagged")).first()
    assert (r.n, r.fraud, r.flagged) == (60000, 705, 1705)
    assert P.select_types(tx01).count() == 23809


def test_type_label_counts(tx01):
    got = {(r.type, r.isFraud): r["count"] for r in A.type_label_counts(tx01).collect()}
    assert got[("TRANSFER", 0)] == 11432 and got[("TRANSFER", 1)] == 343
    assert got[("CASH_OUT", 0)] == 11672 and got[("CASH_OUT", 1)] == 362
    assert got[("CASH_IN", 0)] == 12056 and got[("DEBIT", 0)] == 12017 and got[("PAYMENT", 0)] == 12118
    assert not any(k[1] == 1 for k in got if k[0] in ("CASH_IN", "DEBIT", "PAYMENT"))


def test_negative_counts_and_balance(tx01):
    neg = A.negative_counts(tx01).first()
    assert (neg.oldbalanceOrg, neg.oldbalanceDest, neg.newbalanceDest) == (5046, 3471, 1783)
    bc = A.balance_consistency(tx01).first()
    assert (bc.both_ok_rows, bc.rows) == (5125, 23809)


def test_log1p_nulls_and_drop(tx01):
    ft = P.feature_table(tx01)
    nulls = ft.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in
                     ("oldbalanceOrg_log1p", "oldbalanceDest_log1p", "newbalanceDest_log1p")]).first()
    assert tuple(nulls) == (1931, 1416, 728)
    kept = P.drop_null_rows(ft)
    assert kept.count() == 20562 and kept.filter(F.col(C.LABEL) == 1).count() == 598


def test_flagship_golden(tx01):
    r = decide.flagship(scored_fixed(P.select_types(tx01))).first()
    assert r.tau_star == 0.8 and r.min_cost == 6335.0
    assert (r.tp, r.fp, r.tn, r.fn) == (705, 6335, 16769, 0)


def test_exact_auc_golden(tx01):
    r = E.auc_metrics(scored_fixed(P.select_types(tx01))).first()
    assert abs(r.roc_auc - 0.8629936359305) < 1e-6
    assert abs(r.pr_auc - 0.0998632782907) < 1e-6


def test_every_fraud_row_clears_the_account(tx01):
    assert tx01.filter((F.col("isFraud") == 1) & (F.col("newbalanceOrig") != 0)).count() == 0
