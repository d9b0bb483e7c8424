"""Rules that hold at every input size: null scores, lost rows, headers, scratch."""

import math

import pytest
from pyspark.sql import functions as F

from txnlab import config as C
from txnlab import session
from txnlab.operators import evaluate as E
from txnlab.operators import model as M
from txnlab.operators import profile as A
from txnlab.operators import sampling as D
from txnlab.operators.ranking import ROWS_PER_RANGE_CONF, exact_quantiles, range_ids, running_totals
from txnlab.session import checkpoint_root, drop_scratch, materialize
from txnlab.sources.transactions import TRANSACTION_SCHEMA, read_text_columns, read_transactions


def scores(spark, n=2000):
    vals = [None, float("nan"), 0.0, 1.0, 0.29, 0.57, 0.58, 0.5]
    rows = [(vals[i % 8] if i % 3 else (i * 37 % 1000) / 1000, i % 7 == 0) for i in range(n)]
    return spark.createDataFrame([(s, int(y)) for s, y in rows], "score double, label int"), rows


@pytest.mark.parametrize("per", ["2000000", "50"])
def test_one_null_rule_at_every_size(spark, per):
    df, rows = scores(spark)
    live = [(s, y) for s, y in rows if s is not None and not math.isnan(s)]
    spark.conf.set(ROWS_PER_RANGE_CONF, per)
    try:
        pos, neg = [s for s, y in live if y], [s for s, y in live if not y]
        auc = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
        assert E.roc_auc(df).first()[0] == pytest.approx(auc, abs=1e-6)
        assert E.roc_points(df).count() == len({s for s, _ in live}) + 2
    finally:
        spark.conf.unset(ROWS_PER_RANGE_CONF)
    for r in E.threshold_counts(df).collect():
        got = E.confusion(df, r.threshold).first() if r.threshold in (0.01, 0.29, 0.5, 0.57, 0.58, 0.99) else None
        if got:
            assert (got.tp, got.fp, got.tn, got.fn) == (r.tp, r.fp, r.tn, r.fn)
    left = E.unscored_count(df).first()
    assert left.rows - left.unscored_rows == len(live)


def test_ranges_of_several_levels_keep_the_order(spark):
    df = spark.range(5000).select((F.col("id") * 7 % 5000).cast("double").alias("v"), F.lit(1).alias("n"))
    ids = range_ids(df, "v", 400)
    assert 200 < ids.select("_range_id").distinct().count() <= 512
    rows = [(r.v, r.cum_n) for r in running_totals(df, "v", ["n"], n_buckets=400).collect()]
    assert sorted(rows) == [(float(i), i + 1) for i in range(5000)]


def test_quantiles_without_values_and_nan(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (3.0, None)], "a double, b double")
    got = {(r.column, r.prob): (r.n, r.value) for r in exact_quantiles(df, ["a", "b"], [0.0, 0.5, 1.0]).collect()}
    assert got == {("a", 0.0): (2, 1.0), ("a", 0.5): (2, 2.0), ("a", 1.0): (2, 3.0),
                   ("b", 0.0): (0, None), ("b", 0.5): (0, None), ("b", 1.0): (0, None)}
    for exact in (True, False):
        assert {r.column: r["count"] for r in A.quantile_summary(df, ["a", "b"], exact=exact).collect()} == {"a": 2, "b": 0}


def test_splits_keep_every_row(spark):
    df = spark.createDataFrame([(None if i % 10 == 0 else i % 2, None if i % 13 == 0 else f"k{i}") for i in range(300)],
                               f"{C.LABEL} int, {C.KEY} string")
    for split in (D.random_split, D.hash_split, D.stratified_split, D.exact_stratified_split):
        out = split(df)
        assert out.count() == 300 and out.filter("split is null").count() == 0
        assert out.select("split").distinct().count() == 3


def test_random_split_reads_its_input_once(spark, tx01):
    plan = D.random_split(tx01)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_sample_cap_holds_and_repeats(spark):
    df = spark.range(20_000).toDF("id")
    a = D.sample_cap(df, 0.5, 1000)
    assert 700 < a.count() <= 1000 and sorted(a.collect()) == sorted(D.sample_cap(df.repartition(7), 0.5, 1000).collect())
    assert 9_000 < D.sample_cap(df, 0.5, 300_000).count() < 11_000


def test_sample_cap_fills_small_caps(spark):
    df = spark.range(20_000).selectExpr("id", "id * 2.5 AS x")
    for cap in (1, 16, 100):
        a = D.sample_cap(df, 0.5, cap)
        assert a.count() == cap and sorted(a.collect()) == sorted(D.sample_cap(df.repartition(7), 0.5, cap).collect())


def test_columns_are_bound_by_name(spark, tmp_path):
    names = TRANSACTION_SCHEMA.fieldNames()
    row = {c: str(i) for i, c in enumerate(names)}
    for where, order in (("a", names), ("b", names[::-1])):
        (tmp_path / where).mkdir()
        (tmp_path / where / "x.csv").write_text(",".join(order) + "\n" + ",".join(row[c] for c in order) + "\n")
    a, b = (read_transactions(spark, str(tmp_path / x)) for x in "ab")
    assert a.schema == b.schema == TRANSACTION_SCHEMA and a.collect() == b.collect()
    (tmp_path / "c.csv").write_text(",".join(names[1:]) + "\n")
    with pytest.raises(ValueError, match="step"):
        read_transactions(spark, str(tmp_path / "c.csv"))
    (tmp_path / "d.csv").write_text(",".join([*names, "more"]) + "\n" + ",".join(["x"] * 12) + "\n")
    with pytest.raises(Exception, match="not int"):
        read_transactions(spark, str(tmp_path / "d.csv")).collect()
    got = {r.column: (r.present, r.extra, r.bad_values)
           for r in A.contract_report(read_text_columns(spark, str(tmp_path / "d.csv")), TRANSACTION_SCHEMA).collect()}
    assert got["step"] == (True, False, 1) and got["type"] == (True, False, 0) and got["more"] == (True, True, 0)


def test_reliability_reports_every_bin_by_its_edges(spark):
    df = spark.createDataFrame([(x, 1) for x in (0.29, 0.57, 0.58, 1.0, None)], "score double, label int")
    got = {r.bin: r.rows for r in M.reliability(df, bins=100).collect()}
    assert len(got) == 100 and {b for b, n in got.items() if n} == {29, 57, 58, 99}


def test_one_sided_metrics_and_undefined_goals(spark):
    a = spark.createDataFrame([("roc_auc", 0.9), ("pr_auc", 0.5)], "metric string, value double")
    b = spark.createDataFrame([("roc_auc", 0.9)], "metric string, value double")
    assert {r.metric: r.ok for r in E.metric_parity(a, b).collect()} == {"roc_auc": True, "pr_auc": False}
    none = spark.createDataFrame([(m, None) for m in C.TARGETS], "metric string, value double")
    assert all(r.met is False for r in E.targets(none).collect())


def test_scratch_is_owned_and_needs_a_shared_folder(spark, monkeypatch):
    monkeypatch.setattr(session, "_owned", {})  # not that of other tests
    materialize(spark.range(3).toDF("x"), "owned")
    assert drop_scratch(spark) >= 1 and drop_scratch(spark) == 0

    class Context:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Context

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError):
        checkpoint_root(Session)
