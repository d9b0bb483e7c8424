"""Exact samples, stored sketches, quarantine, model versions, salted joins, observed writes."""

import json
import os
from collections import Counter

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from txnlab.operators import records as R
from txnlab.operators import sampling as D
from txnlab.operators import sketches as K
from txnlab.operators import skew
from txnlab.session import materialize, shared_dir
from txnlab.sources import models as V
from txnlab.sources import quarantine as Z
from txnlab.sources.transactions import TRANSACTION_SCHEMA


# ------------------------------------------------------------------ exact sample
def half_equal(spark):
    return spark.range(4000).selectExpr("id", "'x' AS _sample_a2").unionAll(spark.range(4000).selectExpr("-1L", "'z'"))


@pytest.mark.parametrize("k", [1, 17, 500, 7999, 8000, 9000])
def test_exact_sample_has_k_rows_with_half_of_them_equal(spark, k):
    df = half_equal(spark)
    rows = D.exact_sample(df, k).collect()
    assert len(rows) == min(k, 8000)
    seen = Counter(rows)
    assert all(n == 1 for r, n in seen.items() if r.id >= 0) and seen[(-1, "z")] <= 4000
    equal = seen[(-1, "z")]
    assert abs(equal - len(rows) / 2) <= 4 * len(rows) ** 0.5  # drawn one by one


def test_exact_sample_does_not_depend_on_the_deal(spark, monkeypatch):
    df = half_equal(spark)
    want = Counter(D.exact_sample(df, 300).collect())
    assert Counter(D.exact_sample(df.repartition(7), 300).collect()) == want
    monkeypatch.setattr(D, "COPIES_AT_ONCE", 100)
    assert Counter(D.exact_sample(df.repartition(3), 300).collect()) == want
    assert Counter(D.exact_sample(df, 300, seed=1).collect()) != want
    assert D.exact_sample(df, 0).count() == 0 and D.exact_sample(df.limit(0), 5).count() == 0


def test_kth_key(spark):
    keys = [-(1 << 63), -5, -5, -5, 0, 7, 7, (1 << 63) - 1]
    df = spark.createDataFrame([(k,) for k in keys], "key long")
    assert [D.kth_key(df, i) for i in range(1, 9)] == [
        (-(1 << 63), 1), (-5, 1), (-5, 2), (-5, 3), (0, 1), (7, 1), (7, 2), ((1 << 63) - 1, 1)]
    with pytest.raises(ValueError):
        D.kth_key(df, 9)


# ---------------------------------------------------------------------- sketches
def test_a_new_load_adds_its_sketches_only(spark):
    path = shared_dir(spark, "sketches")
    a = spark.range(50_000).selectExpr("CAST(id AS double) AS v", "CAST(id AS string) AS s", "IF(id % 2 = 0, 'p', 'q') AS part")
    b = spark.range(50_000, 80_000).selectExpr("CAST(id AS double) AS v", "CAST(id % 1000 AS string) AS s", "'r' AS part")
    K.append_sketches(K.profile_sketches(a, ["v"], ["s"], F.col("part")), path)
    first = {f for f in os.listdir(path) if f.endswith(".parquet")}
    K.append_sketches(K.profile_sketches(b, ["v"], ["s"], F.col("part")), path)
    assert first < {f for f in os.listdir(path) if f.endswith(".parquet")}  # old files as they were
    sk = K.read_sketches(spark, path)
    assert sk.count() == 6
    for r in K.merged_quantiles(sk, [0.1, 0.5, 0.9]).collect():
        assert r.n == 80_000 and abs(r.value / 80_000 - r.prob) < 0.01
    d = K.merged_cardinality(sk).first()
    assert d.n == 80_000 and abs(d.distinct_count - 50_000) < 500
    parts = K.merged_quantiles(sk.filter("part <> 'r'"), [0.5]).first()
    assert parts.n == 50_000 and abs(parts.value - 25_000) < 500
    o = K.merged_overlap(sk.filter("part = 'p'"), sk.filter("part = 'r'")).first()
    assert (o.distinct_a, o.distinct_b, o.in_both, o.in_either) == (25_000, 1000, 500, 25_500)


def test_sketches_have_one_aggregate_and_no_values_where_there_are_none(spark):
    df = spark.createDataFrame([(None, None), (float("nan"), None)], "v double, s string")
    sk = K.profile_sketches(df, ["v"], ["s"])
    plan = sk._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Exchange") == 1
    sk = materialize(sk, "sk")
    assert [tuple(r) for r in K.merged_quantiles(sk, [0.5]).collect()] == [("v", 0.5, 0, None)]
    assert [tuple(r)[:3] for r in K.merged_cardinality(sk).collect()] == [("s", 0, 0)]


# -------------------------------------------------------------------- quarantine
HEADER = ",".join(TRANSACTION_SCHEMA.fieldNames())
GOOD = "1,TRANSFER,10.5,C1,100,89.5,C2,0,10.5,0,0"


def test_quarantine_keeps_every_line(spark, tmp_path):
    lines = [GOOD, GOOD.replace("10.5,C1", "x,C1"), GOOD + ",more", "1,TRANSFER", GOOD.replace("10.5,C1", "-3,C1"),
             GOOD.replace("TRANSFER", ""), GOOD[:-3] + "7,0", GOOD.replace("C1,100", "C1,-2").replace("1,TR", "one,TR"), GOOD]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    out = Z.load_with_quarantine(spark, str(tmp_path / "in"), shared_dir(spark, "quarantine"))
    good, bad = Z.accepted_rows(spark, out), Z.rejected_rows(spark, out).collect()
    assert good.schema == TRANSACTION_SCHEMA and good.count() == 2 and good.count() + len(bad) == len(lines)
    why = sorted(tuple(r.reasons) for r in bad)
    no_record = "not a record of the header's columns"
    assert why == sorted([("amount: not double",), (no_record,), (no_record,), ("negative amount",), ("no type",),
                          ("label not 0 or 1",), ("step: not int", "negative balance")])
    assert GOOD + ",more" in {r.rejected_line for r in bad}
    report = {r.reason: r.rows for r in Z.quarantine_report(spark, out).collect()}
    assert report["accepted"] == 2 and report["rejected"] == 7 and report[no_record] == 2


def test_quarantine_of_other_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text(",".join(reversed(HEADER.split(","))) + ",note\n" + ",".join(reversed(GOOD.split(","))) + ",n\n")
    out = Z.load_with_quarantine(spark, str(tmp_path / "a.csv"), shared_dir(spark, "quarantine"))
    assert [r.amount for r in Z.accepted_rows(spark, out).collect()] == [10.5]
    (tmp_path / "b.csv").write_text("step,type\n1,x\n")
    with pytest.raises(ValueError, match="amount"):
        Z.judge_rows(spark, str(tmp_path / "b.csv"))


# ------------------------------------------------------------------------ models
def fitted(spark, reg):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (2.0, 1.0), (3.0, 1.0)], "x double, label double")
    stages = [VectorAssembler(inputCols=["x"], outputCol="features"), LogisticRegression(regParam=reg)]
    return Pipeline(stages=stages).fit(df), df


def test_model_versions(spark):
    root = shared_dir(spark, "models")
    assert V.versions(spark, root) == []
    (a, df), (b, _) = fitted(spark, 0.1), fitted(spark, 0.5)
    reads = df.select("x").schema
    assert [V.publish(m, root, reads, features=["x"], seed=42) for m in (a, b)] == [1, 2]
    m, meta = V.load_version(spark, root, data=df)
    assert meta["version"] == 2 and meta["features"] == ["x"] and meta["seed"] == 42 and meta["environment"]["spark"]
    assert [s["params"].get("regParam") for s in meta["stages"]] == [None, 0.5]
    assert m.stages[1].coefficients == b.stages[1].coefficients
    assert V.load_version(spark, root, 1)[0].stages[1].coefficients == a.stages[1].coefficients
    for other in (df.drop("x"), df.withColumn("x", F.col("x").cast("string"))):
        with pytest.raises(ValueError, match="reads x as double"):
            V.load_version(spark, root, data=other)
    with pytest.raises(ValueError, match="no version 9"):
        V.metadata(spark, root, 9)


def test_a_half_written_version_is_never_loaded(spark, monkeypatch):
    root = shared_dir(spark, "models")
    a, df = fitted(spark, 0.1)
    V.publish(a, root, df.select("x").schema)

    def dies(*args, **kw):
        raise RuntimeError("lost")
    monkeypatch.setattr(V, "describe", dies)
    with pytest.raises(RuntimeError):
        V.publish(a, root, df.select("x").schema)
    monkeypatch.undo()
    assert V.versions(spark, root) == [1]
    open(os.path.join(root, "_claim-v000002"), "w").close()  # claimed by a writer that died
    assert V.versions(spark, root) == [1] and V.publish(a, root, df.select("x").schema) == 3
    assert V.versions(spark, root) == [1, 3] and V.metadata(spark, root)["version"] == 3


# -------------------------------------------------------------------- salted join
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_is_the_plain_join(spark, how):
    large = spark.range(3000).selectExpr("CASE WHEN id % 10 < 4 THEN 7 WHEN id % 10 = 9 THEN NULL ELSE id % 40 END AS k", "id AS v")
    other = spark.createDataFrame([(7, "a"), (7, "b"), (3, "c"), (50, "d"), (None, "e")], "k long, w string")
    large = materialize(large, "large")
    got = skew.salted_join(large, other, "k", how, tasks=16)
    want = large.join(other, "k", how)
    assert sorted(got.columns) == sorted(want.columns)
    assert Counter(got.select(want.columns).collect()) == Counter(want.collect())


def test_heavy_keys_are_dealt_evenly(spark):
    """With 40 % of the rows under one key, the fullest of its shares is near the average task."""
    large = materialize(spark.range(20_000).selectExpr("IF(id % 10 < 4, -1, id) AS k", "id AS v"), "large")
    salts = skew.heavy_keys(large, ["k"], 8).collect()
    assert [(r.k, r["_salts"]) for r in salts] == [(-1, 5)]
    shares = large.filter("k = -1").groupBy(F.pmod(F.monotonically_increasing_id(), F.lit(5))).count().collect()
    assert len(shares) == 5 and max(r["count"] for r in shares) <= 2 * 20_000 / 8


# ----------------------------------------------------------------- observed writes
def test_split_counts_are_taken_while_writing(spark):
    df = spark.range(1000).selectExpr("id", "CAST(IF(id % 7 = 0, NULL, id % 3 = 0) AS int) AS isFraud",
                                      "CASE WHEN id % 10 < 7 THEN 'train' WHEN id % 10 = 7 THEN 'validation' ELSE 'test' END AS split")
    src = shared_dir(spark, "observed-in")
    df.write.parquet(src)
    written, seen = R.write_observed(spark, src, lambda t: t.filter("id >= 0"), "observed", R.split_measures())
    want = sorted(tuple(r) for r in D.split_counts(df).collect())
    assert written.count() == 1000
    assert sorted(tuple(r) for r in R.split_counts_of(spark, seen).collect()) == want
    assert sum(seen[f"{s}_nulls"] for s in ("train", "validation", "test")) == 143
    model, data = fitted(spark, 0.1)  # its summary goes to tasks in this session still
    assert model.transform(data).select("probability").collect()


def test_run_record_has_the_drivers_memory(spark):
    r = R.run_record(spark, {"a": spark.range(10)}).first()
    assert r.driver_jvm_max_mb >= r.driver_jvm_used_mb > 0 and r.driver_python_peak_mb > 0 and r.driver_memory
    assert json.dumps(r.driver_memory)


# ------------------------------------------------------------------------- search
def test_halving_keeps_the_best_and_fits_fewer_rows(spark):
    from txnlab.operators import model as M
    from txnlab.operators.search import halving_search
    from txnlab.plans.inputs import model_input, part
    from conftest import SF01

    mi = materialize(model_input(spark, SF01), "halving-input")
    train, val = part(mi, "train"), part(mi, "validation")
    grid = {"regParam": [0.01, 0.1, 10.0, 100.0]}
    got = halving_search(train, val, grid, eta=2).collect()
    assert [(r.rung, r["rank"]) for r in got] == [(1, 1), (1, 2), (1, 3), (1, 4), (2, 1), (2, 2), (3, 1)]
    last = got[-1]
    assert last.fit_rows == train.count() and sum(r.fit_rows for r in got) < 0.8 * 4 * last.fit_rows
    full = M.grid_search(train, val, grid).filter("rank = 1").first()
    assert (last.regParam, last.min_cost) == (full.regParam, full.min_cost)


def test_a_bracket_that_misses_is_widened(spark, monkeypatch):
    from txnlab.operators import ranking

    df = spark.range(40_000).selectExpr("CAST(id AS double) AS v")
    want = [tuple(r) for r in ranking.exact_quantiles(df, ["v"], [0.25, 0.5]).orderBy("prob").collect()]
    assert want == [("v", 0.25, 40_000, 9999.75), ("v", 0.5, 40_000, 19999.5)]
    real = ranking.F.percentile_approx
    monkeypatch.setattr(ranking.F, "percentile_approx", lambda c, p, a: ranking.F.transform(real(c, p, a), lambda x: x + 7777.0))
    assert [tuple(r) for r in ranking.exact_quantiles(df, ["v"], [0.25, 0.5]).orderBy("prob").collect()] == want
    assert ranking._holds(3, 2, 3.5) and not ranking._holds(4, 9, 3.5) and not ranking._holds(0, 4, 3.5)
