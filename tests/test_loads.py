"""Duplicates within a load and against earlier loads."""

import os
import random
from collections import Counter

from pyspark.sql import functions as F

from txnlab.operators import loads as L
from txnlab.operators import profile as A
from txnlab.session import shared_dir

SCHEMA = "a string, b string, x double"


def files(store):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, fs in os.walk(store) for f in fs if f.endswith(".parquet")}


def test_loads_add_up_to_the_duplicates_of_the_whole(spark):
    rnd, store, whole, seen = random.Random(2), shared_dir(spark, "loads"), [], set()
    for i in range(4):
        rows = [(rnd.choice("pq"), str(rnd.randrange(400)), rnd.choice([0.5, None])) for _ in range(500)]
        rows += [("hot", None, 1.0)] * 300 + [(None, "hot", 1.0), ("", "hot", 1.0), ("hot", "", 1.0)]
        before = files(store)
        df = spark.createDataFrame(rows, SCHEMA)
        report = {r.load: r for r in L.merge_load(df, store, f"l{i}", capacity=3000).collect()}
        own = Counter(rows)
        assert tuple(report[f"l{i}"])[:1] and report[f"l{i}"].rows == len(rows)
        assert report[f"l{i}"].repeated_within == len(rows) - len(own)
        assert report[f"l{i}"].repeated_earlier == sum(r in seen for r in own)
        assert before.items() <= files(store).items()  # old files as they were
        seen |= set(own)
        whole += rows
    union = spark.createDataFrame(whole, SCHEMA)
    total = L.load_report(spark, store).agg(F.sum(F.col("repeated_within") + F.col("repeated_earlier"))).first()[0]
    assert total == A.duplicate_count(union).first()[0] == len(whole) - len(seen)
    again = L.merge_load(union, store, "l2", capacity=3000)  # merged already
    assert again.count() == 4 and L.load_report(spark, store).filter("load = 'l2'").first().rows == 803


def test_a_broken_off_load_is_written_anew(spark, monkeypatch):
    store = shared_dir(spark, "loads")
    df = spark.range(100).selectExpr("id % 60 AS id")
    L.merge_load(df.filter("id < 30"), store, "a", capacity=1000)
    real = L.filter_blocks
    monkeypatch.setattr(L, "filter_blocks", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    try:
        L.merge_load(df, store, "b", capacity=1000)
    except OSError:
        pass
    assert [r.load for r in L.load_report(spark, store).collect()] == ["a"]
    monkeypatch.setattr(L, "filter_blocks", real)
    r = L.merge_load(df, store, "b", capacity=1000).filter("load = 'b'").first()
    assert (r.rows, r.repeated_within, r.repeated_earlier) == (100, 40, 30)


def test_filter_rules_out_most_and_nothing_that_is_there(spark):
    stored = L.row_hashes(spark.range(20_000).selectExpr("id"))
    other = L.row_hashes(spark.range(20_000, 60_000).selectExpr("id"))
    n = L.n_blocks(20_000)
    filters = L.filter_blocks(stored.filter("h1 % 2 = 0"), n).unionAll(L.filter_blocks(stored.filter("h1 % 2 <> 0"), n))
    assert L.maybe_stored(stored, filters, n).count() == 20_000
    assert L.maybe_stored(other, filters, n).count() < 0.02 * 40_000


def test_empty_loads(spark):
    store = shared_dir(spark, "loads")
    none = spark.createDataFrame([], SCHEMA)
    for name in ("a", "b"):
        r = L.merge_load(none, store, name).filter(F.col("load") == name).first()
        assert (r.rows, r.repeated_within, r.repeated_earlier) == (0, 0, 0)
    df = spark.createDataFrame([(None, None, None)] * 3, SCHEMA)
    assert L.merge_load(df, store, "c").filter("load = 'c'").first().repeated_within == 2
