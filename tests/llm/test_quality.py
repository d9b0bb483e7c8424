import random

import pytest
from pyspark.sql import functions as F

from conftest import DOCUMENTS, SF001, odd_rows
from txnlab.llm import quality as C

LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    held = F.col("doc_id") % 4 == 0
    got = C.classify(docs, labels.filter(~held)).join(labels.filter(held), "doc_id").collect()
    toxic = [r for r in got if r.toxic]
    clean = [r for r in got if r.quality and not r.toxic]
    assert sum(not r.kept for r in toxic) >= 0.7 * len(toxic)
    assert sum(r.kept for r in clean) >= 0.97 * len(clean)


def test_sparse_sites_shrink_to_their_priors(spark):
    rnd = random.Random(1)
    rows, labels = [], []
    for i in range(900):
        host = ("good", "bad", "mid")[i % 3]
        path = "p" if i % 2 else "q"
        good = rnd.random() < {"good": 0.95, "bad": 0.1, "mid": 0.5}[host]
        rows.append((i, "same words in every text here", path, host, 1))
        labels.append((i, int(good), 0))
    rows += [(9000, "same words in every text here", "new", "good", 1), (9001, "same words", "x", "never", 1)]
    got = C.classify(spark.createDataFrame(rows, DOCUMENTS), spark.createDataFrame(labels, LABELS)).collect()
    by = {r.doc_id: r for r in got}
    share = sum(x[1] for x in labels) / len(labels)
    assert by[9001].host_posterior == pytest.approx(share, abs=0.1)      # a host hardly seen: the global share
    assert abs(by[9000].path_posterior - by[0].host_posterior) < 0.1      # a path hardly seen: its host's share
    assert by[0].host_posterior > 0.8 > 0.3 > by[1].host_posterior
    assert by[0].score > by[2].score > by[1].score


def test_odd_rows_and_labels(spark):
    docs = spark.createDataFrame(odd_rows(), DOCUMENTS)
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 0, 0), (2, 1, 1), (3, None, 0), (None, 1, 1), (77, 1, 1)], LABELS)
    for lab in (labels, labels.limit(0), labels.filter("doc_id = 1")):
        got = C.classify(docs, lab)
        assert got.count() == len(odd_rows()) and got.filter("score is null or kept is null").count() == 0
        kept = C.keep_good(docs, lab)
        assert kept.columns == docs.columns
        assert kept.count() == got.filter("kept").count()
    assert C.classify(docs.limit(0), labels).count() == 0 and C.keep_good(docs.limit(0), labels).count() == 0


def test_keep_good_agrees_with_classify(spark, docs001):
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    kept = {r.doc_id for r in C.keep_good(docs001, labels).collect()}
    assert kept == {r.doc_id for r in C.classify(docs001, labels).filter("kept").collect()}
