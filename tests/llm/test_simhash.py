import random

import numpy as np
import pytest

import brute
from conftest import DOCUMENTS, odd_rows
from txnlab.llm import simhash as S


def check(spark, rows, radius=3, bucket_rows=S.BUCKET_ROWS):
    docs = spark.createDataFrame(rows, DOCUMENTS)
    got = [tuple(r) for r in S.near_duplicates(docs, radius=radius, bucket_rows=bucket_rows).collect()]
    fps = [brute.simhash(r[1]) for r in rows]
    want = list(zip([r[0] for r in rows], ["%016x" % f for f in fps], brute.classes(fps, [r[0] for r in rows], radius)))
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_odd_rows(spark):
    check(spark, odd_rows())


def near_rows(n=72):
    rnd = random.Random(5)
    vocab = ["w%d" % i for i in range(300)]
    rows = []
    for g in range(6):
        base = [rnd.choice(vocab) for _ in range(200)]
        for _ in range(n // 6):
            w = list(base)
            for _ in range(rnd.randrange(4)):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            rows.append((len(rows), " ".join(w), "en", "a", 1))
    return rows


@pytest.mark.parametrize("radius,bucket_rows", [(3, 8192), (3, 8)])
def test_near_copies_link_as_by_brute_force(spark, radius, bucket_rows):
    check(spark, near_rows(), radius, bucket_rows)


def test_lanes_are_exact():
    rnd = np.random.RandomState(1)
    fp = np.unique(rnd.randint(0, 2**63 - 1, 150).astype(np.uint64) & np.uint64(0xFF0F))
    for radius in (1, 3, 6, 7):
        u, v = S.bucket_links(np.array([len(fp)]), fp, radius)
        want = brute.classes([int(x) for x in fp], list(range(len(fp))), radius)
        comp = {int(x): i for i, x in enumerate(fp)}
        got = list(range(len(fp)))
        for a, b in zip(u, v):
            got[comp[int(a)]] = comp[int(b)]
        assert got == want


def test_drop_keeps_one_of_each_group(spark):
    rows = near_rows() + odd_rows()
    docs = spark.createDataFrame(rows, DOCUMENTS)
    # by place, as ids repeat and are null
    classes = set(brute.classes([brute.simhash(r[1]) for r in rows], list(range(len(rows))), 3))
    kept = S.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert len(kept.collect()) == len(classes)


def test_empty_and_clashing_names(spark):
    empty = spark.createDataFrame([], DOCUMENTS)
    assert S.near_duplicates(empty).count() == 0 and S.drop_near_duplicates(empty).count() == 0
    rows = [(1, "a b c d", 5, "x"), (2, "a b c d", 6, "y")]
    odd = spark.createDataFrame(rows, "doc_id long, text string, fp long, component_id string")
    assert [tuple(r) for r in S.drop_near_duplicates(odd).collect()] == [rows[0]]


def test_drop_keeps_unrelated_texts_under_null_and_equal_ids(spark):
    rnd = random.Random(7)
    texts = [" ".join("v%d" % rnd.randrange(10_000) for _ in range(60)) for _ in range(30)]
    rows = [(None if i < 20 else 5, t, "en", "a", 1) for i, t in enumerate(texts)]
    assert len(set(brute.classes([brute.simhash(t) for t in texts], list(range(30)), 3))) == 30
    kept = S.drop_near_duplicates(spark.createDataFrame(rows + rows[:3] + rows[-2:], DOCUMENTS)).collect()
    assert sorted(r.text for r in kept) == sorted(texts)
