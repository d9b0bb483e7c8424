import random

import numpy as np

import brute
from conftest import DOCUMENTS, SF001, odd_rows
from txnlab.llm import decontaminate as D

ITEMS = "item_id long, text string"


def want(docs, items):
    out = set()
    for d in docs:
        for i in items:
            s = brute.item_matches(d[1], i[1])
            if s is not None:
                out.add((d[0], i[0], round(s, 6)))
    return out


def got(docs, items):
    return {(r.doc_id, r.item_id, round(r.similarity, 6)) for r in D.find_matches(docs, items).collect()}


def test_tables_as_by_brute_force(spark, docs001):
    items = spark.read.parquet(f"{SF001}/benchmark.parquet")
    rows = [tuple(r) for r in docs001.collect()]
    expect = want(rows, [tuple(r) for r in items.collect()])
    assert expect and got(docs001, items) == expect


def test_edited_passages(spark):
    rnd = random.Random(2)
    vocab = ["v%d" % i for i in range(500)]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.randrange(12, 60)))) for i in range(12)]
    rows = []
    for n in range(150):
        i = rnd.choice(items)
        w = i[1].split()
        for _ in range(rnd.randrange(4)):
            w[rnd.randrange(len(w))] = "zz"
        pad = [" ".join(rnd.choice(vocab) for _ in range(rnd.randrange(60))) for _ in range(2)]
        rows.append((n, f"{pad[0]} {' '.join(w)} {pad[1]}".upper() if n % 2 else f"{pad[0]}\n{' '.join(w)}\n{pad[1]}",
                     "en", "a", 1))
    docs = spark.createDataFrame(rows, DOCUMENTS)
    expect = want(rows, items)
    found = got(docs, spark.createDataFrame(items, ITEMS))
    assert found <= expect
    assert len(found) >= 0.99 * len(expect)  # at a similarity of just 0.8 a fingerprint may lie beyond the radius
    assert {x for x in expect if x[2] >= 0.9} <= found


def test_item_blocks_change_nothing(spark, docs001, monkeypatch):
    items = spark.read.parquet(f"{SF001}/benchmark.parquet")
    whole = got(docs001, items)
    monkeypatch.setattr(D.item_blocks, "__defaults__", ("item_id", "text", 2000))
    assert len(list(D.item_blocks(items))) > 3
    assert got(docs001, items) == whole


def test_odd_rows(spark):
    items = [(1, "the quick brown fox jumps over the lazy dog and runs far away"), (2, None), (3, ""), (4, "a"),
             (4, "a"), (None, "word word word word word word word")]
    docs = spark.createDataFrame(odd_rows(), DOCUMENTS)
    table = spark.createDataFrame(items, ITEMS)
    assert got(docs, table) == want(odd_rows(), items)
    kept = D.decontaminate(docs, table)
    assert kept.columns == docs.columns
    clean = [r for r in docs.collect() if not want([r], items)]
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, clean))


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCUMENTS)
    items = spark.createDataFrame([(1, "a b c d e f")], ITEMS)
    assert D.find_matches(none, items).count() == 0
    docs = spark.createDataFrame(odd_rows(), DOCUMENTS)
    assert D.find_matches(docs, items.limit(0)).count() == 0
    assert D.decontaminate(docs, items.limit(0)).count() == len(odd_rows())


def test_block_indexes_find_all_within_the_radius():
    rng = np.random.default_rng(4)
    for m in (1, 40, 3000):
        own = rng.integers(0, 2**64, m, dtype=np.uint64)
        own[: m // 3] = own[0]  # equal fingerprints
        flips = [sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 30), replace=False)) for _ in range(1100)]
        fp = own[rng.integers(0, m, 1100)] ^ np.array(flips, dtype=np.uint64)
        index = object.__new__(D.ItemIndex)
        index.sizes = {7: (np.arange(m) + 100, own, [D.BlockIndex(own, b) for b in range(4)])}
        x, k = index.candidates(7, fp)
        near = np.bitwise_count(fp[:, None] ^ own[None, :]) <= D.RADIUS
        assert sorted(zip(x.tolist(), k.tolist())) == sorted((int(a), int(b) + 100) for a, b in zip(*np.nonzero(near)))
        assert len(index.candidates(7, fp[:0])[0]) == 0


def test_equal_items_are_dealt_over_the_blocks(spark, monkeypatch):
    items = spark.createDataFrame([(1, "one two three four five six seven")] * 400, ITEMS)
    monkeypatch.setattr(D.item_blocks, "__defaults__", ("item_id", "text", 2000))
    sizes = [len(b.ids) for b in D.item_blocks(items)]
    assert sum(sizes) == 400 and max(sizes) <= 100
