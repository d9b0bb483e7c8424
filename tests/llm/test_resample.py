import hashlib
import math
import random
import re
from zlib import crc32

import numpy as np
import pytest

from tests_llm_common import clashing
from txnlab.llm import resample as R
from txnlab.llm.queries import QUERIES

from conftest import DOCUMENTS, SF001, SF01, odd_rows


def plain(docs, targets, sizes=2, buckets=10_000, draw=(25, 100), min_words=20, seed=7):
    """(doc_id, n_features, weight, score, rank) by the formulas, row by row."""
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    def features(t):
        w = words(t)
        return [crc32(" ".join(w[i: i + n]).encode()) % buckets for n in range(1, sizes + 1) for i in range(len(w) - n + 1)]
    s, t = [0] * buckets, [0] * buckets
    for _, x in docs:
        for f in features(x):
            s[f] += 1
    for x in targets:
        for f in features(x):
            t[f] += 1
    ns, nt = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((b + 1) * (ns + buckets) / ((a + 1) * (nt + buckets)))) for a, b in zip(s, t)]
    rows = []
    for at, (key, x) in enumerate(docs):
        f = features(x)
        w = math.floor(sum(gain[i] for i in f) / len(f)) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        rows.append([key, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, len(words(x))])
    pool = sorted((r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(pool[: len(pool) * draw[0] // draw[1]]):
        r[4] = i + 1
    return rows


def listed(rows):
    return sorted([tuple(r[:5]) for r in rows], key=repr)


@pytest.mark.parametrize("finish", [1000, 0])
def test_whole_table_against_plain(spark, finish):
    docs, target = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "benchmark"))
    got = R.resample(docs.repartition(5), target, finish=finish)
    want = plain([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()])
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert listed(got.collect()) == listed(want)


def test_query(spark):
    got = QUERIES["op12_importance_resample"](spark, SF001)
    docs, target = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("documents", "benchmark"))
    assert listed(got.collect()) == listed(plain([(r.doc_id, r.text) for r in docs.collect()],
                                                 [r.text for r in target.collect()]))


def test_odd_rows_and_clashing_names(spark):
    rows = odd_rows()
    docs = clashing(spark.createDataFrame(rows, DOCUMENTS))
    target = spark.createDataFrame([(1, "the quick brown fox", 3), (2, None, 4)], "item_id long, text string, key long")
    got = R.resample(docs, target, min_words=1, draw=(1, 2), finish=0).collect()
    # equal keys: which of two repeated rows has the smaller rank is open, their ranks aren't
    assert listed(got) == listed(plain([(r[0], r[1]) for r in rows], ["the quick brown fox", None], min_words=1, draw=(1, 2)))


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCUMENTS)
    none = spark.createDataFrame([], "item_id long, text string")
    assert R.resample(docs, none).collect() == []
    one = spark.createDataFrame([(5, "a b " * 30, "en", "a", 1)], DOCUMENTS)
    assert listed(R.resample(one, none, draw=(1, 1)).collect()) == listed(plain([(5, "a b " * 30)], [], draw=(1, 1)))


def test_stretches_of_a_long_text():
    text = b"aa bb cc dd " * 500
    whole = np.sort(np.concatenate([h for _, h in R.feature_hashes(text, 3)]))
    for chunk in (1, 7, 100):
        parts = list(R.feature_hashes(text, 3, chunk))
        assert sum(n for n, _ in parts) == 2000
        assert (np.sort(np.concatenate([h for _, h in parts])) == whole).all()


def test_cutoff_of_every_rank_with_ties(spark):
    rng = random.Random(3)
    keys = [(rng.randrange(4), rng.randrange(6), i) for i in range(300)]
    df = spark.createDataFrame(keys, "a long, b long, row long").repartition(7, "row")
    df = R.materialize(df, "keys")
    for k in (1, 2, 77, 150, 299, 300):
        assert R.cutoff(df, k, finish=0) == sorted(keys)[k - 1]


def test_weighted_median_leaves_a_quarter_on_each_side():
    rng = random.Random(5)
    for _ in range(200):
        parts = [[rng.randrange(50) for _ in range(rng.randrange(1, 30))] for _ in range(rng.randrange(1, 9))]
        pivot = R.weighted_median([(len(p), sorted(p)[(len(p) - 1) // 2]) for p in parts])
        every = sum(parts, [])
        assert 4 * sum(x <= pivot for x in every) >= len(every) and 4 * sum(x >= pivot for x in every) >= len(every) - 3
