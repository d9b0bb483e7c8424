import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import brute
from conftest import DOCUMENTS, SF01, odd_rows
from txnlab.llm import perplexity as P
from txnlab.llm.textops import text_buffer


def check(got, rows):
    key = lambda x: (x[0] is None, x[0], x[1:])
    want = []
    for r in rows:
        n, chars, sym, dup, rep = brute.quality_counts(r[1])
        want.append((r[0], n, chars, sym, dup, rep, n < 10 or 100 * rep > 20 * n))
    have = sorted([tuple(g[:7]) for g in got], key=key)
    assert have == sorted(want, key=key)
    assert not any(g.kept and g.base_failed for g in got)


ODD_TEXTS = ["a b c d e a b c d e", "x\nx\n\n \nx y\nx y\r\nx y", "#*$%&|<> ## a", "w " * 12 + "v", "é ü 漢字 \U0001f600 a b c d e f g",
             "one two three four five six seven eight nine ten\n" * 3]


def test_base_counts(spark, docs001):
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(ODD_TEXTS)] + odd_rows()
    check(P.judge(spark.createDataFrame(rows, DOCUMENTS)).collect(), rows)
    check(P.judge(docs001).collect(), [tuple(r) for r in docs001.collect()])


def plain(texts, order=P.ORDER):
    """Interpolated modified Kneser-Ney over byte classes, the plain way: bits of each text."""
    seqs = []
    for t in texts:
        seqs.append([0] * (order - 1) + [int(P.CLASS[b]) for b in t.encode()] + [0])
    counts = {order: Counter()}
    for s in seqs:
        for i in range(order - 1, len(s)):
            counts[order][tuple(s[i - order + 1: i + 1])] += 1
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    disc, total, off = {}, {}, {}
    for n in range(1, order + 1):
        k = Counter(min(c, 5) if c < 5 else 9 for c in counts[n].values())
        y = k[1] / (k[1] + 2 * k[2]) if k[1] + 2 * k[2] else None
        disc[n] = {}
        for i in (1, 2, 3):
            x = i - (i + 1) * y * k[i + 1] / k[i] if k[i] and y is not None else None
            disc[n][i] = 0.5 * i if x is None else min(float(i), max(0.1 * i, x))
        total[n], off[n] = defaultdict(int), defaultdict(float)
        for g, c in counts[n].items():
            total[n][g[:-1]] += c
            off[n][g[:-1]] += disc[n][min(c, 3)]

    def p(g):
        n = len(g)
        if n == 0:
            return 1 / P.CLASSES
        if not total[n][g[:-1]]:
            return p(g[1:])
        c = counts[n][g]
        return (max(0.0, c - (disc[n][min(c, 3)] if c else 0)) + off[n][g[:-1]] * p(g[1:])) / total[n][g[:-1]]
    return [-sum(math.log2(p(tuple(s[i - order + 1: i + 1]))) for i in range(order - 1, len(s))) for s in seqs], p


def sample_rows(n=60):
    rnd = random.Random(9)
    syll = ["ba", "to", "ri", "ne", "lu", "sch", "é", "x1"]
    return [(i, " ".join("".join(rnd.choices(syll, k=rnd.randrange(1, 4))) for _ in range(rnd.randrange(40))),
             "en" if i % 3 else "de", "a", 1) for i in range(n)]


@pytest.mark.parametrize("model_rows", [P.MODEL_ROWS, 10])
def test_perplexity_is_that_of_the_plain_model(spark, model_rows):
    rows = sample_rows()
    got = {r.doc_id: r.bits_per_char for r in P.judge(spark.createDataFrame(rows, DOCUMENTS), model_rows=model_rows).collect()}
    for lang in ("en", "de"):
        mine = [r for r in rows if r[2] == lang]
        for r, bits in zip(mine, plain([r[1] for r in mine])[0]):
            assert got[r[0]] == pytest.approx(bits / (len(r[1].encode()) + 1), rel=1e-4)


def test_probabilities_sum_to_one():
    _, p = plain([r[1] for r in sample_rows()])
    for h in [(0, 0, 0), (3, 4, 5), (60, 61, 62)]:
        assert sum(p(h + (w,)) for w in range(P.CLASSES)) == pytest.approx(1)


def test_grams():
    data, off = text_buffer(pa.array(["ab", "", "c"]))
    key, at = P.grams(data, off)
    a, b, c = (int(P.CLASS[ord(x)]) for x in "abc")
    assert key.tolist() == [a, a << 6 | b, (a << 6 | b) << 6, 0, c, c << 6] and at.tolist() == [0, 3, 4, 6]


def test_junk_is_rejected_and_prose_kept(spark):
    rnd = random.Random(3)
    syll = ["ba", "to", "ri", "ne", "lu", "ma", "ke"]
    rows = [(i, " ".join("".join(rnd.choices(syll, k=2)) for _ in range(60)), "en", "a", 1) for i in range(200)]
    rows += [(900 + i, " ".join("".join(rnd.choices("qxz#$%&|<>~^", k=9)) for _ in range(60)), "en", "a", 1) for i in range(4)]
    kept = {r.doc_id: r.kept for r in P.judge(spark.createDataFrame(rows, DOCUMENTS)).collect()}
    assert all(kept[i] for i in range(200)) and not any(kept[i] for i in range(900, 904))


def test_empty(spark):
    assert P.judge(spark.createDataFrame([], DOCUMENTS)).count() == 0


def test_junk_that_documents_hold_is_rejected(spark):
    judged = P.judge(spark.read.parquet(f"{SF01}/documents.parquet")).filter("not base_failed")
    rows = judged.join(spark.read.parquet(f"{SF01}/labels.parquet"), "doc_id").select("quality", "kept").collect()
    out = {q: [not r.kept for r in rows if r.quality == q] for q in (0, 1)}
    print({q: (sum(x), len(x)) for q, x in out.items()})
    assert sum(out[0]) >= 0.1 * len(out[0]) and sum(out[1]) <= 0.03 * len(out[1])


def test_direct_lookup_is_binary_search(monkeypatch):
    """Many n-grams at once are found by their contexts, with the same values."""
    rng = np.random.RandomState(3)
    seen = np.unique(rng.randint(0, 1 << 24, 5000)).astype(np.int32)
    n, g = [], []
    for k in (4, 3, 2, 1):
        keys = np.unique(seen & ((1 << 6 * k) - 1))
        n += [np.full(len(keys), k), np.full(len(np.unique(keys >> 6)), -k)]
        g += [keys, np.unique(keys >> 6)]
    n, g = np.concatenate(n), np.concatenate(g).astype(np.int32)
    model = P.Model(n, g, rng.rand(len(g)) * 0.9 + 0.05)
    asked = np.concatenate([seen, rng.randint(0, 1 << 24, 5000).astype(np.int32), seen[:9] + 1, [0, (1 << 24) - 1]]).astype(np.int32)
    monkeypatch.setattr(P, "DIRECT", 1 << 30)
    slow = [model.log2(asked & ((1 << 6 * k) - 1), k) for k in (4, 3, 2, 1)]
    monkeypatch.setattr(P, "DIRECT", 1)
    fast = [model.log2(asked & ((1 << 6 * k) - 1), k) for k in (4, 3, 2, 1)]
    assert all(a.dtype == b.dtype and (a == b).all() for a, b in zip(slow, fast))
