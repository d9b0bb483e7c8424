import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

import brute
from conftest import DOCUMENTS, odd_rows
from txnlab.llm import katz as K


def model(rows, k=K.DISCOUNTED):
    """(base, probability) functions of a Katz bigram model, the plain way."""
    train = [brute.words(t) + ["</s>"] for d, t in rows if not brute.held_out(d)]
    c = Counter(w for t in train for w in t)
    n, v = sum(c.values()), len(c)
    once = sum(1 for w, x in c.items() if x == 1 and w != "</s>")
    total = n + (once == 0)

    def name(w):
        return "<unk>" if (w != "</s>" and c[w] < 2) or not train else w
    uni = Counter(map(name, [w for t in train for w in t]))
    uni["<unk>"] = max(1, uni["<unk>"])
    after = defaultdict(Counter)
    for t in train:
        for a, b in zip(["<s>"] + t, t):
            after[name(a) if a != "<s>" else a][name(b)] += 1
    d = K.good_turing(np.array([sum(x == r for h in after.values() for x in h.values()) for r in range(1, k + 2)]))

    def p(h, w):
        seen, ctx = after.get(h, Counter()), sum(after.get(h, Counter()).values()) + 1
        disc = {x: (d[r - 1] * r if r <= k else r) / ctx for x, r in seen.items()}
        if w in disc:
            return disc[w]
        return (1 - sum(disc.values())) / (1 - sum(uni[x] / total for x in seen)) * uni[w] / total

    def score(text):
        t = [name(w) for w in brute.words(text) + ["</s>"]]
        return sum(math.log10(p(a, b)) for a, b in zip(["<s>"] + t, t))

    def base(text):
        t = brute.words(text) + ["</s>"]
        return len(t), sum(c[w] > 0 for w in t), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
    return base, score, p, uni, after


def check(spark, rows, monkeypatch=None, **kw):
    docs = spark.createDataFrame(rows, DOCUMENTS)
    got = K.score(docs, **kw).collect()
    base, score, *_ = model([(r[0], r[1]) for r in rows])
    want = [(r[0], brute.held_out(r[0]), *base(r[1]), score(r[1])) for r in rows]
    key = lambda r: repr((r[0], r[2], round(r[5], 4)))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9)
        assert g[6] == pytest.approx(w[6], rel=1e-6, abs=1e-5)


def zipf_rows(n=150):
    rnd = random.Random(4)
    vocab = ["w%d" % i for i in range(400)]
    weight = [1 / (i + 1) for i in range(400)]
    return [(i, " ".join(rnd.choices(vocab, weight, k=rnd.randrange(60))), "en", "a", 1) for i in range(n)]


def test_one_bucket(spark):
    check(spark, zipf_rows())


def test_many_blocks_buckets_and_crowded_contexts(spark, monkeypatch):
    rows = zipf_rows()
    docs = spark.createDataFrame(rows, DOCUMENTS).repartition(4)
    got = {r.doc_id: r.score for r in K.score(docs, bucket_text=3000, bucket_tokens=400).collect()}
    _, score, *_ = model([(r[0], r[1]) for r in rows])
    for r in rows:
        assert got[r[0]] == pytest.approx(score(r[1]), rel=1e-6, abs=1e-5)


def test_probabilities_of_a_context_sum_to_one():
    rows = [(r[0], r[1]) for r in zipf_rows()]
    *_, p, uni, after = model(rows)
    for h in list(after)[:20] + ["never"]:
        assert sum(p(h, w) for w in uni) == pytest.approx(1)


def test_odd_rows(spark):
    check(spark, odd_rows())


def test_empty_and_no_training(spark):
    assert K.score(spark.createDataFrame([], DOCUMENTS)).count() == 0
    held = [(i, "a b c", "en", "a", 1) for i in range(40) if brute.held_out(i)]
    check(spark, held)


def open_model(rows, k=K.DISCOUNTED):
    """Words seen once keep their counts, unseen ones share N1 / (N + 1)."""
    texts = [(d, brute.words(t) + ["</s>"]) for d, t in rows]
    train = [t for d, t in texts if not brute.held_out(d)]
    c, after = Counter(w for t in train for w in t), defaultdict(Counter)
    left = max(1, sum(x == 1 and w != "</s>" for w, x in c.items())) / (sum(c.values()) + 1)
    unseen = {w for _, t in texts for w in t} - set(c)
    left = left if unseen else 0
    for t in train:
        for a, b in zip(["<s>"] + t, t):
            after[a][b] += 1
    d = K.good_turing(np.array([sum(x == r for h in after.values() for x in h.values()) for r in range(1, k + 2)]))
    uni = {w: (1 - left) * x / sum(c.values()) for w, x in c.items()} | {w: left / len(unseen) for w in unseen}

    def p(h, w):
        seen = after.get(h, Counter())
        disc = {x: (d[r - 1] * r if r <= k else r) / (sum(seen.values()) + 1) for x, r in seen.items()}
        return disc[w] if w in disc else (1 - sum(disc.values())) / (1 - sum(uni[x] for x in seen)) * uni[w]
    return p, uni, after, {d: sum(math.log10(p(a, b)) for a, b in zip(["<s>"] + t, t)) for d, t in texts}


def test_query_keeps_all_training_words(spark, tmp_path):
    from txnlab.llm.queries import QUERIES

    rows = zipf_rows() + [(900 + i, " ".join(f"new{i}x{j}" for j in range(20)), "en", "a", 1) for i in range(20)]
    p, uni, after, want = open_model([r[:2] for r in rows])
    assert all(sum(p(h, w) for w in uni) == pytest.approx(1) for h in [*list(after)[:10], "never"])
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op2_katz_score"](spark, str(tmp_path)).collect()}
    assert all(got[d].score == pytest.approx(x, rel=1e-6, abs=1e-5) for d, x in want.items())
    dealt = K.score(spark.createDataFrame(rows, DOCUMENTS), bucket_text=3000, bucket_tokens=40, min_count=1).collect()
    assert all(r.score == pytest.approx(want[r.doc_id], rel=1e-6, abs=1e-5) for r in dealt)
    held = [r for r in got.values() if r.held_out and r.n_tokens > 10]
    strange = [r.score / r.n_tokens for r in held if r.doc_id >= 900]
    assert strange and max(strange) < min(r.score / r.n_tokens for r in held if r.doc_id < 900)


def test_without_unseen_words_nothing_is_kept_back(spark):
    rows = [(i, "a b c a b d", "en", "a", 1) for i in range(30)] + [(99, "a b " * 40_000, "en", "a", 1)]
    p, uni, after, want = open_model([r[:2] for r in rows])
    assert all(sum(p(h, w) for w in uni) == pytest.approx(1) for h in [*after, "never"])
    got = K.score(spark.createDataFrame(rows, DOCUMENTS), min_count=1).collect()
    assert all(r.score == pytest.approx(want[r.doc_id], rel=1e-7) for r in got)


def test_gaps_round_trip():
    for x in ([], [0], [3, 4, 9, 2**40, 2**63 + 5]):
        x = np.array(x, np.uint64)
        assert K.from_gaps(K.unpack(K.pack([K.gaps(x)]))[0]).tolist() == x.tolist()
