import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from conftest import DOCUMENTS
from txnlab.llm import katz as Z
from txnlab.llm import kneser as K
from txnlab.llm import perplexity as P
from txnlab.llm.textops import BASE, mix


def plain(texts):
    """Bits per word by interpolated modified Kneser-Ney over word bigrams, the plain way."""
    seqs = [["<s>", *t.translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})).split(), "</s>"] for t in texts]
    two = Counter(x for s in seqs for x in zip(s, s[1:]))
    one = Counter(w for _, w in two)
    d1, d2 = (K.discounts([sum(c == i for c in t.values()) for i in range(1, 5)]) for t in (one, two))
    total, left = defaultdict(int), defaultdict(float)
    for (v, _), c in two.items():
        total[v] += c
        left[v] += d2[min(c, 3)]
    back = sum(d1[min(c, 3)] for c in one.values()) / len(two)
    low = {w: (c - d1[min(c, 3)]) / len(two) + back / len(one) for w, c in one.items()}
    assert sum(low.values()) == pytest.approx(1)
    p = {(v, w): (c - d2[min(c, 3)] + left[v] * low[w]) / total[v] for (v, w), c in two.items()}
    return [-sum(math.log2(p[x]) for x in zip(s, s[1:])) / (len(s) - 1) for s in seqs]


def sentences(rnd, n, size=60):
    """Each word is followed by one of three."""
    names = [f"w{i}" for i in range(60)]
    after = {x: rnd.sample(names, 3) for x in names}
    out = []
    for _ in range(n):
        s = [rnd.choice(names)]
        while len(s) < size:
            s.append(rnd.choice(after[s[-1]]))
        out.append(" ".join(s))
    return out


@pytest.mark.parametrize("how", [{}, {"bucket_text": 3000, "context_tokens": 40, "shards": 3}])
def test_bits_are_those_of_the_plain_model(spark, how, monkeypatch):
    if how:
        monkeypatch.setattr(K, "BLOCK_TEXT", 2000)
    rnd = random.Random(5)
    texts = sentences(rnd, 50, 20) + ["", "A b\tC\na B c", "the " * 300, "é 漢字  x", "the " * 300, None]
    rows = [(i, t, [None, "en", "de"][i % 3], "a", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOCUMENTS).repartition(3)
    got = {r._id: r.bits_per_word for r in K.word_bits(docs, **how).collect()}
    ids = {r.doc_id: r._id for r in docs.select("doc_id", K.text_id(docs.text, docs.lang).alias("_id")).collect()}
    for lang in (None, "en", "de"):
        mine = [r for r in rows if r[2] == lang]
        for r, bits in zip(mine, plain([r[1] or "" for r in mine])):
            assert got[ids[r[0]]] == pytest.approx(bits, abs=1e-3)


def test_shuffled_words_are_rejected(spark):
    rnd = random.Random(11)
    texts = sentences(rnd, 220)
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(texts[:200])]
    rows += [(900 + i, " ".join(rnd.sample(t.split(), 60)), "en", "a", 1) for i, t in enumerate(texts[200:])]
    got = P.judge(spark.createDataFrame(rows, DOCUMENTS)).collect()
    kept = {r.doc_id: r.kept for r in got if not r.base_failed}
    assert sum(not kept[i] for i in kept if i >= 900) == sum(i >= 900 for i in kept) >= 15
    assert sum(kept[i] for i in kept if i < 900) >= 0.98 * sum(i < 900 for i in kept)


def test_no_texts(spark):
    assert K.word_bits(spark.createDataFrame([], DOCUMENTS)).count() == 0


def test_a_task_reads_several_partitions(spark):
    """Fuller blocks hold a bigram less often: fewer rows for the buckets."""
    docs = spark.createDataFrame([(i, f"a{i % 3} b c d{i % 5}", "en") for i in range(64)], "_id long, _text string, lang string")
    docs = docs.select("lang", "_id", "_text").repartition(8)
    apart, both = (K.cells(docs, 1, {}, False, k) for k in (1, 4))
    assert both.count() * 4 == apart.count() == 8


def test_a_share_of_the_buckets_is_sent_at_a_time(spark, monkeypatch):
    """Of a large table's bigrams, no pass shuffles more than about its share; the bits are the same."""
    sent = {"counted": [], "scored": []}

    def noted(f, kind):
        def run(requests, *rest):
            sent[kind].append(requests.filter("bucket < 8").count())
            return f(requests, *rest)
        return run

    monkeypatch.setattr(K, "merge", noted(K.merge, "counted"))
    monkeypatch.setattr(K, "lookup", noted(K.lookup, "scored"))
    rnd = random.Random(3)
    texts = sentences(rnd, 60, 20) + ["", "x", None]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], DOCUMENTS).repartition(4)
    size = sum(len(t or "") for t in texts)
    got = {r._id: (r.bits_per_word, r.n_tokens) for r in K.word_bits(docs, bucket_text=-(-size // 8)).collect()}
    ids = [r._id for r in docs.select("doc_id", K.text_id(docs.text, docs.lang).alias("_id")).orderBy("doc_id").collect()]
    assert len(sent["counted"]) > 1 and max(sent["counted"]) < 0.7 * sum(sent["counted"])
    assert max(sent["scored"]) < 0.4 * sum(sent["scored"])
    for i, t, bits in zip(ids, texts, plain([t or "" for t in texts])):
        assert got[i] == (pytest.approx(bits, abs=1e-3), len((t or "").split()) + 1)


def test_a_block_without_bigrams_in_a_share(spark):
    docs = spark.createDataFrame([("", 1, "")], "lang string, _id long, _text string")
    for scored in (False, True):
        parts = [K.cells(docs, 4, {}, scored, 1, i, 2).collect() for i in range(2)]
        assert sorted(sum(r.bucket < 4 for r in p) for p in parts) == [0, 1]
        assert [sum(r.bucket >= 4 for r in p) for p in parts] == [int(scored)] * 2


def test_buckets_are_drawn_once_a_word(monkeypatch):
    """Not once a token; a dealt context's tokens, by their next words, as before."""
    mixed = []
    monkeypatch.setattr(Z, "mix", lambda h: mixed.append(h.size) or mix(h))
    rng = np.random.RandomState(1)
    key = rng.randint(1, 1 << 62, 50).astype(np.uint64)
    c, t = rng.randint(0, 50, 4000).astype(np.int32), rng.randint(0, 50, 4000).astype(np.int32)
    assert (Z.deal(key, np.ones(50, np.int64), c, t, 7) == (mix(key) % np.uint64(7))[c]).all()
    assert sum(mixed) <= 100
    parts = np.ones(50, dtype=np.int64)
    parts[3] = 4
    part = mix(key[t]) % parts[c].astype(np.uint64)
    assert (Z.deal(key, parts, c, t, 7) == mix(key[c] + part * np.uint64(BASE)) % np.uint64(7)).all()


def test_vocabulary_of_alike_hashes():
    """Hashes that differ in the low bits only, where the places stand while they are sorted."""
    rng = np.random.RandomState(2)
    wide = rng.randint(0, 1 << 62, 30).astype(np.uint64) * np.uint64(4)
    for h in (rng.choice(wide, 900), (rng.choice(wide, 900) & ~np.uint64(255)) | rng.randint(0, 3, 900).astype(np.uint64),
              rng.randint(0, 40, 900).astype(np.uint64), wide[:1], wide[:0]):
        seen, index = Z.vocabulary(h)
        assert seen.tolist() == sorted(set(h.tolist())) and (seen[index] == h).all()
