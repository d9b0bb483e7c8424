import re
from collections import Counter, defaultdict
from itertools import permutations

from tests_llm_common import clashing
from txnlab.llm import audit as A

from conftest import DOCUMENTS, odd_rows

LABELS = "doc_id long, quality int, toxic int"


def plain(docs, labels):
    """{(part, order, step): (kept, removed, redundant, unique, good, toxic, shapley)}."""
    first = {}
    for key, text, part in docs:
        if key is not None:
            first[text or ""] = min(key, first.get(text or "", key))
    good = {k for k, q, _ in labels if q == 1}
    toxic = {k for k, _, x in labels if x == 1}
    rows = defaultdict(list)
    for key, text, part in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = {c for c, bad in zip("ABCDE", (
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            bool(re.search("[#$%&*|]", t)), key is not None and key > first.get(t, key))) if bad}
        rows[part or ""].append((f, key is not None and key in good, key is not None and key in toxic))
    out = {}
    for part, docs_ in rows.items():
        shapley = Counter()
        for order in permutations("ABCDE"):
            before = set()
            for step, c in enumerate(order, 1):
                gone = [r for r in docs_ if not r[0] & before and c in r[0]]
                out[part, "".join(order), step] = [
                    sum(not r[0] & (before | {c}) for r in docs_), len(gone),
                    sum(bool(r[0] & before) and c in r[0] for r in docs_), sum(r[0] == {c} for r in docs_),
                    sum(r[1] for r in gone), sum(r[2] for r in gone)]
                shapley[c] += len(gone)
                before.add(c)
        for order in permutations("ABCDE"):
            for step, c in enumerate(order, 1):
                out[part, "".join(order), step].append(shapley[c])
    return {k: tuple(v) for k, v in out.items()}


def rows_of(df):
    assert df.columns[:10] == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                               "toxic_lost", "shapley"]
    got = [tuple(r) for r in df.collect()]
    out = {r[:3]: r[3:10] for r in got}
    assert len(out) == len(got)
    return out


def some_docs():
    many = " ".join(f"w{i}" for i in range(250))
    return odd_rows() + [
        (20, many, "en", "a", 1), (21, many, "en", "b", 1), (22, many, "en", "c", 1), (23, many + " ##", "en", "a", 1),
        (24, many + " A" * 80, "en", "a", 1), (25, "word " * 300, "en", "clean", 1), (26, many + " x", "en", "clean", 1),
        (None, many, "en", "a", 1), (27, "ABC | ABC " * 150, "en", "b", 1), (27, "ABC | ABC " * 150, "en", "b", 1)]


def test_every_order_against_plain(spark):
    labels = [(20, 1, 0), (21, 0, 1), (21, 1, 0), (27, 1, 1), (None, 1, 1), (26, None, None), (1, 1, 0), (1, 1, 0), (99, 1, 1)]
    docs = clashing(spark.createDataFrame(some_docs(), DOCUMENTS))
    got = rows_of(A.audit(docs.repartition(3), clashing(spark.createDataFrame(labels, LABELS))))
    assert got == plain([(r[0], r[1], r[3]) for r in some_docs()], labels)


def test_a_part_that_fails_nothing_has_zeros(spark):
    text = " ".join(f"w{i}" for i in range(250))
    docs = spark.createDataFrame([(1, text, "en", "a", 1), (2, "short", "en", "b", 1)], DOCUMENTS)
    got = rows_of(A.audit(docs, spark.createDataFrame([], LABELS)))
    assert got["a", "ABCDE", 5] == (1, 0, 0, 0, 0, 0, 0)
    assert got["b", "ABCDE", 1] == (0, 1, 0, 1, 0, 0, 120)
    assert len(got) == 1200


def test_empty(spark):
    docs = spark.createDataFrame([], DOCUMENTS)
    assert A.audit(docs, spark.createDataFrame([], LABELS)).collect() == []


def test_hot_copies(spark, monkeypatch):
    """A third of the rows is one text; hot groups are met where they stand."""
    monkeypatch.setattr(A, "HOT_GROUPS", 10)
    docs = [(i, "same text" if i % 3 else f"text {i // 6}", "en", "a", 1) for i in range(120)]
    rows = A.measure(spark.createDataFrame(docs, DOCUMENTS), "doc_id", "text", "source")
    doc = dict(rows.select("row", "doc").collect())
    first = {}
    for i, t, *_ in docs:
        first.setdefault(t, i)
    got = sorted(doc[r.row] for r in A.copies_of_smaller(rows).collect())
    assert got == [i for i, t, *_ in docs if first[t] < i]


def test_few_jobs(spark):
    """A level is one join for all filters: the driver keeps plans and stages of all."""
    docs = spark.createDataFrame(some_docs(), DOCUMENTS)
    labels = spark.createDataFrame([(20, 1, 0)], LABELS)
    spark.sparkContext.setJobGroup("audit-jobs", "")
    try:
        A.audit(docs, labels).collect()
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("audit-jobs")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) < 60
