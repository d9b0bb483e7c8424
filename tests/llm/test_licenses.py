import random
import re

import brute
from conftest import DOCUMENTS, odd_rows
from txnlab.llm import licenses as L

TEXTS = [
    "Released under the MIT License.", "mit-license MIT LICENSE mit  license", "The Apache License; apache\nlicense",
    "GNU General Public License, general public", "license mit", "", None, "mit license " * 2000,
    "Permission is hereby granted, free of charge, to any individual person obtaining a copy of this software and "
    "associated documentation files (the Software), to deal in the Software without restriction",
    "Redistribution and use in binary forms, with or without modification, are permitted",
    "Licensed under CC BY-NC 4.0. otherwise plain words follow", "émit license 漢mit license mit\u00a0license",
]


def check(got, rows):
    key = lambda x: (x[0] is None, x[0], x[1])
    want = sorted([(r[0], *brute.license_base(r[1])) for r in rows], key=key)
    have = sorted([(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got], key=key)
    assert have == want
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert r.labels == ",".join(sorted(set(filter(None, r.labels.split(","))))) and 0 <= r.score <= 1


def test_base(spark, docs001):
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(TEXTS)]
    got = L.scan(spark.createDataFrame(rows, DOCUMENTS)).collect()
    check(got, rows)
    check(L.scan(docs001).collect(), [tuple(r) for r in docs001.collect()])
    by = {r.doc_id: r for r in got}
    assert by[8].labels == "mit" and by[8].base_labels == ""  # a word too many shifts the diagonal by one
    span = [s for s in by[8].spans if s.label == "mit"][0]
    assert span.first_word == 0 and span.cover > 0.9
    assert by[9].labels == ""  # less than COVER of the notice
    assert by[10].labels == "cc" and by[10].score == 1.0


def test_odd_rows_empty_and_clashing_names(spark):
    check(L.scan(spark.createDataFrame(odd_rows(), DOCUMENTS)).collect(), odd_rows())
    assert L.scan(spark.createDataFrame([], DOCUMENTS)).count() == 0
    odd = spark.createDataFrame([(1, "the mit license", 5, "x")], "doc_id long, text string, words int, h string")
    check(L.scan(odd).collect(), [(1, "the mit license")])


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())


def check_spans(got, rows):
    want = sorted(((r[0], brute.license_spans(r[1], L.TEMPLATES, split)) for r in rows), key=lambda x: (x[0] is None, *x))
    have = sorted(((r.doc_id, sorted((s.label, s.last_word, s.cover) for s in r.spans)) for r in got),
                  key=lambda x: (x[0] is None, *x))
    assert have == want
    for r in got:
        assert set(filter(None, r.labels.split(","))) == {s.label for s in r.spans} | set(filter(None, r.base_labels.split(",")))


def test_a_template_word_counts_once(spark):
    rows = [(1, "we released under the released under the table", "en", "a", 1),
            (2, "licensed under cc licensed under cc", "en", "a", 1),
            (3, "permission is hereby granted " * 40, "en", "a", 1)]
    got = L.scan(spark.createDataFrame(rows, DOCUMENTS)).collect()
    assert [(r.labels, r.score) for r in got] == [("", 0.0)] * 3
    check_spans(got, rows)


def test_spans_against_brute_force(spark):
    rnd = random.Random(5)
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(TEXTS)]
    for i in range(120):  # notices with words added, left out, changed and repeated, between other words
        words = split(rnd.choice(L.TEMPLATES)[1])
        rate = rnd.choice([0, 0.03, 0.08, 0.15])
        out = []
        for w in words:
            x = rnd.random()
            out += [] if x < rate else [w, rnd.choice(words)] if x < 2 * rate else ["zz"] if x < 3 * rate else [w]
        pad = ["plain"] * rnd.randrange(5)
        text = " ".join(pad + out + pad + (out[: rnd.randrange(len(out) + 1)] if i % 3 == 0 else []))
        rows.append((100 + i, text, "en", "a", 1))
    got = L.scan(spark.createDataFrame(rows, DOCUMENTS)).collect()
    check_spans(got, rows)
    assert sum(bool(r.labels) for r in got if r.doc_id >= 100) >= 60
    check_spans(L.scan(spark.createDataFrame(odd_rows(), DOCUMENTS)).collect(), odd_rows())
