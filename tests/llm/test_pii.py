import hashlib

import pytest

import brute
from conftest import DOCUMENTS, odd_rows
from txnlab.llm import pii as P

TRICKY = [
    "a@b.c_d@e.f x+y%z@host.co.uk. no@dot @x.y a@b..c a.b@c-d.e-f@g.h",
    "1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 01.002.3.255 9.9.9 1.2.3.4567 1..2.3.4",
    "4111 1111 1111 1111 and 4111-1111-1111-1111, 4111111111111112 12 34 5500000000000004x",
    "+1 (649) 555-1648 +44.20.7946.0958 ++1 555 123 4567 +12 +1(((((9 +1234567890123456789",
    "mixed +1 555 010 9999 me@x.org 10.0.0.1 4111111111111111\n\tme@x.org\u00a0\u00e9@x.org",
    "漢字 a@b.cc \U0001f600 +1 555 010 9999 \U0001f600 1.1.1.1", "", None, "1" * 3000, "a" * 3000 + "@", "+" * 500,
]


def check(got, rows):
    by = sorted((r[0], r[1] or "") for r in rows)
    found = sorted(((r.doc_id, r) for r in got), key=lambda x: x[0])
    assert len(by) == len(found)
    for (d, text), (_, r) in zip(by, found):
        spans = brute.personal(text)
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        n = [sum(k == x for k, _, _ in spans) for x in ("email", "ip", "card", "phone")]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == n, (d, text)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest(), (d, text)
        base = [x for x in r.spans.split(",") if x and not x.startswith("term")]
        assert ",".join(base) == listed


def test_base_spans(spark, docs001):
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(TRICKY)]
    check(P.find_personal_data(spark.createDataFrame(rows, DOCUMENTS)).collect(), rows)
    check(P.find_personal_data(docs001).collect(), [tuple(r) for r in docs001.collect()])


def revealing():
    """'zanzibar' stands near one address in different sentences and hardly elsewhere."""
    rows = [(i, f"number {i} the zanzibar desk {'abcdefgh'[i]}x writes from boss@corp.com about case {i}", "en", "a", 1)
            for i in range(6)]
    rows += [(10 + i, f"the desk writes about many other things today {i}", "en", "a", 1) for i in range(200)]
    rows += [(1000, "Zanzibar is mentioned here; zanzibars is another word", "en", "a", 1)]
    return rows


def test_terms_that_reveal_an_entity(spark):
    docs = spark.createDataFrame(revealing(), DOCUMENTS)
    got = {r.doc_id: r for r in P.find_personal_data(docs).collect()}
    assert "term:0:8" in got[1000].spans.split(",") and got[1000].n_term == 1
    assert got[10].n_term == 0
    clean = {r.doc_id: r for r in P.sanitise(docs).collect()}
    assert "boss@corp.com" not in clean[0].text and "[EMAIL]" in clean[0].text and "zanzibar" not in clean[0].text
    assert "zanzibars is another word" in clean[1000].text and not clean[1000].text.startswith("Zanzibar")
    assert clean[10].text == "the desk writes about many other things today 0"
    assert all(r.n_chars == len(r.text) for r in clean.values())


def test_copies_are_one_piece_of_evidence(spark):
    rows = [(i, "the zanzibar desk writes from boss@corp.com today", "en", "a", 1) for i in range(9)]
    assert all(r.n_term == 0 for r in P.find_personal_data(spark.createDataFrame(rows, DOCUMENTS)).collect())


def test_odd_rows_empty_and_clashing_names(spark):
    docs = spark.createDataFrame(odd_rows(), DOCUMENTS)
    assert P.find_personal_data(docs).count() == len(odd_rows())
    clean = P.sanitise(docs)
    assert clean.columns == docs.columns and clean.count() == len(odd_rows())
    assert clean.filter("text is null").count() == 2
    assert P.find_personal_data(docs.limit(0)).count() == 0 and P.sanitise(docs.limit(0)).count() == 0
    odd = spark.createDataFrame([(1, "a@b.cc", "k", 2.0)], "doc_id long, text string, terms string, spans double")
    assert [tuple(r) for r in P.sanitise(odd, length=None).collect()] == [(1, "[EMAIL]", "k", 2.0)]


@pytest.mark.parametrize("text", ["a@b.cc and 10.0.0.1", "+1 555 010 9999 4111111111111111 x", "漢 a@b.cc 漢"])
def test_nothing_but_the_spans_is_replaced(spark, text):
    want, at = "", 0
    for k, s, e in brute.personal(text):
        want, at = want + text[at:s] + P.PLACEHOLDER[k], e
    docs = spark.createDataFrame([(1, text, "en", "a", 1)], DOCUMENTS)
    assert P.sanitise(docs).first().text == want + text[at:]


def far(i, name):
    return f"{name} opened the file and {'said nothing more about it ' * 6}before a note went to u{i}@corp.com at last"


def test_a_far_and_rare_name_reveals(spark):
    rows = [(i, far(i, f"Quill{i}"), "en", "a", 1) for i in range(40)] + [(90, "quill7 was seen", "en", "a", 1)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    got = {r.doc_id: r for r in P.find_personal_data(docs).collect()}
    assert all(f"term:0:{len(f'Quill{i}')}" in got[i].spans.split(",") and got[i].n_term == 1 for i in range(40))
    assert got[90].spans == "term:0:6"
    clean = {r.doc_id: r.text for r in P.sanitise(docs).collect()}
    assert clean[3] == far(3, "").replace("u3@corp.com", "[EMAIL]") and clean[90] == "[TERM] was seen"


def test_copies_count_alike_on_both_sides(spark):
    texts = [f"the zanzibar desk {w} wrote from boss@corp.com then" for w in ("one", "two", "three", "four", "five")]
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(texts + texts[:1] * 100)]
    rows += [(500 + i, f"the desk one two three four five wrote from there then {i}", "en", "a", 1) for i in range(100)]
    got = {r.doc_id: r for r in P.find_personal_data(spark.createDataFrame(rows, DOCUMENTS)).collect()}
    assert all("term:4:12" in got[i].spans.split(",") for i in range(105)) and got[500].n_term == 0


def test_many_entities_in_one_text(spark):
    rows = [(1, " ".join(f"w{i}x a{i}@b.cc" for i in range(300)), "en", "a", 1)]
    rows += [(10 + i, f"nothing of note here {i}", "en", "a", 1) for i in range(40)]
    got = {r.doc_id: r for r in P.find_personal_data(spark.createDataFrame(rows, DOCUMENTS)).collect()}
    assert got[1].n_email == 300 and got[1].n_term == 300 and got[10].n_term == 0


def test_one_text_is_no_evidence_with_caution(spark):
    rows = revealing() + [(2000 + i, f"rare{i} stands alone beside u{i}@corp.com here", "en", "a", 1) for i in range(30)]
    rows += [(3000 + i, f"rare{i} was seen elsewhere too", "en", "a", 1) for i in range(30)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    got = {r.doc_id: r for r in P.find_personal_data(docs, z=P.CAUTION).collect()}
    assert all(got[2000 + i].n_term == got[3000 + i].n_term == 0 for i in range(30))
    assert got[1000].n_term == 1 and "term:0:8" in got[1000].spans  # six texts of one address


def test_lower_bound():
    """Against the formula: the share at which a test of z deviations turns."""
    for n in (1, 2, 3, 10, 200):
        for hits in {n, n - 1, (n + 1) // 2}:
            p, z = hits / n, P.CAUTION
            low = (p + z * z / (2 * n) - z * (p * (1 - p) / n + z * z / (4 * n * n)) ** 0.5) / (1 + z * z / n)
            assert low <= p and abs((p - low) ** 2 - z * z * low * (1 - low) / n) < 1e-12
