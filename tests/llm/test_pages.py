import random
import re
from html import unescape
from itertools import product

import pytest

from tests_llm_common import clashing
from txnlab.llm import pages as P
from txnlab.llm.queries import QUERIES

from conftest import SF001, SF01

PAGES = "page_id long, url string, html string"
S = ["The council met on Tuesday to discuss the new bridge, which has been delayed twice this year.",
     "Residents said that the works, though welcome, had closed the only road to the harbour for months.",
     "A spokesman for the builders answered that the weather was to blame; the steel arrived late.",
     "Short one.", "Work will start again in May, and the first cars should cross before the autumn storms."]
P_ = "".join(f"<p>{s}</p>" for s in S)

SITE = """<html><head><title>T</title><style>p{{}}</style></head><body class="has-sidebar home">
<header><a href="/">The Daily</a><p>All the news of the coast, every day.</p></header>
<div id="main-nav"><ul><li><a href=a>Home</a></li><li><a href=b>News</a></li><li><a href=c>Sport</a></li></ul></div>
<div class="cookie-notice">We use cookies to improve your visit. <button>Accept all</button></div>
<div class="post"><h1>Bridge late again</h1>{body}
<div class="post-comments"><article class="c"><p>I think that the bridge was a bad idea, and so do all my friends.</p></article>
<form><label>Your comment</label><textarea>Write here</textarea></form></div></div>
<div class="sidebarRight"><h3>Most read</h3><p>The longest article of the year is about boats, and it is worth it.</p></div>
<script>document.write("<p>no</p>")</script><footer>&copy; The Daily &middot; All rights reserved.</footer></body></html>"""


def text_of(html):
    page = P.parse(html)
    x = P.features(page["texts"], page["links"], page["kinds"], [1] * len(page["texts"]))
    return "\n".join(t for t, k in zip(page["texts"], P.label(page, x @ P.DEFAULT[:-1] + P.DEFAULT[-1])) if k)


def test_a_page_of_class_names():
    assert text_of(SITE.format(body=P_)) == "\n".join(["Bridge late again", *S])


@pytest.mark.parametrize("tag", ["article", "main", 'div class="entry-content"', 'section id="article"', 'div role="main"'])
def test_kinds_of_articles(tag):
    name = tag.split()[0]
    html = f"<body><nav><a href=x>One</a> <a href=y>Two</a></nav><{tag}><header><h1>Head</h1></header>{P_}</{name}>" \
           "<aside><p>Read also this piece, which is long, on another matter of the week.</p></aside>" \
           '<div class="ad">Buy a boat now, and save a third of the price until Sunday.</div></body>'
    assert text_of(html) == "\n".join(["Head", *S])


def test_no_markup_hints_at_all():
    html = "<div><a href=1>Home</a> <a href=2>About us</a> <a href=3>Contact</a></div><div>" + P_ + \
           "</div><div><ul><li><a href=4>Older</a></li><li><a href=5>Newer</a></li></ul></div>"
    assert text_of(html) == "\n".join(S)


def test_notices_forms_and_adverts_within_an_article():
    html = f'<article><h2>A &amp; B</h2><p>{S[0]}</p><div class="ad-slot">Buy now, pay later, says our sponsor.</div>' \
           f'<p>{S[1]}<div class="newsletter-signup"><p>Get our letter every day, free of charge.</p><form><input>' \
           f'<label>Mail</label></form></div><p>{S[2]}<aside>See also our older pieces.</aside><p hidden>{S[3]}</p>' \
           f'<p style="display: none">x y z</p><p>{S[4]}</article>'
    assert text_of(html) == "\n".join(["A & B", S[0], S[1], S[2], S[4]])


def test_parse_details():
    def texts(h):
        return P.parse(h)["texts"]
    assert texts("") == [] and texts("  \n ") == [] and texts("<") == ["<"]
    assert texts("a &lt;b&gt; &#233;&nbsp; c") == ["a <b> é c"]
    assert texts("<p>one<br>two <b>th</b>ree<p>four") == ["one two three", "four"]
    assert texts("<p>x</p><script>var a='</p>';</script><!-- <p>no</p> --><P>y") == ["x", "y"]
    assert texts("<p>x<script>never closed <p>no") == ["x"]
    assert texts("<p>x<!-- never closed <p>no") == ["x"]
    assert texts("<p>x <a href='no") == ["x"] and texts("<p>x</p") == ["x"]
    assert texts("a < b and c<d>e") == ["a < b and ce"]
    assert texts('<p title="a > b">x</p>') == ["x"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>") == ["a", "b", "c", "d"]
    assert texts("<table><tr><td>a<td>b<tr><td>c</table>d") == ["a", "b", "c", "d"]
    assert texts("<div><button>no</div><p>yes") == ["yes"]
    assert texts("<select><option>no</select>yes<svg><text>no</text></svg>") == ["yes"]
    assert texts("<title>no</title>&am") == ["&am"]


def test_long_and_deep_pages():
    deep = "<div>" * 20_000 + "deep" + "</div>" * 20_000
    assert P.parse(deep)["texts"] == ["deep"]
    many = "<article>" + "<p>word word, word.</p>" * 20_000 + "</article>"
    assert text_of(many).count("\n") == 19_999
    assert P.parse("<a href=\"" * 3_000)["texts"] is not None


def cut_cost(side, gain, edges):
    return sum(max(g, 0) if not s else max(-g, 0) for s, g in zip(side, gain)) + sum(
        c for u, v, c in edges if side[u] != side[v])


def test_min_cut_against_all_labellings():
    rng = random.Random(1)
    for _ in range(150):
        n = rng.randrange(1, 9)
        gain = [rng.randrange(-9, 10) for _ in range(n)]
        edges = [(rng.randrange(n), rng.randrange(n), rng.randrange(6)) for _ in range(rng.randrange(12))]
        edges = [e for e in edges if e[0] != e[1]]
        side = P.min_cut(gain, edges)
        assert cut_cost(side, gain, edges) == min(cut_cost(x, gain, edges) for x in product([False, True], repeat=n))


def articles(spark, sf):
    """page_id -> text of the article element, by its own simple rules: the given
    pages have no other blocks inside."""
    out = {}
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        body = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        body = re.sub(r"</?(b|a|i|em)\b[^>]*>", "", body).replace("<br>", " ")
        lines = [" ".join(unescape(x).split()) for x in re.split(r"<[^>]*>", body)]
        out[r.page_id] = "\n".join(x for x in lines if x)
    return out


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_query_on_whole_tables(spark, sf):
    got = QUERIES["op13_main_text"](spark, sf)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    rows = got.collect()
    assert {r.page_id: r.text for r in rows} == articles(spark, sf)
    assert all(r.n_chars == len(r.text) for r in rows)


def test_odd_rows_and_clashing_names(spark):
    site = SITE.format(body=P_)
    rows = [(1, "http://a/x", site), (1, "http://a/x", site), (2, None, None), (None, "nonsense", ""), (3, "http://A/y", "a"),
            (None, None, None), (4, "http://b/", "<p>" + "long " * 50_000)]
    df = clashing(spark.createDataFrame(rows, PAGES))
    got = sorted((tuple(r) for r in P.extract(df).collect()), key=repr)
    assert [r[:2] for r in got] == sorted([r[:2] for r in rows], key=repr)
    text = "\n".join(["Bridge late again", *S])
    assert [r[2] for r in got if r[0] == 1] == [text, text]
    assert {r[3] for r in got if r[0] == 2} == {0}


def test_empty(spark):
    assert P.extract(spark.createDataFrame([], PAGES)).collect() == []


def test_repeats_and_hot_blocks(spark, monkeypatch):
    monkeypatch.setattr(P, "HOT_BLOCKS", 5)
    rows = [(i, "http://h/", f"<p>Menu</p><p>own {i}</p>" + ("<p>some</p>" if i < 3 else "")) for i in range(30)]
    rows += [(99, "http://other/", "<p>Menu</p>"), (5, "http://h/", rows[5][2])]
    pages = P.keyed_pages(spark.createDataFrame(rows, PAGES), "page_id", "url", "html")
    ids = P.block_ids(pages)
    got = P.with_repeats(pages, P.repeated_places(ids, P.repeated_blocks(ids))).collect()
    assert len(got) == len(rows)
    for r in got:
        texts = P.parse(r.html)["texts"]
        again = {texts[x["at"]]: x["pages"] for x in r.again or []}
        # a page's copy alone doesn't repeat its own block; a repeated one counts rows
        want = {} if r.key == 99 else {"Menu": 31, **({"some": 3} if r.key < 3 else {})}
        assert again == want
