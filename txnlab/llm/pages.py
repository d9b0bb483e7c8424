"""Main text of web pages by minimum cut.

A page is read into blocks: runs of text between block-level tags, with the
element they stand in.  Every block gets a cost for either label, content or
boilerplate, and the labelling of least cost is a minimum cut:

* the costs are terminal capacities.  A logistic classifier over text features
  (length, share of link text, punctuation, kind of element, neighbours, and on
  how many different pages of its host the same block stands) gives log odds, cut
  at ``EVIDENCE``; what the markup says of the enclosing elements (``article``,
  ``nav``, class names ...) adds to them.  The classifier is fitted by Spark ML on
  blocks whose markup leaves no doubt, so that it judges those without any.
* smoothness edges join neighbouring blocks, weaker the further apart they stand
  in the tree, and blocks and elements to the element around them (proximity in
  the tree), so that elements of one kind go together.
* a maximum flow (shortest augmenting paths by levels) gives the cut; blocks on
  the source's side are the text, in page order, one to a line.

Work by Spark: pages are parsed where they stand and the hashes of their blocks
(host and text) written; a hash that different pages have counts as repeated, and
is joined back to its places.  Repeated blocks that may be hot are fewer than
``HOT_BLOCKS`` and are met by a broadcast of that size, the others by a shuffle of
ids.  A page's repeated places join it by a hash of its url and html, so that its
text is shuffled once and stored never.  A task holds a batch of pages; a page's
graph grows with its blocks.

Nothing is dropped or cut inside of a page's text.  A page without html, or
without any content, has an empty text; a page that ends inside a tag or comment
ends there.  White space is what ``str.split`` takes as such.  Repeated rows give
equal rows each.  With no doubtless blocks of both kinds in the table the weights
are ``DEFAULT``.  An empty table gives an empty result.  Only the named columns are
read, so other columns, whatever their names, don't matter.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlab.session import materialize

EVIDENCE = 3.0   # most that the classifier says for or against a block
STRONG, WEAK = 6.0, 3.0  # what markup says
OUTSIDE = 2.0    # against blocks without markup hints on a page that has an article
ADJACENT, INSIDE, NESTED = 1.0, 0.75, 0.5  # edges: neighbours, block and element, element and element
ACROSS = 0.1     # factor of edges between elements of which the markup says different things
HOT_BLOCKS = 10_000
FIT_PAGES = 5_000  # pages, picked by hash, whose blocks the classifier is fitted on
UNIT = 1000      # capacities are whole thousandths

# Elements of HTML by their part in a page.
BLOCK = set("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure
footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table
tbody td tfoot th thead tr ul caption search""".split())
RAW = set("script style textarea title iframe xmp noembed noframes".split())
DROPPED = set("noscript template select button svg math object canvas video audio datalist map".split())
CLOSES = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr", "table"),
          "td": ("td th", "tr table"), "th": ("td th", "tr table"), "tbody": ("tbody thead tfoot", "table"),
          "thead": ("tbody thead tfoot", "table"), "tfoot": ("tbody thead tfoot", "table")}
CLOSES = {k: (set(a.split()), set(b.split())) for k, (a, b) in CLOSES.items()}
KIND = {**dict.fromkeys("p blockquote pre".split(), 1), **dict.fromkeys("h1 h2 h3 h4 h5 h6".split(), 2),
        **dict.fromkeys("li dt dd".split(), 3), **dict.fromkeys("td th caption".split(), 4)}
# Words of class names, ids and roles.
AGAINST = set("""ad ads adv advert adverts advertisement adsense sponsor sponsored promo promoted banner nav navbar
navigation menu breadcrumb breadcrumbs sidebar aside complementary related recommended recommendations comment comments
reply replies disqus respond cookie cookies consent gdpr newsletter subscribe subscription signup share sharing social
pagination pager footer contentinfo popup modal overlay widget notice notices notification alert search login
copyright disclaimer toolbar masthead topbar""".split())
PERHAPS = set("header form side hidden meta".split())
IN_FAVOUR = set("article articlebody content maincontent post entry story main prose".split())
UNSURE = set("has with without no wrapper wrap layout container page".split())

_TAG = re.compile(r"""<(?:!--.*?(?:--!?>|\Z)|(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)(?:>|\Z)
                       |(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)|[!?/][^>]*(?:>|\Z))""", re.S | re.X)
_ATTR = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
_NAME = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_TELLS = re.compile("class|id|role|hidden|style", re.I)


def hint_of(tag: str, attrs: str, around: float) -> float:
    """What an element's markup says, given what the element around it says:
    above 0 for content, below 0 for boilerplate, and how sure it is."""
    if tag in ("html", "body"):
        return 0.0
    names, hidden = set(), False
    if attrs and _TELLS.search(attrs):
        for name, a, b, c in _ATTR.findall(attrs):
            name, value = name.lower(), unescape(a or b or c)
            if name in ("class", "id", "role"):
                names.update(x.lower() for x in _NAME.findall(value))
            elif name == "hidden" or (name == "aria-hidden" and value == "true"):
                hidden = True
            elif name == "style" and "display:none" in value.replace(" ", "").lower():
                hidden = True
    if names & UNSURE:
        names = set()
    if hidden or tag in ("nav", "aside", "footer", "menu", "dialog", "search") or names & AGAINST:
        says = -STRONG
    elif tag == "header" or tag == "form" or names & PERHAPS:
        # a heading of an article is part of it
        says = -STRONG if tag == "form" else around if around > 0 or names & IN_FAVOUR else -WEAK
    elif tag in ("article", "main") or names & {"articlebody"}:
        says = STRONG
    elif names & IN_FAVOUR:
        says = WEAK
    else:
        return around
    # what stands inside a menu, sidebar or list of comments stays boilerplate
    if around <= -STRONG and says > 0 and tag != "main":
        return around
    return max(says, around) if says > 0 else says


def parse(html: str) -> dict:
    """Blocks of a page: text, characters in links, kind, element; and for each
    element the one around it and what the markup says."""
    out = {"texts": [], "links": [], "kinds": [], "nodes": [], "parents": [-1], "hints": [0.0]}
    stack, opened = [("", 0, False)], Counter()  # (tag, element, dropped)
    buf, linked, link = [], 0, -1  # link: height of the stack at an open <a>

    def flush():
        nonlocal buf, linked
        text = " ".join("".join(buf).split()) if buf else ""
        if text:
            out["texts"].append(text)
            out["links"].append(min(linked, len(text)))
            out["kinds"].append(next((KIND[s[0]] for s in reversed(stack[-4:]) if s[0] in KIND), 0))
            out["nodes"].append(stack[-1][1])
        buf, linked = [], 0

    def close(i):
        nonlocal link
        for s in stack[i:]:
            opened[s[0]] -= 1
        del stack[i:]
        if link > len(stack):
            link = -1

    def add(chunk):
        nonlocal linked
        if chunk and not stack[-1][2]:
            chunk = unescape(chunk)
            buf.append(chunk)
            if link >= 0:
                linked += len(chunk.strip())

    at, size = 0, len(html)
    while at < size:
        lt = html.find("<", at)
        if lt < 0:
            add(html[at:])
            break
        m = _TAG.match(html, lt)
        if m is None:  # a lone '<' is text
            add(html[at: lt + 1])
            at = lt + 1
            continue
        add(html[at: lt])
        at = m.end()
        end, tag, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if tag is None or (at == size and html[-1] != ">"):
            continue
        tag = tag.lower()
        if tag == "br":
            add(" ")
        elif tag == "a":
            link = -1 if end else len(stack)
        elif end:
            if tag in BLOCK and not stack[-1][2]:
                flush()
            if opened[tag] > 0:
                i = max(i for i, s in enumerate(stack) if s[0] == tag) if stack[-1][0] != tag else len(stack) - 1
                if tag in BLOCK or stack[-1][2]:
                    if stack[i][2] or not stack[-1][2] or tag in BLOCK:
                        flush()
                        close(i)
        elif tag in RAW:
            close_at = re.compile(f"</{tag}[\\s/>]", re.I).search(html, at)
            at = close_at.start() if close_at else size
        elif tag in DROPPED:
            if not attrs.endswith("/"):
                opened[tag] += 1
                stack.append((tag, stack[-1][1], True))
        elif tag in BLOCK:
            if not stack[-1][2]:
                flush()
            if stack[-1][0] == "p" or (stack[-1][0] in KIND and KIND[stack[-1][0]] == 2 == KIND.get(tag)):
                close(len(stack) - 1)
            if tag in CLOSES:
                same, limit = CLOSES[tag]
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in limit:
                        break
                    if stack[i][0] in same:
                        close(i)
                        break
            if tag not in ("hr", "html", "body"):
                around = stack[-1][1]
                out["parents"].append(around)
                out["hints"].append(hint_of(tag, attrs, out["hints"][around]))
                opened[tag] += 1
                stack.append((tag, len(out["parents"]) - 1, stack[-1][2]))
    flush()
    return out


# ------------------------------------------------------------------ evidence
STOPS = (". ", "! ", "? ", "; ", ", ", ": ")
FEATURES = ("length", "words", "link_share", "all_links", "stops", "ends", "capitals", "digits", "paragraph", "heading",
            "item", "cell", "pages", "before", "after", "link_before", "link_after")
DEFAULT = np.array([0.5, 0.4, -2.0, -1.5, 1.0, 1.0, -0.5, -1.0, 1.0, 0.3, -0.8, -0.5, -2.5, 0.2, 0.2, -0.7, -0.7, -2.0])


def features(texts, links, kinds, pages) -> np.ndarray:
    """One row of ``FEATURES`` per block of a page; ``pages`` counts the host's
    different pages with the block."""
    rows = []
    for text, link, kind, n in zip(texts, links, kinds, pages):
        size, words = len(text), text.count(" ") + 1
        share = link / size
        stops = sum(map(text.count, STOPS)) + (text[-1] in ".!?;:")
        rows.append((math.log1p(size) / 5, math.log1p(words) / 4, share, share > 0.9, min(1.0, 5 * stops / words),
                     text[-1] in ".!?\"”»)", sum(w[0].isupper() for w in text.split(" ")) / words,
                     sum(map(text.count, "0123456789")) / size,
                     kind == 1, kind == 2, kind == 3, kind == 4, min(6.0, math.log2(n)) / 6))
    x = np.array(rows, dtype=float).reshape(len(rows), 13)
    near = np.zeros((len(rows), 4))
    near[1:, 0], near[:-1, 1] = x[:-1, 1], x[1:, 1]
    near[1:, 2], near[:-1, 3] = x[:-1, 2], x[1:, 2]
    return np.hstack([x, near])


# --------------------------------------------------------------- minimum cut
def min_cut(gain: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes are on the source's side of a minimum cut: node v is joined to
    the source with capacity ``gain[v]``, or to the sink with its negative, and
    each edge (u, v, capacity) holds in both directions.  Of several minimum cuts
    that with the fewest nodes on the source's side.

    Levels by breadth first, then augmenting paths along them, until the sink is
    out of reach."""
    n = len(gain)
    s, t = n, n + 1
    head, to, cap = [[] for _ in range(n + 2)], [], []

    def join(u, v, there, back):
        head[u].append(len(to))
        head[v].append(len(to) + 1)
        to.extend((v, u))
        cap.extend((there, back))
    for v, g in enumerate(gain):
        if g > 0:
            join(s, v, g, 0)
        elif g < 0:
            join(v, t, -g, 0)
    for u, v, c in edges:
        if c > 0:
            join(u, v, c, c)
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = [s]
        for u in queue:
            for e in head[u]:
                if cap[e] and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
            if level[t] >= 0:
                break
        if level[t] < 0:
            return [level[v] >= 0 for v in range(n)]
        tried = [0] * (n + 2)
        path, u = [], s
        while True:
            if u == t:
                flow = min(cap[e] for e in path)
                back = None
                for i, e in enumerate(path):
                    cap[e] -= flow
                    cap[e ^ 1] += flow
                    if back is None and not cap[e]:
                        back = i
                u = to[path[back] ^ 1]
                del path[back:]
                continue
            while tried[u] < len(head[u]):
                e = head[u][tried[u]]
                if cap[e] and level[to[e]] == level[u] + 1:
                    break
                tried[u] += 1
            else:
                if u == s:
                    break
                level[u] = -1  # no way on from here
                e = path.pop()
                u = to[e ^ 1]
                continue
            path.append(e)
            u = to[e]


def _gap(parents, depth, a, b) -> int:
    """Steps between two elements of the tree."""
    steps = 0
    while a != b:
        if depth[a] < depth[b]:
            a, b = b, a
        a, steps = parents[a], steps + 1
    return steps


def label(page: dict, evidence) -> list[bool]:
    """Content or not, for each block of a parsed page, given the classifier's
    log odds."""
    nodes, parents, hints = page["nodes"], page["parents"], page["hints"]
    n = len(nodes)
    if not n:
        return []
    depth = [0] * len(parents)
    for v in range(1, len(parents)):
        depth[v] = depth[parents[v]] + 1
    article = any(hints[v] >= STRONG for v in nodes)
    gain = []
    for v, e in zip(nodes, evidence):
        g = max(-EVIDENCE, min(EVIDENCE, float(e))) + hints[v]
        gain.append(round(UNIT * (g - (OUTSIDE if article and hints[v] == 0 else 0))))
    edges, used = [], set()

    def edge(u, v, a, b, weight):
        edges.append((u, v, round(UNIT * weight * (1 if hints[a] == hints[b] else ACROSS))))
    for i, v in enumerate(nodes):
        if i:
            edge(i - 1, i, nodes[i - 1], v, ADJACENT / (1 + _gap(parents, depth, nodes[i - 1], v) / 4))
        edge(i, n + v, v, v, INSIDE)
        while v not in used:
            used.add(v)
            if parents[v] >= 0:
                edge(n + v, n + parents[v], v, parents[v], NESTED)
                v = parents[v]
    side = min_cut(gain + [0] * len(parents), edges)
    return side[:n]


# ---------------------------------------------------------------------- Spark
def _digest(*parts: str) -> int:
    h = hashlib.blake2b("\0".join(parts).encode("utf-8", "surrogatepass"), digest_size=8)
    return int.from_bytes(h.digest(), "big", signed=True)


def _host(url: str | None) -> str:
    m = re.match(r"[^:]*://([^/?#]*)", url or "")
    return m[1].lower() if m else ""


def keyed_pages(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """(page, key, url, html); ``page`` is a hash of url and html."""
    d = pages.select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").alias("url"),
                     F.col(f"`{html}`").cast("string").alias("html"))
    return d.select(F.xxhash64("url", "html").alias("page"), "key", "url", "html")


def block_ids(pages: DataFrame) -> DataFrame:
    """(page, ids), written: hashes of host and text of each block, in order."""
    def read(batches):
        for batch in batches:
            ids = []
            for u, h in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                host = _host(u)
                ids.append([_digest(host, x) for x in parse(h or "")["texts"]])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int64()))], ["page", "ids"])

    d = pages.select("page", F.col("url").cast("string").alias("url"), "html")
    return materialize(d.mapInArrow(read, "page long, ids array<long>"), "pages-ids")


def repeated_blocks(ids: DataFrame) -> DataFrame:
    """(id, pages), written: blocks that different pages of a host have, and on how
    many rows they stand."""
    each = ids.select("page", F.explode(F.array_distinct("ids")).alias("id"))
    n = each.groupBy("id").agg(F.count(F.lit(1)).alias("pages"), F.min("page").alias("a"), F.max("page").alias("b"))
    return materialize(n.filter("a < b").select("id", "pages"), "pages-repeated")


def repeated_places(ids: DataFrame, repeated: DataFrame) -> DataFrame:
    """(page, again), written: the places of a page's repeated blocks, each with the
    number of pages.  A block on more than 1/HOT_BLOCKS of all places is one of
    fewer than HOT_BLOCKS."""
    total = ids.agg(F.sum(F.size("ids"))).first()[0] or 0
    at = total // HOT_BLOCKS + 1
    hot = repeated.filter(F.col("pages") > at).select("id", F.col("pages").alias("hot"))
    rows = ids.select("page", F.posexplode("ids").alias("at", "id"))
    met = rows.join(F.broadcast(hot), "id", "left")
    few = met.filter("hot IS NULL").join(repeated, "id").select("page", "at", "pages")
    met = met.filter("hot IS NOT NULL").select("page", "at", F.col("hot").alias("pages")).unionByName(few)
    # a set: copies of a page have the same places
    return materialize(met.groupBy("page").agg(F.collect_set(F.struct("at", "pages")).alias("again")), "pages-again")


def with_repeats(pages: DataFrame, again: DataFrame) -> DataFrame:
    """``pages`` with ``again``; a table of few bytes a page is hashed, no text sorted."""
    return pages.join(again.hint("shuffle_hash"), "page", "left")


def _pages_of(batch: pa.RecordBatch):
    names = batch.schema.names
    for html, again in zip(*(batch.column(names.index(c)).to_pylist() for c in ("html", "again"))):
        page = parse(html or "")
        page["pages"] = [1] * len(page["texts"])
        for x in again or []:
            page["pages"][x["at"]] = x["pages"]
        yield page


def fit_evidence(blocks: DataFrame) -> np.ndarray:
    """Weights of ``FEATURES`` and the intercept, fitted on the blocks of ``blocks``
    (with ``again``) of which the markup leaves no doubt, both kinds weighing alike."""
    def examples(batches):
        for batch in batches:
            kind, rows = [], []
            for page in _pages_of(batch):
                hints = [page["hints"][v] for v in page["nodes"]]
                x = features(page["texts"], page["links"], page["kinds"], page["pages"])
                for h, r in zip(hints, x):
                    if abs(h) >= STRONG:
                        kind.append(float(h > 0))
                        rows.append(r.tolist())
            yield pa.RecordBatch.from_arrays([pa.array(kind, pa.float64()), pa.array(rows, pa.list_(pa.float64()))],
                                             ["label", "x"])

    rows = materialize(blocks.mapInArrow(examples, "label double, x array<double>"), "pages-examples")
    n = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}  # two rows
    if len(n) < 2:
        return DEFAULT
    weight = F.when(F.col("label") == 1, 0.5 / n[1.0]).otherwise(0.5 / n[0.0]) * sum(n.values())
    rows = rows.select("label", array_to_vector("x").alias("features"), weight.alias("w"))
    model = LogisticRegression(maxIter=30, regParam=0.02, standardization=False, weightCol="w").fit(rows)
    return np.array([*model.coefficients.toArray(), model.intercept])


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: <key>, <url>, text, n_chars."""
    keyed = keyed_pages(pages, key, url, html)
    ids = block_ids(keyed)
    again = repeated_places(ids, repeated_blocks(ids))
    share = min(1.0, FIT_PAGES / max(1, ids.count()))
    sample = keyed.filter(F.pmod("page", F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    weights = fit_evidence(with_repeats(sample, again))

    def text_of(batches):
        for batch in batches:
            out = []
            for page in _pages_of(batch):
                x = features(page["texts"], page["links"], page["kinds"], page["pages"])
                keep = label(page, x @ weights[:-1] + weights[-1])
                out.append("\n".join(t for t, k in zip(page["texts"], keep) if k))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.string()),
                 pa.array([len(t) for t in out], pa.int64())], ["key", "url", "text", "n_chars"])

    used = with_repeats(keyed, again).select("key", "url", "html", "again")
    schema = T.StructType([used.schema["key"], used.schema["url"], T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType())])
    done = used.mapInArrow(text_of, schema)
    return done.select(F.col("key").alias(key), F.col("url").alias(url), "text", "n_chars")
