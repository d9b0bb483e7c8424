"""Modified Kneser-Ney over words: the bits of every text under the bigram model of its language.

Tokens are words, lower-cased A-Z, then one end per text; every text trains the
model and is scored by it.  p(w|v) = (c(vw) - D2) / c(v) + back(v) * p(w), and
p(w) = (N(w) - D1) / N + back / V with N(w) the number of different words before w.
Discounts are by count of counts, for each language and order.

Nothing that grows with the corpus is broadcast or gathered in one place:

1. Counts: each block of texts sends its distinct bigrams with counts to context
   buckets.  A bucket merges them into its part of the model: contexts, their
   next words and counts, as sorted arrays of hashes.
2. Words: a written part sends its next words, with how many contexts each has there,
   to word buckets, which add them up and answer with N(w).
3. Scores: the texts are read again and each block sends its distinct bigrams
   with the documents that hold them; a bucket looks them up in its part of
   the model and returns the documents' bits.

Counts are made for a share of the buckets at a time (``SHARES``), scores for a share
of the buckets and of the texts (``SHARDS``), which bounds what lies on disk at once;
for it the texts are read once more for each.

A context that holds more than a share of a bucket is dealt by its next word over
several; its sums are put together first.  Which ones these are is estimated from
some texts and decides only where rows go.  Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlab.llm.katz import END, by_bucket, deal, from_gaps, gaps, pack, release, small, unpack, vocabulary, \
    word_bucket
from txnlab.llm.katz import _in_order as in_order
from txnlab.llm.textops import AT_ONCE, BYTE_VALUE, LOWER, blocks, running, slice_hash, text_buffer, words
from txnlab.session import materialize

BLOCK_TEXT = 16 << 20
SCORED_TEXT = 8 << 20  # of a block whose texts are scored, which takes more memory
TOGETHER = 2  # partitions of the texts that a task counts
BLOCK_DOCS = 32768
BUCKET_TEXT = 24 << 20
CONTEXT_TOKENS = 1 << 20  # a context with more is dealt over several buckets
LARGE = 4  # buckets; fewer are counted and scored at once
SHARES, SHARDS = 2, 2  # of the buckets, of the texts
SAMPLE = 20_000  # texts from which frequent contexts are estimated
# shuffle files go when the table made of them is written, not some time later
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
UNITS = 1e4  # bits are sent as whole numbers of 1 / UNITS

LOWER_VALUE = BYTE_VALUE[LOWER]  # words hash as their lower-cased bytes
START = np.uint64(0x2222222222222222)
NONE = (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def stream(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of texts in a row, each text between ``START`` and ``END``, and each one's text."""
    parts, own = [], []
    for i, j in blocks(off, AT_ONCE):
        mine = data[off[i]: off[j]]
        s, e, w = words(mine, off[i: j + 1] - off[i])
        h, size = slice_hash(running(mine, LOWER_VALUE), s, e), np.diff(w)
        doc, out = np.arange(j - i), np.empty(len(s) + 2 * (j - i), dtype=np.uint64)
        first = w[:-1] + 2 * doc
        out[first], out[first + size + 1] = START, END
        out[np.arange(len(h)) + 2 * np.repeat(doc, size) + 1] = h
        parts.append(out)
        own.append(np.repeat(np.arange(i, j, dtype=np.int32), size + 2))
    return np.concatenate(parts), np.concatenate(own)


def by_language(batches, limit: int):
    """(language, ids, texts) of the rows of one language, of about ``limit`` bytes of text."""
    held: dict = {}

    def flush(name):
        ids, texts, _, _ = held.pop(name)
        return name, np.concatenate(ids), pa.concat_arrays(texts)

    for b in batches:
        names = b.column(0).to_pylist()
        ids, texts = b.column(1).to_numpy(), b.column(2).cast(pa.large_string())
        for name in dict.fromkeys(names):
            rows = np.array([i for i, x in enumerate(names) if x == name])
            mine = texts.take(pa.array(rows))
            _, off = text_buffer(mine)
            for i, j in blocks(off, max(1, limit // 4)):
                h = held.setdefault(name, [[], [], 0, 0])
                h[0].append(ids[rows[i:j]])
                h[1].append(mine.slice(i, j - i))
                h[2] += int(off[j] - off[i])
                h[3] += j - i
                if h[2] >= limit or h[3] >= BLOCK_DOCS:
                    yield flush(name)
        while sum(h[2] for h in held.values()) > 2 * limit or sum(h[3] for h in held.values()) > 2 * BLOCK_DOCS:
            yield flush(max(held, key=lambda x: (held[x][2], held[x][3])))
    for name in list(held):
        yield flush(name)


def frequent(docs: DataFrame, rows: int, limit: int) -> dict:
    """Of each language the contexts with more than about ``limit`` tokens: hashes, ascending, and
    over how many buckets each is dealt."""
    def run(batches):
        for name, _, texts in by_language(batches, BLOCK_TEXT // 4):
            h, _ = stream(*text_buffer(texts))
            w, index = vocabulary(h)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(w)), pa.array(w.view(np.int64)),
                                              pa.array(np.bincount(index).astype(np.int64))], names=["lang", "w", "c"])
            del texts, h, w, index
        release()

    k = max(1, rows // SAMPLE)
    some = docs.filter(F.pmod(F.xxhash64("_id"), F.lit(k)) == 0).mapInArrow(run, "lang string, w long, c long")
    found = some.groupBy("lang", "w").agg(F.sum("c").alias("c")).filter(F.col("c") * k > limit)
    out: dict = {}
    for r in found.collect():  # no more than tokens / limit
        out.setdefault(r.lang, []).append((r.w % (1 << 64), -(-r.c * k // limit)))
    return {x: (np.array([w for w, _ in sorted(v)], np.uint64), np.array([p for _, p in sorted(v)], np.int64))
            for x, v in out.items()}


def _cell(c, t, own, w) -> bytes:
    """Bigrams, sorted: the contexts, how many next words each has, the distinct next words,
    each bigram's one; then its count, or the texts that hold it, with times."""
    step = np.concatenate([[True], (c[1:] != c[:-1]) | (t[1:] != t[:-1])])
    entry = np.flatnonzero(step)
    ec, et = c[entry], t[entry]
    unit = np.flatnonzero(np.concatenate([[True], ec[1:] != ec[:-1]]))
    next_, which = np.unique(et, return_inverse=True)
    out = [gaps(w[ec[unit]]), small(np.diff(unit, append=len(ec))), gaps(w[next_]), small(which)]
    if own is None:
        return pack(out + [small(np.diff(entry, append=len(c)))], 3)
    ref = np.flatnonzero(step | np.concatenate([[True], own[1:] != own[:-1]]))
    refs = np.diff(np.searchsorted(ref, entry), append=len(ref))
    return pack(out + [small(refs), small(own[ref]), small(np.diff(ref, append=len(c)))], 3)


def cells(docs: DataFrame, n: int, hot: dict, scored: bool, together: int = 1, share: int = 0,
          shares: int = 1) -> DataFrame:
    """(lang, bucket, block, x): each block's bigrams for each bucket of a ``share``, with counts; or, when
    texts are ``scored``, with the texts, and in buckets from ``n`` on the texts' ids and tokens (these in
    the first share, 0 in others).
    ``together`` partitions are read by one task: fuller blocks hold a bigram and a word less often."""
    def run(batches):
        ctx = TaskContext.get()
        for seq, (name, ids, texts) in enumerate(by_language(batches, limit)):
            block = (ctx.partitionId() << 24) | seq
            h, own = stream(*text_buffer(texts))
            del texts
            w, index = vocabulary(h)
            inside = h[:-1] != END
            c, t, own = index[:-1][inside], index[1:][inside], own[1:][inside]
            tokens = np.bincount(own, minlength=len(ids))
            del h, index, inside
            known, many = hot.get(name, NONE)
            parts = np.ones(len(w), dtype=np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, w), len(known) - 1)
                parts = np.where(known[at] == w, many[at], 1)
            bk = deal(w, parts, c, t, n)
            if shares > 1:
                mine = bk % shares == share
                bk, c, t, own = bk[mine], c[mine], t[mine], own[mine]
                tokens = tokens if share == 0 else np.zeros_like(tokens)
                del mine
            if not len(bk):  # a block of few words
                own = own if scored else None
            elif scored:
                bk, c, t, own = in_order(bk, c, t, own)
            else:
                own = None
                bk, c, t = in_order(bk, c, t)
            cuts = np.searchsorted(bk, np.arange(n + 1))
            out = [(n + block % n, pack([ids.view(np.uint64), small(tokens)]))] if scored else []
            for k in np.flatnonzero(np.diff(cuts)).tolist():
                a, z = cuts[k], cuts[k + 1]
                out.append((k, _cell(c[a:z], t[a:z], None if own is None else own[a:z], w)))
            del bk, c, t, own, w
            release()
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(out)), pa.array([k for k, _ in out], pa.int32()),
                 pa.array([block] * len(out), pa.int64()), pa.array([x for _, x in out], pa.binary())],
                names=["lang", "bucket", "block", "x"])
            del ids, tokens, out
        release()

    limit = SCORED_TEXT if scored else BLOCK_TEXT
    if together > 1:
        docs = docs.coalesce(-(-docs.rdd.getNumPartitions() // together))
    return docs.mapInArrow(run, "lang string, bucket int, block long, x binary")


def bigrams(got: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of cells: the distinct contexts and next words, sorted; of each distinct bigram, in order, the places
    of its two among them, and its count."""
    own, ci = vocabulary(np.concatenate([from_gaps(g[0]) for g in got]))
    next_, ti = vocabulary(np.concatenate([from_gaps(g[2]) for g in got]))
    c, t, i, j = [], [], 0, 0
    for g in got:
        c.append(np.repeat(ci[i: i + len(g[0])], g[1]))
        t.append(ti[j: j + len(g[2])][g[3]])
        i, j = i + len(g[0]), j + len(g[2])
    c, t, r = in_order(np.concatenate(c), np.concatenate(t), np.concatenate([g[4] for g in got]))
    entry = np.flatnonzero(np.concatenate([[True], (c[1:] != c[:-1]) | (t[1:] != t[:-1])]))
    return own, next_, c[entry], t[entry], np.add.reduceat(r, entry, dtype=np.int64)


def _table(rows: list[tuple], names: list[str], types: list) -> pa.Table:
    return pa.table({c: pa.array([r[i] for r in rows], t) for i, (c, t) in enumerate(zip(names, types))})


def sums(r: np.ndarray, h: np.ndarray, n: int) -> list[np.ndarray]:
    """Of contexts: tokens after them, and different words seen once, twice and more often."""
    return [np.bincount(h, weights=x, minlength=n).astype(np.int64) for x in (r, r == 1, r == 2, r > 2)]


def merge(requests: DataFrame, hot: dict) -> DataFrame:
    """(kind, lang, bucket, part, x): the model's parts; sums of contexts that are dealt over buckets;
    numbers of bigrams seen once to four times."""
    def run(t: pa.Table) -> pa.Table:
        lang, bucket = t.column("lang")[0].as_py(), t.column("bucket")[0].as_py()
        got = [unpack(x) for x in t.column("x").to_pylist()]
        own, next_, c, which, r = bigrams(got)
        del got
        per = np.bincount(c, minlength=len(own))
        rows = [("model", lang, bucket, -1, pack([gaps(own), small(per), gaps(next_), small(which), small(r)], 3)),
                ("counts", lang, bucket, -1, pack([np.array([(r == i).sum() for i in range(1, 5)], np.int64)]))]
        dealt = np.isin(own, hot.get(lang, NONE)[0])
        if dealt.any():
            s = sums(r, c, len(own))
            rows.append(("hot", lang, bucket, -1, pack([own[dealt]] + [x[dealt] for x in s])))
        del own, next_, c, which, r
        release()
        return _table(rows, ["kind", "lang", "bucket", "part", "x"],
                      [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.binary()])

    return requests.groupBy("lang", "bucket").applyInArrow(
        run, "kind string, lang string, bucket int, part int, x binary")


def word_requests(model: DataFrame, m: int) -> DataFrame:
    """(lang, bucket, part, x): the next words of the model's part ``part``, with their numbers of contexts
    there, for word bucket ``bucket``."""
    def run(batches):
        for b in batches:
            for lang, part, x in zip(*(b.column(c).to_pylist() for c in range(3))):
                _, _, next_, which, _ = unpack(x)
                next_, before = from_gaps(next_), np.bincount(which, minlength=len(next_))
                rows = [(lang, k, part, pack([gaps(next_[mine]), small(before[mine])]))
                        for k, mine in by_bucket(word_bucket(next_, m), m)]
                yield from _table(rows, ["lang", "bucket", "part", "x"],
                                  [pa.string(), pa.int32(), pa.int32(), pa.binary()]).to_batches()
        release()

    return model.select("lang", "bucket", "x").mapInArrow(run, "lang string, bucket int, part int, x binary")


def word_answers(asked: DataFrame) -> DataFrame:
    """(lang, bucket, part, x): N(w) of the words that context bucket ``bucket`` asked word bucket ``part`` for;
    and without a bucket how many words have N(w) of one to four, their sum and their number."""
    def run(t: pa.Table) -> pa.Table:
        lang, part = t.column("lang")[0].as_py(), t.column("bucket")[0].as_py()
        got = [unpack(x) for x in t.column("x").to_pylist()]
        all_, at = vocabulary(np.concatenate([from_gaps(g[0]) for g in got]))
        n = np.bincount(at, weights=np.concatenate([g[1].astype(np.float64) for g in got])).astype(np.int64)
        stat = [(n == i).sum() for i in range(1, 5)] + [n.sum(), len(n)]
        rows, done = [(lang, None, part, pack([np.array(stat, np.int64)]))], 0
        for bucket, g in zip(t.column("part").to_pylist(), got):
            rows.append((lang, bucket, part, pack([small(n[at[done: done + len(g[0])]])])))
            done += len(g[0])
        release()
        return _table(rows, ["lang", "bucket", "part", "x"], [pa.string(), pa.int32(), pa.int32(), pa.binary()])

    return asked.groupBy("lang", "bucket").applyInArrow(run, "lang string, bucket int, part int, x binary")


def discounts(n) -> np.ndarray:
    """What is taken off counts of 0, 1, 2 and more, from the numbers of n-grams seen once to four times;
    half the count where the estimate is undefined."""
    n = [float(x) for x in n[:4]]
    d = [0.0]
    y = n[0] / (n[0] + 2 * n[1]) if n[0] + 2 * n[1] else None
    for i in (1, 2, 3):
        x = i - (i + 1) * y * n[i] / n[i - 1] if y is not None and n[i - 1] else None
        d.append(0.5 * i if x is None else min(float(i), max(0.1 * i, x)))
    return np.array(d)


def lookup(requests: DataFrame, model: DataFrame, n: int, m: int, stats: dict) -> DataFrame:
    """(block, ids, x): per block the texts' bits from each bucket, and the rows with their ids."""
    names, types = ["block", "ids", "x"], [pa.int64(), pa.bool_(), pa.binary()]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        blocks_, xs = left.column("block").to_pylist(), left.column("x").to_pylist()
        if not blocks_ or left.column("bucket")[0].as_py() >= n:
            return _table([(b, True, x) for b, x in zip(blocks_, xs)], names, types)
        s = stats[left.column("lang")[0].as_py()]
        parts = dict(zip(right.column("part").to_pylist(), right.column("x").to_pylist()))
        part = unpack(parts.pop(-1))
        next_, r = from_gaps(part[2]), part[4].astype(np.int64)
        before = np.zeros(len(next_), dtype=np.int64)
        for k, mine in by_bucket(word_bucket(next_, m), m):
            before[mine] = unpack(parts[k])[0]
        d1, d2 = s["d1"], s["d2"]
        low = (before - d1[np.minimum(before, 3)]) / s["n"] + s["back"] / s["words"]
        own, h = from_gaps(part[0]), np.repeat(np.arange(len(part[0])), part[1])
        total = sums(r, h, len(own))
        known, *whole = s["hot"]
        if len(known):  # dealt over buckets: their sums are of all of them
            at = np.minimum(np.searchsorted(known, own), len(known) - 1)
            total = [np.where(known[at] == own, x[at], y) for x, y in zip(whole, total)]
        back = sum(d2[i] * total[i] for i in (1, 2, 3)) / total[0]
        bits = -np.log2((r - d2[np.minimum(r, 3)]) / total[0][h] + back[h] * low[part[3]])
        key = h * len(next_) + part[3]  # ascending: the model is sorted by context and next word, as are cells
        del h, low, before, r, part
        rows = []
        for block, x in zip(blocks_, xs):
            g = unpack(x)
            c, t = np.searchsorted(own, from_gaps(g[0])), np.searchsorted(next_, from_gaps(g[2]))
            value = np.repeat(bits[np.searchsorted(key, np.repeat(c, g[1]) * len(next_) + t[g[3]])], g[4])
            doc = np.bincount(g[5], weights=value * g[6])
            there = np.unique(g[5])
            rows.append((block, False, pack([gaps(there), small(np.rint(doc[there] * UNITS).astype(np.int64))])))
        release()
        return _table(rows, names, types)

    return requests.groupBy("lang", "bucket").cogroup(model.groupBy("lang", "bucket")).applyInArrow(
        run, "block long, ids boolean, x binary")


def per_text(rows: DataFrame) -> DataFrame:
    def run(t: pa.Table) -> pa.Table:
        ids = tokens = None
        got = []
        for named, x in zip(t.column("ids").to_pylist(), t.column("x").to_pylist()):
            if named:
                ids, tokens = unpack(x)
            else:
                got.append(unpack(x))
        bits = np.zeros(len(ids))
        for there, value in got:
            bits[from_gaps(there).astype(np.int64)] += value / UNITS
        del got
        release()
        return pa.table({"_id": pa.array(ids.view(np.int64)), "word_bits": pa.array(bits),
                         "word_tokens": pa.array(tokens.astype(np.int64))})

    return rows.groupBy("block").applyInArrow(run, "_id long, word_bits double, word_tokens long")


def text_id(text, lang):
    """Of a text and its language, null languages being one: equal ones are scored alike."""
    return F.xxhash64(F.coalesce(text, F.lit("")), language(lang))


def language(lang):
    return F.coalesce(F.concat(F.lit("="), lang.cast("string")), F.lit(""))


def written(df: DataFrame, name: str) -> DataFrame:
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return materialize(df, name)
    finally:
        conf.set(CLEANUP, before) if before is not None else conf.unset(CLEANUP)


def word_bits(docs: DataFrame, text: str = "text", lang: str = "lang", bucket_text: int = BUCKET_TEXT,
              context_tokens: int = CONTEXT_TOKENS, shards: int | None = None, shares: int | None = None) -> DataFrame:
    """(_id, bits_per_word, n_tokens): one row per different text of a language (see ``text_id``)."""
    text, lang = F.col(f"`{text}`"), F.col(f"`{lang}`")
    docs = docs.select(language(lang).alias("lang"), text_id(text, lang).alias("_id"), text.alias("_text"))
    size, rows = docs.agg(F.sum(F.octet_length("_text")), F.count(F.lit(1))).first()
    n = max(1, -(-(size or 0) // bucket_text))
    m = max(1, n // 16)
    shards = shards or (SHARDS if n >= LARGE else 1)
    shares = shares or (SHARES if n >= LARGE else 1)
    hot = frequent(docs, rows, context_tokens)
    made = None
    for i in range(shares):
        x = cells(docs, n, hot, False, TOGETHER if n >= LARGE else 1, i, shares)
        x = written(merge(x, hot), "kneser-words-model")
        made = x if made is None else made.unionByName(x)
    answers = written(word_answers(word_requests(made.filter("kind = 'model'"), m)), "kneser-words-answers")
    stats: dict = {}
    none = {"counts": np.zeros(4, np.int64), "words": np.zeros(6, np.int64), "hot": {}}
    for r in answers.filter("bucket is null").toLocalIterator():  # six numbers a bucket
        s = stats.setdefault(r.lang, {k: v.copy() for k, v in none.items()})
        s["words"] += unpack(r.x)[0]
    for r in made.filter("kind = 'counts' or kind = 'hot'").toLocalIterator():  # few numbers a bucket
        s = stats[r.lang]
        if r.kind == "counts":
            s["counts"] += unpack(r.x)[0]
        else:
            v, *x = unpack(r.x)
            for w, row in zip(v.tolist(), np.array(x).T):
                s["hot"][w] = s["hot"].get(w, 0) + row
    for s in stats.values():
        d1, w = discounts(s["words"]), s["words"]
        rare = [w[0], w[1], w[5] - w[0] - w[1]]
        v = sorted(s["hot"])
        s.update(d1=d1, d2=discounts(s["counts"]), n=float(w[4]), words=float(w[5]),
                 back=float(sum(x * y for x, y in zip(d1[1:], rare)) / max(1, w[4])),
                 hot=[np.array(v, np.uint64)] + [np.array([s["hot"][x][i] for x in v], np.int64) for i in range(4)])
    model = made.filter("kind = 'model'").select("lang", "bucket", "part", "x").unionByName(
        answers.filter("bucket is not null"))
    out = None
    for i in range(shards):
        mine = docs.filter(F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(shards)) == i) if shards > 1 else docs
        for j in range(shares):
            part = model.filter(F.pmod("bucket", F.lit(shares)) == j)
            x = lookup(cells(mine, n, hot, True, shards, j, shares), part, n, m, stats)
            x = written(per_text(x), "kneser-words-bits")
            out = x if out is None else out.unionByName(x)
    return out.groupBy("_id").agg((F.sum("word_bits") / F.sum("word_tokens")).alias("bits_per_word"),
                                  F.max("word_tokens").alias("n_tokens"))
