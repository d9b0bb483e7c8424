"""Quality rules: simple counts, and perplexity under modified Kneser-Ney, over words and over characters.

The word model (bigrams of every word of every text, see ``kneser``) judges which words
stand together; it stays in partitions and is looked up there.

The second model is over characters (byte classes: A-Z lower-cased, digits, blanks,
punctuation and the bytes of other letters, ``CLASSES`` in all), of order
``ORDER``, one per language.  Spark counts the n-grams of every whole text; the
lower orders' continuation counts, the discounts by count of counts and the
interpolation are grouped aggregations and joins over the n-gram table.  The
result are sorted arrays of n-gram keys with their log-probabilities; a key is
the n-gram's classes, six bits each, a hash without collisions.

An order-4 model has 2^24 keys per language at most, whatever the corpus: that
bounds what is broadcast.  Languages whose models together pass ``MODEL_ROWS``
are scored in several passes, each over the documents of its languages only.

Bands: per language and model, a document is rejected if its log-perplexity lies further
than ``LOWER_WIDTH`` or ``UPPER_WIDTH`` (words: ``LOWER_WORDS`` or ``UPPER_WORDS``)
spreads (quartile distances) from the median, spreads growing
for short texts, whose average varies more.

Null and empty texts have no words and fail the base rule; a null language is
a language of its own.  One row per row; repeated rows are judged alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnlab.llm.katz import release
from txnlab.llm.kneser import text_id, word_bits, written
from txnlab.llm.textops import AT_ONCE, BASE, WORD, blocks, mix, running, slice_hash, text_buffer, window_hash, words
from txnlab.session import materialize

ORDER = 4
CLASSES = 64
MODEL_ROWS = 8_000_000
LOWER_WIDTH, UPPER_WIDTH = 6.0, 6.0  # set from good and low-quality labels: README
SHORT = 200  # a text of so many characters has its band widened by the root of 2
LOWER_WORDS, UPPER_WORDS = 6.0, 6.0  # as above, for the word model
SHORT_WORDS = 35
DIRECT = 1 << 16  # so many n-grams at once are looked up by their contexts, fewer by binary search

MIN_WORDS = 10
REPEAT_WINDOW = 5
SYMBOLS = b"#*$%&|<>"


def _classes() -> np.ndarray:
    """Byte to class; 0 is the edge of a text."""
    c = np.zeros(256, dtype=np.uint8)
    c[:33] = 1                                   # blanks and controls
    c[48:58] = 2                                 # digits
    c[65:91] = c[97:123] = np.arange(3, 29)      # letters
    rest = [b for b in range(33, 128) if not c[b]]
    c[rest] = 29 + np.arange(len(rest)) % 12     # punctuation
    c[128:] = 41 + np.arange(128) % 23           # bytes of other characters
    return c


CLASS = _classes()
# per byte: the first of a character in a word, and, counted in the upper half, a symbol
_COUNTED = WORD & ((np.arange(256) & 0xC0) != 0x80) | (np.isin(np.arange(256), list(SYMBOLS)).astype(np.int64) << 32)


def grams(data: np.ndarray, off: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all n-grams of texts, each with order-1 edges before and one
    after it, and the offsets of each text's keys."""
    n, pad = len(off) - 1, order - 1
    edge = off + pad * np.arange(n + 1)  # where the edges before each text begin, and those after the last one
    inside = np.ones(len(data) + pad * (n + 1), dtype=bool)
    for i in range(pad):
        inside[edge + i] = False
    stream = np.zeros(len(inside), dtype=np.uint8)
    stream[inside] = CLASS[data]
    key = stream[: len(stream) - pad].astype(np.int32)
    for i in range(1, order):
        key <<= 6
        key |= stream[i: len(stream) - pad + i]
    whole = np.ones(len(key), dtype=bool)
    for i in range(1, pad):
        whole[edge[1:] - pad + i] = False  # begins in one text's end, and goes on
    return key[whole], off + np.arange(n + 1)


# ------------------------------------------------------------------- counts
def count_grams(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, g, c): how often each n-gram stands in the texts of a language."""
    def run(batches):
        held: dict = {}

        def flush(name):
            k = np.concatenate([x[0] for x in held[name]])
            c = np.concatenate([x[1] for x in held[name]])
            u, at = np.unique(k, return_inverse=True)
            held[name] = [(u, np.bincount(at, weights=c).astype(np.int64))]

        for b in batches:
            release()  # what the batch before took
            names = b.column(1).to_pylist()
            for name in dict.fromkeys(names):
                rows = pa.array([i for i, x in enumerate(names) if x == name], pa.int64())
                data, off = text_buffer(b.column(0).take(rows))
                for i, j in blocks(off):
                    key, _ = grams(data[off[i]: off[j]], off[i: j + 1] - off[i])
                    held.setdefault(name, []).append(np.unique(key, return_counts=True))
                    if len(held[name]) > 8:
                        flush(name)
        for name in held:
            flush(name)
            k, c = held[name][0]
            for i in range(0, len(k), 1 << 16):
                n = len(k[i: i + (1 << 16)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * n, pa.string()), pa.array(k[i: i + n]), pa.array(c[i: i + n])],
                    names=["lang", "g", "c"])
        held.clear()
        release()

    rows = docs.select(F.col(f"`{text}`"), F.col(f"`{lang}`").cast("string").alias("lang"))
    return rows.mapInArrow(run, "lang string, g int, c long").groupBy("lang", "g").agg(F.sum("c").alias("c"))


def kneser_ney(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, n, g, p): interpolated probability of every n-gram that was seen,
    and as ``back`` the weight its longer contexts give to shorter ones: rows
    (lang, n, g) with p null are contexts of order n."""
    by_order = {order: counts}
    for n in range(order - 1, 0, -1):  # continuation counts: distinct symbols before
        longer = by_order[n + 1]
        rest = F.col("g").bitwiseAND(F.lit((1 << 6 * n) - 1)).alias("g")
        by_order[n] = longer.groupBy("lang", rest).agg(F.count(F.lit(1)).alias("c"))
    below, out = None, None
    for n in range(1, order + 1):
        t = by_order[n]
        k = t.groupBy("lang").agg(*[F.sum((F.col("c") == i).cast("long")).cast("double").alias(f"n{i}")
                                    for i in range(1, 5)])
        y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))
        d = []
        for i in (1, 2, 3):  # kept within the count; half of it where the estimate is undefined
            x = i - (i + 1) * y * F.try_divide(F.col(f"n{i + 1}"), F.col(f"n{i}"))
            d.append(F.when(x.isNull(), 0.5 * i).otherwise(F.least(F.lit(float(i)), F.greatest(F.lit(0.1 * i), x))))
        k = k.select(F.col("lang").alias("_l"), *[x.alias(f"d{i + 1}") for i, x in enumerate(d)])
        taken = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        t = t.join(k, F.col("lang").eqNullSafe(F.col("_l"))).select("lang", "g", "c", taken.alias("d"))
        t = t.withColumn("h", F.shiftright("g", 6))
        over = Window.partitionBy("lang", "h")
        t = t.withColumn("all", F.sum("c").over(over)).withColumn("back", F.sum("d").over(over) / F.col("all"))
        if n == 1:
            t = t.withColumn("low", F.lit(1.0 / CLASSES))
        else:
            s = below.select(F.col("lang").alias("_l"), F.col("g").alias("_s"), F.col("p").alias("low"))
            suffix = F.col("g").bitwiseAND(F.lit((1 << 6 * (n - 1)) - 1))
            t = t.join(s, F.col("lang").eqNullSafe(F.col("_l")) & (suffix == F.col("_s")))
        t = t.withColumn("p", (F.col("c") - F.col("d")) / F.col("all") + F.col("back") * F.col("low"))
        below = materialize(t.select("lang", "g", "h", "p", "back"), f"kneser-ney-{n}")
        seen = below.select("lang", F.lit(n).alias("n"), "g", "p")
        ctx = below.groupBy("lang", "h").agg(F.max("back").alias("p")).select(
            "lang", F.lit(-n).alias("n"), F.col("h").alias("g"), "p")
        out = seen.unionByName(ctx) if out is None else out.unionByName(seen).unionByName(ctx)
    return out


class Model:
    """One language's sorted arrays: order n -> keys and log-probabilities;
    order -n -> contexts and back-off weights (logs to base 2)."""

    def __init__(self, n: np.ndarray, g: np.ndarray, p: np.ndarray):
        self.table = {}
        for k in np.unique(n).tolist():
            key, val = g[n == k], np.log2(p[n == k])
            at = np.argsort(key)
            self.table[k] = (key[at], val[at].astype(np.float32))

    def _find(self, n: int, key: np.ndarray):
        keys, values = self.table.get(n, (np.zeros(0, np.int32), np.zeros(0, np.float32)))
        if not len(keys):
            return np.zeros(len(key), bool), np.zeros(len(key), np.float32)
        if len(key) < DIRECT or n > ORDER or n < 1:
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            return keys[at] == key, values[at]
        # many keys: per context, a bit for each symbol seen after it and where its keys begin.
        # Made for each call, as a model of few keys would not be small with it
        own, one = keys >> 6, np.uint64(1)
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        bits, start = np.zeros(1 << 6 * (n - 1), np.uint64), np.zeros(1 << 6 * (n - 1), np.int32)
        bits[own[first]] = np.bitwise_or.reduceat(one << (keys & 63).astype(np.uint64), first)
        start[own[first]] = first
        found, out = np.empty(len(key), bool), np.empty(len(key), np.float32)
        for i in range(0, len(key), AT_ONCE):
            some = key[i: i + AT_ONCE]
            h = some >> 6
            mine, bit = bits[h], one << (some & 63).astype(np.uint64)
            at = start[h] + np.bitwise_count(mine & (bit - one))
            found[i: i + AT_ONCE] = (mine & bit) != 0
            out[i: i + AT_ONCE] = values[np.minimum(at, len(keys) - 1)]
        return found, out

    def log2(self, key: np.ndarray, n: int = ORDER) -> np.ndarray:
        """Recursive: the n-gram's own value, else back-off weight and the shorter one's."""
        if n == 0:
            return np.full(len(key), -6.0, dtype=np.float32)
        found, out = self._find(n, key)
        miss = np.flatnonzero(~found)
        if len(miss):
            known, back = self._find(-n, key[miss] >> 6)
            low = self.log2(key[miss] & ((1 << 6 * (n - 1)) - 1), n - 1)
            out = out.copy()
            out[miss] = np.where(known, back, 0) + low
        return out


# --------------------------------------------------------------- base counts
def base_counts(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """Per text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    n = len(off) - 1
    s, e, w = words(data, off)
    p = running(data)
    sums = lambda x: np.concatenate([[0], np.cumsum(x)])
    counted = np.diff(sums(_COUNTED[data])[off])
    # lines: cut at \n and at the edges of texts
    cut = np.flatnonzero(data == 0x0A)
    a = np.sort(np.concatenate([off[:-1], cut + 1]), kind="stable")
    z = np.sort(np.concatenate([off[1:], cut]), kind="stable")
    doc = np.searchsorted(off, a, side="right") - 1
    empty = z <= a
    a, z = a[~empty], z[~empty]
    has = np.searchsorted(s, z) > np.searchsorted(s, a)
    a, z = a[has], z[has]
    doc = np.searchsorted(off, a, side="right") - 1
    line = mix(slice_hash(p, a, z) + doc.astype(np.uint64) * np.uint64(BASE))
    _, first = np.unique(line, return_index=True)
    lines = np.bincount(doc, minlength=n) - np.bincount(doc[first], minlength=n)
    # words in windows that stand more than once in their text
    cover = np.zeros(len(s) + 1, dtype=np.int64)
    g = window_hash(slice_hash(p, s, e), REPEAT_WINDOW)
    if len(g):
        own = np.repeat(np.arange(n), np.diff(w))[: len(g)]
        at = np.flatnonzero(np.arange(REPEAT_WINDOW, REPEAT_WINDOW + len(g)) <= w[own + 1])
        key = mix(g[at] + own[at].astype(np.uint64) * np.uint64(BASE))
        order = np.argsort(key)
        sk = key[order]
        same = sk[1:] == sk[:-1]
        twice = np.zeros(len(sk), dtype=bool)
        twice[1:] |= same
        twice[:-1] |= same
        hit = at[order[twice]]
        np.add.at(cover, hit, 1)
        np.add.at(cover, np.minimum(hit + REPEAT_WINDOW, len(s)), -1)
    repeated = sums(np.cumsum(cover)[:-1] > 0)
    return {"n_words": np.diff(w), "word_chars": counted & 0xFFFFFFFF, "n_symbols": counted >> 32,
            "n_dup_lines": lines, "n_repeat_words": np.diff(repeated[w])}


BASE_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _score(docs: DataFrame, key: str, text: str, models: dict) -> DataFrame:
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(models)
    schema = docs.select(F.col(f"`{key}`").alias("_key"), F.col("lang"), F.col("_id")).schema
    for c in BASE_COLUMNS + ["n_keys"]:
        schema = schema.add(c, "long")
    schema = schema.add("bits", "double")

    def run(batches):
        for b in batches:
            names = b.column(1).to_pylist()
            for name in dict.fromkeys(names):
                rows = pa.array([i for i, x in enumerate(names) if x == name], pa.int64())
                data, off = text_buffer(b.column(3).take(rows))
                model = sent.value.get(name)
                for i, j in blocks(off):
                    d, o = data[off[i]: off[j]], off[i: j + 1] - off[i]
                    few = [base_counts(d[o[u]: o[v]], o[u: v + 1] - o[u]) for u, v in blocks(o, AT_ONCE)]
                    base = {c: np.concatenate([x[c] for x in few]) for c in BASE_COLUMNS}
                    k, at = grams(d, o)
                    value = model.log2(k) if model is not None else np.full(len(k), -6.0, np.float32)
                    total = np.concatenate([[0.0], np.cumsum(value, dtype=np.float64)])
                    part = rows.slice(i, j - i)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(c).take(part) for c in range(3)]
                        + [pa.array(base[c].astype(np.int64)) for c in BASE_COLUMNS]
                        + [pa.array(np.diff(at)), pa.array(-np.diff(total[at]))], names=schema.names)
                    del d, o, few, base, k, at, value, total
                del rows, data, off
            del b
            release()

    return docs.select(F.col(f"`{key}`").alias("_key"), "lang", "_id",
                       F.col(f"`{text}`").alias("_text")).mapInArrow(run, schema)


def _passes(size: dict, limit: int) -> list[list]:
    """Languages in groups whose model rows stay within ``limit`` (one may pass it alone)."""
    out, held = [], 0
    for name, n in sorted(size.items(), key=lambda x: (-x[1], str(x[0]))):
        if not out or held + n > limit:
            out.append([])
            held = 0
        out[-1].append(name)
        held += n
    return out


def _band(scored: DataFrame, value: str, size: str, short: int, lower: float, upper: float,
          names: tuple[str, str]) -> DataFrame:
    """Adds the bounds of ``value`` by language, from the texts with enough words."""
    q = F.percentile_approx(value, [0.25, 0.5, 0.75], 10_000)
    band = scored.filter(F.col("n_words") >= MIN_WORDS).groupBy("lang").agg(q.alias("q"))
    band = band.select(F.col("lang").alias("_l"), F.col("q")[1].alias("middle"),
                       F.greatest(F.col("q")[1] - F.col("q")[0], F.lit(1e-3)).alias("down"),
                       F.greatest(F.col("q")[2] - F.col("q")[1], F.lit(1e-3)).alias("up"))
    wide = F.sqrt(1 + F.lit(float(short)) / F.col(size))
    out = scored.join(band, F.col("lang").eqNullSafe(F.col("_l")), "left")
    out = out.withColumn(names[0], F.col("middle") - lower * wide * F.col("down"))
    return out.withColumn(names[1], F.col("middle") + upper * wide * F.col("up")).drop("_l", "middle", "down", "up")


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
          model_rows: int = MODEL_ROWS) -> DataFrame:
    """One row per document: key, the base counts, base_failed, bits_per_char
    (log2 of the perplexity) and the band's bounds, the same of the words, and kept."""
    counts = written(count_grams(docs, text, lang), "kneser-ney-counts")
    table = materialize(kneser_ney(counts), "kneser-ney-model")
    size = {r[0]: r[1] for r in table.groupBy("lang").count().collect()}
    named = docs.select(F.col(f"`{key}`"), F.col(f"`{text}`"), F.col(f"`{lang}`").cast("string").alias("lang"),
                        text_id(F.col(f"`{text}`"), F.col(f"`{lang}`")).alias("_id"))
    scored = None
    for names in _passes(size, model_rows):
        mine = None
        for x in names:
            eq = F.col("lang").eqNullSafe(F.lit(x))
            mine = eq if mine is None else mine | eq
        models = {}
        for x in names:  # bounded: see MODEL_ROWS
            t = table.filter(F.col("lang").eqNullSafe(F.lit(x))).select("n", "g", "p").toArrow()
            models[x] = Model(*[t.column(c).to_numpy() for c in ("n", "g", "p")])
        part = _score(named.filter(mine), key, text, models)
        scored = part if scored is None else scored.unionByName(part)
    if scored is None:
        scored = _score(named, key, text, {})
    scored = materialize(scored.withColumn("bits_per_char", F.col("bits") / F.col("n_keys")), "kneser-ney-scores")
    found = word_bits(named, text, "lang")
    scored = materialize(scored.join(found, "_id", "left"), "kneser-ney-bits")
    out = _band(scored, "bits_per_char", "n_keys", SHORT, LOWER_WIDTH, UPPER_WIDTH, ("lower", "upper"))
    out = _band(out, "bits_per_word", "n_tokens", SHORT_WORDS, LOWER_WORDS, UPPER_WORDS, ("lower_word", "upper_word"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    inside = (F.col("bits_per_char").between(F.col("lower"), F.col("upper"))
              & F.col("bits_per_word").between(F.col("lower_word"), F.col("upper_word")))
    return out.select(F.col("_key").alias(key), *BASE_COLUMNS, failed.alias("base_failed"),
                      (~failed & F.coalesce(inside, F.lit(False))).alias("kept"), "bits_per_char", "lower", "upper",
                      "bits_per_word", "lower_word", "upper_word")
