"""Katz backoff bigram model, trained and evaluated over the whole corpus.

Tokens are lower-cased words and one end per text.  With ``min_count`` 1 every
training word keeps its own counts: the unigram level leaves unseen words the
Good-Turing mass N1 / (N + 1), shared equally by the distinct words of the corpus
that training lacks, and gives the rest to the training words by frequency.
With ``min_count`` 2 (a closed vocabulary) words seen once in training stand for
all unknown ones as one word, which has their relative frequency.  Bigrams seen r <= ``DISCOUNTED`` times are discounted by Good and
Turing; what a context thereby has left goes to the words not seen after it, in
proportion to their unigram probability and exactly normalised:
alpha(h) = (1 - sum of discounted P(w|h)) / (1 - sum of unigram P(w)), both over
the words seen after h.  Every context counts one token more than it has, so
that one whose words are all too frequent for a discount has something left too.

Nothing that grows with the corpus is broadcast or gathered in one place:

1. ``blocks``: documents in blocks of about ``BLOCK_TEXT`` bytes, packed.
2. Words: each block sends its distinct words and training counts to word
   buckets; a bucket adds them up, numbers them and answers each block in the same
   order.  A word's id is its place among the bucket's sorted words, times the
   number of buckets, plus the bucket: dense, so that ids in order are small gaps.
3. Bigrams: each block sends, to context buckets, its distinct bigrams with
   training counts and the documents that hold them.  A bucket merges them into
   its part of the model table (contexts with their totals; words with counts)
   and returns per document the sum of log r and how many tokens have r = 1, 2,
   ... (their discounts are known only when all buckets are counted), and for
   unseen bigrams the context's sums that alpha needs.
4. Counts of counts give the discounts, and the parts are added per document.

Identical words and bigrams of a block are one entry, so frequent ones cost a
bucket one entry per block.  A context that holds more than a share of a bucket
is dealt by its next word over as many buckets as its size asks for; its alpha
is put together from their sums.

Words are told apart by 64-bit hashes, from the answers on by their ids.  A block's
rows for a bucket, and a bucket's part of the model, hold each next word once and
say by its place which one a bigram has.
Null texts are empty (one token, the end); a null key is in training; repeated
rows are texts of their own.  An empty table gives an empty result; without
training texts every token is unknown.
"""

from __future__ import annotations

import ctypes
import math
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlab.llm.textops import BASE, LOWER, blocks, mix, text_buffer, word_hashes, words
from txnlab.session import materialize, shared_dir

BLOCK_TEXT = 12 << 20
BUCKET_TEXT = 12 << 20
BUCKET_TOKENS = 3 << 19  # about what a bucket holds
DISCOUNTED = 5
FOLDS, HELD = 5, 1

END = np.uint64(0x1111111111111111)  # as a word's hash
END_ID, START_ID, UNKNOWN_ID, FIRST_ID = (np.uint64(x) for x in range(4))


# ----------------------------------------------------------------- packing
def pack(arrays: list[np.ndarray], level: int = 1) -> bytes:
    """Arrays as bytes, one plane per byte of a value (high bytes repeat), each
    array compressed where that helps."""
    z, out = zstandard.ZstdCompressor(level=level), []
    for a in arrays:
        a = np.ascontiguousarray(a)
        raw = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T).tobytes()
        close = z.compress(raw) if len(raw) > 64 else raw
        use = len(close) < len(raw)
        body = close if use else raw
        out.append(struct.pack("<4s?QQ", a.dtype.str.encode(), use, len(body), len(a)) + body)
    return b"".join(out)


def unpack(data: bytes) -> list[np.ndarray]:
    z, out, at, head = zstandard.ZstdDecompressor(), [], 0, struct.calcsize("<4s?QQ")
    while at < len(data):
        kind, used, size, n = struct.unpack_from("<4s?QQ", data, at)
        body = data[at + head: at + head + size]
        dtype = np.dtype(kind.rstrip(b"\0").decode())
        raw = z.decompress(body, max_output_size=n * dtype.itemsize) if used else body
        planes = np.frombuffer(raw, dtype=np.uint8).reshape(dtype.itemsize, n) if n else np.zeros((dtype.itemsize, 0), np.uint8)
        out.append(np.frombuffer(np.ascontiguousarray(planes.T).tobytes(), dtype=dtype))
        at += head + size
    return out


# log sums and unigram masses are stored as whole numbers of these, a few bytes each:
# a long text's score is off by about 1e-6 for the root of its number of buckets
LOG_UNITS = 1e6
MASS_UNITS = float((1 << 32) - 1)


def gaps(x: np.ndarray) -> np.ndarray:
    """Ascending numbers as their differences."""
    return small(np.diff(x.astype(np.uint64), prepend=np.uint64(0)))


def from_gaps(x: np.ndarray) -> np.ndarray:
    return np.cumsum(x, dtype=np.uint64)


def small(x: np.ndarray) -> np.ndarray:
    """The array in the narrowest unsigned type that holds it."""
    most = int(x.max()) if len(x) else 0
    return x.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32 if most < 1 << 32 else np.uint64)


# ------------------------------------------------------------------- blocks
def make_blocks(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(block, keys, held, sizes, z): documents packed, in blocks of their own ids."""
    kind = docs.schema[key].dataType.simpleString()
    fold = F.crc32(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).cast("binary")) % FOLDS
    rows = docs.select(F.col(f"`{key}`").alias("_key"), (fold == HELD).alias("held"), F.col(f"`{text}`").alias("_text"))

    def run(batches):
        ctx, seq = TaskContext.get(), 0
        z = zstandard.ZstdCompressor(level=9)
        held, keys, texts, size = [], [], [], 0

        def flush():
            sizes = np.concatenate([s for _, s in texts])
            raw = b"".join(t for t, _ in texts)
            block = (ctx.partitionId() << 24) | seq
            keep = pa.chunked_array(keys).combine_chunks()
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(keep)], pa.int32()), keep),
                 pa.array([pack([np.concatenate(held)])], pa.binary()), pa.array([pack([sizes])], pa.binary()),
                 pa.array([z.compress(raw)], pa.binary())], names=["block", "keys", "held", "sizes", "z"])

        for b in batches:
            data, off = text_buffer(b.column(2))
            flags = b.column(1).to_numpy(zero_copy_only=False).astype(np.uint8)
            for i, j in blocks(off, BLOCK_TEXT // 4):
                for i2 in range(i, j, 16384):
                    j2 = min(j, i2 + 16384)
                    keys.append(b.column(0).slice(i2, j2 - i2))
                    held.append(flags[i2:j2])
                    texts.append((data[off[i2]: off[j2]].tobytes(), np.diff(off[i2: j2 + 1])))
                    size += int(off[j2] - off[i2])
                    if size >= BLOCK_TEXT or sum(map(len, held)) > 32768:
                        yield flush()
                        held, keys, texts, size, seq = [], [], [], 0, seq + 1
        if keys:
            yield flush()
        del held, keys, texts
        release()

    return rows.mapInArrow(run, f"block long, keys array<{kind}>, held binary, sizes binary, z binary")


def tokens(held: bytes, sizes: bytes, z: bytes):
    """Of a block: held flags, word hashes of all documents and their offsets."""
    held, sizes = unpack(held)[0].astype(bool), unpack(sizes)[0]
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(z, max_output_size=max(1, int(sizes.sum()))), np.uint8)
    off = np.concatenate([[0], np.cumsum(sizes)])
    parts, at = [], [np.zeros(1, np.int64)]
    for i, j in blocks(off):
        low = LOWER[raw[off[i]: off[j]]]
        s, e, w = words(low, off[i: j + 1] - off[i])
        parts.append(word_hashes(low, s, e))
        at.append(w[1:] + at[-1][-1])
    return held, np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.concatenate(at)


def vocabulary(h: np.ndarray):
    """Sorted distinct hashes and each token's index among them."""
    # sorted with the places in the low bits, which is faster than an argsort; where hashes are too
    # wide for that, they give up these bits, and the argsort is made if any come out of order by it
    bits = len(h).bit_length()
    low, fits = np.uint64((1 << bits) - 1), len(h) and int(h.max()).bit_length() + bits <= 64
    one = h << np.uint64(bits) if fits else h & ~low
    one |= np.arange(len(h), dtype=np.uint64)
    one.sort()
    one &= low
    order = one.view(np.int64)
    s = h[order]
    if (s[1:] < s[:-1]).any():
        order = np.argsort(h)
        s = h[order]
    new = np.concatenate([[True], s[1:] != s[:-1]]) if len(s) else np.zeros(0, bool)
    index = np.empty(len(h), dtype=np.int32)
    index[order] = np.cumsum(new, dtype=np.int32) - 1
    return s[new], index


def by_bucket(bucket: np.ndarray, n: int):
    """(k, places of bucket k in order) of each bucket that has any: sorted once,
    whatever their number."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(n + 1))
    for k in np.flatnonzero(np.diff(cuts)):
        yield int(k), order[cuts[k]: cuts[k + 1]]


def release() -> None:
    """Give freed memory back: workers are used again, also by other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def word_bucket(w: np.ndarray, n: int) -> np.ndarray:
    return (mix(w ^ np.uint64(0xABCDEF)) % np.uint64(n)).astype(np.int64)


# -------------------------------------------------------------------- words
def word_requests(packed: DataFrame, n: int) -> DataFrame:
    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                held, h, at = tokens(*[b.column(c)[r].as_py() for c in (1, 2, 3)])
                w, index = vocabulary(h)
                train = np.repeat(~held, np.diff(at))
                c = np.bincount(index[train], minlength=len(w))
                w = np.concatenate([w, [END]])  # the end's count last: it needs no order
                c = np.concatenate([c, [int((~held).sum())]])
                del h, index, train
                for k, mine in by_bucket(word_bucket(w, n), n):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k], pa.int32()), b.column(0).slice(r, 1),
                         pa.array([pack([w[mine], small(c[mine])])], pa.binary())], names=["bucket", "block", "x"])
        release()

    return packed.select("block", "held", "sizes", "z").mapInArrow(run, "bucket int, block long, x binary")


def word_answers(requests: DataFrame) -> DataFrame:
    """(block, bucket, x): the training counts of the words each block asked for and
    their places (as differences; the end may be out of order, so they wrap around);
    per bucket a row without a block: tokens, words, words seen once, texts, words
    unseen; and as block -1 the bucket's sorted hashes, by which ids are read."""
    def run(t: pa.Table) -> pa.Table:
        asked = [unpack(x) for x in t.column("x").to_pylist()]
        w = np.concatenate([a[0] for a in asked])
        all_, index = vocabulary(w)
        total = np.bincount(index, weights=np.concatenate([a[1].astype(np.float64) for a in asked])).astype(np.int64)
        out, at = [], 0
        for a in asked:
            place = index[at: at + len(a[0])]
            out.append(pack([small(total[place]), np.diff(place.astype(np.uint32), prepend=np.uint32(0))]))
            at += len(a[0])
        is_end = all_ == END
        stat = np.array([total.sum(), (total > 0).sum(), ((total == 1) & ~is_end).sum(), total[is_end].sum(),
                         (total == 0).sum()], np.int64)
        bucket = t.column("bucket")[0].as_py()
        n, known = len(out), pack([gaps(all_)])
        del asked, w, all_, index, total
        release()
        return pa.table({"block": pa.array(t.column("block").to_pylist() + [None, -1], pa.int64()),
                         "bucket": pa.array([bucket] * (n + 2), pa.int32()),
                         "x": pa.array(out + [pack([stat]), known], pa.binary())})

    return requests.groupBy("bucket").applyInArrow(run, "block long, bucket int, x binary")


# ------------------------------------------------------------------ bigrams
def deal(key: np.ndarray, parts: np.ndarray, c: np.ndarray, t: np.ndarray, n: int) -> np.ndarray:
    """Bucket of each bigram (c, t) of indexes into ``key``: by context, and by
    next word where a context has several parts.  In slices, as the hashes are
    wider than the indexes."""
    out = (mix(key) % np.uint64(n)).astype(np.int32)[c]
    several = parts > 1
    dealt = np.flatnonzero(several[c]) if several.any() else np.zeros(0, np.int64)
    for i in range(0, len(dealt), 1 << 18):
        at = dealt[i: i + (1 << 18)]
        x, y = c[at], t[at]
        part = mix(key[y]) % parts[x].astype(np.uint64)
        out[at] = mix(key[x] + part * np.uint64(BASE)) % np.uint64(n)
    return out


def _in_order(*columns: np.ndarray) -> list[np.ndarray]:
    """Columns of small whole numbers sorted by the first, then the second, ..."""
    bits = [int(c.max()).bit_length() for c in columns]
    if sum(bits) > 63:
        order = np.lexsort(columns[::-1])
        return [c[order] for c in columns]
    one = np.zeros(len(columns[0]), dtype=np.int64)
    for c, b in zip(columns, bits):
        one <<= b
        one |= c
    one.sort()
    out = []
    for b in reversed(bits):
        out.append((one & ((1 << b) - 1)).astype(np.int32))
        one >>= b
    return out[::-1]


def bigram_requests(packed: DataFrame, answers: DataFrame, n: int, stats: dict, limit: int, min_count: int) -> DataFrame:
    """Rows for buckets (bucket, block, x); in buckets from ``n`` on, one row per
    block: its documents' tokens, known tokens and base score."""
    total, known, texts = stats["tokens"], stats["words"], stats["texts"]
    # the unknown word's count: none where it only stands for words without any
    once, end = max(1, stats["once"]) if min_count > 1 else 0, END_ID if texts else UNKNOWN_ID
    floor = math.log10(total + 0.5 * (known + 1))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return empty
        held, h, at = tokens(*[left.column(c)[0].as_py() for c in ("held", "sizes", "z")])
        docs = len(held)
        w, index = vocabulary(h)
        del h
        count, ids = np.zeros(len(w) + 1, dtype=np.int64), np.zeros(len(w) + 1, dtype=np.uint64)
        places = dict(by_bucket(word_bucket(np.concatenate([w, [END]]), n), n))
        for k, x in zip(right.column("bucket").to_pylist(), right.column("x").to_pylist()):
            count[places[k]], place = unpack(x)
            ids[places[k]] = FIRST_ID + np.cumsum(place, dtype=np.uint32).astype(np.uint64) * np.uint64(n) + np.uint64(k)
        del places
        # base: every word, and one end per text
        size = np.diff(at)
        doc = np.repeat(np.arange(docs, dtype=np.int32), size)
        value = np.log10(count + 0.5) - floor
        base = np.bincount(doc, weights=value[index], minlength=docs) + value[-1]
        n_known = np.bincount(doc, weights=(count > 0)[index], minlength=docs).astype(np.int64) + int(count[-1] > 0)
        block = left.column("block")[0].as_py()
        out = [(n + block % n, pack([size + 1, n_known, base]))]
        # the model's words: unknown for those seen less than ``min_count`` times
        word = np.where(count[:-1] >= min_count, ids[:-1], UNKNOWN_ID)
        seen = np.where(count[:-1] >= min_count, count[:-1], once)
        key = np.concatenate([word, [end, START_ID]])
        freq = np.concatenate([seen, [texts or once, texts]])
        # tokens of all texts in a row: each word, then the end; contexts one before
        n_tok = len(index) + docs
        nxt = np.full(n_tok, len(w), dtype=np.int32)
        nxt[np.arange(len(index), dtype=np.int32) + doc] = index
        del doc, index
        ctx = np.empty(n_tok, dtype=np.int32)
        ctx[1:] = nxt[:-1]
        ctx[at[:-1] + np.arange(docs)] = len(w) + 1
        own = np.repeat(np.arange(docs, dtype=np.int32), size + 1)
        # model words have indexes of their own, so that all unknown words are one
        mk, slot = vocabulary(key)
        mfreq = np.zeros(len(mk), dtype=np.int64)
        mfreq[slot] = freq
        # as a context the unknown word is dealt as if seen as often as words seen once
        parts = np.maximum(1, -(-np.where(mk == UNKNOWN_ID, np.maximum(mfreq, stats["once"]), mfreq) // limit))
        c, t = slot[ctx], slot[nxt]
        del ctx, nxt
        bk = deal(mk, parts, c, t, n)
        bk, c, t, own = _in_order(bk, c, t, own)
        cuts = np.searchsorted(bk, np.arange(n + 1))
        for k in range(n):
            a, z = cuts[k], cuts[k + 1]
            if a < z:
                out.append((k, _bucket_rows(c[a:z], t[a:z], own[a:z], mk, mfreq, parts, held)))
        del bk, c, t, own
        release()
        return pa.table({"bucket": pa.array([k for k, _ in out], pa.int32()),
                         "block": pa.array([block] * len(out), pa.int64()),
                         "x": pa.array([x for _, x in out], pa.binary())})

    empty = pa.table({"bucket": pa.array([], pa.int32()), "block": pa.array([], pa.int64()),
                      "x": pa.array([], pa.binary())})
    both = packed.select("block", "held", "sizes", "z").groupBy("block").cogroup(
        answers.filter("block >= 0").groupBy("block"))
    return both.applyInArrow(run, "bucket int, block long, x binary")


def _bucket_rows(c, t, own, mk, mfreq, parts, held) -> bytes:
    """A block's bigrams for one bucket, sorted by context, word, document: the
    contexts (id, frequency, whether dealt, number of words after), the distinct
    next words (id, frequency), and of each bigram its word among them, its
    training count and the documents that hold it, with times."""
    step = np.concatenate([[True], (c[1:] != c[:-1]) | (t[1:] != t[:-1])])
    entry = np.flatnonzero(step)
    ref = np.flatnonzero(step | np.concatenate([[True], own[1:] != own[:-1]]))
    times = np.diff(np.concatenate([ref, [len(c)]]))
    ref_entry = np.cumsum(step)[ref] - 1
    train = np.bincount(ref_entry, weights=times * ~held[own[ref]], minlength=len(entry)).astype(np.int64)
    ec, et = c[entry], t[entry]
    unit = np.flatnonzero(np.concatenate([[True], ec[1:] != ec[:-1]]))
    per = np.diff(np.concatenate([unit, [len(ec)]]))
    refs = np.diff(np.concatenate([np.flatnonzero(np.concatenate([[True], ref_entry[1:] != ref_entry[:-1]])), [len(ref)]]))
    uc = ec[unit]
    words_, which = np.unique(et, return_inverse=True)
    return pack([gaps(mk[uc]), small(mfreq[uc]), small((parts[uc] > 1) & (mfreq[uc] > 0)), small(per), gaps(mk[words_]),
                 small(mfreq[words_]), small(which), small(train), small(refs), own[ref].astype(np.uint16), small(times)], 3)


def merge(requests: DataFrame, n_buckets: int, total: int, share: float = 1.0, unseen: float = 0.0) -> DataFrame:
    """What a bucket makes of the blocks' bigrams; rows by ``kind``:

    model: its contexts (total, sums) and their words with counts;
    part: per block the documents' sums and numbers of tokens by count;
    unseen: per block the documents' tokens that were not seen after their
    context, with the context's sums;
    crowd: sums of contexts that are dealt over several buckets;
    counts: numbers of bigrams seen once, twice, ...;
    base: the blocks' own rows, as they came.

    A word of count c has the unigram probability share * c / total, one without
    a count ``unseen``.
    """
    k1 = DISCOUNTED + 1

    def run(t: pa.Table) -> pa.Table:
        if t.column("bucket")[0].as_py() >= n_buckets:
            return pa.table({"kind": pa.array(["base"] * t.num_rows), "block": t.column("block"), "x": t.column("x")})
        blocks_, got = t.column("block").to_pylist(), [unpack(x) for x in t.column("x").to_pylist()]
        for g in got:
            g[0], g[4] = from_gaps(g[0]), from_gaps(g[4])
        ctx = np.concatenate([np.repeat(g[0], g[3]) for g in got])
        word = np.concatenate([g[4][g[6]] for g in got])
        both = vocabulary(mix(ctx * np.uint64(BASE) + word))[1]
        n = int(both.max()) + 1
        r = np.bincount(both, weights=np.concatenate([g[7].astype(np.float64) for g in got]), minlength=n).astype(np.int64)
        first = np.zeros(n, dtype=np.int32)
        first[both[::-1]] = np.arange(len(both), dtype=np.int32)[::-1]
        p_word = np.concatenate([g[5].astype(np.uint32 if g[5].itemsize < 8 else np.uint64)[g[6]] for g in got])[first] * (share / total)
        p_word[p_word == 0] = unseen
        ctx, word = ctx[first], word[first]
        hk, h = vocabulary(ctx)
        h_total = np.zeros(len(hk), dtype=np.int64)
        h_crowd = np.zeros(len(hk), dtype=bool)
        units = np.concatenate([g[0] for g in got])
        at = np.searchsorted(hk, units)
        h_total[at] = np.concatenate([g[1].astype(np.int64) for g in got])
        h_crowd[at] = np.concatenate([g[2].astype(bool) for g in got])
        # the context's sums: discounted counts wait for the discounts
        was = r > 0
        sums = np.zeros((len(hk), k1 + 1))
        for i in range(1, k1):
            sums[:, i - 1] = np.bincount(h, weights=r == i, minlength=len(hk))
        sums[:, DISCOUNTED] = np.bincount(h, weights=np.where(r > DISCOUNTED, r, 0), minlength=len(hk))
        sums[:, k1] = np.bincount(h, weights=np.where(was, p_word, 0), minlength=len(hk))
        rows: list[tuple] = []
        order = np.lexsort((word, h))
        order = order[was[order]]
        next_, which = vocabulary(word[order])
        rows.append(("model", None, pack([gaps(hk), small(h_total), small(np.bincount(h[was], minlength=len(hk))),
                                          gaps(next_), small(which), small(r[order])], 3)))
        del next_, which, order
        rows.append(("counts", None, pack([np.array([(r == i).sum() for i in range(1, k1 + 1)], np.int64)])))
        if h_crowd.any():
            rows.append(("crowd", None, pack([hk[h_crowd], h_total[h_crowd]] + [np.ascontiguousarray(x) for x in sums[h_crowd].T])))
        log_r = np.log10(np.maximum(r, 1))
        log_h = np.log10(h_total + 1.0)
        log_p = np.log10(np.maximum(p_word, 1e-300))
        done = 0
        for block, g in zip(blocks_, got):
            e = both[done: done + len(g[6])]
            done += len(g[6])
            ref = np.repeat(e, g[8])
            doc, times = g[9].astype(np.int64), g[10].astype(np.float64)
            docs = int(doc.max()) + 1
            seen = was[ref]
            value = np.where(seen, log_r[ref] - log_h[h[ref]], log_p[ref]) * times
            part = [small(np.rint(np.bincount(doc, weights=-value, minlength=docs) * LOG_UNITS).astype(np.int64))]
            for i in range(1, k1):
                part.append(small(np.bincount(doc, weights=times * (r[ref] == i), minlength=docs).astype(np.int64)))
            rows.append(("part", block, pack(part)))
            miss = np.flatnonzero(~seen)
            if len(miss):
                hh = h[ref[miss]]
                used, at = vocabulary(hh.astype(np.uint64))
                used = used.astype(np.int64)
                crowd = h_crowd[used]
                rows.append(("unseen", block, pack(
                    [doc[miss].astype(np.uint16), small(times[miss].astype(np.int64)), small(at), gaps(hk[used[crowd]]),
                     small(h_total[used]), crowd.astype(np.uint8)]
                    + [small(sums[used, i].astype(np.int64)) for i in range(k1)] + [np.rint(np.clip(sums[used, k1], 0, 1) * MASS_UNITS).astype(np.uint32)])))
        # a worker keeps nothing of a bucket for the next one or for the stages after it
        del got, ctx, word, both, first, r, p_word, h, was, log_r, log_h, log_p, units, sums
        release()
        return pa.table({"kind": pa.array([x[0] for x in rows]), "block": pa.array([x[1] for x in rows], pa.int64()),
                         "x": pa.array([x[2] for x in rows], pa.binary())})

    return requests.groupBy("bucket").applyInArrow(run, "kind string, block long, x binary")


# ---------------------------------------------------------------- discounts
def good_turing(n: np.ndarray, k: int = DISCOUNTED) -> np.ndarray:
    """d_1..d_k from the numbers of bigrams seen 1..k+1 times; where the estimate
    isn't between 0 and 1, half a count is taken off."""
    d = np.array([1 - 0.5 / r for r in range(1, k + 1)])
    if n[0] <= 0:
        return d
    last = (k + 1) * n[k] / n[0]
    for r in range(1, k + 1):
        if n[r - 1] > 0 and last < 1:
            x = ((r + 1) * n[r] / (r * n[r - 1]) - last) / (1 - last)
            if 0 < x < 1:
                d[r - 1] = x
    return d


def alpha(total: np.ndarray, sums: list[np.ndarray], d: np.ndarray) -> np.ndarray:
    """Back-off weights of contexts from their total, the numbers of words seen
    once, twice, ... after them, the tokens of more frequent ones, and the
    unigram mass of all of them."""
    k = len(d)
    mass = sums[k] + sum(sums[i] * (i + 1) * d[i] for i in range(k))
    return (1 - mass / (total + 1.0)) / np.maximum(1 - sums[k + 1], 1e-12)


# -------------------------------------------------------------------- score
def _crowded(made: DataFrame, d: np.ndarray) -> DataFrame:
    """(block, doc, value): log alpha of unseen bigrams whose context is dealt over buckets."""
    k1 = DISCOUNTED + 2

    def sums(batches):
        for b in batches:
            for x in b.column(0).to_pylist():
                a = unpack(x)
                yield pa.RecordBatch.from_arrays([pa.array(a[0].view(np.int64)), pa.array(a[1].astype(np.int64))]
                                                 + [pa.array(v.astype(np.float64)) for v in a[2:]], names=names)

    def asked(batches):
        for b in batches:
            for block, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                doc, times, at, named, _, crowd = unpack(x)[:6]
                crowd = crowd.astype(bool)
                mine, hk = np.flatnonzero(crowd[at]), np.zeros(len(crowd), np.uint64)
                hk[crowd] = from_gaps(named)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(mine), block, np.int64)), pa.array(doc[mine].astype(np.int32)),
                     pa.array(hk.view(np.int64)[at[mine]]), pa.array(times[mine].astype(np.int64))],
                    names=["block", "doc", "h", "times"])

    names = ["h", "total", *[f"s{i}" for i in range(k1)]]
    context = made.filter("kind = 'crowd'").select("x").mapInArrow(
        sums, "h long, total long, " + ", ".join(f"s{i} double" for i in range(k1)))
    context = context.groupBy("h").agg(F.max("total").alias("total"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(k1)])
    mass = F.col(f"s{DISCOUNTED}")
    for i in range(DISCOUNTED):
        mass = mass + F.col(f"s{i}") * float((i + 1) * d[i])
    a = (1 - mass / (F.col("total") + 1.0)) / F.greatest(F.lit(1e-12), 1 - F.col(f"s{k1 - 1}"))
    rows = made.filter("kind = 'unseen'").select("block", "x").mapInArrow(
        asked, "block long, doc int, h long, times long")
    rows = rows.join(context.select("h", F.log10(a).alias("a")), "h")
    return rows.groupBy("block", "doc").agg(F.sum(F.col("times") * F.col("a")).alias("value"))


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", bucket_text: int = BUCKET_TEXT,
          bucket_tokens: int = BUCKET_TOKENS, min_count: int = 2) -> DataFrame:
    """One row per document: key, held_out, n_tokens, n_known, train_tokens,
    base_score and score (log10 probability)."""
    spark = docs.sparkSession
    packed = materialize(make_blocks(docs, key, text), "katz-blocks")
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    n = max(1, -(-size // bucket_text))
    answers = materialize(word_answers(word_requests(packed, n)), "katz-words")
    total = np.zeros(5, dtype=np.int64)
    for r in answers.filter("block is null").select("x").toLocalIterator():  # five numbers a bucket
        total += unpack(r.x)[0]
    stats = dict(zip(("tokens", "words", "once", "texts", "unseen"), map(int, total)))
    asked = bigram_requests(packed, answers, n, stats, max(1, bucket_tokens // 4), min_count)
    path = shared_dir(spark, "katz-model")
    if min_count > 1:
        made = merge(asked, n, stats["tokens"] + (stats["once"] == 0))
    else:
        # with no unseen word there is nobody to leave a share to
        left = max(1, stats["once"]) / (stats["tokens"] + 1) if stats["unseen"] else 0.0
        made = merge(asked, n, max(1, stats["tokens"]), 1 - left, left / max(1, stats["unseen"]))
    made.write.partitionBy("kind").parquet(path)
    made = spark.read.schema("block long, x binary, kind string").parquet(path)
    counts = np.zeros(DISCOUNTED + 1, dtype=np.int64)
    for r in made.filter("kind = 'counts'").select("x").toLocalIterator():  # six numbers a bucket
        counts += unpack(r.x)[0]
    d = good_turing(counts)
    kind = docs.schema[key].dataType.simpleString()
    train = stats["tokens"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        t = {}
        for k, x, keys, held in zip(*(left.column(c).to_pylist() for c in ("kind", "x", "_none", "held"))):
            t.setdefault(k, []).append(held if k == "keys" else x)
        held = unpack(t["keys"][0])[0].astype(bool)
        keys = left.column("keys").filter(pc.equal(left.column("kind"), "keys")).combine_chunks()
        keys = (keys.chunk(0) if isinstance(keys, pa.ChunkedArray) else keys).flatten()
        n_tokens, n_known, base = unpack(t["base"][0])
        out = np.zeros(len(held))
        for x in t.get("part", []):
            value, *seen = unpack(x)
            out[: len(value)] += sum(s * math.log10(d[i]) for i, s in enumerate(seen)) - value / LOG_UNITS
        for x in t.get("unseen", []):
            doc, times, at, _, h_total, crowd, *sums = unpack(x)
            sums = [s.astype(np.float64) for s in sums]
            sums[-1] /= MASS_UNITS
            a = np.log10(np.maximum(alpha(h_total, sums, d), 1e-300))
            out += np.bincount(doc, weights=times * np.where(crowd.astype(bool), 0.0, a)[at], minlength=len(out))
        np.add.at(out, right.column("doc").to_numpy(), right.column("value").to_numpy())
        return pa.Table.from_arrays(
            [keys, pa.array(held), pa.array(n_tokens.astype(np.int64)), pa.array(n_known.astype(np.int64)),
             pa.array(np.full(len(out), train, np.int64)), pa.array(base), pa.array(out)], names=names)

    names = [key, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    rows = made.filter("kind in ('base', 'part', 'unseen')").select(
        "block", "kind", "x", F.lit(None).cast(f"array<{kind}>").alias("keys"), F.lit(None).cast("binary").alias("held"))
    rows = rows.unionByName(packed.select("block", F.lit("keys").alias("kind"), F.lit(None).cast("binary").alias("x"),
                                          "keys", "held")).withColumn("_none", F.lit(0))
    return rows.groupBy("block").cogroup(_crowded(made, d).groupBy("block")).applyInArrow(
        run, f"`{key}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
             "score double")
