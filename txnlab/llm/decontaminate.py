"""Benchmark decontamination with SimHash windows.

For every benchmark item, windows of the item's own size slide over every
document.  A window whose fingerprint is within ``RADIUS`` bits of the item's
is a candidate, and the exact weighted similarity of their 5-word shingles
(sum of smaller counts over sum of larger counts) decides: 0.8 or more is a
match.

* A window that shares no shingle with the item has similarity 0, so only the
  windows over a shared shingle are fingerprinted; that loses no match.
* Fingerprints stand in four indexes of 16-bit blocks, sorted by value.  Two within
  RADIUS bits agree on some block up to RADIUS // 4 bits, so each window probes
  each index at its block's values of that distance (2,517 of 65,536), and the
  union of what stands there holds all within the radius.  The work for a window
  doesn't grow with the items but by what it finds.  At similarity 0.8 the expected distance is
  under 10 bits; RADIUS lies more than three deviations above.
* Items go out as index arrays in blocks of at most ``ITEM_BLOCK_BYTES`` of
  text; a larger benchmark is several passes over the documents.  Documents
  are never shuffled, so hot sources or shared passages cost no one task more.

Words are runs of non-blank bytes, A-Z lower-cased.  Items under five words
are one shingle and match a document of just these words; items without words
(null, blank) match nothing, nor do documents without words.  Repeated items
and repeated rows are judged one by one.  Without documents or without items
there are no matches.  Extra columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlab.llm.textops import LOWER, blocks, text_buffer, window_hash, word_hashes, words
from txnlab.session import materialize

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 19
ITEM_BLOCK_BYTES = 16 << 20
_SIEVE = 20  # bits of the table that sieves shingles
_PROBE_WINDOWS = 512  # windows that probe at once


def simhash_windows(sh: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """Fingerprint of each window of ``n`` shingle hashes beginning at ``starts`` (ascending)."""
    out = np.zeros(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        j = int(np.searchsorted(starts, starts[i] + 16384))
        lo, hi = int(starts[i]), int(starts[j - 1]) + n
        bits = np.unpackbits(sh[lo:hi].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total = np.zeros((hi - lo + 1, 64), dtype=np.int32)
        np.cumsum(bits, axis=0, out=total[1:], dtype=np.int32)
        at = starts[i:j] - lo
        ones = 2 * (total[at + n] - total[at]) > n
        out[i:j] = np.packbits(ones, axis=1, bitorder="little").view(np.uint64).ravel()
        i = j
    return out


def shingles(h: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Shingle hashes of one word sequence; a shorter one is a single shingle."""
    return window_hash(h, size) if len(h) >= size else window_hash(h, max(len(h), 1))


def similarity(a: tuple, b: tuple) -> float:
    """Weighted Jaccard of two (sorted hashes, counts)."""
    at = np.minimum(np.searchsorted(a[0], b[0]), len(a[0]) - 1)
    same = a[0][at] == b[0]
    both = int(np.minimum(a[1][at[same]], b[1][same]).sum())
    return both / (int(a[1].sum()) + int(b[1].sum()) - both)


class BlockIndex:
    """Fingerprints by the value of one 16-bit block."""

    def __init__(self, fps: np.ndarray, block: int):
        self.block = block
        values = self.values_of(fps)
        self.order = np.argsort(values, kind="stable")
        self.values = values[self.order]

    def values_of(self, fps: np.ndarray) -> np.ndarray:
        return (fps >> np.uint64(16 * self.block)).astype(np.int64) & 0xFFFF

    def probe(self, fps: np.ndarray, distance: int):
        """(x, y): the pairs of ``fps`` and own fingerprints within ``distance`` bits in the block."""
        there = np.zeros(1 << 16, dtype=bool)
        there[self.values] = True
        every = np.arange(1 << 16)
        probes = self.values_of(fps)[:, None] ^ every[np.bitwise_count(every) <= distance][None, :]
        x, at = np.nonzero(there[probes])
        value = probes[x, at]
        a, z = np.searchsorted(self.values, value), np.searchsorted(self.values, value, side="right")
        rep = np.repeat(np.arange(len(x)), z - a)
        inner = np.arange(len(rep)) - np.repeat(np.cumsum(z - a) - (z - a), z - a)
        return x[rep], self.order[a[rep] + inner]


class ItemIndex:
    """The items of one block: shingles, fingerprints by window size, block values."""

    def __init__(self, ids: list, texts: list):
        data, off = text_buffer(pa.array([t or "" for t in texts], pa.large_string()))
        data = LOWER[data]
        s, e, w = words(data, off)
        h = word_hashes(data, s, e)
        self.ids, self.items, by_size, short, pairs = [], [], {}, {}, []
        for i, item in enumerate(ids):
            own = h[w[i]: w[i + 1]]
            if not len(own):
                continue
            sh = shingles(own)
            k = len(self.items)
            self.ids.append(item)
            self.items.append(np.unique(sh, return_counts=True))
            if len(own) < SHINGLE:
                short.setdefault((len(own), int(sh[0])), []).append(k)
                continue
            fp = simhash_windows(sh, np.zeros(1, np.int64), len(sh))[0]
            by_size.setdefault(len(sh), []).append((k, fp))
            pairs += [(int(x), len(sh)) for x in self.items[k][0]]
        self.short = short
        self.sizes = {}
        for n, v in by_size.items():
            fps = np.array([f for _, f in v], dtype=np.uint64)
            self.sizes[n] = np.array([k for k, _ in v]), fps, [BlockIndex(fps, b) for b in range(4)]
        pairs = sorted(set(pairs))
        self.shingle = np.array([p[0] for p in pairs], dtype=np.uint64)
        self.shingle_size = np.array([p[1] for p in pairs], dtype=np.int64)
        self.sieve = np.zeros(1 << _SIEVE, dtype=bool)
        self.sieve[(self.shingle >> np.uint64(64 - _SIEVE)).astype(np.int64)] = True

    def candidates(self, n: int, fp: np.ndarray, radius: int = RADIUS):
        """(window, item) pairs within ``radius`` bits, found over the block indexes."""
        k, own, tables = self.sizes[n]
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for i in range(0, len(fp), _PROBE_WINDOWS):
            mine = fp[i: i + _PROBE_WINDOWS]
            found = [x * len(own) + y for x, y in (t.probe(mine, radius // 4) for t in tables)]
            x, y = np.divmod(np.unique(np.concatenate(found)), len(own))
            near = np.bitwise_count(mine[x] ^ own[y]) <= radius
            out.append((x[near] + i, k[y[near]]))
        return tuple(np.concatenate(part) for part in zip(*out))

    def matches(self, h: np.ndarray, sh: np.ndarray, hits: np.ndarray):
        """Best match of each item in a document: {item: (similarity, start)}.
        h: its words; sh: its shingles; hits: places whose shingle may be an item's."""
        best: dict[int, tuple[float, int]] = {}
        if 0 < len(h) < SHINGLE:
            for k in self.short.get((len(h), int(sh[0])), []):
                best[k] = (1.0, 0)
        if not len(hits):
            return best
        a = np.searchsorted(self.shingle, sh[hits])
        z = np.searchsorted(self.shingle, sh[hits], side="right")
        rep = np.repeat(np.arange(len(hits)), z - a)
        if not len(rep):
            return best
        inner = np.arange(len(rep)) - np.repeat(np.cumsum(z - a) - (z - a), z - a)
        size, place = self.shingle_size[a[rep] + inner], hits[rep]
        for n in np.unique(size).tolist():
            at = place[size == n]
            width = min(n, len(sh))
            last = len(sh) - width
            mark = np.zeros(last + 2, dtype=np.int64)
            np.add.at(mark, np.clip(at - width + 1, 0, last + 1), 1)
            np.add.at(mark, np.minimum(at, last) + 1, -1)
            starts = np.flatnonzero(np.cumsum(mark)[: last + 1] > 0)
            for i in range(0, len(starts), 4096):
                some = starts[i: i + 4096]
                x, k = self.candidates(n, simhash_windows(sh, some, width))
                for s, item in zip(some[x].tolist(), k.tolist()):
                    sim = similarity(self.items[item], np.unique(sh[s: s + width], return_counts=True))
                    if sim >= SIMILARITY and sim > best.get(item, (0.0, 0))[0]:
                        best[item] = (sim, s)
        return best


def scan(col: pa.Array, index: ItemIndex):
    """(row, {item: (similarity, start)}) of each text of a column with a match."""
    data, off = text_buffer(col)
    for i, j in blocks(off):
        low, o = LOWER[data[off[i]: off[j]]], off[i: j + 1] - off[i]
        s, e, w = words(low, o)
        h = word_hashes(low, s, e)
        sh = window_hash(h, SHINGLE)
        hit = np.flatnonzero(index.sieve[(sh >> np.uint64(64 - _SIEVE)).astype(np.int64)]) if len(sh) else sh
        count = np.diff(w)
        look = count < SHINGLE if index.short else np.zeros(j - i, dtype=bool)
        doc = np.searchsorted(w, hit, side="right") - 1
        ok = hit + SHINGLE <= w[doc + 1] if len(hit) else np.zeros(0, bool)
        hit, doc = hit[ok], doc[ok]
        look[doc] = True
        for d in np.flatnonzero(look & (count > 0)).tolist():
            own = h[w[d]: w[d + 1]]
            mine = sh[w[d]: w[d + 1] - SHINGLE + 1] if len(own) >= SHINGLE else shingles(own)
            at = hit[np.searchsorted(doc, d): np.searchsorted(doc, d, side="right")] - w[d]
            if found := index.matches(own, mine, at):
                yield i + d, found


def item_blocks(items: DataFrame, item: str = "item_id", text: str = "text", limit: int = ITEM_BLOCK_BYTES):
    """The items as ItemIndex objects of at most about ``limit`` bytes of text each."""
    total = items.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n = max(1, -(-2 * total // limit))  # twice as many as would do if all were equal
    # repeated items are dealt over the blocks too; written, as a row's place must not change
    part = F.pmod(F.xxhash64(item, text, F.monotonically_increasing_id()), F.lit(n))
    dealt = materialize(items.select(F.col(item).alias("item"), F.col(text).alias("text"), part.alias("part")), "items")
    for b in range(n):
        rows = dealt.filter(F.col("part") == b).select("item", "text").collect()
        if rows:
            yield ItemIndex([r[0] for r in rows], [r[1] for r in rows])


def find_matches(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                 item_text: str = "text") -> DataFrame:
    """One row for each document and item that it holds: key, item id, the first
    word of the best window, its words and the similarity."""
    spark = docs.sparkSession
    schema = docs.select(F.col(f"`{key}`")).schema
    schema = schema.add(item, items.schema[item].dataType).add("first_word", "long").add("n_words", "long")
    schema = schema.add("similarity", "double")
    parts = []
    for index in item_blocks(items, item, item_text):
        sent = spark.sparkContext.broadcast(index)

        def run(batches, sent=sent):
            index = sent.value
            for b in batches:
                rows, ids, first, n, sim = [], [], [], [], []
                for row, found in scan(b.column(1), index):
                    for k, (s, at) in sorted(found.items()):
                        rows.append(row)
                        ids.append(index.ids[k])
                        first.append(at)
                        n.append(int(index.items[k][1].sum()) + SHINGLE - 1)
                        sim.append(s)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(rows, pa.int64())), pa.array(ids), pa.array(first, pa.int64()),
                     pa.array(n, pa.int64()), pa.array(sim, pa.float64())] if rows else
                    [b.column(0).slice(0, 0), pa.array([], pa.int64()), pa.array([], pa.int64()),
                     pa.array([], pa.int64()), pa.array([], pa.float64())], names=schema.names)

        parts.append(docs.select(F.col(f"`{key}`"), F.col(f"`{text}`")).mapInArrow(run, schema))
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id",
                  item_text: str = "text") -> DataFrame:
    """The documents without a match, all columns."""
    spark, at = docs.sparkSession, docs.columns.index(text)
    for index in item_blocks(items, item, item_text):
        sent = spark.sparkContext.broadcast(index)

        def run(batches, sent=sent):
            for b in batches:
                clean = np.ones(b.num_rows, dtype=bool)
                for row, _ in scan(b.column(at), sent.value):
                    clean[row] = False
                yield b if clean.all() else b.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
