"""SimHash near-duplicates with bit-sliced comparison.

Documents get a 64-bit fingerprint; fingerprints within ``radius`` differing
bits are linked, and each document gets the smallest ``doc_id`` reachable.

How the pairs are found without comparing all:

* equal fingerprints collapse to one row first, so a hot group of copies is one row;
* two fingerprints within radius r agree on at least one of r+1 bit blocks, and
  on one of r+1 blocks of the rest: every fingerprint goes into (r+1)^2 buckets
  keyed by the bits it must share (a mask and the masked value);
* a bucket above ``BUCKET_ROWS`` fingerprints is split by the same rule on the
  bits still free, again and again.  A bucket that fixes all but k bits holds
  2^k fingerprints at most, so the splitting ends; nothing is cut off;
* in a bucket the fingerprints stand as vertical bit planes (64 per word), the
  distances of a query to all of them grow in carry-save counters, and queries
  whose lanes all exceed the radius are abandoned;
* a bucket returns a star per local component, never its pairs; the stars of
  all buckets are merged by alternating large-star and small-star steps.

Nulls and blank texts have fingerprint zero and link like any other.  A null
``doc_id`` never is a component's id unless the whole component has none.
Repeated rows get one row each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlab.llm.textops import blocks, neutral, text_buffer
from txnlab.session import materialize

SEED = 42
BUCKET_ROWS = 8192
_ALL = (1 << 64) - 1


# ------------------------------------------------------------- fingerprints
def fingerprint(text: bytes, k: int = 3, seed: int = SEED) -> int:
    """Majority bits of the XXH64 of every k-word shingle (repeats included)."""
    w = text.lower().split()
    if not w:
        return 0
    joined = b" ".join(w)
    if len(w) <= k:
        return xxhash.xxh64_intdigest(joined, seed)
    at = np.zeros(len(w) + 1, dtype=np.int64)
    np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1, out=at[1:])
    n = len(w) - k + 1
    digest = xxhash.xxh64_intdigest
    h = np.fromiter([digest(joined[a:b], seed) for a, b in zip(at[:n].tolist(), (at[k:] - 1).tolist())], np.uint64, n)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, 16384):
        part = h[i: i + 16384]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, text: str = "text", out: str = "fingerprint", k: int = 3,
                     keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all) and the signed 64-bit fingerprint ``out``."""
    keep = docs.columns if keep is None else keep
    need = keep + [c for c in [text] if c not in keep]
    schema = docs.select(*[F.col(f"`{c}`") for c in keep]).withColumn(out, F.lit(0).cast("long")).schema

    def run(batches):
        for b in batches:
            data, off = text_buffer(b.column(b.schema.get_field_index(text)))
            fp = np.zeros(b.num_rows, dtype=np.uint64)
            for i, j in blocks(off):
                for d in range(i, j):
                    fp[d] = fingerprint(data[off[d]: off[d + 1]].tobytes(), k)
            cols = [b.column(b.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(fp.view(np.int64))], names=keep + [out])

    return docs.select(*[F.col(f"`{c}`") for c in need]).mapInArrow(run, schema)


# -------------------------------------------------------------- bit planes
def planes(fp: np.ndarray) -> np.ndarray:
    """(64, words): bit b of 64 fingerprints per word, vertically."""
    pad = (-len(fp)) % 64
    full = np.concatenate([fp, np.zeros(pad, np.uint64)]) if pad else fp
    bits = np.unpackbits(full.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits, axis=0, bitorder="little").T).view(np.uint64)


def near_lanes(query: np.ndarray, plane_of, radius: int) -> np.ndarray:
    """For each query a row of lane words: bit set where the distance <= radius.

    ``plane_of(b, rows)`` gives the lane words of bit b for the queries ``rows``.
    Counters are carry-save: counter[i] holds bit i of 64 distances per word;
    what leaves the last one sticks in ``over``.
    """
    width = max(1, radius.bit_length())
    start = (1 << width) - 1 - radius  # so that the counter leaves its range at radius + 1
    rows = np.arange(len(query))
    shape = plane_of(0, rows).shape
    ones = np.uint64(_ALL)
    counter = [np.full(shape, ones if start >> i & 1 else np.uint64(0), dtype=np.uint64) for i in range(width)]
    over = np.zeros(shape, dtype=np.uint64)
    result = np.full(shape, ones, dtype=np.uint64)
    for b in range(64):
        bit = (query[rows] >> np.uint64(b)) & np.uint64(1)
        carry = plane_of(b, rows) ^ (np.uint64(0) - bit)[:, None]
        for i in range(width):
            counter[i], carry = counter[i] ^ carry, counter[i] & carry
        over |= carry
        if b % 8 == 7:
            done = (over == ones).all(axis=1)
            if done.any():
                result[rows[done]] = ones
                live = ~done
                rows, over = rows[live], over[live]
                counter = [c[live] for c in counter]
                if not len(rows):
                    return ~result
    result[rows] = over
    return ~result


def _stars(hits: np.ndarray, n: int) -> np.ndarray:
    """Component (smallest member index) of each of n rows with neighbour bit rows."""
    comp = np.full(n, -1, dtype=np.int64)
    for s in range(n):
        if comp[s] >= 0:
            continue
        seen = np.zeros(n, dtype=bool)
        seen[s] = True
        fresh = np.array([s])
        while len(fresh):
            reach = np.bitwise_or.reduce(hits[fresh], axis=0)
            bits = np.unpackbits(reach.view(np.uint8), bitorder="little")[:n].astype(bool)
            fresh = np.flatnonzero(bits & ~seen)
            seen[fresh] = True
        comp[seen] = s
    return comp


def bucket_links(sizes: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (larger, smaller) of buckets given as consecutive runs of
    distinct, ascending fingerprints."""
    at = np.concatenate([[0], np.cumsum(sizes)])
    hi, lo = [], []
    small = np.flatnonzero((sizes >= 2) & (sizes <= 64))
    if len(small):
        word, used, w = np.zeros(len(small), np.int64), 0, 0
        lane0 = np.zeros(len(small), np.int64)
        for i, m in enumerate(sizes[small].tolist()):  # several small buckets share a word of 64 lanes
            if used + m > 64:
                w, used = w + 1, 0
            word[i], lane0[i] = w, used
            used += m
        m = sizes[small]
        rep = np.repeat(np.arange(len(small)), m)
        inner = np.arange(len(rep)) - np.repeat(np.cumsum(m) - m, m)
        src = at[small][rep] + inner
        q = fp[src]
        lane = lane0[rep] + inner
        table = np.zeros((w + 1) * 64, dtype=np.uint64)
        table[word[rep] * 64 + lane] = q
        pl, wq = planes(table), word[rep]
        hit = near_lanes(q, lambda b, rows: pl[b][wq[rows], None], radius)[:, 0]
        full = np.uint64(_ALL)
        mask = (full >> (np.uint64(64) - m.astype(np.uint64))) << lane0.astype(np.uint64)
        hit &= mask[rep] & ~(np.uint64(1) << lane.astype(np.uint64))
        for g in np.unique(rep[hit != 0]).tolist():
            a, n = int(np.searchsorted(rep, g)), int(m[g])
            own = (hit[a: a + n] >> np.uint64(lane0[g]))[:, None]
            comp = _stars(own, n)
            mem = fp[at[small[g]]: at[small[g]] + n]
            out = comp != np.arange(n)
            hi.append(mem[out])
            lo.append(mem[comp[out]])
    for g in np.flatnonzero(sizes > 64).tolist():
        mem = fp[at[g]: at[g + 1]]
        pl, n = planes(mem), len(mem)
        hit = np.concatenate([
            near_lanes(mem[i: i + 512], lambda b, rows: np.broadcast_to(pl[b], (len(rows), pl.shape[1])), radius)
            for i in range(0, n, 512)])
        comp = _stars(hit, n)
        out = comp != np.arange(n)
        hi.append(mem[out])
        lo.append(mem[comp[out]])
    none = np.zeros(0, np.uint64)
    return (np.concatenate(hi), np.concatenate(lo)) if hi else (none, none)


# ----------------------------------------------------------------- buckets
def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def refine(mask: int, radius: int) -> list[int]:
    """``mask`` with one of radius+1 blocks of its free bits added, each in turn."""
    free = [b for b in range(64) if not mask >> b & 1]
    if not free:
        return []
    cuts = np.array_split(np.array(free), min(radius + 1, len(free)))
    return [mask | sum(1 << int(b) for b in c) for c in cuts]


def _bucketed(fps: DataFrame, masks: list[int]) -> DataFrame:
    m = F.explode(F.array(*[F.lit(_signed(x)).cast("long") for x in masks]))
    return fps.select("fp", m.alias("mask")).withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))


def _finer(rows: DataFrame, radius: int) -> DataFrame:
    """(mask, key, fp) of crowded (mask, fp) rows, each in the buckets of its
    mask's refinements."""
    def run(batches):
        known: dict = {}
        for b in batches:
            mask, fp = (b.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            for m in set(mask.tolist()):
                finer = known.setdefault(m, np.array([_signed(x) for x in refine(m & _ALL, radius)], dtype=np.int64))
                own = np.tile(fp[mask == m], len(finer))
                out = np.repeat(finer, int((mask == m).sum()))
                yield pa.RecordBatch.from_arrays([pa.array(out), pa.array(own & out), pa.array(own)],
                                                 names=["mask", "key", "fp"])

    return rows.mapInArrow(run, "mask long, key long, fp long").distinct()


def _compare(rows: DataFrame, radius: int) -> DataFrame:
    """Star edges of all buckets of (mask, key, fp) rows."""
    rows = rows.repartition("mask", "key").sortWithinPartitions("mask", "key", "fp")

    def run(batches):
        rest = None
        for b in batches:
            t = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(3)])
            t = t if rest is None else np.concatenate([rest, t], axis=1)
            cut = np.flatnonzero((t[0, 1:] != t[0, :-1]) | (t[1, 1:] != t[1, :-1])) + 1
            if not len(cut):
                rest = t
                continue
            rest = t[:, cut[-1]:]
            yield links(t[:, : cut[-1]], cut[:-1])
        if rest is not None and rest.shape[1]:
            yield links(rest, np.zeros(0, np.int64))

    def links(t, cut):
        sizes = np.diff(np.concatenate([[0], cut, [t.shape[1]]]))
        u, v = bucket_links(sizes, t[2].astype(np.int64).view(np.uint64), radius)
        u, v = u.view(np.int64), v.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(u, v)), pa.array(np.minimum(u, v))], names=["u", "v"])

    return rows.select("mask", "key", "fp").mapInArrow(run, "u long, v long")


def near_edges(fps: DataFrame, radius: int = 3, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Edges (u > v) between distinct fingerprints ``fp`` whose closure links
    exactly the pairs within ``radius`` bits."""
    masks = [m2 for m1 in refine(0, radius) for m2 in refine(m1, radius)]
    rows, edges = _bucketed(fps, masks), None
    while True:
        size = rows.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        size = materialize(size, "simhash-buckets")
        fit = rows.join(size.filter(F.col("n") <= bucket_rows).select("mask", "key"), ["mask", "key"], "left_semi")
        found = _compare(fit, radius)
        edges = found if edges is None else edges.unionByName(found)
        big = size.filter(F.col("n") > bucket_rows)
        if big.isEmpty():
            return edges.distinct()
        crowd = rows.join(big.select("mask", "key"), ["mask", "key"], "left_semi").select("mask", "fp")
        rows = materialize(_finer(crowd, radius), "simhash-crowded")


# -------------------------------------------------------------- components
def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u > v): root is the smallest
    node reachable.  Alternating large-star and small-star steps, each written
    to the shared folder; both only ever point nodes at smaller ones."""
    def state(e):
        h = F.xxhash64("u", "v").cast("decimal(38,0)")
        return tuple(e.agg(F.count(F.lit(1)), F.sum(h)).first())

    cur = materialize(edges, "simhash-links")
    seen = state(cur)
    while True:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u > v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.filter("u > v").unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        cur = materialize(small, "simhash-links")
        now = state(cur)
        if now == seen:
            return cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now


def link(marked: DataFrame, radius: int = 3, key: str = "doc_id", fingerprint_col: str = "fingerprint",
         bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(fp, root, component_id): the class of each distinct fingerprint of ``marked``.
    ``root``, its smallest fingerprint, is the class's own; ids may repeat or be null."""
    fps = marked.groupBy(F.col(fingerprint_col).alias("fp")).agg(F.min(key).alias("least"))
    fps = materialize(fps, "simhash-distinct")
    roots = components(near_edges(fps.select("fp"), radius, bucket_rows))
    fps = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    fps = fps.withColumn("root", F.coalesce("root", "fp"))
    ids = fps.groupBy("root").agg(F.min("least").alias("component_id"))
    return fps.join(ids, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, k: int = 3, radius: int = 3, key: str = "doc_id", text: str = "text",
                    bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per document: key, fingerprint (hex) and component_id."""
    marked = materialize(with_fingerprint(docs, text, "fp", k, [key]), "simhash-marked")
    classes = link(marked, radius, key, "fp", bucket_rows).drop("root")
    out = marked.join(classes, "fp")
    return out.select(key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, k: int = 3, radius: int = 3, key: str = "doc_id",
                         text: str = "text") -> DataFrame:
    """The documents whose key is the smallest of their class, one row for each
    class; the columns of ``docs``."""
    rows, (key, text) = neutral(docs, key, text)
    marked = materialize(with_fingerprint(rows, text, "_fp", k), "simhash-marked")
    slim = marked.select(F.col(key).alias("_key"), "_fp")
    classes = link(slim, radius, "_key", "_fp").withColumnRenamed("fp", "_fp")
    first = slim.join(classes, "_fp").groupBy("root").agg(
        F.min(F.struct(F.col("_key").isNull().alias("no_key"), "_key", "_fp")).alias("x"))
    first = first.select("x._key", "x._fp")
    marked = marked.withColumnRenamed(key, "_key")
    same = marked["_key"].eqNullSafe(first["_key"]) & (marked["_fp"] == first["_fp"])
    out = marked.join(first, same, "left_semi").withColumnRenamed("_key", key)
    return out.dropDuplicates([key, "_fp"]).select(*rows.columns).toDF(*docs.columns)
