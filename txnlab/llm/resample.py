"""Importance resampling towards a target: documents drawn by hashed n-gram weights.

Features are the runs of 1 to ``sizes`` consecutive words, hashed into
``buckets`` by crc32.  Both tables' bucket counts are summed by Spark; a bucket's
gain is 1000 times the log ratio of its share of the target to its share of the
documents.  The gains are one array of ``buckets`` numbers, the only thing that
goes out to the tasks; a document's weight is the floored mean of its features'
gains, and Gumbel noise from a hash of its key makes the draw of the highest
scores a draw without replacement in proportion to exp(weight / 1000).

The cutoff of the draw is found by weighted medians of medians.  Each round every
partition gives the median of its remaining keys and how many there are; the
median of these, weighted by the numbers, has at least a quarter of all remaining
keys on each side, so counting what lies on each side discards a quarter or more.
Both sides' medians are made while counting, so a round is one job; the remaining
keys are written anew whenever they are fewer than a quarter of those last written,
so that all rounds together read a small multiple of the keys.  ``FINISH`` keys or
fewer are sorted.  A task holds the keys of one file split.  The winners are
sorted by range, each range numbered by itself from the totals before it.

Scores are ordered downwards, ties by smaller key (null last), then by place in
the written scores, so that repeated rows are drawn one by one.  A null text has
no words; a document without features has weight 0 and the noise alone.  A null
key hashes as the empty text.  With an empty target, or without documents, the
gains are those of the formula with its counts at 0.  Only the named columns are
read: other columns, whatever their names, don't matter.
"""

from __future__ import annotations

import hashlib
import math
import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlab.session import materialize

BUCKETS = 10_000
SIZES = 2
SEED = 7
MIN_WORDS = 20
DRAW = (25, 100)
FINISH = 1_000
CHUNK = 1 << 20  # bytes of a text whose words are held at once

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
GAP = re.compile(rb"[^0-9a-z\x80-\xff]")


def feature_hashes(text: bytes, sizes: int = SIZES, chunk: int = CHUNK):
    """Yields (words, crc32 of each feature) for stretches of a lower-cased text."""
    at, before = 0, []
    while at < len(text):
        gap = GAP.search(text, at + chunk)
        end = gap.start() if gap else len(text)
        fresh = WORD.findall(text, at, end)
        at = end
        words = before + fresh
        crc = list(map(crc32, words))
        out = [crc[len(before):]]
        spaced = [b" " + w for w in words] if sizes > 1 else []
        for k in range(2, sizes + 1):
            crc = list(map(crc32, spaced[k - 1:], crc))  # the last word is added to each run of k - 1
            out.append(crc[max(0, len(before) - k + 1):])
        before = words[-(sizes - 1):] if sizes > 1 else []
        yield len(fresh), np.array(sum(out, []), dtype=np.uint32)


def _texts(batch: pa.RecordBatch, i: int):
    return (b"" if t is None else t.lower() for t in batch.column(i).cast(pa.large_binary()).to_pylist())


def bucket_counts(df: DataFrame, text: str, buckets: int = BUCKETS, sizes: int = SIZES) -> DataFrame:
    """(bucket, n): features of all texts, added up in each task first."""
    def count(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for t in _texts(batch, 0):
                for _, h in feature_hashes(t, sizes):
                    total += np.bincount(h % buckets, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["bucket", "n"])

    d = df.select(F.col(f"`{text}`").cast("string").alias("t"))
    return d.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text: str = "text", target_text: str = "text", buckets: int = BUCKETS,
          sizes: int = SIZES) -> np.ndarray:
    """The gain of every bucket, whole numbers."""
    counted = []
    for df, col in ((docs, text), (target, target_text)):
        have = np.zeros(buckets, dtype=np.int64)
        for r in bucket_counts(df, col, buckets, sizes).collect():  # a row per bucket
            have[r.bucket] = r.n
        counted.append(have)
    (s, t), total = counted, [float(c.sum()) + buckets for c in counted]
    return np.array([math.floor(1000 * math.log((float(b) + 1) * total[0] / ((float(a) + 1) * total[1])))
                     for a, b in zip(s.tolist(), t.tolist())], dtype=np.int64)


def gumbel(key, seed: int = SEED) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(docs: DataFrame, gain: np.ndarray, key: str = "doc_id", text: str = "text", sizes: int = SIZES,
           seed: int = SEED) -> DataFrame:
    """(row, <key>, n_words, n_features, weight, score), written; ``row`` is a
    place, unique from here on."""
    kind = docs.schema[key].dataType
    if not isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise ValueError(f"{key} must be a column of whole numbers")
    buckets = len(gain)

    def score(batches):
        for batch in batches:
            keys = batch.column(1).to_pylist()
            out = []
            for k, t in zip(keys, _texts(batch, 2)):
                words = n = 0
                total = 0
                for w, h in feature_hashes(t, sizes):
                    words, n, total = words + w, n + len(h), total + int(gain[h % buckets].sum())
                weight = total // n if n else 0
                out.append((words, n, weight, weight + gumbel(k, seed)))
            cols = [pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 4)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.int64()), *cols],
                                             ["row", "key", "n_words", "n_features", "weight", "score"])

    d = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").alias("key"),
                    F.col(f"`{text}`").cast("string").alias("t"))
    return materialize(d.mapInArrow(
        score, "row long, key long, n_words long, n_features long, weight long, score long"), "resample-scores")


# ----------------------------------------------------------------- selection
# A key is (-score, document key, row), compared in that order; a missing document
# key is above all others.
_LAST = (1 << 63) - 1
_ORDER = ("a", "b", "row")


def _key_columns(rows: DataFrame) -> DataFrame:
    return rows.select((-F.col("score")).alias("a"), F.coalesce("key", F.lit(_LAST)).alias("b"), "row")


def _below(cols, key) -> np.ndarray:
    (a, b, c), (x, y, z) = cols, key
    return (a < x) | ((a == x) & ((b < y) | ((b == y) & (c < z))))


def _nth(cols, m: int):
    """The m-th key (from 0) in order, by a selection in each column."""
    out = []
    for i in range(len(cols)):
        v = np.partition(cols[i], m)[m]
        m -= int((cols[i] < v).sum())
        here = cols[i] == v
        cols = [c[here] for c in cols]
        out.append(int(v))
    return out


def _between(df: DataFrame, lo, hi) -> DataFrame:
    """Rows of keys strictly between two keys (None: no bound)."""
    me = [F.col(n) for n in _ORDER]

    def before(x, y):
        return (x[0] < y[0]) | ((x[0] == y[0]) & ((x[1] < y[1]) | ((x[1] == y[1]) & (x[2] < y[2]))))
    if lo is not None:
        df = df.filter(before([F.lit(v) for v in lo], me))
    if hi is not None:
        df = df.filter(before(me, [F.lit(v) for v in hi]))
    return df


def _round(keys: DataFrame, pivot):
    """One row per partition that has keys: how many are below and above the
    pivot, and the median of each side."""
    side = "struct<n:long,a:long,b:long,row:long>"

    def look(batches):
        cols = [[np.zeros(0, np.int64)] for _ in _ORDER]
        for batch in batches:
            for c, x in zip(cols, batch.columns):
                c.append(x.to_numpy(zero_copy_only=False))
        cols = [np.concatenate(c) for c in cols]
        low = _below(cols, pivot) if pivot else np.zeros(len(cols[0]), bool)
        high = ~low
        if pivot:
            high &= ~((cols[0] == pivot[0]) & (cols[1] == pivot[1]) & (cols[2] == pivot[2]))
        row = {}
        for name, keep in (("low", low), ("high", high)):
            n = int(keep.sum())
            a, b, r = _nth([c[keep] for c in cols], (n - 1) // 2) if n else (0, 0, 0)
            row[name] = {"n": n, "a": a, "b": b, "row": r}
        kind = pa.struct([(n, pa.int64()) for n in ("n", *_ORDER)])
        yield pa.RecordBatch.from_arrays([pa.array([row["low"]], kind), pa.array([row["high"]], kind)], ["low", "high"])

    return keys.mapInArrow(look, f"low {side}, high {side}").collect()


def weighted_median(medians: list[tuple[int, tuple]]):
    """The first median with half of the weight at or below it."""
    total, seen = sum(n for n, _ in medians), 0
    for n, key in sorted(medians, key=lambda x: x[1]):
        seen += n
        if 2 * seen >= total:
            return key


def cutoff(keys: DataFrame, k: int, finish: int = FINISH):
    """The k-th key in order (from 1) of ``keys``, a written table of unique
    (a, b, row)."""
    stored = left = keys.count()
    if not 1 <= k <= stored:
        raise ValueError("k must be 1 to the number of keys")
    lo = hi = pivot = None
    while left > finish:
        found = _round(_between(keys, lo, hi), pivot)
        low = sum(r.low.n for r in found)
        if pivot is not None and k == low + 1:
            return pivot
        side = "high"
        if pivot is not None:
            side = "low" if k <= low else "high"
            lo, hi, k = (lo, pivot, k) if side == "low" else (pivot, hi, k - low - 1)
        at = [(r[side].n, tuple(r[side][c] for c in _ORDER)) for r in found if r[side].n]
        left = sum(n for n, _ in at)
        pivot = weighted_median(at)
        if 4 * left < stored:
            keys, stored = materialize(_between(keys, lo, hi), "resample-keys"), left
    rest = sorted(tuple(r) for r in _between(keys, lo, hi).collect())  # finish rows at most
    return rest[k - 1]


def ranked(winners: DataFrame) -> DataFrame:
    """``winners`` with ``rank``: sorted by range, numbered within each range, and
    moved on by the number of rows in the ranges before."""
    order = ["a", "b", "row"]
    fields = winners.schema.fields

    def number(batches):
        seen, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part), pa.int64()), pa.array(np.arange(seen, seen + n), pa.int64())],
                [*batch.schema.names, "part", "at"])
            seen += n

    schema = T.StructType([*fields, T.StructField("part", T.LongType()), T.StructField("at", T.LongType())])
    done = materialize(winners.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(number, schema),
                       "resample-winners")
    sizes = sorted((r.part, r["count"]) for r in done.groupBy("part").count().collect())  # a row per partition
    before, moved = 0, []
    for part, n in sizes:
        moved.append((part, before))
        before += n
    moved = winners.sparkSession.createDataFrame(moved, "part long, before long")
    # one row per shuffle partition
    return done.join(F.broadcast(moved), "part").withColumn("rank", F.col("before") + F.col("at") + 1)


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
             draw: tuple[int, int] = DRAW, min_words: int = MIN_WORDS, buckets: int = BUCKETS, sizes: int = SIZES,
             seed: int = SEED, finish: int = FINISH) -> DataFrame:
    """One row per document: <key>, n_features, weight, score, and the rank of
    those drawn: ``draw[0] / draw[1]`` of the documents with ``min_words`` words."""
    gain = gains(docs, target, text, target_text, buckets, sizes)
    scored = scores(docs, gain, key, text, sizes, seed)
    pool = materialize(_key_columns(scored.filter(F.col("n_words") >= min_words)), "resample-keys")
    k = pool.count() * draw[0] // draw[1]
    out = ["key", "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if k < 1:
        return scored.select(*out, none).withColumnRenamed("key", key)
    last = cutoff(pool, k, finish)
    keyed = scored.withColumn("a", -F.col("score")).withColumn("b", F.coalesce("key", F.lit(_LAST)))
    me = F.struct("a", "b", "row")
    drawn = (F.col("n_words") >= min_words) & (me <= F.struct(*[F.lit(v).cast("long") for v in last]))
    won = ranked(keyed.filter(drawn)).select(*out, "rank")
    return won.unionByName(keyed.filter(~drawn).select(*out, none)).withColumnRenamed("key", key)
