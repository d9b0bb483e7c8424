"""Splits, samples and class weights.

The default split (D2) is a pure function of the row key, so it is the same
on every run, every partitioning and every executor that recomputes a lost
partition.  ``randomSplit`` (D1) is kept for parity but depends on the input
partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlab import config as C
from txnlab.functions.columns import hash_bucket, hash_unit, ratio6
from txnlab.session import materialize

MODULUS = 10000


def _cut_points(weights) -> list[int]:
    total = float(sum(weights))
    acc, cuts = 0.0, []
    for w in weights[:-1]:
        acc += w
        cuts.append(int(round(MODULUS * acc / total)))
    return cuts


def _assign(bucket, names, weights):
    cuts = _cut_points(weights)
    expr = None
    for name, cut in zip(names[:-1], cuts):
        expr = F.when(bucket < cut, name) if expr is None else expr.when(bucket < cut, name)
    return expr.otherwise(names[-1]) if expr is not None else F.lit(names[-1])


def random_split(df: DataFrame, weights=C.SPLIT_WEIGHTS, seed: int = C.SEED, names=C.SPLIT_NAMES) -> DataFrame:
    """A random ``split`` per row from one seeded number, in one pass over
    the input.  Repeatable for the same partitions; use D2 to split by key."""
    total, acc, cuts = float(sum(weights)), 0.0, []
    for w in weights[:-1]:
        acc += w
        cuts.append(acc / total)
    drawn = df.withColumn("_u", F.rand(seed))
    expr = None
    for name, cut in zip(names[:-1], cuts):
        expr = F.when(F.col("_u") < cut, name) if expr is None else expr.when(F.col("_u") < cut, name)
    return drawn.withColumn("split", expr.otherwise(names[-1]) if expr is not None else F.lit(names[-1])).drop("_u")


def hash_split(df: DataFrame, key: str = C.KEY, weights=C.SPLIT_WEIGHTS, salt: str = "",
               names=C.SPLIT_NAMES) -> DataFrame:
    """``split`` from the md5 of the key: repeatable, and all rows of one key
    (e.g. one account) land in the same split.  Rows without a key are one key."""
    safe = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return df.withColumn("split", _assign(hash_bucket(safe, salt, MODULUS), names, weights))


def stratified_split(df: DataFrame, label: str = C.LABEL, key: str = C.KEY, weights=C.SPLIT_WEIGHTS,
                     salt: str = "strata", names=C.SPLIT_NAMES) -> DataFrame:
    """D3: D2 within each class, with a class-specific salt, so each class is cut
    in the given proportions independently.  No sort: a class holding nearly
    all rows costs the same as any other.  Rows without a label are a class
    of their own, rows without a key one key."""
    salted = F.concat(F.lit(salt), F.coalesce(F.col(label).cast("string"), F.lit("null")), F.lit("|"),
                      F.coalesce(F.col(key).cast("string"), F.lit("")))
    return df.withColumn("split", _assign(hash_bucket(salted, "", MODULUS), names, weights))


def _hash52(key) -> "F.Column":
    """A 52-bit md5 prefix of the key: exact as a double, so it can order rows."""
    k = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(k), 1, 13), 16, 10).cast("bigint")


def exact_stratified_split(df: DataFrame, label: str = C.LABEL, key: str = C.KEY, weights=C.SPLIT_WEIGHTS,
                           names=C.SPLIT_NAMES, n_buckets: int | None = None) -> DataFrame:
    """D3, exact: each class is cut in the given proportions by position.

    Rows are ordered within their class by a 52-bit hash of the key, so all
    rows of one key stay together.  The position of each (class, hash) group
    comes from the two-level running counts (no per-class sort in one task);
    a class's cuts are the hashes of the first groups past each proportion, and
    rows are assigned by comparing their hash with their class's cuts: the rows
    themselves meet only the table of cuts, one row per class.  Proportions are
    exact up to the size of a hash group.  Rows without a label are a class of
    their own.
    """
    from txnlab.operators.ranking import running_totals
    hashed = df.withColumn("_h", _hash52(key))
    groups = materialize(hashed.groupBy(F.col(label).alias("_c"), "_h").agg(F.count(F.lit(1)).alias("_cnt")),
                         "strata-groups")
    ranked = running_totals(groups, "_h", ["_cnt"], group_cols=["_c"], n_buckets=n_buckets)
    sizes = groups.groupBy(F.col("_c").alias("_c2")).agg(F.sum("_cnt").alias("_n"))
    ranked = ranked.join(sizes, ranked["_c"].eqNullSafe(sizes["_c2"]))
    pos = (F.col("cum__cnt") - F.col("_cnt")).cast("double") / F.col("_n").cast("double")
    total, acc, aggs = float(sum(weights)), 0.0, []
    for i, w in enumerate(weights[:-1]):
        acc += w
        aggs.append(F.min(F.when(pos >= F.lit(acc / total), F.col("_h"))).alias(f"_cut{i}"))
    aggs = aggs or [F.lit(None).cast("long").alias("_cut0")]
    cuts = materialize(ranked.groupBy("_c").agg(*aggs), "strata-cuts")
    out = hashed.join(cuts, hashed[label].eqNullSafe(cuts["_c"]))
    expr = F.lit(names[-1])
    for i, name in reversed(list(enumerate(names[:-1]))):
        cut = F.col(f"_cut{i}")
        expr = F.when(cut.isNull() | (F.col("_h") < cut), F.lit(name)).otherwise(expr)
    return out.select(*df.columns, expr.alias("split"))


def split_counts(df: DataFrame, label: str = C.LABEL, split: str = "split") -> DataFrame:
    """Rows, positives and positive ratio per split."""
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(label) == 1).alias("positives")
    ).withColumn("pos_ratio", F.coalesce(ratio6("positives", "rows"), F.lit(0.0)))


def class_weights(df: DataFrame, label: str = C.LABEL, mode: str = "ratio") -> DataFrame:
    """One row ``mode, n_neg, n_pos, weight_neg, weight_pos``.

    ``ratio``: positive n_neg/n_pos, negative 1.  ``balanced``: n/(2 n_c).
    Without positives every weight is 1.  MLlib divides by the weight sum, so
    the two modes give the same fit.
    """
    counts = df.agg(F.count_if(F.col(label) == 0).alias("n_neg"), F.count_if(F.col(label) == 1).alias("n_pos"))
    n_neg, n_pos = F.col("n_neg").cast("double"), F.col("n_pos").cast("double")
    if mode == "ratio":
        w_pos = F.when(F.col("n_pos") > 0, n_neg / n_pos).otherwise(F.lit(1.0))
        w_neg = F.lit(1.0)
    elif mode == "balanced":
        n = n_neg + n_pos
        ok = (F.col("n_pos") > 0) & (F.col("n_neg") > 0)
        w_pos = F.when(ok, n / (2.0 * n_pos)).otherwise(F.lit(1.0))
        w_neg = F.when(ok, n / (2.0 * n_neg)).otherwise(F.lit(1.0))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return counts.select(F.lit(mode).alias("mode"), "n_neg", "n_pos", w_neg.alias("weight_neg"),
                         w_pos.alias("weight_pos"))


def stratified_sample(df: DataFrame, label: str = C.LABEL, fractions=None, seed: int = C.SEED,
                      weight_col: str = "sample_weight") -> DataFrame:
    """``sampleBy`` per class; each kept row carries ``1/fraction`` so counts
    taken on the sample estimate counts on the whole."""
    fractions = dict(fractions or C.SAMPLE_FRACTIONS)
    sampled = df.sampleBy(label, fractions=fractions, seed=seed)
    w = None
    for cls, frac in fractions.items():
        wt = 1.0 / frac if frac > 0 else 0.0
        w = F.when(F.col(label) == cls, wt) if w is None else w.when(F.col(label) == cls, wt)
    return sampled.withColumn(weight_col, w.otherwise(F.lit(1.0)))


COPIES_AT_ONCE = 1 << 16  # copies of one row that one task numbers
_BITS = 12                # of a key, that one histogram resolves


def _unit_cut(share: float) -> int:
    """The 64-bit key below which ``share`` of all keys lie."""
    return max(-(1 << 63), min((1 << 63) - 1, int(share * 2.0 ** 64) - (1 << 63)))


def kth_key(keys: DataFrame, k: int, key: str = "key") -> tuple[int, int]:
    """The k-th smallest (from 1) of a column of 64-bit numbers, and how many of its
    equals belong to the k smallest.  Histograms over ever fewer leading bits, each
    an aggregation to at most ``2 ** _BITS`` rows within the bin that holds the
    k-th; no sort."""
    shift, inside = 64, keys
    while True:
        step = min(_BITS, shift)
        shift -= step
        bins = inside.groupBy(F.shiftright(key, shift).alias("b")).agg(F.count(F.lit(1)).alias("n"))
        for b, n in sorted(tuple(r) for r in bins.collect()):
            if k <= n:
                break
            k -= n
        else:
            raise ValueError("k is more than the number of keys")
        if shift == 0:
            return b, k
        inside = keys.filter(F.shiftright(key, shift) == b)


def exact_sample(df: DataFrame, k: int, seed: int = C.SEED) -> DataFrame:
    """A uniform sample of exactly ``k`` rows (all, where there are fewer),
    without sorting the rows or bringing them to one task.

    Every row has a 64-bit key, a hash of its values and of its number among the
    rows that equal it, so that repeated rows are drawn one by one and the same
    rows give the same sample, however they are dealt.  Rows are told apart by 128
    bits of hashes; these are counted (the only shuffle that grows with the
    rows), each hash's copies numbered in slices, and keys that can be among the
    k smallest written.  ``kth_key`` finds the last one.  A row without an equal
    decides by itself; of repeated ones, as many copies as they have keys in the
    sample are taken.
    """
    n = df.count()
    if k >= n:
        return df
    if k <= 0:
        return df.filter(F.lit(False))
    cols = [F.col(f"`{c}`") for c in df.columns]
    a, b = (F.xxhash64(*cols, F.lit(seed + i)) for i in (0, 1))

    def key(copy):
        return F.xxhash64("_sample_a", "_sample_b", copy)
    row = ["_sample_a", "_sample_b"]
    counts = df.select(a.alias(row[0]), b.alias(row[1])).groupBy(*row).agg(F.count(F.lit(1)).alias("_sample_n"))
    counts = materialize(counts, "sample-counts")
    zero = F.lit(0).cast("long")
    slices = F.sequence(zero, F.floor((F.col("_sample_n") - 1) / COPIES_AT_ONCE))
    slices = counts.withColumn("_sample_s", F.explode(slices))
    # slices of one row's copies go to different tasks
    big = slices.filter("_sample_s > 0").repartition("_sample_a", "_sample_s")
    slices = slices.filter("_sample_s = 0").unionByName(big)
    first = F.col("_sample_s") * COPIES_AT_ONCE
    last = F.least(first + COPIES_AT_ONCE, F.col("_sample_n")) - 1
    each = slices.select("_sample_a", "_sample_b", F.explode(F.sequence(first, last)).alias("_sample_c"))
    each = each.select("_sample_a", "_sample_b", key(F.col("_sample_c")).alias("key"))
    share = (k + 5.0 * k ** 0.5 + 10) / n
    while True:  # more than once only where chance leaves fewer than k below the cut
        near = each if share >= 1 else each.filter(F.col("key") < F.lit(_unit_cut(share)))
        near = materialize(near, "sample-keys")
        if near.count() >= k:
            break
        share *= 2
    cut, ties = kth_key(near, k)
    drawn = near.filter(F.col("key") < F.lit(cut)).select(*row)
    # equal keys of different rows are next to impossible; the few are told by their hashes
    last = near.filter(F.col("key") == F.lit(cut)).orderBy(*row).limit(ties)
    times = drawn.unionByName(last.select(*row)).groupBy(*row).agg(F.count(F.lit(1)).alias("_sample_m"))
    many = counts.filter("_sample_n > 1").join(times.select(*row), row).select(*row, F.lit(True).alias("_sample_many"))
    times = materialize(times.join(many, row, "left"), "sample-drawn")
    keyed = df.withColumn(row[0], a).withColumn(row[1], b)
    once = times.filter("_sample_many IS NULL").select(*row)
    once = keyed.filter(key(zero) <= F.lit(cut)).join(once, row, "left_semi")
    again = keyed.join(times.filter("_sample_many"), row).dropDuplicates(row)
    again = again.withColumn("_sample_c", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_sample_m"))))
    return once.select(*cols).unionAll(again.select(*cols))


def sample_cap(df: DataFrame, fraction: float, cap: int, seed: int = C.SEED) -> DataFrame:
    """``fraction`` of the rows, ``cap`` at most: an ``exact_sample`` of the smaller
    number (sampling is the feature)."""
    return exact_sample(df, min(cap, int(df.count() * fraction + 0.5)), seed)


def downsample(df: DataFrame, label: str = C.LABEL, k: float = 1.0, key: str = C.KEY,
               salt: str = "down") -> DataFrame:
    """Keep every positive and about ``k`` negatives per positive.

    The keep decision is a hash of the key against ``k * n_pos / n_neg``
    (one scalar subquery), so the sample is repeatable.
    """
    counts = df.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n"))
    frac = counts.select(
        F.coalesce(F.try_divide(F.lit(float(k)) * F.col("p").cast("double"), F.col("n").cast("double")),
                   F.lit(0.0))
    ).scalar()
    keep = (F.col(label) == 1) | (hash_unit(key, salt) < frac)
    return df.filter(keep)
