"""Exact running totals and exact quantiles without a single-task sort.

A global ``Window.orderBy`` moves every row into one task.  Instead the
ordering key is cut into value ranges; each range gets the exact total of every
range before it from a small per-range table, and the running sum inside a
range is an ordinary window partitioned by the range id.  The join that
attaches the offsets and the window are keyed on the same columns, so the big
side is shuffled once.  Every input takes this path, whatever its size.

Inputs must have a unique ordering key per group (callers group by the value
first), so a value shared by a third of all rows is a single row here and no
range can be hot.  Rows without an ordering key (null) have no place in the
order and are left out.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnlab.session import materialize

BUCKET = "_range_id"


ROWS_PER_RANGE_CONF = "spark.txnlab.rowsPerRange"
DEFAULT_ROWS_PER_RANGE = 2_000_000
# one level of boundaries: what reaches the driver, and what a range is cut
# into at each further level
FAN_OUT = 128


def default_buckets(df: DataFrame) -> int:
    """Value ranges so that a range holds about ``rowsPerRange`` rows at most.
    Callers pass written tables, so the count is answered from file metadata."""
    per = int(df.sparkSession.conf.get(ROWS_PER_RANGE_CONF, str(DEFAULT_ROWS_PER_RANGE)))
    return max(1, -(-df.count() // max(1, per)))


def range_ids(df: DataFrame, order_col: str, n_buckets: int | None = None) -> DataFrame:
    """Adds ``_range_id``: the index of the value range ``order_col`` falls in.

    The first up to ``FAN_OUT`` ranges are cut at approximate quantiles.  Where
    more are needed, each range is cut again at its own approximate quantiles,
    aggregated on the executors (one array per range), until there are enough.
    """
    k = n_buckets or default_buckets(df)
    first = min(k, FAN_OUT)
    bounds: list[float] = []
    if first > 1:
        probs = [i / first for i in range(1, first)]
        bounds = df.approxQuantile(order_col, probs, min(0.01, 0.25 / first))
        bounds = sorted({float(b) for b in bounds if abs(b) != float("inf")})
    key = F.col(order_col).cast("double")
    if not bounds:
        out = df.withColumn(BUCKET, F.lit(0).cast("long"))
    else:
        splits = [float("-inf")] + bounds + [float("inf")]
        out = Bucketizer(splits=splits, inputCol="_range_key", outputCol="_range_at", handleInvalid="keep").transform(
            df.withColumn("_range_key", key))
        out = out.withColumn(BUCKET, F.col("_range_at").cast("long")).drop("_range_key", "_range_at")
    done = first
    while done < k:
        fan = min(FAN_OUT, -(-k // done))
        cuts = out.groupBy(BUCKET).agg(F.percentile_approx(
            key, [i / fan for i in range(1, fan)], 100 * fan).alias("_cuts"))
        # no more than k boundaries in all, k being rows / rowsPerRange
        out = out.join(F.broadcast(cuts), BUCKET)
        at = F.size(F.filter("_cuts", lambda c: c <= key))
        out = out.withColumn(BUCKET, F.col(BUCKET) * fan + at).drop("_cuts")
        done *= fan
    return out


def running_totals(
    df: DataFrame,
    order_col: str,
    sum_cols: list[str],
    group_cols: tuple[str, ...] | list[str] = (),
    descending: bool = False,
    n_buckets: int | None = None,
    prefix: str = "cum_",
) -> DataFrame:
    """Adds ``cum_<c>``: the sum of ``c`` over rows up to and including this one.

    Rows are ordered by ``order_col`` (ascending, or descending) within
    ``group_cols``; ``(group_cols, order_col)`` must be unique.
    """
    group_cols = list(group_cols)
    value_order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    ranged = range_ids(df.filter(F.col(order_col).isNotNull()), order_col, n_buckets)
    totals = ranged.groupBy(*group_cols, BUCKET).agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols])
    bucket_order = F.col(BUCKET).desc() if descending else F.col(BUCKET).asc()
    w_before = Window.partitionBy(*group_cols).orderBy(bucket_order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *group_cols,
        BUCKET,
        *[F.coalesce(F.sum(f"_t_{c}").over(w_before), F.lit(0)).alias(f"_off_{c}") for c in sum_cols],
    )
    keys = group_cols + [BUCKET]
    offsets = offsets.select(*[F.col(c).alias(f"_k_{c}") for c in keys], *[f"_off_{c}" for c in sum_cols])
    same = None
    for c in keys:
        eq = F.col(c).eqNullSafe(F.col(f"_k_{c}"))
        same = eq if same is None else same & eq
    joined = ranged.join(offsets, same)
    w_in = (
        Window.partitionBy(*group_cols, BUCKET)
        .orderBy(value_order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    out = joined.select(
        *[c for c in df.columns],
        *[(F.col(f"_off_{c}") + F.sum(c).over(w_in)).alias(f"{prefix}{c}") for c in sum_cols],
    )
    return out


ACCURACY = 10_000  # of the approximate quantiles that bracket the exact ones


def number(c) -> Column:
    """A column's value as a double; NaN, like null, is no value."""
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def _holds(below: int, inside: int, pos: float) -> bool:
    """Whether a bracket with so many values below and inside has those at rank ``pos``."""
    return below <= math.floor(pos) and below + inside > math.ceil(pos)


def exact_quantiles(
    df: DataFrame,
    cols: list[str] | tuple[str, ...],
    probs: list[float] | tuple[float, ...],
    n_buckets: int | None = None,
) -> DataFrame:
    """Exact linear-interpolation quantiles (Spark ``percentile`` semantics).

    Returns long form ``column, prob, n, value``; a column without values has
    its rows too, with n = 0 and a null value.  The columns' numbers are written
    first.  One pass of approximate quantiles brackets each target rank by a known
    error; then the values below the bracket are counted and those inside kept, a
    few per ten thousand, and the exact ranks are found among those by running
    counts.  A bracket that turns out not to hold its rank is widened to the whole
    column and counted again.
    """
    cols, probs = list(cols), [float(p) for p in probs]
    # what ``df`` derives its columns from is read once; the passes read the numbers
    df = materialize(df.select(*[number(c).alias(f"v{i}") for i, c in enumerate(cols)]), "quantile-columns")
    names, cols = cols, [f"v{i}" for i in range(len(cols))]
    eps = 3.0 / ACCURACY
    points = sorted({x for p in probs for x in (p - eps, p + eps) if 0 < x < 1})
    aggs = []
    for i, c in enumerate(cols):
        aggs.append(F.count(number(c)).alias(f"n{i}"))
        if points:
            aggs.append(F.percentile_approx(number(c), points, ACCURACY).alias(f"q{i}"))
    found = df.agg(*aggs).first()  # a few numbers per column
    inf = float("inf")
    spans = []
    for i, c in enumerate(cols):
        n = found[f"n{i}"]
        # a bracket is some ranks wide; where that is no share of the rows to
        # speak of, it is all of them
        q = dict(zip(points, found[f"q{i}"] or [])) if points and n * eps >= 4 else {}
        for j, p in enumerate(probs):
            spans.append((i, j, q.get(p - eps, -inf), q.get(p + eps, inf), n))
    live = [x for x in spans if x[4]]
    spark = df.sparkSession
    pos = [(names[i], probs[j], n, i, j, probs[j] * max(0, n - 1)) for i, j, _, _, n in spans]
    targets = spark.createDataFrame(pos, "column string, prob double, n long, i int, j int, pos double").select(
        "column", "prob", "n", "i", "j", "pos", F.floor("pos").alias("lo"), F.ceil("pos").alias("hi"))
    if not live:
        return targets.select("column", "prob", "n", F.lit(None).cast("double").alias("value"))
    while True:
        counted = df.agg(*[F.count_if(number(cols[i]) < lo).alias(f"b{i}_{j}") for i, j, lo, _, _ in live]).first()
        inside = F.array(*[F.when(number(cols[i]).between(lo, hi), F.struct(
            F.lit(i).alias("i"), F.lit(j).alias("j"), number(cols[i]).alias("value"))) for i, j, lo, hi, _ in live])
        near = df.select(F.explode(F.filter(inside, lambda x: x.isNotNull())).alias("x")).select("x.*")
        near = materialize(near.groupBy("i", "j", "value").agg(F.count(F.lit(1)).alias("cnt")), "quantile-brackets")
        held = {(r.i, r.j): r.n for r in near.groupBy("i", "j").agg(F.sum("cnt").alias("n")).collect()}
        missed = {(i, j) for i, j, _, _, n in live if not _holds(
            counted[f"b{i}_{j}"], held.get((i, j), 0), probs[j] * max(0, n - 1))}
        if not missed:
            break
        # an estimate further off than it says: take the whole column
        live = [(i, j, -inf, inf, n) if (i, j) in missed else (i, j, lo, hi, n) for i, j, lo, hi, n in live]
    below = spark.createDataFrame([(i, j, counted[f"b{i}_{j}"]) for i, j, *_ in live], "i int, j int, below long")
    rt = running_totals(near, "value", ["cnt"], group_cols=["i", "j"], n_buckets=n_buckets)
    want = targets.join(below, ["i", "j"])  # a row per column and quantile
    hit = rt.join(F.broadcast(want), ["i", "j"])
    before = F.col("below") + F.col("cum_cnt") - F.col("cnt")
    upto = F.col("below") + F.col("cum_cnt")
    at = lambda r: F.max(F.when((before <= F.col(r)) & (upto > F.col(r)), F.col("value")))
    per = hit.groupBy("i", "j").agg(at("lo").alias("v_lo"), at("hi").alias("v_hi"))
    value = F.when(
        (F.col("hi") == F.col("lo")) | (F.col("v_hi") == F.col("v_lo")), F.col("v_lo")
    ).otherwise(
        (F.col("hi") - F.col("pos")) * F.col("v_lo") + (F.col("pos") - F.col("lo")) * F.col("v_hi")
    )
    return targets.join(per, ["i", "j"], "left").select("column", "prob", "n", value.alias("value"))


def quantile_scalar(df: DataFrame, col: str, prob: float, n_buckets: int | None = None) -> Column:
    """The exact quantile of one column as a scalar-subquery Column (no collect)."""
    q = exact_quantiles(df, [col], [prob], n_buckets)
    return q.select("value").scalar()
