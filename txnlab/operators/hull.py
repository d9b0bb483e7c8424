"""Isotonic calibration and cost-optimal thresholds over all distinct scores.

Both are one shape: rows in order of score are pooled into blocks whose share of
positives rises strictly from block to block (pool adjacent violators).  The
shares are the isotonic calibration; the borders between blocks are the corners
of the ROC curve's upper hull, that is the only thresholds that are best at any
ratio of costs.

Rows are grouped by score first, so a hot score is one row.  Value ranges
(``ranking.range_ids``) are pooled each in a task with a monotone stack, and
neighbouring ranges' blocks are pooled again, ``FAN`` at a time, until one range is
left.  Pooling blocks gives what pooling their rows gives, so the tree changes
nothing.  A task's input is bounded: a range holds about ``rowsPerRange`` scores, and
as counts are whole numbers, the blocks of N rows are sides of a convex chain
between lattice points with increasing slopes, of which there are O(N^(2/3)).
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnlab.functions.columns import ratio6
from txnlab.operators.evaluate import LABEL, SCORE, scored_rows
from txnlab.operators.ranking import BUCKET, range_ids
from txnlab.session import materialize

FAN = 64                       # neighbouring ranges pooled in one task at each level
BLOCKS_AT_ONCE = 1_000_000     # blocks that go to every task as arrays (40 MB); more are met by range
_PART = "at long, lo double, hi double, n long, pos long"


def pool(rows: Iterable[tuple]) -> list[list]:
    """Blocks [lo, hi, n, pos] of ``rows`` (lo, hi, n, pos) in order: a row joins the
    block before it while that one's share of positives is not below its own."""
    out: list[list] = []
    for lo, hi, n, pos in rows:
        while out and out[-1][3] * n >= pos * out[-1][2]:
            lo, _, m, p = out.pop()
            n, pos = n + m, pos + p
        out.append([lo, hi, n, pos])
    return out


def _pooled(rows: DataFrame) -> DataFrame:
    """One pooling per value of ``at``."""
    def run(table: pa.Table) -> pa.Table:
        t = table.sort_by("lo")
        blocks = pool(zip(*(t.column(c).to_pylist() for c in ("lo", "hi", "n", "pos"))))
        cols = list(zip(*blocks)) if blocks else [[]] * 4
        kinds = (pa.float64(), pa.float64(), pa.int64(), pa.int64())
        at = pa.array([t.column("at")[0].as_py()] * len(blocks), pa.int64())
        return pa.Table.from_arrays([at, *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                                    ["at", "lo", "hi", "n", "pos"])

    return rows.groupBy("at").applyInArrow(run, _PART)


def score_blocks(scored: DataFrame, score: str = SCORE, label: str = LABEL, weight_col: str | None = None,
                 n_buckets: int | None = None) -> DataFrame:
    """(lo, hi, n, pos), written: the pooled blocks of all scores that are
    numbers, ``n`` rows with ``pos`` positives from ``lo`` to ``hi``.  ``weight_col``
    is a whole number of rows that a row stands for."""
    w = F.col(weight_col).cast("long") if weight_col else F.lit(1)
    s = scored_rows(scored, score).filter(F.col(label).isNotNull())
    # 0.0 and -0.0 are one score
    per = s.groupBy((F.col(score).cast("double") + F.lit(0.0)).alias("x")).agg(
        F.sum(w).cast("long").alias("n"), F.sum(F.when(F.col(label) == 1, w).otherwise(0)).cast("long").alias("pos"))
    per = materialize(per.filter("n > 0"), "hull-scores")
    ranged = range_ids(per, "x", n_buckets)
    blocks = materialize(_pooled(ranged.select(F.col(BUCKET).alias("at"), F.col("x").alias("lo"), F.col("x").alias("hi"),
                                               "n", "pos")), "hull-blocks")
    left = (blocks.agg(F.max("at")).first()[0] or 0) + 1
    while left > 1:
        up = blocks.withColumn("at", F.floor(F.col("at") / FAN))
        blocks = materialize(_pooled(up), "hull-blocks")
        left = -(-left // FAN)
    return blocks.drop("at")


# ----------------------------------------------------------------- calibration
def isotonic_steps(blocks: DataFrame) -> DataFrame:
    """``lo, hi, n, pos, rate``: the calibrated value of each block of scores."""
    return blocks.select("lo", "hi", "n", "pos", ratio6("pos", "n").alias("rate"))


def _corners(table) -> tuple[np.ndarray, np.ndarray]:
    """Scores and values between which the calibration is drawn straight."""
    rows = sorted(table)
    x = np.array([v for r in rows for v in r[:2]], dtype=float)
    y = np.repeat(np.array([r[3] / r[2] for r in rows], dtype=float), 2)
    return x, y


def apply_isotonic_steps(blocks: DataFrame, scored: DataFrame, score: str = SCORE,
                         at_once: int = BLOCKS_AT_ONCE) -> DataFrame:
    """``scored`` with ``score`` calibrated: the block's value from lo to hi, a straight
    line from a block to the next, the outermost values beyond them; null and NaN
    stay as they are, and without any block every score becomes null.

    Up to ``at_once`` blocks go to the tasks as arrays; more are cut into ranges that
    begin at a block, and distinct scores meet their range's blocks there."""
    kept = [F.col(f"`{c}`") if c != score else F.col("_iso").alias(score) for c in scored.columns]
    key = F.col(f"`{score}`").cast("double")
    n = blocks.count()
    if n == 0:
        return scored.withColumn("_iso", F.lit(None).cast("double")).select(*kept)
    if n <= at_once:
        x, y = _corners([tuple(r) for r in blocks.select("lo", "hi", "n", "pos").collect()])

        @F.pandas_udf("double")
        def value(s):
            return s.where(s.isna(), np.interp(s.to_numpy(dtype=float, na_value=np.nan), x, y))
        return scored.withColumn("_iso", value(key)).select(*kept)
    cuts = sorted(set(blocks.approxQuantile("lo", [i * at_once / n for i in range(1, -(-n // at_once))], 0.01)))
    b = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="lo", outputCol="at")
    # each range needs the block after it, to draw the line to it
    heads = b.transform(blocks).groupBy("at").agg(F.min(F.struct("lo", "hi", "n", "pos")).alias("r"))
    heads = heads.select((F.col("at") - 1).alias("at"), "r.*")
    parts = b.transform(blocks).select("at", "lo", "hi", "n", "pos").unionByName(heads)
    xs = scored_rows(scored, score).select(key.alias("lo")).distinct()
    xs = b.transform(xs)

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        s = right.column("lo")
        if left.num_rows and right.num_rows:
            x, y = _corners(zip(*(left.column(c).to_pylist() for c in ("lo", "hi", "n", "pos"))))
            v = pa.array(np.interp(s.to_numpy(), x, y))
        else:
            v = pa.nulls(right.num_rows, pa.float64())
        return pa.Table.from_arrays([s, v], ["_x", "_iso"])

    values = parts.groupBy("at").cogroup(xs.groupBy("at")).applyInArrow(meet, "_x double, _iso double")
    out = scored.join(values, key == F.col("_x"), "left")
    return out.withColumn("_iso", F.when(F.isnan(key), key).otherwise(F.col("_iso"))).select(*kept)


# ------------------------------------------------------------------ thresholds
def optimal_thresholds(blocks: DataFrame) -> DataFrame:
    """E2 for every cost ratio at once: ``threshold, fp_count, fn_count, tp_count,
    ratio_from, ratio_to``: flagging scores from ``threshold`` on (null: none) costs
    least exactly where the cost of a miss over that of a false alarm is in
    [ratio_from, ratio_to) (null: no end).  At a border, where both sides cost
    the same, the lower threshold is listed.

    One window over the blocks, as few as the last pooling's task held."""
    order = Window.partitionBy(F.lit(0)).orderBy("lo")
    neg = F.col("n") - F.col("pos")
    b = blocks.select("lo", "pos", neg.alias("neg")).select(
        "lo", "pos", "neg", F.sum("pos").over(order).alias("pos_to"), F.sum("neg").over(order).alias("neg_to"),
        F.lag("pos").over(order).alias("pos0"), F.lag("neg").over(order).alias("neg0"),
        F.lead("lo").over(order).alias("next"), *[F.sum(c).over(Window.partitionBy(F.lit(0))).alias(f"all_{c}")
                                                  for c in ("pos", "neg")])
    # from a block on: worth it where ratio * pos >= neg; the block before asks for more
    some = b.filter("pos > 0").select(
        F.col("lo").alias("threshold"), (F.col("all_neg") - F.col("neg_to") + F.col("neg")).alias("fp_count"),
        (F.col("pos_to") - F.col("pos")).alias("fn_count"),
        (F.col("all_pos") - F.col("pos_to") + F.col("pos")).alias("tp_count"),
        ratio6("neg", "pos").alias("ratio_from"), F.when(F.col("pos0") > 0, ratio6("neg0", "pos0")).alias("ratio_to"))
    none = b.filter("next IS NULL AND neg > 0").select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0).cast("long").alias("fp_count"),
        F.col("all_pos").alias("fn_count"), F.lit(0).cast("long").alias("tp_count"), F.lit(0.0).alias("ratio_from"),
        ratio6("neg", "pos").alias("ratio_to"))
    return some.unionByName(none)


def best_threshold_at(corners: DataFrame, ratios) -> DataFrame:
    """``ratio`` and the corner of ``optimal_thresholds`` that is best at it, with its cost
    (a false alarm costs 1).  Exact unless a ratio is within 1e-6 of a border."""
    per = corners.withColumn("ratio", F.explode(F.array(*[F.lit(float(r)) for r in ratios])))
    per = per.filter((F.col("ratio") >= F.col("ratio_from")) & (F.col("ratio_to").isNull() | (F.col("ratio") < F.col("ratio_to"))))
    return per.select("ratio", "threshold", "fp_count", "fn_count",
                      (F.col("fp_count") + F.col("ratio") * F.col("fn_count")).alias("cost"))
