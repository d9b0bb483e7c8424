"""The decide path: score -> cost curve -> tau* -> confusion -> metrics.

``flagship`` is the whole path over one scored set in a single distributed
aggregation: the (bucket, label) counts give the confusion counts at every
grid threshold, so tau* and its precision/recall/F1 come from the same
99-row table.  ``validate_then_test`` is the held-out form: tau* is chosen on
the validation split and enters the test-set plan as a scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlab import config as C
from txnlab.functions.columns import r6
from txnlab.operators import evaluate as E
from txnlab.session import materialize


def flagship(scored: DataFrame, c_fp: float = C.COST_FP, c_fn: float = C.COST_FN,
             steps: int = C.GRID_STEPS) -> DataFrame:
    """One row: ``tau_star, min_cost, tp, fp, tn, fn, precision, recall, f1``."""
    tc = E.threshold_counts(scored, steps).withColumn(
        "cost", F.col("fp") * F.lit(float(c_fp)) + F.col("fn") * F.lit(float(c_fn))
    ).withColumn("rows", F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn"))
    best = tc.filter(F.col("rows") > 0).agg(
        F.min_by(F.struct("threshold", "cost", "tp", "fp", "tn", "fn"), F.struct("cost", "threshold")).alias("b")
    ).select("b.*").filter(F.col("threshold").isNotNull())
    out = E.prf(best)
    return out.select(
        F.col("threshold").alias("tau_star"), r6("cost").alias("min_cost"), "tp", "fp", "tn", "fn",
        "precision", "recall", "f1",
    )


def split_counts_table(scored_split: DataFrame, bins: int | None = None) -> DataFrame:
    """Positives and negatives per (split, score), written once.

    This is the only table the decide path keeps: its size is the number of
    distinct scores per split (at most 1e6 per split for 6-decimal scores, or
    ``bins`` with pooling), not the number of rows, so tau*, confusion
    counts, AUCs and curves all run on a small table however large the
    scored set is.
    """
    if bins:
        # model probabilities are near-continuous: pooling them on a 1/bins grid
        # bounds the table at `bins` rows per split; confusion counts at grid
        # thresholds coarser than 1/bins are unchanged, AUCs move only by ties
        counts = E.score_counts(scored_split, group_cols=["split"], mode="binned", bins=bins)
    else:
        counts = E.score_counts(scored_split, group_cols=["split"])
    return materialize(counts, "split-score-counts")


def counts_of(counts: DataFrame, name: str) -> DataFrame:
    return counts.filter(F.col("split") == name).drop("split")


def rows_of(counts: DataFrame, name: str) -> DataFrame:
    """One split's counts as ``score, label, n`` rows (use ``weight_col="n"``)."""
    return E.counts_as_rows(counts_of(counts, name))


def validation_tau(counts: DataFrame, c_fp: float = C.COST_FP, c_fn: float = C.COST_FN):
    """tau* on the validation split, as a scalar-subquery Column."""
    return E.tau_star(rows_of(counts, "validation"), c_fp, c_fn, weight_col="n")


def validate_then_test(counts: DataFrame, **kw) -> DataFrame:
    """E16 on the test split at the validation tau*."""
    return E.metrics_record(None, validation_tau(counts, **kw), counts=counts_of(counts, "test"))
