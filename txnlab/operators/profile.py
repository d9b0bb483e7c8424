"""Table profiles as distributed aggregations.

Each operator is one aggregation (partial aggregation on the map side, a tiny
final merge), so a group that holds a third of all rows is combined before any
shuffle.  ``quality_checks`` folds the null, negative, zero and balance checks
into a single scan.  Results are long-form tables whose size is fixed by the
number of columns asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlab import config as C
from txnlab.functions.columns import balance_ok_payee, balance_ok_payer, r6, ratio6
from txnlab.operators.ranking import exact_quantiles, number


def _rows(items: list[Column]) -> Column:
    """Turn one wide row into several long rows."""
    return F.explode(F.array(*items))


# --------------------------------------------------------------------- S2, S7
def schema_report(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Per expected column: present, actual type, type ok, null count.

    Null counts come from one aggregation; type names come from the schema.
    """
    actual = {f.name: f.dataType for f in df.schema.fields}
    present = [f.name for f in expected.fields if f.name in actual]
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in present]) if present else None
    items = []
    for f in expected.fields:
        act = actual.get(f.name)
        nulls = F.col(f.name) if f.name in actual else F.lit(None).cast("long")
        items.append(
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("expected_type"),
                F.lit(act.simpleString() if act else None).cast("string").alias("actual_type"),
                F.lit(act is not None).alias("present"),
                F.lit(act == f.dataType).alias("type_ok"),
                nulls.cast("long").alias("null_count"),
            )
        )
    base = counts if counts is not None else df.sparkSession.range(1)
    return base.select(_rows(items).alias("r")).select("r.*")


def contract_report(text: DataFrame, expected: T.StructType) -> DataFrame:
    """A table read as strings against the contract, one row per column:
    expected or extra, present, null values, and values that aren't of the
    expected type.  One pass; nothing fails on the first bad value."""
    kinds = {f.name: f.dataType.simpleString() for f in expected.fields}
    names = list(kinds) + [c for c in text.columns if c not in kinds]
    aggs, items = [F.count(F.lit(1)).alias("_rows")], []
    for i, c in enumerate(names):
        here = c in text.columns
        if here:
            x = F.col(f"`{c}`")
            bad = x.isNotNull() & x.try_cast(kinds[c]).isNull() if c in kinds else F.lit(False)
            aggs += [F.count_if(x.isNull()).alias(f"_n{i}"), F.count_if(bad).alias(f"_b{i}")]
        items.append(F.struct(
            F.lit(c).alias("column"), F.lit(kinds.get(c)).cast("string").alias("expected_type"),
            F.lit(here).alias("present"), F.lit(c not in kinds).alias("extra"),
            (F.col(f"_n{i}") if here else F.lit(None).cast("long")).alias("null_count"),
            (F.col(f"_b{i}") if here else F.lit(None).cast("long")).alias("bad_values")))
    return text.agg(*aggs).select(_rows(items).alias("r")).select("r.*")


def fingerprint(df: DataFrame, cols=None) -> DataFrame:
    """Rows, columns and an order-free content fingerprint.

    ``bit_xor`` of a row hash cancels pairs of duplicate rows, so a second
    component sums the hashes as decimal(38,0) (a long sum would overflow
    under ANSI mode).
    """
    cols = list(cols or df.columns)
    h = F.xxhash64(*[F.col(c) for c in cols])
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(cols)).alias("columns"),
        F.bit_xor(h).alias("hash_xor"),
        F.sum(h.cast("decimal(38,0)")).cast("string").alias("hash_sum"),
    )


# --------------------------------------------------------------------- A1-A4, A8
def null_counts(df: DataFrame, cols=None) -> DataFrame:
    """A1: ``column, null_count`` in one pass (0, not null, on an empty table)."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.select(
        _rows([F.struct(F.lit(c).alias("column"), F.col(c).alias("null_count")) for c in cols]).alias("r")
    ).select("r.*")


def duplicate_count(df: DataFrame, cols=None, method: str = "two_phase", row_hash: bool = False) -> DataFrame:
    """A2: rows minus distinct rows, as ``sum(count - 1)`` over full-row groups.

    ``two_phase`` (default, exact): shuffle only a 96-bit row hash
    (xxhash64 + murmur3) to find hash groups seen more than once, semi-join
    the rows to those candidates, and count full-row duplicates among them.
    Equal rows always share a hash and colliding hashes are separated by the
    full-row group, so the count is exact.  The candidates are written, so the
    semi join is planned by their measured size.  ``rows``: one full-row
    shuffle.  ``hash`` (or ``row_hash=True``): the hash groups alone, for rows
    too wide to shuffle, where a collision would count as a duplicate.
    A hot duplicated row is combined map-side by partial aggregation (and
    split by AQE's skew handling in the semi join).
    """
    cols = list(cols or df.columns)
    if row_hash:
        method = "hash"
    h1, h2 = F.xxhash64(*cols).alias("_h1"), F.hash(*cols).alias("_h2")
    if method == "hash":
        groups = df.select(h1, h2).groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n"))
    elif method == "rows":
        groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    elif method == "two_phase":
        from txnlab.session import materialize

        hashed = df.select(*cols, h1, h2)
        cand = materialize(
            hashed.groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
            .select("_h1", "_h2"), "duplicate-candidates")
        rows = hashed.join(cand, ["_h1", "_h2"], "left_semi")
        groups = rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    else:
        raise ValueError(f"unknown method {method!r}")
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def negative_counts(df: DataFrame, cols=C.NUMERIC_COLUMNS) -> DataFrame:
    """A3: one long column per numeric column: rows below zero."""
    return df.agg(*[F.count_if(F.col(c) < 0).alias(c) for c in cols])


def zero_count(df: DataFrame, col: str = "amount") -> DataFrame:
    """A4: rows where ``col`` is exactly zero."""
    return df.agg(F.count_if(F.col(col) == 0).alias(f"zero_{col}_rows"))


def balance_consistency(df: DataFrame, types=C.KEPT_TYPES, eps: float = C.BALANCE_EPS) -> DataFrame:
    """Rows of the kept types on which both balance identities hold."""
    kept = df.filter(F.col(C.TYPE).isin(*types))
    payer, payee = balance_ok_payer(eps), balance_ok_payee(eps)
    return kept.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(payer).alias("payer_ok_rows"),
        F.count_if(payee).alias("payee_ok_rows"),
        F.count_if(payer & payee).alias("both_ok_rows"),
    ).withColumn("both_ok_share", F.coalesce(ratio6("both_ok_rows", "rows"), F.lit(0.0)))


def quality_checks(df: DataFrame, cols=C.NUMERIC_COLUMNS, types=C.KEPT_TYPES,
                   eps: float = C.BALANCE_EPS) -> DataFrame:
    """A1 + A3 + A4 + A8 in one scan: ``check, column, value`` (long form)."""
    all_cols = list(df.columns)
    kept = F.col(C.TYPE).isin(*types)
    payer, payee = balance_ok_payer(eps), balance_ok_payee(eps)
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"null__{c}") for c in all_cols]
    aggs += [F.count_if(F.col(c) < 0).alias(f"neg__{c}") for c in cols]
    aggs += [
        F.count_if(F.col("amount") == 0).alias("zero__amount"),
        F.count_if(kept).alias("kept__rows"),
        F.count_if(kept & payer & payee).alias("kept__both_ok"),
    ]
    wide = df.agg(*aggs)
    items = [F.struct(F.lit("rows").alias("check"), F.lit(None).cast("string").alias("column"),
                      F.col("rows").alias("value"))]
    items += [F.struct(F.lit("null_count").alias("check"), F.lit(c).alias("column"),
                       F.col(f"null__{c}").alias("value")) for c in all_cols]
    items += [F.struct(F.lit("negative_count").alias("check"), F.lit(c).alias("column"),
                       F.col(f"neg__{c}").alias("value")) for c in cols]
    items += [
        F.struct(F.lit("zero_count").alias("check"), F.lit("amount").alias("column"), F.col("zero__amount").alias("value")),
        F.struct(F.lit("kept_rows").alias("check"), F.lit(None).cast("string").alias("column"),
                 F.col("kept__rows").alias("value")),
        F.struct(F.lit("balance_both_ok").alias("check"), F.lit(None).cast("string").alias("column"),
                 F.col("kept__both_ok").alias("value")),
    ]
    return wide.select(_rows(items).alias("r")).select("r.*")


# --------------------------------------------------------------------- A5-A7
def quantile_summary(df: DataFrame, cols=("amount",), probs=C.SUMMARY_PROBS, exact: bool = True,
                     accuracy: int = 10000) -> DataFrame:
    """A5: ``column, count, min, p50, p90, p99, max`` per column.

    ``exact`` uses distributed exact quantiles (interpolated as Spark's
    ``percentile``); otherwise ``percentile_approx`` in one pass.  NaN, like
    null, is no value; a column without values has a row with count 0.
    """
    cols = list(cols)
    names = [f"p{int(round(p * 100))}" for p in probs]
    if exact:
        q = exact_quantiles(df, cols, [0.0, *probs, 1.0])
        labels = F.when(F.col("prob") == 0.0, "min").when(F.col("prob") == 1.0, "max")
        for p, n in zip(probs, names):
            labels = labels.when(F.col("prob") == float(p), n)
        # n is constant per column, so it rides along as a grouping key: one
        # pass over the quantile table, no join back
        piv = (
            q.withColumn("stat", labels)
            .groupBy("column", "n")
            .pivot("stat", ["min", *names, "max"])
            .agg(F.first("value"))
        )
        return piv.select("column", F.col("n").alias("count"), *[r6(c).alias(c) for c in ["min", *names, "max"]])
    items = []
    aggs = []
    for c in cols:
        aggs += [
            F.count(number(c)).alias(f"{c}__count"),
            F.min(number(c)).alias(f"{c}__min"),
            F.percentile_approx(number(c), list(probs), accuracy).alias(f"{c}__q"),
            F.max(number(c)).alias(f"{c}__max"),
        ]
        items.append(
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"{c}__count").alias("count"),
                r6(f"{c}__min").alias("min"),
                *[r6(F.col(f"{c}__q")[i]).alias(n) for i, n in enumerate(names)],
                r6(f"{c}__max").alias("max"),
            )
        )
    return df.agg(*aggs).select(_rows(items).alias("r")).select("r.*")


def describe_numeric(df: DataFrame, cols=C.NUMERIC_COLUMNS) -> DataFrame:
    """``column, count, mean, stddev, min, max`` (sample stddev), one pass."""
    cols = list(cols)
    aggs = []
    items = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__n"), F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__sd"),
                 F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
        items.append(F.struct(F.lit(c).alias("column"), F.col(f"{c}__n").alias("count"),
                              r6(f"{c}__mean").alias("mean"), r6(f"{c}__sd").alias("stddev"),
                              r6(f"{c}__min").alias("min"), r6(f"{c}__max").alias("max")))
    return df.agg(*aggs).select(_rows(items).alias("r")).select("r.*")


def skew_report(df: DataFrame, cols=C.NUMERIC_COLUMNS) -> DataFrame:
    """Skew evidence per column: stddev > mean, max / p99, skewness."""
    cols = list(cols)
    aggs, items = [], []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__sd"),
                 F.skewness(x).alias(f"{c}__skew"), F.max(x).alias(f"{c}__max")]
        items.append(F.struct(F.lit(c).alias("column"), F.col(f"{c}__mean").alias("mean"),
                              F.col(f"{c}__sd").alias("stddev"), F.col(f"{c}__skew").alias("skewness"),
                              F.col(f"{c}__max").alias("max")))
    moments = df.agg(*aggs).select(_rows(items).alias("r")).select("r.*")
    p99 = exact_quantiles(df, cols, [0.99]).select("column", F.col("value").alias("p99"))
    j = moments.join(p99, "column", "left")
    return j.select(
        "column",
        r6("mean").alias("mean"),
        r6("stddev").alias("stddev"),
        r6("skewness").alias("skewness"),
        r6("p99").alias("p99"),
        r6("max").alias("max"),
        r6(F.try_divide(F.col("max"), F.col("p99"))).alias("max_over_p99"),
        (F.col("stddev") > F.col("mean")).alias("std_gt_mean"),
    )


# --------------------------------------------------------------------- A9-A12, A17
def type_label_counts(df: DataFrame, label: str = C.LABEL) -> DataFrame:
    """Rows by ``type`` and label."""
    return df.groupBy(C.TYPE, label).agg(F.count(F.lit(1)).alias("count"))


def type_label_pivot(df: DataFrame, label: str = C.LABEL) -> DataFrame:
    """A10: ``type, not_fraud, fraud`` with 0 for a missing cell."""
    return df.groupBy(C.TYPE).agg(
        F.count_if(F.col(label) == 0).alias("not_fraud"),
        F.count_if(F.col(label) == 1).alias("fraud"),
    )


def fraud_rate_by_type(df: DataFrame, label: str = C.LABEL) -> DataFrame:
    """Total, fraud and fraud rate by type."""
    return df.groupBy(C.TYPE).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col(label) == 1).alias("fraud")
    ).withColumn("fraud_rate", F.coalesce(ratio6("fraud", "total"), F.lit(0.0)))


def selection_effect(df: DataFrame, types=C.KEPT_TYPES, label: str = C.LABEL) -> DataFrame:
    """Rows and label density before and after the type filter, one pass."""
    kept = F.col(C.TYPE).isin(*types)
    agg = df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(kept).alias("rows_after"),
        F.count_if(F.col(label) == 1).alias("pos_before"),
        F.count_if(kept & (F.col(label) == 1)).alias("pos_after"),
    )
    return agg.select(
        "rows_before",
        "rows_after",
        F.coalesce(ratio6(F.col("rows_before") - F.col("rows_after"), F.col("rows_before")), F.lit(0.0)).alias("reduction"),
        F.coalesce(ratio6("pos_before", "rows_before"), F.lit(0.0)).alias("density_before"),
        F.coalesce(ratio6("pos_after", "rows_after"), F.lit(0.0)).alias("density_after"),
    )


def account_clearing(df: DataFrame, label: str = C.LABEL) -> DataFrame:
    """Share of rows that empty the payer's account, by type and label."""
    return df.groupBy(C.TYPE, label).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("newbalanceOrig") == 0).alias("cleared_rows")
    ).withColumn("cleared_share", ratio6("cleared_rows", "rows"))


# --------------------------------------------------------------------- A16
def histogram(df: DataFrame, col: str, bins: int = C.HIST_BINS, clip_q: float | None = None,
              name: str | None = None, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """``bins`` equal-width bins over [min, max] of all non-null rows.

    With ``clip_q`` the values are first clipped to [0, exact clip_q-quantile].
    The last bin is closed (a value equal to max falls in it), and every bin
    is reported, empty ones with 0.  Bounds enter as scalar subqueries; a
    single-valued column gets the range [v - 0.5, v + 0.5].
    """
    vals = df.select(F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    if clip_q is not None:
        hi_q = exact_quantiles(vals, ["v"], [clip_q]).select("value").scalar()
        vals = vals.select(F.least(F.greatest(F.col("v"), F.lit(0.0)), hi_q).alias("v"))
    if lo is not None and hi is not None:
        # a fixed range: values outside it are left out, as numpy does with range=
        vals = vals.filter((F.col("v") >= lo) & (F.col("v") <= hi))
        bounds = vals.sparkSession.range(1).select(F.lit(float(lo)).alias("lo"), F.lit(float(hi)).alias("hi"))
    else:
        bounds = vals.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    b = bounds.select(F.struct("lo", "hi").alias("b")).scalar()
    lo0, hi0 = b.getField("lo"), b.getField("hi")
    lo = F.when(lo0 == hi0, lo0 - 0.5).otherwise(lo0)  # noqa: F811 (column from here on)
    hi = F.when(lo0 == hi0, hi0 + 0.5).otherwise(hi0)
    # bin = floor(bins * (v - lo) / (hi - lo)) + 1, with v == hi folded into the last bin
    pos = F.floor(F.lit(float(bins)) * (F.col("v") - lo) / (hi - lo)) + 1
    binned = vals.select(F.least(pos, F.lit(bins)).cast("long").alias("bin"))
    counts = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    spark = df.sparkSession
    grid = spark.range(1, bins + 1).select(F.col("id").cast("long").alias("bin"))
    width = (hi - lo) / F.lit(float(bins))
    # at most `bins` rows on each side: broadcast the counts
    out = grid.join(F.broadcast(counts), "bin", "left").select(
        F.lit(name or col).alias("column"),
        "bin",
        r6(lo + (F.col("bin") - 1).cast("double") * width).alias("bin_lo"),
        r6(lo + F.col("bin").cast("double") * width).alias("bin_hi"),
        F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"),
    )
    # an empty input has no bounds: report no bins
    return out.filter(lo0.isNotNull())


# --------------------------------------------------------------------- A18-A20
def id_cardinality(df: DataFrame, cols=C.ID_COLUMNS, exact: bool = False, rsd: float = 0.01) -> DataFrame:
    """Distinct ids vs rows.  HyperLogLog++ by default (no shuffle of ids);
    ``exact`` counts distinct values with a shuffle."""
    cols = list(cols)
    fn = (lambda c: F.count_distinct(F.col(c))) if exact else (lambda c: F.approx_count_distinct(F.col(c), rsd))
    wide = df.agg(F.count(F.lit(1)).alias("rows"), *[fn(c).alias(f"{c}__d") for c in cols])
    items = [F.struct(F.lit(c).alias("column"), F.col("rows").alias("rows"),
                      F.col(f"{c}__d").cast("long").alias("distinct_count")) for c in cols]
    return wide.select(_rows(items).alias("r")).select("r.*").withColumn(
        "distinct_ratio", ratio6("distinct_count", "rows")
    )


def flag_vs_label(df: DataFrame, flag: str = C.RULE_FLAG, label: str = C.LABEL) -> DataFrame:
    """2x2 counts of rule flag against label, and their correlation."""
    f, y = F.col(flag), F.col(label)
    return df.agg(
        F.count_if((f == 0) & (y == 0)).alias("flag0_label0"),
        F.count_if((f == 0) & (y == 1)).alias("flag0_label1"),
        F.count_if((f == 1) & (y == 0)).alias("flag1_label0"),
        F.count_if((f == 1) & (y == 1)).alias("flag1_label1"),
        r6(F.corr(f.cast("double"), y.cast("double"))).alias("corr"),
    )


_PARITY_STATS = ("count", "mean", "std", "min", "max", "unique")


def _profile_long(df: DataFrame, cols: list[str], side: str, exact_unique: bool = True) -> DataFrame:
    aggs, items = [], []
    for c in cols:
        x = F.col(c).cast("double")
        uniq = F.count_distinct(x) if exact_unique else F.approx_count_distinct(x, 0.002)
        aggs += [F.count(x).cast("double").alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max"),
                 uniq.cast("double").alias(f"{c}__unique")]
        items += [F.struct(F.lit(c).alias("column"), F.lit(s).alias("stat"), F.col(f"{c}__{s}").alias(side))
                  for s in _PARITY_STATS]
    return df.agg(*aggs).select(_rows(items).alias("r")).select("r.*")


def profile_parity(a: DataFrame, b: DataFrame, cols=C.NUMERIC_COLUMNS, tol: float = C.PARITY_REL_TOL,
                   exact_unique: bool = True) -> DataFrame:
    """Count, mean, std, min, max, unique of two tables within a relative error.

    Exact distinct counts shuffle every distinct value of every column;
    ``exact_unique=False`` uses HyperLogLog++ (relative error 0.2%, well
    inside a 1% tolerance) with no shuffle of values.
    """
    cols = list(cols)
    la, lb = _profile_long(a, cols, "a", exact_unique), _profile_long(b, cols, "b", exact_unique)
    j = la.join(lb, ["column", "stat"], "full")
    diff = F.abs(F.col("a") - F.col("b"))
    rel = F.when(F.col("a") == 0, diff).otherwise(diff / F.abs(F.col("a")))
    return j.select("column", "stat", r6("a").alias("a"), r6("b").alias("b"), r6(rel).alias("rel_diff"),
                    (F.coalesce(rel, F.lit(float("inf"))) <= tol).alias("ok"))
