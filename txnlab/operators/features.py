"""Row-wise selection and feature operators.

All are narrow (no shuffle): Catalyst folds them into one projection over the
scan and prunes the columns nobody reads.  The two operators that need a
table-wide number (P7 weights, P11 quantile) take it as a scalar subquery, so
the plan stays lazy and no row reaches the driver.
"""

from __future__ import annotations

from pyspark.ml.feature import PolynomialExpansion
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlab import config as C
from txnlab.functions.columns import (
    balance_ok_payee,
    balance_ok_payer,
    decision,
    encode_type_col,
    log1p_col,
)
from txnlab.operators.ranking import quantile_scalar


def select_types(df: DataFrame, types=C.KEPT_TYPES) -> DataFrame:
    """Keep rows whose ``type`` is in ``types`` (pushed into the scan)."""
    return df.filter(F.col(C.TYPE).isin(*types))


def project(df: DataFrame, cols=C.FEATURES + (C.LABEL,), keep_key: bool = True) -> DataFrame:
    """The given columns, in the given order (plus the row key if present)."""
    lead = [C.KEY] if keep_key and C.KEY in df.columns and C.KEY not in cols else []
    return df.select(*lead, *cols)


def encode_type(df: DataFrame, unseen: int = C.UNSEEN_TYPE_CODE) -> DataFrame:
    """``type_encoded`` with TRANSFER 1, CASH_OUT 0, others ``unseen``."""
    return df.withColumn("type_encoded", encode_type_col(C.TYPE, unseen))


def log1p_cols(df: DataFrame, cols=C.SKEWED_COLUMNS, on_domain: str = "null") -> DataFrame:
    """One ``<c>_log1p`` column per input column, in one projection."""
    return df.withColumns({f"{c}{C.LOG1P_SUFFIX}": log1p_col(c, on_domain) for c in cols})


def feature_table(df: DataFrame, types=C.KEPT_TYPES, unseen: int = C.UNSEEN_TYPE_CODE,
                  on_domain: str = "null", keep_key: bool = True) -> DataFrame:
    """P1 -> P3 -> P4 -> P2: the fixed, ordered feature table (FIXTURES F2)."""
    return project(log1p_cols(encode_type(select_types(df, types), unseen), on_domain=on_domain),
                   keep_key=keep_key)


def validity_flags(df: DataFrame, cols=C.NUMERIC_COLUMNS) -> DataFrame:
    """P5: per-row zero / negative / null predicates."""
    neg_any = F.lit(False)
    null_any = F.lit(False)
    for c in cols:
        neg_any = neg_any | F.coalesce(F.col(c) < 0, F.lit(False))
        null_any = null_any | F.col(c).isNull()
    return df.withColumns(
        {
            "amount_is_zero": F.coalesce(F.col("amount") == 0, F.lit(False)),
            "amount_is_negative": F.coalesce(F.col("amount") < 0, F.lit(False)),
            "any_negative": neg_any,
            "any_null": null_any,
        }
    )


def balance_flags(df: DataFrame, eps: float = C.BALANCE_EPS) -> DataFrame:
    """The payer and payee balance identities, per row."""
    payer = F.coalesce(balance_ok_payer(eps), F.lit(False))
    payee = F.coalesce(balance_ok_payee(eps), F.lit(False))
    return df.withColumns({"payer_ok": payer, "payee_ok": payee, "both_ok": payer & payee})


def with_weight(df: DataFrame, weights: DataFrame, label: str = C.LABEL, out: str = "weight") -> DataFrame:
    """Attach the class weight from a one-row ``weight_neg, weight_pos`` table.

    The weights enter as one scalar subquery, so the caller's plan stays lazy
    and nothing is joined or collected.
    """
    w = weights.select(F.struct("weight_neg", "weight_pos").alias("w")).scalar()
    return df.withColumn(
        out, F.when(F.col(label) == 1, w.getField("weight_pos")).otherwise(w.getField("weight_neg"))
    )


def decide(scored: DataFrame, tau, score: str = "score", out: str = "yhat") -> DataFrame:
    """1 if score >= tau else 0; ``tau`` is a float or a Column."""
    return scored.withColumn(out, decision(score, tau))


def drop_null_rows(df: DataFrame, cols=None) -> DataFrame:
    """P10: drop rows with a null in ``cols`` (all columns by default)."""
    return df.na.drop(subset=list(cols) if cols else None)


def null_drop_report(df: DataFrame, cols=None) -> DataFrame:
    """P10 companion: rows, rows a null drop removes, rows kept, and the
    nulls per column behind it (the count the null policy always reports).
    One aggregation."""
    cols = list(cols or df.columns)
    any_null = F.lit(False)
    for c in cols:
        any_null = any_null | F.col(c).isNull()
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(any_null).alias("dropped_rows"),
        F.count_if(~any_null).alias("kept_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols],
    )


def clip_quantile(df: DataFrame, col: str, q: float = C.CLIP_QUANTILE, lower: float | None = 0.0,
                  out: str | None = None) -> DataFrame:
    """Clip ``col`` to [lower, exact q-quantile of col]."""
    hi = quantile_scalar(df, col, q)
    v = F.least(F.col(col), hi)
    if lower is not None:
        v = F.greatest(v, F.lit(float(lower)))
    # least()/greatest() skip nulls: keep a null input null
    return df.withColumn(out or f"{col}_clipped", F.when(F.col(col).isNotNull(), v))


def rule_flag(df: DataFrame, limit: float = C.RULE_LIMIT, out: str = "rule_flag") -> DataFrame:
    """The business rule behind ``isFlaggedFraud``: a single transfer above ``limit``."""
    return df.withColumn(out, ((F.col(C.TYPE) == "TRANSFER") & (F.col("amount") > limit)).cast("int"))


def interactions(df: DataFrame, spec: dict | None = None) -> DataFrame:
    """Balance changes, their ratios to the amount, and amount x type,
    plus any extra terms in ``spec`` (name -> SQL expression or Column)."""
    orig_delta = F.col("oldbalanceOrg") - F.col("newbalanceOrig")
    dest_delta = F.col("newbalanceDest") - F.col("oldbalanceDest")
    cols: dict[str, Column] = {
        "orig_delta": orig_delta,
        "dest_delta": dest_delta,
        "orig_delta_ratio": F.try_divide(orig_delta, F.col("amount")),
        "dest_delta_ratio": F.try_divide(dest_delta, F.col("amount")),
        "amount_to_orig_balance": F.try_divide(F.col("amount"), F.col("oldbalanceOrg")),
    }
    if "amount_log1p" in df.columns and "type_encoded" in df.columns:
        cols["amount_log1p_x_type"] = F.col("amount_log1p") * F.col("type_encoded")
    for name, term in (spec or {}).items():
        cols[name] = F.expr(term) if isinstance(term, str) else term
    return df.withColumns(cols)


def polynomial_stage(input_col: str = "unscaled_features", output_col: str = "poly_features", degree: int = 2):
    """Polynomial terms of the assembled vector, as a pipeline stage."""
    return PolynomialExpansion(degree=degree, inputCol=input_col, outputCol=output_col)
