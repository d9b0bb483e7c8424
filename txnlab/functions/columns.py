"""Column expressions shared by the operators.

All are built-in Spark SQL expressions, so they stay inside whole-stage
codegen; none needs a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txnlab import config as C

__all__ = [
    "col_of",
    "encode_type_col",
    "log1p_col",
    "balance_ok_payer",
    "balance_ok_payee",
    "exact_floor",
    "grid_bucket",
    "hash_unit",
    "hash_bucket",
    "fixed_score",
    "decision",
    "r6",
    "ratio6",
    "mean6",
]


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def r6(c) -> Column:
    """Round a computed double to 6 digits (the precision results are compared at)."""
    return F.round(col_of(c), 6)


def ratio6(num, den) -> Column:
    """``num / den`` of two counts, rounded half-up to 6 decimals exactly.

    Decimal division, so the result does not depend on summation order or
    partitioning (a double quotient that sits on a rounding tie could round
    either way); null when ``den`` is 0.
    """
    # decimal(38,10): exact for counts, and fractional weights (1/fraction)
    # keep ten decimals; the quotient comes back as decimal(38,6), half-up
    n = col_of(num).cast("decimal(38,10)")
    d = col_of(den).cast("decimal(38,10)")
    return F.round(F.try_divide(n, d), 6).cast("double")


def mean6(c) -> Column:
    """Mean of a column on the 1e-6 grid, rounded half-up to 6 decimals exactly."""
    x = col_of(c).cast("decimal(18,6)")
    return F.round(F.try_divide(F.sum(x), F.count(x).cast("decimal(20,0)")), 6).cast("double")


def encode_type_col(type_col="type", unseen: int = C.UNSEEN_TYPE_CODE) -> Column:
    """Fixed code, TRANSFER 1, CASH_OUT 0, anything else ``unseen``."""
    t = col_of(type_col)
    expr = None
    for name, code in C.TYPE_CODES.items():
        expr = F.when(t == name, F.lit(code)) if expr is None else expr.when(t == name, F.lit(code))
    return expr.otherwise(F.lit(unseen))


def log1p_col(c, on_domain: str = "null") -> Column:
    """``log1p`` with an explicit policy for values <= -1 (outside its domain).

    ``null``: the value becomes null (Spark's own behaviour);
    ``clamp``: negative inputs are clamped to 0 first;
    ``error``: the query fails on the first such value.
    """
    x = col_of(c)
    if on_domain == "null":
        return F.log1p(x)
    if on_domain == "clamp":
        # greatest() skips nulls; a null input must stay null
        return F.when(x.isNotNull(), F.log1p(F.greatest(x, F.lit(0.0))))
    if on_domain == "error":
        return F.when(x <= -1, F.raise_error(F.lit("log1p: value <= -1"))).otherwise(F.log1p(x))
    raise ValueError(f"unknown on_domain policy {on_domain!r}")


def balance_ok_payer(eps: float = C.BALANCE_EPS) -> Column:
    """Payer identity ``oldbalanceOrg = newbalanceOrig + amount`` within eps."""
    return F.abs(F.col("oldbalanceOrg") - (F.col("newbalanceOrig") + F.col("amount"))) < F.lit(eps)


def balance_ok_payee(eps: float = C.BALANCE_EPS) -> Column:
    """Payee identity ``newbalanceDest = oldbalanceDest + amount`` within eps."""
    return F.abs(F.col("newbalanceDest") - (F.col("oldbalanceDest") + F.col("amount"))) < F.lit(eps)


def exact_floor(score, steps: int) -> Column:
    """The largest k with k/steps <= score, compared against the exact doubles
    k/steps (``floor(score*steps)`` can be one off in binary floating point)."""
    s = col_of(score).cast("double")
    b0 = F.floor(s * F.lit(float(steps)))
    lo = b0.cast("double") / F.lit(float(steps))
    hi = (b0 + 1).cast("double") / F.lit(float(steps))
    return b0 - F.when(s < lo, 1).otherwise(0) + F.when(s >= hi, 1).otherwise(0)


def grid_bucket(score, steps: int = C.GRID_STEPS) -> Column:
    """Number of grid thresholds ``i/steps`` (i = 1..steps-1) that are <= score.

    ``floor(score*steps)`` alone is off by one for some grid points in binary
    floating point (0.29, 0.57, 0.58 fall one bucket low), so the first guess
    is corrected against the exact doubles ``i/steps``.  Bucket b therefore
    means: predicted positive at every threshold i/steps with i <= b.
    """
    return F.least(F.greatest(exact_floor(score, steps), F.lit(0)), F.lit(steps - 1)).cast("int")


def _hash32(key, salt: str = "") -> Column:
    k = col_of(key).cast("string")
    if salt:
        k = F.concat(F.lit(salt), k)
    return F.conv(F.substring(F.md5(k), 1, 8), 16, 10).cast("bigint")


def hash_bucket(key, salt: str = "", modulus: int = 10000) -> Column:
    """A repeatable bucket in [0, modulus) from the md5 of the key."""
    return _hash32(key, salt) % F.lit(modulus)


def hash_unit(key, salt: str = "") -> Column:
    """A repeatable number in [0, 1) from the md5 of the key."""
    return _hash32(key, salt).cast("double") / F.lit(4294967296.0)


def fixed_score(amount="amount", new_balance="newbalanceOrig") -> Column:
    """The fixed reference scorer (no trained model), for evaluation operators."""
    p = C.FIXED_SCORER
    raw = F.lit(p["amount_weight"]) * col_of(amount) / F.lit(p["amount_scale"]) + F.when(
        col_of(new_balance) == 0, F.lit(p["cleared_bonus"])
    ).otherwise(F.lit(0.0))
    # least() skips nulls: a missing amount has no score
    return F.when(raw.isNotNull(), F.round(F.least(F.lit(1.0), raw), 6))


def decision(score, tau) -> Column:
    """1 if score >= tau else 0 (tau may be a float or a Column)."""
    t = tau if isinstance(tau, Column) else F.lit(float(tau))
    return (col_of(score) >= t).cast("int")
