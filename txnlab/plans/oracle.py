"""DuckDB SQL oracles for the registered queries.

Each string is standalone ANSI-style SQL over the pre-registered tables
(``lineitem orders customer supplier``), built from the same transactions
view.  They are written independently of the Spark operators -- brute force
where that is simplest (a cross product with the 99-point grid, global window
sums) -- so a match checks the distributed plans against a plain definition.
"""

from __future__ import annotations

from txnlab import config as C

NUM = list(C.NUMERIC_COLUMNS)
RAW_COLS = list(C.TRANSACTION_COLUMNS)

TX = """transactions AS (
  SELECT
    concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
                   CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR)) AS txn_key,
    CAST(date_diff('hour', TIMESTAMP '1995-01-01 00:00:00', l_shipdate) AS INTEGER) AS step,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'TRANSFER' WHEN '2-HIGH' THEN 'CASH_OUT'
         WHEN '3-MEDIUM' THEN 'PAYMENT' WHEN '4-NOT SPECIFIED' THEN 'CASH_IN'
         ELSE 'DEBIT' END AS type,
    l_extendedprice AS amount,
    c_name AS nameOrig,
    c_acctbal * 10e0 AS oldbalanceOrg,
    greatest(c_acctbal * 10e0 - l_extendedprice, 0e0) AS newbalanceOrig,
    s_name AS nameDest,
    s_acctbal * 10e0 AS oldbalanceDest,
    CASE WHEN l_linestatus = 'F' THEN s_acctbal * 10e0 + l_extendedprice
         ELSE s_acctbal * 10e0 END AS newbalanceDest,
    CAST(CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') AND l_extendedprice >= 70000
               AND c_acctbal * 10e0 <= l_extendedprice AND l_returnflag = 'R'
               AND l_tax >= 0.06 THEN 1 ELSE 0 END AS INTEGER) AS isFraud,
    CAST(CASE WHEN o_orderpriority = '1-URGENT' AND l_extendedprice > 90000
              THEN 1 ELSE 0 END AS INTEGER) AS isFlaggedFraud
  FROM lineitem
  JOIN orders   ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey  = c_custkey
  JOIN supplier ON l_suppkey  = s_suppkey
)"""
RAW = "raw AS (SELECT " + ", ".join(RAW_COLS) + " FROM transactions)"
KEPT = "kept AS (SELECT * FROM transactions WHERE type IN ('TRANSFER', 'CASH_OUT'))"
SCORED = """scored AS (
  SELECT txn_key, CAST(isFraud AS INTEGER) AS label,
         round(least(1e0, 0.6e0 * amount / 105000e0
               + CASE WHEN newbalanceOrig = 0 THEN 0.4e0 ELSE 0e0 END), 6) AS score
  FROM kept)"""
GRID = "grid AS (SELECT CAST(range AS DOUBLE) / 100e0 AS threshold FROM range(1, 100))"


def L1P(x: str) -> str:
    return f"CASE WHEN {x} > -1 THEN ln(1 + {x}) END"


def HB(expr: str) -> str:
    return f"(CAST(('0x' || substr(md5({expr}), 1, 8)) AS BIGINT) % 10000)"


def SPLIT(expr: str) -> str:
    h = HB(expr)
    return f"CASE WHEN {h} < 7000 THEN 'train' WHEN {h} < 8500 THEN 'validation' ELSE 'test' END"


SSCORED = f"sscored AS (SELECT *, {SPLIT('txn_key')} AS split FROM scored)"
FEAT = ("feat AS (SELECT txn_key, step, "
        + ", ".join(f"{L1P(c)} AS {c}_log1p" for c in C.SKEWED_COLUMNS)
        + ", CASE type WHEN 'TRANSFER' THEN 1 WHEN 'CASH_OUT' THEN 0 ELSE -1 END AS type_encoded, isFraud FROM kept)")
FEAT_COLS = ["txn_key", *C.FEATURES, "isFraud"]
MI = ("mi AS (SELECT *, " + SPLIT("txn_key") + " AS split FROM feat WHERE "
      + " AND ".join(f"{c} IS NOT NULL" for c in FEAT_COLS) + ")")


def R6(n: str, d: str) -> str:
    """n/d of non-negative integers, rounded half-up to 6 decimals, in integer arithmetic."""
    return (f"(CAST((2000000 * CAST({n} AS HUGEINT) + CAST({d} AS HUGEINT)) // "
            f"NULLIF(2 * CAST({d} AS HUGEINT), 0) AS DOUBLE) / 1e6)")


def MEAN6(x: str) -> str:
    """Mean of a non-negative 6-decimal column, rounded half-up to 6 decimals, in integer arithmetic."""
    s_, n = f"CAST(sum(CAST(round({x} * 1e6) AS BIGINT)) AS HUGEINT)", f"CAST(count({x}) AS HUGEINT)"
    return f"(CAST((2 * {s_} + {n}) // NULLIF(2 * {n}, 0) AS DOUBLE) / 1e6)"


def W(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def curve(name: str, src: str) -> str:
    return f"""{name} AS (
  SELECT round(g.threshold, 6) AS threshold,
         CAST(count_if(s.score >= g.threshold AND s.label = 0) AS BIGINT) AS fp_count,
         CAST(count_if(s.score < g.threshold AND s.label = 1) AS BIGINT) AS fn_count,
         round(count_if(s.score >= g.threshold AND s.label = 0) * 1e0
               + count_if(s.score < g.threshold AND s.label = 1) * 25e0, 6) AS total_cost,
         count(s.label) AS n_rows
  FROM grid g LEFT JOIN {src} s ON TRUE
  GROUP BY g.threshold)"""


def best(name: str, curve_name: str) -> str:
    return f"""{name} AS (
  SELECT threshold AS tau_star, total_cost AS min_cost, fp_count, fn_count
  FROM {curve_name} WHERE n_rows > 0 ORDER BY total_cost, threshold LIMIT 1)"""


def auc(p: str, src: str) -> str:
    win = "OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"""{p}_c AS (
  SELECT score, CAST(sum(label) AS DOUBLE) AS pos, CAST(count(*) - sum(label) AS DOUBLE) AS neg
  FROM {src} GROUP BY score),
{p}_t AS (SELECT sum(pos) AS P, sum(neg) AS N FROM {p}_c),
{p}_r AS (SELECT *, sum(pos) {win} AS cum_pos, sum(neg) {win} AS cum_neg FROM {p}_c),
{p}_auc AS (
  SELECT CASE WHEN P > 0 AND N > 0 THEN round(sum(neg * (cum_pos - pos / 2e0)) / (P * N), 6) END AS roc_auc,
         CASE WHEN P > 0 AND N > 0 THEN round(sum((pos / P) * (prec + prev_prec) / 2e0), 6) END AS pr_auc
  FROM (SELECT *, cum_pos / (cum_pos + cum_neg) AS prec,
               CASE WHEN cum_pos - pos + cum_neg - neg > 0
                    THEN (cum_pos - pos) / (cum_pos - pos + cum_neg - neg)
                    ELSE cum_pos / (cum_pos + cum_neg) END AS prev_prec
        FROM {p}_r) x, {p}_t
  GROUP BY P, N)"""


def conf(p: str, src: str, tau: str) -> str:
    return f"""{p}_cf AS (
  SELECT CAST(count_if(score >= tau_star AND label = 1) AS BIGINT) AS tp,
         CAST(count_if(score >= tau_star AND label = 0) AS BIGINT) AS fp,
         CAST(count_if(score < tau_star AND label = 0) AS BIGINT) AS tn,
         CAST(count_if(score < tau_star AND label = 1) AS BIGINT) AS fn
  FROM {src}, {tau})"""


def prf_expr(tp="tp", fp="fp", fn="fn") -> dict[str, str]:
    """Already rounded to 6 digits."""
    p = f"coalesce({R6(tp, f'{tp} + {fp}')}, 0e0)"
    r = f"coalesce({R6(tp, f'{tp} + {fn}')}, 0e0)"
    f1 = f"coalesce({R6(f'2 * {tp}', f'2 * {tp} + {fp} + {fn}')}, 0e0)"
    return {"precision": p, "recall": r, "f1": f1}


def record(p: str, src: str, tau: str) -> str:
    e = prf_expr()
    return (auc(p, src) + ",\n" + conf(p, src, tau) + f""",
{p}_rec AS (
  SELECT tau_star, roc_auc, pr_auc, {e['precision']} AS precision, {e['recall']} AS recall,
         {e['f1']} AS f1, tp, fp, tn, fn
  FROM {p}_auc, {p}_cf, {tau})""")


VAL_TAU = [GRID, curve("vcurve", "(SELECT * FROM sscored WHERE split = 'validation')"), best("vt", "vcurve")]
TEST = "(SELECT * FROM sscored WHERE split = 'test')"
VALID = "(SELECT * FROM sscored WHERE split = 'validation')"

Q: dict[str, str] = {}

# ----------------------------------------------------------------- flagship, S
_flag_prf = prf_expr()
Q["flagship"] = W(TX, KEPT, SCORED, GRID, """tc AS (
  SELECT round(g.threshold, 6) AS threshold,
         count_if(s.score >= g.threshold AND s.label = 1) AS tp,
         count_if(s.score >= g.threshold AND s.label = 0) AS fp,
         count_if(s.score < g.threshold AND s.label = 0) AS tn,
         count_if(s.score < g.threshold AND s.label = 1) AS fn
  FROM grid g, scored s GROUP BY g.threshold)""", """b AS (
  SELECT *, fp * 1e0 + fn * 25e0 AS cost FROM tc ORDER BY cost, threshold LIMIT 1)""") + f"""
SELECT threshold AS tau_star, round(cost, 6) AS min_cost, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
       CAST(tn AS BIGINT) AS tn, CAST(fn AS BIGINT) AS fn, {_flag_prf['precision']} AS precision,
       {_flag_prf['recall']} AS recall, {_flag_prf['f1']} AS f1
FROM b"""
Q["write_record_json"] = Q["flagship"]
Q["read_transactions"] = W(TX) + "SELECT * FROM transactions"

_types = {"step": "int", "type": "string", "amount": "double", "nameOrig": "string", "oldbalanceOrg": "double",
          "newbalanceOrig": "double", "nameDest": "string", "oldbalanceDest": "double", "newbalanceDest": "double",
          "isFraud": "int", "isFlaggedFraud": "int"}
Q["schema_report"] = W(TX, RAW) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", '{t}' AS expected_type, '{t}' AS actual_type, true AS present, true AS type_ok, "
    f"CAST(count(*) - count({c}) AS BIGINT) AS null_count FROM raw" for c, t in _types.items())
A9 = "SELECT type, isFraud, count(*) AS count FROM raw GROUP BY type, isFraud"
Q["write_result"] = W(TX, RAW) + A9

# ----------------------------------------------------------------- P
Q["select_types"] = W(TX, KEPT) + "SELECT * FROM kept"
Q["stored_by_type"] = Q["select_types"]
_feat_sel = ", ".join(f"round({c}, 6) AS {c}" if c.endswith("_log1p") else c for c in FEAT_COLS)
Q["project"] = W(TX, KEPT, FEAT) + f"SELECT {_feat_sel} FROM feat"
Q["encode_type"] = W(TX) + ("SELECT txn_key, type, CASE type WHEN 'TRANSFER' THEN 1 WHEN 'CASH_OUT' THEN 0 "
                            "ELSE -1 END AS type_encoded FROM transactions")
Q["log1p_cols"] = W(TX) + "SELECT txn_key, " + ", ".join(
    f"round({L1P(c)}, 6) AS {c}_log1p" for c in C.SKEWED_COLUMNS) + " FROM transactions"
Q["validity_flags"] = W(TX) + (
    "SELECT txn_key, coalesce(amount = 0, false) AS amount_is_zero, coalesce(amount < 0, false) AS amount_is_negative, "
    + "(" + " OR ".join(f"coalesce({c} < 0, false)" for c in NUM) + ") AS any_negative, "
    + "(" + " OR ".join(f"{c} IS NULL" for c in NUM) + ") AS any_null FROM transactions")
_payer = "coalesce(abs(oldbalanceOrg - (newbalanceOrig + amount)) < 1e-6, false)"
_payee = "coalesce(abs(newbalanceDest - (oldbalanceDest + amount)) < 1e-6, false)"
Q["balance_flags"] = W(TX) + (f"SELECT txn_key, {_payer} AS payer_ok, {_payee} AS payee_ok, "
                              f"{_payer} AND {_payee} AS both_ok FROM transactions")
Q["with_weight"] = W(TX, KEPT, FEAT, MI, "tr AS (SELECT * FROM mi WHERE split = 'train')",
                     "w AS (SELECT count_if(isFraud = 0) AS n_neg, count_if(isFraud = 1) AS n_pos FROM tr)") + (
    "SELECT txn_key, isFraud, round(CASE WHEN isFraud = 1 THEN (CASE WHEN n_pos > 0 THEN n_neg / n_pos ELSE 1e0 END) "
    "ELSE 1e0 END, 6) AS weight FROM tr, w")
Q["decide"] = W(TX, KEPT, SCORED, SSCORED, *VAL_TAU) + (
    f"SELECT txn_key, score, label, CAST(score >= tau_star AS INTEGER) AS yhat FROM {TEST} t, vt")
Q["drop_null_rows"] = W(TX, KEPT, FEAT) + f"SELECT {_feat_sel} FROM feat WHERE " + " AND ".join(
    f"{c} IS NOT NULL" for c in FEAT_COLS)
_fl = list(C.FEATURES) + ["isFraud"]
Q["null_drop_report"] = W(TX, KEPT, FEAT) + (
    "SELECT count(*) AS rows, count_if(" + " OR ".join(f"{c} IS NULL" for c in _fl) + ") AS dropped_rows, "
    + "count_if(NOT (" + " OR ".join(f"{c} IS NULL" for c in _fl) + ")) AS kept_rows, "
    + ", ".join(f"count_if({c} IS NULL) AS null_{c}" for c in _fl) + " FROM feat")
Q["clip_quantile"] = W(TX, KEPT, "q AS (SELECT quantile_cont(amount, 0.99) AS p99 FROM kept)") + (
    "SELECT txn_key, round(greatest(least(amount, p99), 0e0), 6) AS amount_clipped FROM kept, q")
Q["rule_flag"] = W(TX) + ("SELECT txn_key, type, amount, CAST(type = 'TRANSFER' AND amount > 200000 AS INTEGER) "
                          "AS rule_flag FROM transactions")
Q["interactions"] = W(TX, KEPT) + """SELECT txn_key,
  round(oldbalanceOrg - newbalanceOrig, 6) AS orig_delta,
  round(newbalanceDest - oldbalanceDest, 6) AS dest_delta,
  round((oldbalanceOrg - newbalanceOrig) / NULLIF(amount, 0), 6) AS orig_delta_ratio,
  round((newbalanceDest - oldbalanceDest) / NULLIF(amount, 0), 6) AS dest_delta_ratio,
  round(amount / NULLIF(oldbalanceOrg, 0), 6) AS amount_to_orig_balance,
  round((""" + L1P("amount") + """) * (CASE type WHEN 'TRANSFER' THEN 1 WHEN 'CASH_OUT' THEN 0 ELSE -1 END), 6)
    AS amount_log1p_x_type
FROM kept"""

# ----------------------------------------------------------------- A
Q["null_counts"] = W(TX, RAW) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", CAST(count(*) - count({c}) AS BIGINT) AS null_count FROM raw" for c in RAW_COLS)
Q["duplicate_count"] = W(TX, RAW) + (
    "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows FROM (SELECT count(*) AS n FROM raw GROUP BY "
    + ", ".join(RAW_COLS) + ") g")
Q["negative_counts"] = W(TX, RAW) + "SELECT " + ", ".join(f"count_if({c} < 0) AS {c}" for c in NUM) + " FROM raw"
Q["zero_count"] = W(TX, RAW) + "SELECT count_if(amount = 0) AS zero_amount_rows FROM raw"
_qc = ["SELECT 'rows' AS \"check\", CAST(NULL AS VARCHAR) AS \"column\", count(*) AS value FROM raw"]
_qc += [f"SELECT 'null_count', '{c}', count(*) - count({c}) FROM raw" for c in RAW_COLS]
_qc += [f"SELECT 'negative_count', '{c}', count_if({c} < 0) FROM raw" for c in NUM]
_qc += ["SELECT 'zero_count', 'amount', count_if(amount = 0) FROM raw",
        "SELECT 'kept_rows', NULL, count_if(type IN ('TRANSFER', 'CASH_OUT')) FROM raw",
        f"SELECT 'balance_both_ok', NULL, count_if(type IN ('TRANSFER', 'CASH_OUT') AND {_payer} AND {_payee}) FROM raw"]
Q["quality_checks"] = W(TX, RAW) + "SELECT \"check\", \"column\", CAST(value AS BIGINT) AS value FROM (" + \
    "\nUNION ALL\n".join(_qc) + ") u"
Q["quantile_summary"] = W(TX, RAW) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, round(min({c}), 6) AS min, "
    f"round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.9), 6) AS p90, "
    f"round(quantile_cont({c}, 0.99), 6) AS p99, round(max({c}), 6) AS max FROM raw" for c in NUM)
Q["describe_numeric"] = W(TX, RAW) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev, "
    f"round(min({c}), 6) AS min, round(max({c}), 6) AS max FROM raw" for c in NUM)
_sk = []
for c in NUM:
    _sk.append(
        f"SELECT '{c}' AS \"column\", avg(x) AS mean, stddev_samp(x) AS stddev, "
        f"avg(power(x - m, 3)) / power(avg(power(x - m, 2)), 1.5) AS skewness, "
        f"quantile_cont(x, 0.99) AS p99, max(x) AS max "
        f"FROM (SELECT {c} AS x, avg({c}) OVER () AS m FROM raw) s")
Q["skew_report"] = W(TX, RAW, "sk AS (" + "\nUNION ALL\n".join(_sk) + ")") + (
    "SELECT \"column\", round(mean, 6) AS mean, round(stddev, 6) AS stddev, round(skewness, 6) AS skewness, "
    "round(p99, 6) AS p99, round(max, 6) AS max, round(max / NULLIF(p99, 0), 6) AS max_over_p99, "
    "stddev > mean AS std_gt_mean FROM sk")
Q["balance_consistency"] = W(TX, KEPT) + (
    f"SELECT count(*) AS rows, count_if({_payer}) AS payer_ok_rows, count_if({_payee}) AS payee_ok_rows, "
    f"count_if({_payer} AND {_payee}) AS both_ok_rows, "
    f"coalesce({R6(f'count_if({_payer} AND {_payee})', 'count(*)')}, 0e0) AS both_ok_share FROM kept")
Q["type_label_counts"] = W(TX, RAW) + A9
Q["ordered"] = W(TX, RAW) + A9 + " ORDER BY type, isFraud"
Q["type_label_pivot"] = W(TX, RAW) + (
    "SELECT type, count_if(isFraud = 0) AS not_fraud, count_if(isFraud = 1) AS fraud FROM raw GROUP BY type")
Q["fraud_rate_by_type"] = W(TX, RAW) + (
    "SELECT type, count(*) AS total, count_if(isFraud = 1) AS fraud, "
    f"coalesce({R6('count_if(isFraud = 1)', 'count(*)')}, 0e0) AS fraud_rate FROM raw GROUP BY type")
_k = "type IN ('TRANSFER', 'CASH_OUT')"
Q["selection_effect"] = W(TX, RAW) + (
    f"SELECT rows_before, rows_after, coalesce({R6('rows_before - rows_after', 'rows_before')}, 0e0) AS reduction, "
    f"coalesce({R6('pos_before', 'rows_before')}, 0e0) AS density_before, "
    f"coalesce({R6('pos_after', 'rows_after')}, 0e0) AS density_after FROM ("
    f"SELECT count(*) AS rows_before, count_if({_k}) AS rows_after, count_if(isFraud = 1) AS pos_before, "
    f"count_if({_k} AND isFraud = 1) AS pos_after FROM raw) a")
Q["split_counts"] = W(TX, KEPT, FEAT, MI) + (
    "SELECT split, count(*) AS rows, count_if(isFraud = 1) AS positives, "
    f"coalesce({R6('count_if(isFraud = 1)', 'count(*)')}, 0e0) AS pos_ratio FROM mi GROUP BY split")
Q["class_weights"] = W(TX, KEPT, FEAT, MI, "c AS (SELECT count_if(isFraud = 0) AS n_neg, count_if(isFraud = 1) AS n_pos "
                                         "FROM mi WHERE split = 'train')") + (
    "SELECT 'ratio' AS mode, n_neg, n_pos, 1e0 AS weight_neg, "
    "round(CASE WHEN n_pos > 0 THEN n_neg / n_pos ELSE 1e0 END, 6) AS weight_pos FROM c\nUNION ALL\n"
    "SELECT 'balanced', n_neg, n_pos, "
    "round(CASE WHEN n_pos > 0 AND n_neg > 0 THEN (n_neg + n_pos) / (2e0 * n_neg) ELSE 1e0 END, 6), "
    "round(CASE WHEN n_pos > 0 AND n_neg > 0 THEN (n_neg + n_pos) / (2e0 * n_pos) ELSE 1e0 END, 6) FROM c")


def _hist(name: str, src: str) -> str:
    return f"""SELECT '{name}' AS "column", g.bin,
       round(lo + CAST(g.bin - 1 AS DOUBLE) * ((hi - lo) / 60e0), 6) AS bin_lo,
       round(lo + CAST(g.bin AS DOUBLE) * ((hi - lo) / 60e0), 6) AS bin_hi,
       CAST(coalesce(c.n, 0) AS BIGINT) AS count
FROM (SELECT CAST(range AS BIGINT) AS bin FROM range(1, 61)) g
CROSS JOIN (SELECT CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
                   CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi FROM {src}) b
LEFT JOIN (SELECT bin, count(*) AS n FROM (
             SELECT CAST(least(floor(60e0 * (v - lo) / (hi - lo)) + 1, 60) AS BIGINT) AS bin
             FROM {src}, (SELECT CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
                                 CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi FROM {src}) bb) x
           GROUP BY bin) c ON c.bin = g.bin
WHERE lo IS NOT NULL"""


Q["histogram"] = W(
    TX, KEPT,
    f"hk AS (SELECT amount, {L1P('amount')} AS amount_log1p FROM kept WHERE amount IS NOT NULL "
    f"AND {L1P('amount')} IS NOT NULL)",
    "hq AS (SELECT quantile_cont(amount, 0.99) AS p99 FROM hk)",
    "hraw AS (SELECT least(greatest(amount, 0e0), p99) AS v FROM hk, hq)",
    "hlog AS (SELECT amount_log1p AS v FROM hk)",
) + _hist("amount_clipped", "hraw") + "\nUNION ALL\n" + _hist("amount_log1p", "hlog")
Q["account_clearing"] = W(TX, RAW) + (
    "SELECT type, isFraud, count(*) AS rows, count_if(newbalanceOrig = 0) AS cleared_rows, "
    f"{R6('count_if(newbalanceOrig = 0)', 'count(*)')} AS cleared_share FROM raw GROUP BY type, isFraud")
Q["id_cardinality"] = W(TX, RAW) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count(*) AS rows, count(DISTINCT {c}) AS distinct_count, "
    f"{R6(f'count(DISTINCT {c})', 'count(*)')} AS distinct_ratio FROM raw" for c in C.ID_COLUMNS)
Q["flag_vs_label"] = W(TX, RAW) + (
    "SELECT count_if(isFlaggedFraud = 0 AND isFraud = 0) AS flag0_label0, "
    "count_if(isFlaggedFraud = 0 AND isFraud = 1) AS flag0_label1, "
    "count_if(isFlaggedFraud = 1 AND isFraud = 0) AS flag1_label0, "
    "count_if(isFlaggedFraud = 1 AND isFraud = 1) AS flag1_label1, "
    "round(corr(CAST(isFlaggedFraud AS DOUBLE), CAST(isFraud AS DOUBLE)), 6) AS corr FROM raw")


def _prof(src: str, side: str) -> str:
    aggs = []
    for c in NUM:
        aggs += [f"CAST(count({c}) AS DOUBLE) AS {c}__count", f"avg({c}) AS {c}__mean", f"stddev_samp({c}) AS {c}__std",
                 f"min({c}) AS {c}__min", f"max({c}) AS {c}__max", f"CAST(count(DISTINCT {c}) AS DOUBLE) AS {c}__unique"]
    return f"{side} AS (SELECT " + ", ".join(aggs) + f" FROM {src})"


_par_rows = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", '{s}' AS stat, pa.{c}__{s} AS a, pb.{c}__{s} AS b FROM pa, pb"
    for c in NUM for s in ("count", "mean", "std", "min", "max", "unique"))
Q["profile_parity"] = W(
    TX, KEPT, f"ks AS (SELECT *, {SPLIT('txn_key')} AS split FROM kept)",
    _prof("(SELECT * FROM ks WHERE split = 'train')", "pa"),
    _prof("(SELECT * FROM ks WHERE split = 'test')", "pb"),
    f"pr AS ({_par_rows})",
) + """SELECT "column", stat, round(a, 6) AS a, round(b, 6) AS b, round(rel, 6) AS rel_diff,
       coalesce(rel, 'inf'::DOUBLE) <= 0.01 AS ok
FROM (SELECT *, CASE WHEN a = 0 THEN abs(a - b) ELSE abs(a - b) / abs(a) END AS rel FROM pr) x"""

# ----------------------------------------------------------------- D
Q["hash_split"] = W(TX) + f"SELECT txn_key, {SPLIT('txn_key')} AS split FROM transactions"
Q["stratified_split"] = W(TX, KEPT) + (
    "SELECT txn_key, isFraud, " + SPLIT("'strata' || CAST(isFraud AS VARCHAR) || '|' || txn_key") + " AS split FROM kept")
Q["exact_stratified_split"] = W(
    TX, KEPT,
    "hk AS (SELECT txn_key, isFraud, CAST(('0x' || substr(md5(txn_key), 1, 13)) AS BIGINT) AS h FROM kept)",
    "g AS (SELECT isFraud, h, count(*) AS cnt FROM hk GROUP BY isFraud, h)",
    "p AS (SELECT isFraud, h, CAST(sum(cnt) OVER (PARTITION BY isFraud ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING "
    "AND CURRENT ROW) - cnt AS DOUBLE) / CAST(sum(cnt) OVER (PARTITION BY isFraud) AS DOUBLE) AS pos FROM g)",
) + ("SELECT hk.txn_key, hk.isFraud, CASE WHEN pos < 0.7 THEN 'train' WHEN pos < 0.85 THEN 'validation' "
     "ELSE 'test' END AS split FROM hk JOIN p ON hk.isFraud = p.isFraud AND hk.h = p.h")
Q["downsample"] = W(TX, KEPT, FEAT, MI, "tr AS (SELECT * FROM mi WHERE split = 'train')",
                    "fr AS (SELECT coalesce((1e0 * CAST(count_if(isFraud = 1) AS DOUBLE)) / "
                    "NULLIF(CAST(count_if(isFraud = 0) AS DOUBLE), 0), 0e0) AS frac FROM tr)") + (
    "SELECT txn_key, isFraud FROM tr, fr WHERE isFraud = 1 OR "
    "CAST(CAST(('0x' || substr(md5('down' || txn_key), 1, 8)) AS BIGINT) AS DOUBLE) / 4294967296e0 < frac")

# ----------------------------------------------------------------- M
Q["scaler_std"] = W(TX, KEPT, FEAT, MI) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, round(stddev_samp({c}), 6) AS std FROM mi WHERE split = 'train'" for c in C.FEATURES)
# bins by comparison with their edges
Q["reliability"] = W(TX, KEPT, SCORED) + (
    f"SELECT CAST(i AS INTEGER) AS bin, count(score) AS rows, {MEAN6('score')} AS mean_score, "
    f"{R6('count_if(label = 1)', 'count(score)')} AS observed_rate FROM range(10) t(i) "
    "LEFT JOIN scored ON score >= i / 10e0 AND (score < (i + 1) / 10e0 OR i = 9) GROUP BY i")
_poly = []
for _j, _b in enumerate(C.FEATURES):
    _poly.append(f"CAST({_b} AS DOUBLE)")
    _poly += [f"CAST({_a} AS DOUBLE) * {_b}" for _a in C.FEATURES[: _j + 1]]
Q["polynomial_features"] = W(TX, KEPT, FEAT, MI) + " UNION ALL ".join(
    f"SELECT txn_key, CAST({i} AS INTEGER) AS term, round({e}, 3) AS value FROM mi" for i, e in enumerate(_poly))

# ----------------------------------------------------------------- E
Q["cost_curve"] = W(TX, KEPT, SCORED, GRID, curve("cc", "scored")) + (
    "SELECT threshold, fp_count, fn_count, total_cost FROM cc")
Q["best_threshold"] = W(TX, KEPT, SCORED, GRID, curve("cc", "scored"), best("bt", "cc")) + "SELECT * FROM bt"
Q["best_threshold_by_ratio"] = W(TX, KEPT, SCORED, GRID, """tc AS (
  SELECT round(g.threshold, 6) AS threshold,
         count_if(s.score >= g.threshold AND s.label = 0) AS fp,
         count_if(s.score < g.threshold AND s.label = 1) AS fn
  FROM grid g, scored s GROUP BY g.threshold)""",
  "r AS (SELECT unnest([1e0, 5e0, 25e0, 100e0]) AS ratio)",
  "c AS (SELECT ratio, threshold, fp, fn, round(fp * 1e0 + fn * ratio, 6) AS cost FROM tc, r)") + """
SELECT ratio AS fn_cost_ratio, threshold AS tau_star, cost AS min_cost, CAST(fp AS BIGINT) AS fp_count,
       CAST(fn AS BIGINT) AS fn_count
FROM (SELECT *, row_number() OVER (PARTITION BY ratio ORDER BY cost, threshold) AS rk FROM c) x WHERE rk = 1"""
_CONF = W(TX, KEPT, SCORED, SSCORED, *VAL_TAU, conf("t", TEST, "vt"))
_e = prf_expr()
Q["confusion"] = _CONF + "SELECT tp, fp, tn, fn FROM t_cf"
Q["prf"] = _CONF + (f"SELECT tp, fp, tn, fn, {_e['precision']} AS precision, "
                    f"{_e['recall']} AS recall, {_e['f1']} AS f1 FROM t_cf")
Q["fbeta"] = _CONF + f"SELECT tp, fp, tn, fn, coalesce({R6('5 * tp', '5 * tp + 4 * fn + fp')}, 0e0) AS f2 FROM t_cf"
Q["cost_at"] = _CONF + "SELECT tp, fp, tn, fn, round(fp * 1e0 + fn * 25e0, 6) AS cost FROM t_cf"
Q["roc_auc"] = W(TX, KEPT, SCORED, auc("a", "scored")) + "SELECT roc_auc FROM a_auc"
Q["pr_auc"] = W(TX, KEPT, SCORED, auc("a", "scored")) + "SELECT pr_auc FROM a_auc"
Q["roc_points"] = W(TX, KEPT, SCORED, auc("a", "scored")) + (
    "SELECT 0e0 AS fpr, 0e0 AS tpr UNION ALL SELECT 1e0, 1e0 UNION ALL "
    "SELECT round(coalesce(cum_neg / NULLIF(N, 0), 0e0), 6), round(coalesce(cum_pos / NULLIF(P, 0), 0e0), 6) "
    "FROM a_r, a_t")
Q["roc_points_binned"] = W(
    TX, KEPT, SCORED,
    "bs0 AS (SELECT label, score, floor(score * 1000e0) AS b0 FROM scored)",
    "bs AS (SELECT label, CAST(b0 - CASE WHEN score < CAST(b0 AS DOUBLE) / 1000e0 THEN 1 ELSE 0 END "
    "+ CASE WHEN score >= CAST(b0 + 1 AS DOUBLE) / 1000e0 THEN 1 ELSE 0 END AS DOUBLE) / 1000e0 AS score FROM bs0)",
    auc("a", "bs")) + (
    "SELECT 0e0 AS fpr, 0e0 AS tpr UNION ALL SELECT 1e0, 1e0 UNION ALL "
    "SELECT round(coalesce(cum_neg / NULLIF(N, 0), 0e0), 6), round(coalesce(cum_pos / NULLIF(P, 0), 0e0), 6) "
    "FROM a_r, a_t")
Q["pr_points"] = W(TX, KEPT, SCORED, auc("a", "scored")) + (
    "SELECT 0e0 AS recall, round(cum_pos / (cum_pos + cum_neg), 6) AS precision FROM a_r "
    "WHERE score = (SELECT max(score) FROM a_r) UNION ALL "
    "SELECT round(coalesce(cum_pos / NULLIF(P, 0), 0e0), 6), round(cum_pos / (cum_pos + cum_neg), 6) FROM a_r, a_t")
Q["threshold_robustness"] = W(TX, KEPT, SCORED, SSCORED, GRID, curve("vc", VALID), best("bt", "vc")) + (
    "SELECT threshold, total_cost, round(rel, 6) AS rel_change, coalesce(rel <= 0.05, false) AS within_tol FROM "
    "(SELECT vc.*, CASE WHEN min_cost = 0 THEN (CASE WHEN total_cost = 0 THEN 0e0 END) "
    "ELSE (total_cost - min_cost) / min_cost END AS rel FROM vc, bt "
    "WHERE abs(threshold - tau_star) <= 0.02 + 1e-9) x")
Q["random_baseline"] = W(TX, KEPT, SCORED, SSCORED) + (
    f"SELECT {R6('count_if(label = 1)', 'count(label)')} AS prevalence FROM {TEST} t")
_REC = W(TX, KEPT, SCORED, SSCORED, *VAL_TAU, record("te", TEST, "vt"), record("va", VALID, "vt"))
Q["metrics_record"] = _REC + "SELECT * FROM te_rec"


def _long(rec: str, metrics) -> str:
    return " UNION ALL ".join(f"SELECT '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM {rec}" for m in metrics)


_tol = C.PARITY_TOLERANCES
_tol_case = "CASE metric " + " ".join(f"WHEN '{m}' THEN CAST({v!r} AS DOUBLE)" for m, v in _tol.items()) + " END"
Q["metric_parity"] = _REC + (
    f"SELECT metric, round(a, 6) AS a, round(b, 6) AS b, round(b - a, 6) AS delta, {_tol_case} AS tolerance, "
    f"abs(round(b - a, 9)) <= {_tol_case} AS ok FROM "
    f"(SELECT x.metric, x.value AS a, y.value AS b FROM ({_long('va_rec', _tol)}) x "
    f"JOIN ({_long('te_rec', _tol)}) y ON x.metric = y.metric) j")
_goal_case = "CASE metric " + " ".join(f"WHEN '{m}' THEN CAST({v!r} AS DOUBLE)" for m, v in C.TARGETS.items()) + " END"
Q["targets"] = _REC + (
    f"SELECT metric, round(value, 6) AS value, {_goal_case} AS goal, value >= {_goal_case} AS met "
    f"FROM ({_long('te_rec', C.TARGETS)}) l")
Q["threshold_record"] = W(TX, KEPT, SCORED, SSCORED, GRID, curve("vc", VALID), best("bt", "vc")) + (
    "SELECT tau_star, min_cost, 1e0 AS fp_cost, 25e0 AS fn_cost, fp_count, fn_count, "
    f"(SELECT count(*) FROM {VALID} v) AS validation_rows, (SELECT count(*) FROM {VALID} v) AS validation_rows_used, "
    f"CAST(99 AS INTEGER) AS scan_points, false AS sampled, CAST({C.SEED} AS INTEGER) AS seed FROM bt")
_bad = "CAST(step AS INTEGER) % 100 = 0"
Q["contract_report"] = W(TX, RAW) + " UNION ALL ".join(
    [f"SELECT '{c}' AS \"column\", '{t}' AS expected_type, {'false' if c == 'nameDest' else 'true'} AS present, "
     "false AS extra, " + ("CAST(NULL AS BIGINT) AS null_count, CAST(NULL AS BIGINT) AS bad_values" if c == "nameDest"
                           else f"CAST(count(*) - count({c}) AS BIGINT) AS null_count, "
                           + (f"CAST(count_if({_bad}) AS BIGINT)" if c == "amount" else "CAST(0 AS BIGINT)")
                           + " AS bad_values") + (" FROM (SELECT count(*) FROM raw) r" if c == "nameDest" else " FROM raw")
     for c, t in _types.items()]
    + ["SELECT 'note', NULL, true, true, CAST(0 AS BIGINT), CAST(0 AS BIGINT)"])
Q["top_alerts"] = W(TX, KEPT, SCORED) + "SELECT txn_key, label, score FROM scored ORDER BY score DESC, txn_key LIMIT 100"


# Blocks of rising positive share: corners of the lower hull of the running counts,
# walked from the origin, each time to the flattest line (the furthest, of equals).
_HULL = ["""per AS (SELECT score AS x, count(*) AS n, sum(label) AS pos FROM scored WHERE score IS NOT NULL GROUP BY 1)""",
         """pts AS (SELECT x, row_number() OVER (ORDER BY x) AS i, CAST(sum(n) OVER (ORDER BY x) AS BIGINT) AS w,
         CAST(sum(pos) OVER (ORDER BY x) AS BIGINT) AS s FROM per)""",
         """corner(i, w, s) AS (
  SELECT CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT)
  UNION ALL
  SELECT i, w, s FROM (
    SELECT p.i, p.w, p.s, row_number() OVER (ORDER BY CAST(p.s - c.s AS DOUBLE) / (p.w - c.w), p.i DESC) AS r
    FROM corner c JOIN pts p ON p.i > c.i) q WHERE r = 1)""",
         """blk AS (
  SELECT lag(i) OVER (ORDER BY i) + 1 AS i0, i AS i1, w - lag(w) OVER (ORDER BY i) AS n, s - lag(s) OVER (ORDER BY i) AS pos
  FROM corner)""",
         """blocks AS (SELECT a.x AS lo, b.x AS hi, n, pos FROM blk JOIN pts a ON a.i = i0 JOIN pts b ON b.i = i1)"""]
_BLOCKS = W(TX, KEPT, SCORED, *_HULL).replace("WITH ", "WITH RECURSIVE ", 1)
Q["isotonic_steps"] = _BLOCKS + f"SELECT lo, hi, n, pos, {R6('pos', 'n')} AS rate FROM blocks"
Q["isotonic_scores"] = _BLOCKS + (
    "SELECT txn_key, label, round(CAST(pos AS DOUBLE) / n, 6) AS score FROM scored LEFT JOIN blocks ON score BETWEEN lo AND hi")
# every score as a threshold, and none
_CORNERS = _BLOCKS.rstrip() + f""",
cum AS (
  SELECT *, n - pos AS neg, CAST(sum(pos) OVER (ORDER BY lo) AS BIGINT) AS pos_to,
         CAST(sum(n - pos) OVER (ORDER BY lo) AS BIGINT) AS neg_to, CAST(sum(pos) OVER () AS BIGINT) AS p,
         CAST(sum(n - pos) OVER () AS BIGINT) AS q, lag(pos) OVER (ORDER BY lo) AS pos0,
         lag(n - pos) OVER (ORDER BY lo) AS neg0, row_number() OVER (ORDER BY lo DESC) AS back FROM blocks),
corners AS (
  SELECT lo AS threshold, q - neg_to + neg AS fp_count, pos_to - pos AS fn_count, p - pos_to + pos AS tp_count,
         {R6('neg', 'pos')} AS ratio_from, CASE WHEN pos0 > 0 THEN {R6('neg0', 'pos0')} END AS ratio_to
  FROM cum WHERE pos > 0
  UNION ALL
  SELECT NULL, CAST(0 AS BIGINT), p, CAST(0 AS BIGINT), 0e0, {R6('neg', 'pos')} FROM cum WHERE back = 1 AND neg > 0)
"""
Q["optimal_thresholds"] = _CORNERS + "SELECT * FROM corners"
# brute force over every score, by cost
Q["best_threshold_at_ratios"] = W(TX, KEPT, SCORED, "per AS (SELECT score AS x, count(*) AS n, sum(label) AS pos FROM scored "
                                  "WHERE score IS NOT NULL GROUP BY 1)", """t AS (
  SELECT x AS threshold, CAST(sum(n - pos) OVER (ORDER BY x DESC) AS BIGINT) AS fp_count,
         CAST(sum(pos) OVER () - sum(pos) OVER (ORDER BY x DESC) AS BIGINT) AS fn_count FROM per
  UNION ALL SELECT NULL, CAST(0 AS BIGINT), CAST(sum(pos) AS BIGINT) FROM per)""",
  "r AS (SELECT CAST(range AS DOUBLE) AS ratio FROM range(1, 1001))",
  """best AS (SELECT ratio, threshold, fp_count, fn_count, fp_count + ratio * fn_count AS cost,
    row_number() OVER (PARTITION BY ratio ORDER BY fp_count + ratio * fn_count, threshold NULLS LAST) AS rk FROM t, r)""") + (
    "SELECT ratio, threshold, fp_count, fn_count, cost FROM best WHERE rk = 1")
Q["exact_sample"] = W(TX, KEPT) + (
    "SELECT CAST(least(1000, count(*)) AS BIGINT) AS rows, CAST(least(1000, count(*)) AS BIGINT) AS rows_in_table FROM kept")
Q["stored_quantiles"] = W(TX, RAW) + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({p} AS DOUBLE) AS prob, CAST(count({c}) AS BIGINT) AS n, true AS within FROM raw"
    for c in NUM for p in (0.01, 0.25, 0.5, 0.75, 0.99))
Q["stored_cardinality"] = W(TX, RAW) + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count({c}) AS BIGINT) AS n, CAST(count(DISTINCT {c}) AS BIGINT) AS exact, "
    "true AS within FROM raw" for c in C.ID_COLUMNS)
Q["id_overlap"] = W(TX, KEPT, f"s AS (SELECT *, {SPLIT('txn_key')} AS split FROM kept)") + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count_if(a) AS BIGINT) AS distinct_a, CAST(count_if(b) AS BIGINT) AS distinct_b, "
    f"CAST(count_if(a AND b) AS BIGINT) AS in_both, CAST(count_if(a OR b) AS BIGINT) AS in_either FROM (SELECT {c}, "
    f"bool_or(split = 'train') AS a, bool_or(split = 'test') AS b FROM s WHERE {c} IS NOT NULL GROUP BY {c}) g"
    for c in C.ID_COLUMNS)
_neg = "least(oldbalanceOrg, newbalanceOrig, oldbalanceDest, newbalanceDest) < 0"
Q["quarantine_report"] = W(TX, """j AS (
  SELECT coalesce(step % 100 = 0, FALSE) AS no_number, coalesce(amount < 0 AND step % 100 <> 0, FALSE) AS neg_amount,
         coalesce(""" + _neg + """, FALSE) AS neg_balance, type IS NULL AS no_type,
         isFraud IS NULL OR isFraud NOT IN (0, 1) AS no_label FROM transactions)""") + """
SELECT * FROM (
SELECT 'accepted' AS reason, count_if(NOT (no_number OR neg_amount OR neg_balance OR no_type OR no_label)) AS rows FROM j
UNION ALL SELECT 'rejected', count_if(no_number OR neg_amount OR neg_balance OR no_type OR no_label) FROM j
UNION ALL SELECT 'amount: not double', count_if(no_number) FROM j
UNION ALL SELECT 'negative amount', count_if(neg_amount) FROM j
UNION ALL SELECT 'negative balance', count_if(neg_balance) FROM j
UNION ALL SELECT 'no type', count_if(no_type) FROM j
UNION ALL SELECT 'label not 0 or 1', count_if(no_label) FROM j) x WHERE rows > 0"""
Q["duplicates_by_load"] = W(TX, RAW, """g AS (
  SELECT type, nameOrig, nameDest, coalesce((step // 24) % 3, 0) AS l, count(*) AS n,
         min(coalesce((step // 24) % 3, 0)) OVER (PARTITION BY type, nameOrig, nameDest) AS first
  FROM raw GROUP BY 1, 2, 3, 4)""") + """
SELECT 'load-' || l AS load, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows,
       CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS repeated_within,
       CAST(coalesce(count_if(first < l), 0) AS BIGINT) AS repeated_earlier
FROM (SELECT unnest([0, 1, 2]) AS l) x LEFT JOIN g USING (l) GROUP BY l"""
Q["model_versions"] = " UNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS version, CAST({r!r} AS DOUBLE) AS reg_param, CAST({len(C.FEATURES)} AS INTEGER) AS features, "
    "0e0 AS largest_difference" for i, r in ((1, C.REG_PARAM), (2, 10 * C.REG_PARAM)))
Q["salted_join"] = W(TX, "r AS (" + Q["fraud_rate_by_type"] + ")") + (
    "SELECT txn_key, r.* FROM transactions t LEFT JOIN r ON t.type = r.type")

ORACLE_SQL = Q
