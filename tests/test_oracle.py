"""Every registered query with an oracle matches DuckDB on the sf0.001 tables;
every query without one runs and returns a stable schema."""

import pytest

from conftest import SF001
from oracle_check import compare, duck

from __spark_entry__ import entry, oracle_sql, queries
from txnlab.plans.catalog import QUERIES as SPARK_QUERIES

ORACLE = oracle_sql()
QUERIES = queries()
CATALOG = set(SPARK_QUERIES)
ROWS_ONLY = sorted(set(QUERIES) - set(ORACLE))


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(n for n in ORACLE if n in SPARK_QUERIES))
def test_matches_oracle(spark, con, name):
    ok, _, _, detail = compare(spark, con, name, QUERIES[name], ORACLE[name], SF001)
    assert ok, detail


# the training-data queries have tests of their own in tests/llm
@pytest.mark.parametrize("name", [n for n in ROWS_ONLY if n in CATALOG])
def test_rows_only_queries_run(spark, name):
    df = QUERIES[name](spark, SF001)
    assert df.count() > 0 and len(df.columns) > 0


def test_no_scaler_differs_from_the_baseline(spark):
    rows = {r.variant: r for r in QUERIES["ablate"](spark, SF001).collect()}
    assert rows["no_scaler"][1:] != rows["baseline"][1:]
    assert {"no_weight", "no_weight_balanced", "weaker_l2", "centred"} <= set(rows)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["tau_star", "min_cost", "tp", "fp", "tn", "fn", "precision", "recall", "f1"]
    assert df.count() == 1


MULTI_RANGE = ["roc_auc", "pr_auc", "roc_points", "pr_points", "quantile_summary", "skew_report",
               "clip_quantile", "histogram", "metrics_record", "metric_parity", "targets", "roc_points_binned",
               "exact_stratified_split"]


@pytest.mark.parametrize("name", MULTI_RANGE)
def test_multi_range_path_matches_oracle(spark, con, name):
    """The same queries with value ranges of at most 500 rows, so the two-level
    running totals (boundaries, per-range offsets, per-range windows) run as
    they do at scale."""
    from txnlab.operators.ranking import ROWS_PER_RANGE_CONF

    spark.conf.set(ROWS_PER_RANGE_CONF, "500")
    try:
        ok, _, _, detail = compare(spark, con, name, QUERIES[name], ORACLE[name], SF001)
    finally:
        spark.conf.unset(ROWS_PER_RANGE_CONF)
    assert ok, detail
