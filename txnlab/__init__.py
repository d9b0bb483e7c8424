"""txnlab: cost-sensitive analytics over labelled transaction tables on Spark.

Every public operator takes and returns a ``DataFrame`` (so they chain with
``df.transform``) and keeps its work on the executors.  Only results whose size
is fixed by the operator's parameters (a threshold grid, a bucket boundary
list, a handful of columns) ever reach the driver.

    from txnlab import read_transactions, feature_table, hash_split, cost_curve, best_threshold
"""

from txnlab import config  # noqa: F401
from txnlab.operators.evaluate import (  # noqa: F401
    auc_metrics,
    best_threshold,
    best_threshold_by_ratio,
    confusion,
    cost_at,
    cost_curve,
    fbeta,
    metrics_record,
    pr_points,
    prf,
    roc_points,
    threshold_record,
    top_alerts,
)
from txnlab.operators.features import (  # noqa: F401
    balance_flags,
    clip_quantile,
    decide,
    drop_null_rows,
    encode_type,
    feature_table,
    log1p_cols,
    null_drop_report,
    select_types,
    validity_flags,
    with_weight,
)
from txnlab.operators.model import (  # noqa: F401
    coefficients,
    feature_stages,
    lr_stage,
    score,
    score_label,
    train,
    weighted,
)
from txnlab.operators.profile import (  # noqa: F401
    duplicate_count,
    histogram,
    null_counts,
    quality_checks,
    quantile_summary,
    type_label_counts,
    type_label_pivot,
)
from txnlab.operators.sampling import (  # noqa: F401
    class_weights,
    downsample,
    exact_stratified_split,
    hash_split,
    split_counts,
    stratified_split,
)
from txnlab.sources import (  # noqa: F401
    add_row_key,
    read_result,
    read_transactions,
    write_result,
    write_transactions,
)
