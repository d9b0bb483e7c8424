"""M13 by successive halving: many settings on few rows, few settings on all rows.

Every rung fits its settings on a sample of the training rows and ranks them on
the whole validation set; the best ``1 / eta`` of them go on to a sample ``eta``
times as large, and the last rung fits on all rows.  Samples are cut from one hash
of the row key, so each is part of the next, and reruns agree.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlab import config as C
from txnlab.functions.columns import hash_unit
from txnlab.operators.model import fit_and_evaluate_all, weighted
from txnlab.session import materialize

GRID = {"regParam": [0.01, 0.1], "elasticNetParam": [0.0, 0.5], "maxIter": [200, 500], "tol": [1e-6, 1e-8]}


def halving_search(train_df: DataFrame, val_df: DataFrame, grid: dict | None = None, eta: int = 4, by: str = "cost",
                   key: str = C.KEY, label: str = C.LABEL) -> DataFrame:
    """One row per rung and setting: the setting, ``rung`` (from 1), ``fit_rows``, its
    metrics on the validation set and ``rank`` in the rung (1 = best by business
    cost, or by ROC AUC; ties to the setting that stands first in the grid).  Rank
    1 of the last rung is the winner."""
    grid = grid or GRID
    keys = list(grid)
    alive = list(product(*[grid[k] for k in keys]))
    sizes = [len(alive)]
    while sizes[-1] > 1:
        sizes.append(-(-sizes[-1] // eta))
    rows, rung = [], 0
    for rung, n in enumerate(sizes, 1):
        share = float(eta) ** (rung - len(sizes))
        part = train_df if share >= 1 else train_df.filter(hash_unit(key, "halving") < share)
        part = materialize(part, "halving-rung")
        used, w = part.count(), weighted(part, "ratio", label)
        tried = []
        found = fit_and_evaluate_all(w, val_df, [dict(zip(keys, combo)) for combo in alive], label)
        for combo, m in zip(alive, found):
            roc_auc, _, _, min_cost = m
            inf = float("inf")
            cost, auc = (inf if min_cost is None else min_cost), -(roc_auc or 0.0)
            tried.append(((cost, auc) if by == "cost" else (auc,), len(tried), combo, m))
        tried.sort(key=lambda x: x[:2])
        for rank, (_, _, combo, m) in enumerate(tried, 1):
            rows.append((*map(float, combo), rung, used, *m, rank))
        alive = [combo for _, _, combo, _ in tried[: sizes[rung] if rung < len(sizes) else 1]]
    schema = ", ".join([*(f"{k} double" for k in keys), "rung int", "fit_rows long", "roc_auc double", "pr_auc double",
                        "tau_star double", "min_cost double", "rank int"])
    return train_df.sparkSession.createDataFrame(rows, schema)
