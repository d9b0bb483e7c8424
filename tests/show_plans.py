"""Write docs/PLANS.md: the physical plan of key queries (tree, scans with
their pushed filters and read schema).  Usage: python tests/show_plans.py [sf_dir]"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

KEY = ["flagship", "quality_checks", "type_label_counts", "duplicate_count", "hash_split", "roc_auc",
       "quantile_summary", "metrics_record", "top_alerts", "histogram"]


def plan_text(df) -> str:
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def summarize(text: str) -> str:
    tree, details = text.split("\n\n\n", 1) if "\n\n\n" in text else (text, "")
    keep = []
    for block in details.split("\n\n"):
        head = block.strip().splitlines()[0] if block.strip() else ""
        if "Scan parquet" in head:
            for ln in block.splitlines():
                if ln.startswith(("PushedFilters", "ReadSchema", "Location")):
                    keep.append(f"{head}  {ln}")
    tree = re.sub(r"#\d+L?", "", tree)
    return tree.strip() + ("\n\n" + "\n".join(keep) if keep else "")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from txnlab.session import build_session

    spark = build_session("local[8]", shuffle_partitions=16)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # show the static plan Spark starts from
    from __spark_entry__ import queries

    qs = queries()
    out = ["# Physical plans of key queries", "",
           f"Generated by `tests/show_plans.py` at `{sf}` with AQE off (the static plan; at run time AQE may",
           "turn a sort-merge join whose measured side is small into a broadcast join, coalesce partitions",
           "and split skewed ones).  Queries that write an intermediate table show the plan that reads it.",
           ""]
    for n in KEY:
        df = qs[n](spark, sf)
        out += [f"## {n}", "", "```", summarize(plan_text(df)), "```", ""]
    with open(os.path.join(ROOT, "docs", "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
