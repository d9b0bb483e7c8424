"""Command line: list, run or explain the registered queries.

    python -m txnlab list
    python -m txnlab run flagship /root/testdata/sf0.01 [--rows 20]
    python -m txnlab explain roc_auc /root/testdata/sf0.01
"""

from __future__ import annotations

import argparse
import sys


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="txnlab")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    for name in ("run", "explain"):
        p = sub.add_parser(name)
        p.add_argument("query")
        p.add_argument("sf_dir", nargs="?", default="/root/testdata/sf0.01")
        p.add_argument("--rows", type=int, default=20)
    args = ap.parse_args(argv)

    from txnlab.plans.catalog import QUERIES

    if args.cmd == "list":
        from txnlab.plans.oracle import ORACLE_SQL

        for n, fn in QUERIES.items():
            check = "O" if n in ORACLE_SQL else "R"
            doc = (fn.__doc__ or "").strip().splitlines()[0] if fn.__doc__ else ""
            print(f"{n:28s} {check}  {doc}")
        return 0
    if args.query not in QUERIES:
        print(f"unknown query {args.query!r}; see `python -m txnlab list`", file=sys.stderr)
        return 2
    from txnlab.session import build_session

    spark = build_session(app=f"txnlab-{args.query}")
    df = QUERIES[args.query](spark, args.sf_dir)
    if args.cmd == "explain":
        df.explain("formatted")
    else:
        df.show(args.rows, truncate=False)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
