"""The command line lists every registered query with its check kind."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_cli_lists_queries():
    out = subprocess.run([sys.executable, "-m", "txnlab", "list"], cwd=ROOT, capture_output=True, text=True,
                         timeout=120)
    assert out.returncode == 0
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    from txnlab.plans.catalog import QUERIES
    from txnlab.plans.oracle import ORACLE_SQL

    assert len(lines) == len(QUERIES)
    kinds = {ln.split()[0]: ln.split()[1] for ln in lines}
    assert all((kinds[n] == "O") == (n in ORACLE_SQL) for n in QUERIES)


def test_cli_rejects_unknown_query():
    out = subprocess.run([sys.executable, "-m", "txnlab", "run", "no_such_query"], cwd=ROOT, capture_output=True,
                         text=True, timeout=120)
    assert out.returncode == 2
