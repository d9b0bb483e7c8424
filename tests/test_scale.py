"""SURVEY §5.5: nothing proportional to the input reaches the driver.

Runs headline queries at sf0.01 and sf0.1 (10x the rows) in separate
applications with Spark's event log on, and compares the bytes of task
results sent to the driver.  Task counts follow the number of file splits;
the bytes per task must stay flat while the data grows tenfold.
"""

import json
import os
import subprocess
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
NAMES = ["flagship", "roc_auc", "quantile_summary", "metrics_record", "quality_checks"]


def measure(sf_dir):
    out = subprocess.run([sys.executable, os.path.join(HERE, "driver_bytes.py"), sf_dir, *NAMES],
                         capture_output=True, text=True, timeout=900)
    line = [ln for ln in out.stdout.splitlines() if ln.startswith("{")][-1]
    return json.loads(line)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="needs sf0.1 tables")
def test_driver_bytes_do_not_grow_with_rows():
    small, big = measure("/root/testdata/sf0.01"), measure("/root/testdata/sf0.1")
    for n in NAMES:
        assert big[n]["bytes_per_task"] < 2 * small[n]["bytes_per_task"], (n, small[n], big[n])
        assert big[n]["bytes_per_task"] < 64 * 1024, (n, big[n])
