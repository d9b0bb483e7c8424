"""Session construction and the shared scratch location.

On a cluster the session is built by the launcher; ``shared_dir`` then reads
``spark.checkpoint.dir`` (a folder every executor can reach).  Only when that
is unset -- local runs and tests -- does it create a private folder and
register it, so lineage cuts and written tables never land on a path that a
single machine owns.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# scratch tables by application, for drop_scratch
_owned: dict[str, list[str]] = {}


def build_session(master: str = "local[*]", app: str = "txnlab", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster-wide scratch folder.  Unset, a local master gets a private
    one; on a cluster that is an error, as executors share no local folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="txnlab-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, uniquely named path under the shared scratch folder."""
    path = os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    _owned.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Delete the intermediate tables this application has written, once no
    result that reads them is needed any more.  Returns how many there were."""
    paths = _owned.pop(spark.sparkContext.applicationId, [])
    jvm = spark.sparkContext._jvm
    for p in paths:
        at = jvm.org.apache.hadoop.fs.Path(p)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    return len(paths)


def materialize(df, name: str = "table"):
    """Write ``df`` as a parquet table in the shared scratch folder and read it back.

    Used where one derived table feeds several jobs (a scored set feeds tau*,
    confusion counts, running totals): the expensive lineage runs once, the
    result survives executor loss, and later scans get column pruning and
    filter pushdown on the written file.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
