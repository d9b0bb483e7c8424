"""A versioned store of fitted pipelines.

A version is a folder ``v000001``, ``v000002`` ... with the pipeline and its
metadata: parameters, features, seed, time, environment, and the columns it reads.
Both are written to a staging folder first; a version's number is claimed by
creating a file of that name, which one writer only can do, and one rename then
publishes the folder.  A version that is listed is whole; a writer that dies before
the rename leaves a staging folder and at most an unused number.
"""

from __future__ import annotations

import json
import os
import platform
import uuid
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def describe(model: PipelineModel, reads: T.StructType, **more) -> dict:
    """Metadata of a fitted pipeline: set parameters by stage, the columns it reads
    with their types, time and environment, and what the caller adds."""
    stages = []
    for s in model.stages:
        params = {p.name: s.getOrDefault(p) for p in s.params if s.isDefined(p)}
        params = {k: v if isinstance(v, (int, float, str, bool, list)) else str(v) for k, v in params.items()}
        stages.append({"stage": type(s).__name__, "params": params})
    spark = SparkSession.active()
    return {"stages": stages, "reads": json.loads(reads.json()), "created": datetime.now(timezone.utc).isoformat(),
            "environment": {"spark": spark.version, "python": platform.python_version(),
                            "java": spark.sparkContext._jvm.System.getProperty("java.version")}, **more}


def versions(spark: SparkSession, root: str) -> list[int]:
    """The published versions in order."""
    fs, path = _fs(spark, root)
    if not fs.exists(path(root)):
        return []
    names = [(s.getPath().getName(), s.isDirectory()) for s in fs.listStatus(path(root))]
    return sorted(int(n[1:]) for n, is_dir in names if is_dir and n[0] == "v" and n[1:].isdigit())


def publish(model: PipelineModel, root: str, reads: T.StructType, **more) -> int:
    """Store ``model`` as the next version of ``root`` and return its number."""
    spark = SparkSession.active()
    fs, path = _fs(spark, root)
    staging = os.path.join(root, f"_staging-{uuid.uuid4().hex}")
    model.write().save(os.path.join(staging, "pipeline"))
    text = json.dumps(describe(model, reads, **more), sort_keys=True)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(os.path.join(staging, "metadata"))
    n = max(versions(spark, root), default=0) + 1
    while not fs.createNewFile(path(os.path.join(root, f"_claim-v{n:06d}"))):
        n += 1
    if not fs.rename(path(staging), path(os.path.join(root, f"v{n:06d}"))):
        raise RuntimeError(f"{root}: version {n} could not be published")
    return n


def metadata(spark: SparkSession, root: str, version: int | None = None) -> dict:
    """Metadata of a version (the latest one without a number)."""
    have = versions(spark, root)
    if not have or (version is not None and version not in have):
        raise ValueError(f"{root}: no version {'at all' if version is None else version}")
    n = version or have[-1]
    text = spark.read.text(os.path.join(root, f"v{n:06d}", "metadata")).first().value
    return {"version": n, **json.loads(text)}


def load_version(spark: SparkSession, root: str, version: int | None = None, data: DataFrame | None = None
                 ) -> tuple[PipelineModel, dict]:
    """A version's pipeline and metadata; with ``data``, an error if a column that it
    reads is missing there or has another type."""
    meta = metadata(spark, root, version)
    if data is not None:
        have = {f.name: f.dataType for f in data.schema.fields}
        for f in T.StructType.fromJson(meta["reads"]).fields:
            if have.get(f.name) != f.dataType:
                got = have[f.name].simpleString() if f.name in have else "no such column"
                raise ValueError(f"{root} v{meta['version']}: reads {f.name} as {f.dataType.simpleString()}, not {got}")
    return PipelineModel.load(os.path.join(root, f"v{meta['version']:06d}", "pipeline")), meta
