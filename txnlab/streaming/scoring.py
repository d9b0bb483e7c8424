"""Scoring new transactions as they arrive (the report's low-latency target).

The same operators as the batch path -- pinned schema, kept types, encoding,
``log1p``, the fitted pipeline and the tau* decision -- applied to a
Structured Streaming source.  Everything per row is narrow, so each
micro-batch is scored where it is read; the only state is the optional
hourly alert count, bounded by a watermark on the event time derived from
``step``.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txnlab import config as C
from txnlab.functions.columns import decision
from txnlab.operators.features import drop_null_rows, feature_table
from txnlab.operators.model import score_label
from txnlab.sources.transactions import KEYED_SCHEMA, TRANSACTION_SCHEMA

EPOCH_SECONDS = 788918400  # 1995-01-01T00:00:00Z, hour 0 of `step` in the shipped tables


def read_transaction_stream(spark: SparkSession, path: str, fmt: str = "csv", keyed: bool = True,
                            max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream of transactions under the pinned schema (no inference)."""
    reader = spark.readStream.schema(KEYED_SCHEMA if keyed else TRANSACTION_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        # the header must name the schema's columns in order: a file whose
        # header differs is an error, never read by position
        reader = reader.option("header", True).option("enforceSchema", False)
    return reader.format(fmt).load(path)


def score_stream(stream: DataFrame, model: PipelineModel, tau: float) -> DataFrame:
    """``txn_key, step, score, label, alert`` for every kept, complete row."""
    feats = drop_null_rows(feature_table(stream, keep_key=True))
    scored = score_label(model.transform(feats), keep=(C.KEY, "step"))
    return scored.withColumn("alert", decision("score", float(tau)))


def hourly_alert_counts(scored: DataFrame, watermark: str = "2 hours") -> DataFrame:
    """Rows and alerts per hour of ``step``; state is dropped once an hour is
    older than the watermark."""
    # a UTC epoch in seconds: hour windows do not depend on the session time zone
    ts = F.timestamp_seconds(F.lit(EPOCH_SECONDS) + F.col("step").cast("long") * 3600)
    return (
        scored.withColumn("event_time", ts)
        .withWatermark("event_time", watermark)
        .groupBy(F.window("event_time", "1 hour"))
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("alert").alias("alerts"))
        .select(F.col("window.start").alias("hour"), "rows", "alerts")
    )


def start_alert_sink(scored: DataFrame, path: str, checkpoint: str, available_now: bool = False,
                     processing_time: str | None = None) -> StreamingQuery:
    """Append alerted rows to a parquet table; the checkpoint (on shared
    storage) makes the sink exactly-once across restarts."""
    w = (scored.filter(F.col("alert") == 1).writeStream.format("parquet").outputMode("append")
         .option("path", path).option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
