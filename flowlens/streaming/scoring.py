"""Structured Streaming (R1, R2): score flow files as they arrive.

R1 is stateless (the same projection as batch scoring) into an append-only
Parquet sink with a checkpoint, so a restarted or retried query resumes
exactly once. R2 keeps running totals and variant counts in bounded state
(one row, and one row per variant) and publishes a small table per
micro-batch through ``foreachBatch``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.constants import DEFAULT_THRESHOLD
from flowlens.operators.report import variant_counts
from flowlens.operators.variants import two_stage
from flowlens.sinks.snapshots import publish
from flowlens.sources.views import flows_from_events

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def event_stream(spark: SparkSession, source_dir: str, file_glob: str = "events*.parquet",
                 max_files: int = 1000) -> DataFrame:
    """Arriving event files as a stream of flow records; ``max_files`` bounds
    one micro-batch so a backlog is drained in steady, restartable steps.

    The pattern names files or tables: of a table stored as a folder all part
    files are read."""
    raw = (spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", max_files)
           .parquet(f"{source_dir.rstrip('/')}/{file_glob}"))
    return flows_from_events(raw)


def scored_stream(flows: DataFrame, binary_models, multi_models, threshold: float = DEFAULT_THRESHOLD,
                  combine_rule: str = "mean") -> DataFrame:
    """Two-stage scoring of a stream (stateless, row-local)."""
    return two_stage(flows, binary_models, multi_models, threshold=threshold, combine_rule=combine_rule,
                     keep=("row_id", "dataset"))


def run_scoring(scored: DataFrame, sink_dir: str, checkpoint_dir: str, available_now: bool = True):
    """R1 sink: append to Parquet with a checkpoint; ``availableNow`` drains
    what has arrived and stops."""
    cols = [c for c in scored.columns if c != "model_probs"]
    w = (scored.select(*cols).writeStream.format("parquet").outputMode("append")
         .option("path", sink_dir).option("checkpointLocation", checkpoint_dir))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def running_totals(scored: DataFrame) -> DataFrame:
    """R2: total / malicious / benign and threat percentage over all arrivals."""
    agg = scored.agg(F.count(F.lit(1)).alias("total"), F.coalesce(F.sum("pred"), F.lit(0)).cast("long").alias("malicious"))
    return agg.select("total", (F.col("total") - F.col("malicious")).alias("benign"), "malicious",
                      F.coalesce(F.round(F.try_divide(F.col("malicious").cast("double"), F.col("total")) * 100.0, 2),
                                 F.lit(0.0)).alias("threat_pct"))


def running_variant_counts(scored: DataFrame) -> DataFrame:
    """R2: variant counts over all malicious arrivals."""
    return variant_counts(scored)


def run_complete(agg: DataFrame, table_dir: str, checkpoint_dir: str, available_now: bool = True):
    """Complete-mode aggregate, each micro-batch's full result published as the
    next version of a small table (the file sink itself only appends). Readers
    (``sinks.snapshots.read_published``) find a whole table at any time; a batch
    that is delivered again after a failure changes nothing."""
    def write(batch: DataFrame, epoch: int) -> None:
        publish(batch, table_dir, epoch)

    w = (agg.writeStream.outputMode("complete").foreachBatch(write)
         .option("checkpointLocation", checkpoint_dir))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
