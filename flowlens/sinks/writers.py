"""Sinks (K1-K8). Paths are caller-given folders on shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from flowlens.constants import LABEL_COLS
from flowlens.functions.clean import col, to_double, to_label
from flowlens.operators.report import verdict_export


def save_selected(df: DataFrame, features, dst: str, partition_by=("dataset", "split"),
                  labels=LABEL_COLS) -> int:
    """K1: chosen features as float, labels as int, absent features 0.0,
    written as snappy Parquet partitioned by dataset and split.

    Returns the rows written, counted by an observation during the write
    (no second pass over the data).
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = [F.col(p) for p in partition_by if p in types]
    for f in features:
        v = to_double(col(f), types[f]) if f in types else F.lit(0.0)
        cols.append(v.cast("float").alias(f))
    for lab in labels:
        cols.append((to_label(col(lab), types[lab]) if lab in types else F.lit(0)).alias(lab))
    parts = [p for p in partition_by if p in types]
    obs = Observation("rows_written")
    out = df.select(*cols).observe(obs, F.count(F.lit(1)).alias("n"))
    # REBALANCE lets AQE split a hot (dataset, split) over many writers and
    # merge small ones, instead of one task per partition value (skew) or
    # every task writing into every directory (small files).
    if parts:
        out = out.hint("rebalance", *parts)
    (out.write.mode("overwrite").option("compression", "snappy")
        .partitionBy(*parts).parquet(dst))
    return int(obs.get["n"])


def write_importance(scores: DataFrame, dst: str) -> None:
    """K2: feature scores as CSV with a header."""
    scores.coalesce(1).write.mode("overwrite").option("header", True).csv(dst)


def write_feature_list(spark: SparkSession, features, dst: str) -> None:
    """K3: the ordered feature list as one text file (a list of a few dozen
    names; ordering is kept by sorting before the single-partition write)."""
    df = spark.createDataFrame(list(enumerate(features)), "pos int, value string")
    df.orderBy("pos").coalesce(1).select("value").write.mode("overwrite").text(dst)


def write_json_report(reports: DataFrame, dst: str) -> None:
    """K4: one JSON document per row (nested structs, maps, arrays kept)."""
    reports.write.mode("overwrite").json(dst)


def to_json_text(reports: DataFrame, cols=None) -> DataFrame:
    """K4/F8: each row's report as JSON text."""
    cols = cols or reports.columns
    return reports.select(F.to_json(F.struct(*[col(c) for c in cols])).alias("json"))


def write_summary(summary: DataFrame, dst_csv: str, dst_json: str) -> None:
    """K5: the master summary as CSV and JSON, failure rows included. Nested
    columns are JSON-encoded for the CSV."""
    flat = []
    for f in summary.schema.fields:
        if f.dataType.simpleString().startswith(("struct", "map", "array")):
            flat.append(F.to_json(col(f.name)).alias(f.name))
        else:
            flat.append(col(f.name))
    summary.select(*flat).coalesce(1).write.mode("overwrite").option("header", True).csv(dst_csv)
    summary.coalesce(1).write.mode("overwrite").json(dst_json)


def export_libsvm(df: DataFrame, features, label: str, dst: str) -> None:
    """K6 (re-aimed): assembled feature vectors as LIBSVM text (1-based indices,
    zeros dropped). Export only; training reads vectors directly."""
    from pyspark.ml.feature import VectorAssembler
    types = {f.name: f.dataType for f in df.schema.fields}
    prepared = df.select(to_label(col(label), types[label]).cast("double").alias("label"),
                         *[(to_double(col(f), types[f]) if f in types else F.lit(0.0)).alias(f) for f in features])
    vec = VectorAssembler(inputCols=list(features), outputCol="features").transform(prepared)
    vec.select("label", "features").write.mode("overwrite").format("libsvm").save(dst)


def save_model(model, dst: str) -> None:
    """K7: a fitted pipeline, overwritten in place."""
    model.write().overwrite().save(dst)


def export_verdicts(scored: DataFrame, which: str, dst: str) -> None:
    """K8: allowed (benign) or dropped (malicious) rows as CSV; the two exports
    carry different columns."""
    verdict_export(scored, which).write.mode("overwrite").option("header", True).csv(dst)
