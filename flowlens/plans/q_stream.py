"""Registered queries: streaming scoring, input checks and JSON reports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.constants import FEATURE_CATALOGUE, LABEL_COLS
from flowlens.functions.clean import missing_columns
from flowlens.plans import sqltext as S
from flowlens.plans.q_catalog import _base as _catalog_base
from flowlens.plans.q_catalog import scored_table
from flowlens.plans.q_scoring import BIN, MUL, THREAT_SQL, _s2_sql
from flowlens.operators.variants import two_stage
from flowlens.plans.registry import query
from flowlens.session import shared_dir
from flowlens.sinks.snapshots import read_published
from flowlens.sources.registry import load_models, save_scoring_model
from flowlens.sources.views import flows_e
from flowlens.streaming import scoring as R


def _run_dirs(spark: SparkSession, kind: str) -> tuple[str, str]:
    base = shared_dir(spark, f"flowlens-{kind}-{uuid.uuid4().hex[:12]}")
    return f"{base}/out", f"{base}/checkpoint"


@query("stream_scoring", S.with_(*_s2_sql()) + "SELECT row_id, pred, variant, variant_confidence FROM s2")
def stream_scoring(spark: SparkSession, sf: str) -> DataFrame:
    """Events files scored as they arrive (availableNow), read back from the sink."""
    out, ckpt = _run_dirs(spark, "stream")
    flows = R.event_stream(spark, sf)
    R.run_scoring(R.scored_stream(flows, BIN, MUL), out, ckpt)
    return spark.read.parquet(out).select("row_id", "pred", "variant", "variant_confidence")


@query("stream_totals", THREAT_SQL)
def stream_totals(spark: SparkSession, sf: str) -> DataFrame:
    """R2: running verdict totals over the arrivals (complete mode)."""
    out, ckpt = _run_dirs(spark, "totals")
    scored = R.scored_stream(R.event_stream(spark, sf), BIN, MUL)
    R.run_complete(R.running_totals(scored), out, ckpt)
    return read_published(spark, out)


@query("stream_variant_counts", S.with_(*_s2_sql()) +
       f"SELECT variant, {S.B('count(*)')} AS n FROM s2 WHERE pred = 1 GROUP BY variant")
def stream_variant_counts(spark: SparkSession, sf: str) -> DataFrame:
    """R2: running counts per variant over the arrivals (complete mode)."""
    out, ckpt = _run_dirs(spark, "variants")
    scored = R.scored_stream(R.event_stream(spark, sf), BIN, MUL)
    R.run_complete(R.running_variant_counts(scored), out, ckpt)
    return read_published(spark, out)


@query("registry_scoring", S.with_(*_s2_sql()) + "SELECT row_id, pred, variant, variant_confidence FROM s2")
def registry_scoring(spark: SparkSession, sf: str) -> DataFrame:
    """Models saved, found and loaded again, then both stages over all flows."""
    root = shared_dir(spark, f"flowlens-models-{uuid.uuid4().hex[:12]}")
    for m in [*BIN, *MUL]:
        save_scoring_model(spark, m, root)
    first, second = load_models(spark, root, binary={m.name for m in BIN}, multi={m.name for m in MUL})
    return two_stage(flows_e(spark, sf), first, second).select("row_id", "pred", "variant", "variant_confidence")


REQUIRED = ("row_id", "dataset") + LABEL_COLS


@query("input_checks", S.with_(S.FLOWS_E, f"""c AS (SELECT dataset, {S.B('count(*)')} AS n, {S.B('sum(y_binary)')} AS pos
    FROM flows_e GROUP BY dataset)""") + """SELECT 'dataset' || i AS dataset, coalesce(n, 0) AS n_rows, coalesce(pos, 0) AS n_pos,
    coalesce(n - pos, 0) AS n_neg, 6 AS n_missing_features,
    CASE WHEN n IS NULL THEN 'no_rows' WHEN pos = 0 OR pos = n THEN 'single_class' ELSE 'ok' END AS status
  FROM range(1, 25) t(i) LEFT JOIN c ON c.dataset = 'dataset' || i""")
def input_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Required columns asserted before any action; per
    dataset row counts, class presence and absent feature count."""
    df = flows_e(spark, sf)
    miss = missing_columns(df, REQUIRED)
    if miss:
        raise ValueError(f"required columns missing: {miss}")
    derivable = set(df.columns)
    derivable |= {f for f in FEATURE_CATALOGUE if f.startswith("proto_") and "proto" in df.columns}
    derivable |= {f for f in FEATURE_CATALOGUE if f.startswith("service_") and "service" in df.columns}
    n_missing = len([f for f in FEATURE_CATALOGUE if f not in derivable])   # local_resp, *_pkts, ... = 6
    found = df.groupBy(F.col("dataset").alias("_ds")).agg(F.count(F.lit(1)).alias("n"), F.sum("y_binary").cast("long").alias("pos"))
    # the registry names datasets that have no rows at all
    registry = spark.createDataFrame([(f"dataset{i}",) for i in range(1, 25)], "dataset string")
    agg = registry.join(found, F.col("dataset") == F.col("_ds"), "left").select(
        "dataset", F.coalesce("n", F.lit(0)).cast("long").alias("n_rows"), F.coalesce("pos", F.lit(0)).cast("long").alias("n_pos"))
    status = (F.when(F.col("n_rows") == 0, F.lit("no_rows"))
              .when((F.col("n_pos") == 0) | (F.col("n_pos") == F.col("n_rows")), F.lit("single_class"))
              .otherwise(F.lit("ok")))
    return agg.select("dataset", "n_rows", "n_pos", (F.col("n_rows") - F.col("n_pos")).alias("n_neg"),
                      F.lit(n_missing).alias("n_missing_features"), status.alias("status"))


def report_frame(spark: SparkSession, sf: str) -> DataFrame:
    """One nested report per dataset (meta, class counts map,
    test metrics), stamped with the current UTC time."""
    sc = scored_table(spark, sf)
    y = F.col("y_binary")
    counts = sc.groupBy("dataset", "split", "y_binary").agg(F.count(F.lit(1)).alias("n"))
    cc = counts.groupBy("dataset", "split").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("y_binary").cast("string"), "n"))).alias("class_counts"),
        F.sum("n").alias("n"))
    test = sc.where(F.col("split") == "test").groupBy("dataset").agg(
        F.avg((F.col("pred") == y).cast("double")).alias("accuracy"))
    piv = cc.groupBy("dataset").agg(
        *[F.first(F.when(F.col("split") == s, F.col(c)), ignorenulls=True).alias(f"{s}_{c}")
          for s in ("train", "val", "test") for c in ("n", "class_counts")])
    rep = piv.join(test, on="dataset", how="left")
    return rep.select(
        "dataset",
        F.struct(F.col("dataset"), F.lit(2).cast("long").alias("num_class"),
                 F.lit(len(FEATURE_CATALOGUE)).cast("long").alias("feature_count"),
                 F.col("train_n").alias("train_rows"),
                 F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
                 F.col("train_class_counts").alias("class_counts_train")).alias("meta"),
        F.struct(F.struct(F.col("test_n").alias("n"), F.col("test_class_counts").alias("class_counts"),
                          F.col("accuracy")).alias("test")).alias("metrics"))


REPORT_SQL = S.with_(*_catalog_base()) + f"""SELECT dataset, CAST(2 AS BIGINT) AS num_class,
    {S.B("sum(CAST(split = 'train' AS INTEGER))")} AS train_rows,
    CAST(count(DISTINCT CASE WHEN split = 'train' THEN y_binary END) AS INTEGER) AS train_classes,
    round(avg(CASE WHEN split = 'test' THEN CAST(pred = y_binary AS DOUBLE) END), 6) AS test_accuracy
  FROM cs GROUP BY dataset"""


@query("report_json", REPORT_SQL)
def report_json(spark: SparkSession, sf: str) -> DataFrame:
    """Nested reports encoded to JSON text (with a UTC
    creation stamp) and decoded back with the report schema and a num_class
    default; the decoded, deterministic fields are returned."""
    rep = report_frame(spark, sf)
    js = rep.select("dataset", F.to_json(F.struct("dataset", "meta", "metrics")).alias("json"))
    from flowlens.sources.files import REPORT_SCHEMA
    parsed = js.select(F.from_json("json", REPORT_SCHEMA).alias("r"))
    return parsed.select(F.col("r.dataset").alias("dataset"),
                         F.coalesce(F.col("r.meta.num_class"), F.lit(2).cast("long")).alias("num_class"),
                         F.col("r.meta.train_rows").alias("train_rows"),
                         F.size("r.meta.class_counts_train").alias("train_classes"),
                         F.round("r.metrics.test.accuracy", 6).alias("test_accuracy"))
