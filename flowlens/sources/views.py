"""Base tables and the flow views derived from them.

``flows_e`` (from ``events``; ``row_id`` is unique, so it carries every
order-dependent query) and ``flows_l`` (from ``lineitem``; volume, aggregates
only) give the detector's raw flow schema: text numerics, mixed-case protocol,
nullable service, a leak column and both labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(c, pairs, default=None):
    expr = None
    for k, v in pairs:
        expr = F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v))
    return expr if default is None else expr.otherwise(F.lit(default))


def flows_from_events(events: DataFrame) -> DataFrame:
    uid, eid, et = F.col("user_id"), F.col("event_id"), F.col("event_type")
    y_multi = _case(et, [("click", 0), ("error", 1), ("purchase", 2), ("signup", 3), ("view", 4)])
    return events.select(
        eid.alias("row_id"),
        F.col("ts"),
        F.concat(F.lit("dataset"), (uid % 23 + 1).cast("string")).alias("dataset"),
        _case(uid % 4, [(0, "TCP"), (1, "udp"), (2, "Icmp")]).alias("proto"),
        _case(et, [("click", "dns"), ("view", "HTTP"), ("purchase", "-"), ("signup", "ssl")]).alias("service"),
        F.col("value").alias("duration"),
        F.when(eid % 10 == 0, F.lit("-")).when(eid % 10 == 1, F.lit(""))
         .otherwise(F.col("value").cast("string")).alias("orig_bytes"),
        F.regexp_extract(F.col("props"), "[0-9]+", 0).alias("resp_bytes"),
        (uid % 2 == 0).alias("local_orig"),
        (eid % 3 == 0).cast("int").alias("conn_state_SF"),
        y_multi.alias("y_multiclass"),
        (y_multi > 0).cast("int").alias("y_binary"),
    )


def flows_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows_from_events(table(spark, sf_dir, "events"))


def flows_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.lit("dataset"), (F.col("l_suppkey") % 23 + 1).cast("string")).alias("dataset"),
        _case(F.col("l_returnflag"), [("A", "tcp"), ("N", "udp"), ("R", "icmp")]).alias("proto"),
        _case(F.col("l_linestatus"), [("F", "dns"), ("O", "-")]).alias("service"),
        F.col("l_tax").alias("duration"),
        F.col("l_extendedprice").alias("orig_bytes"),
        F.col("l_quantity").alias("resp_bytes"),
        F.col("l_discount").alias("missed_bytes"),
        ((F.col("l_discount") >= 0.05) & (F.col("l_quantity") > 25)).cast("int").alias("y_binary"),
        F.lit(0.0).alias("zero"),
    )
