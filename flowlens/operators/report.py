"""Scoring report (M9): totals, variant counts, per-model stats, first rows,
probability distributions and histograms over a scored frame.

Each report is a single aggregate or a bounded top-k; global aggregates run
partial per partition and merge one row per partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.constants import (BENIGN, DEFAULT_THRESHOLD, DIST_ROWS_PER_VERDICT, FIRST_ROWS,
                                MALICIOUS, NO_VARIANT, UNKNOWN_VARIANT)
from flowlens.operators.ensemble import prob_col
from flowlens.operators.ordered import first_n


def threat_summary(scored: DataFrame) -> DataFrame:
    """Total, benign, malicious, threat percentage (2 digits, 0 when empty)."""
    agg = scored.agg(F.count(F.lit(1)).alias("total"),
                     F.coalesce(F.sum("pred"), F.lit(0)).cast("long").alias("malicious"))
    return agg.select(
        "total",
        (F.col("total") - F.col("malicious")).alias("benign"),
        "malicious",
        F.coalesce(F.round(F.try_divide(F.col("malicious").cast("double"), F.col("total")) * 100.0, 2),
                   F.lit(0.0)).alias("threat_pct"),
    )


def threat_band(pct: Column) -> Column:
    """High above 50 percent of threats, medium above 20, else low."""
    return F.when(pct > 50, "high").when(pct > 20, "medium").otherwise("low")


def dataset_threat(scored: DataFrame) -> DataFrame:
    """A7, A21, F1 for each dataset: totals, threat percentage with its band and
    one-digit label, and the short dataset name. Null names are a dataset."""
    agg = scored.groupBy("dataset").agg(F.count(F.lit(1)).alias("total"),
                                        F.coalesce(F.sum("pred"), F.lit(0)).cast("long").alias("malicious"))
    pct = F.col("malicious").cast("double") / F.col("total") * 100.0
    return agg.select("dataset", F.replace("dataset", F.lit("dataset"), F.lit("D")).alias("short"),
                      "total", (F.col("total") - F.col("malicious")).alias("benign"), "malicious",
                      F.round(pct, 2).alias("threat_pct"), threat_band(pct).alias("band"))


def variant_counts(scored: DataFrame, by=()) -> DataFrame:
    """Rows per variant over all malicious rows (partial aggregation map-side).

    Malicious rows are counted per group and empty groups dropped afterwards,
    instead of filtering rows first: a row filter on ``pred`` would be pushed
    below the scoring projection and evaluate stage 1 twice per row.
    """
    return (scored.groupBy(*by, "variant")
            .agg(F.sum(F.col("pred").cast("long")).alias("n"))
            .where(F.col("n") > 0))


def variant_breakdown(scored: DataFrame, min_count: int = 1) -> DataFrame:
    """Resolved variants only, positive counts, largest first."""
    # the resolved flag is an aggregate, so the filter stays above the
    # aggregation instead of being pushed into the scoring projection
    resolved = ~F.col("variant").isin(NO_VARIANT, UNKNOWN_VARIANT)
    return (scored.groupBy("variant")
            .agg(F.sum(F.col("pred").cast("long")).alias("n"), F.max(resolved).alias("_resolved"))
            .where((F.col("n") >= F.lit(max(min_count, 1))) & F.col("_resolved"))
            .drop("_resolved")
            .orderBy(F.desc("n"), "variant"))


def model_stats(scored: DataFrame, model_names, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Per model flagged count and mean probability (4 digits).

    One global aggregate with two columns per model, then the one-row result is
    unpivoted; the scored rows are never exploded by model.
    """
    names = sorted(model_names)
    aggs = []
    for i, n in enumerate(names):
        p = F.col(prob_col(n))
        aggs += [F.coalesce(F.sum((p >= F.lit(float(threshold))).cast("long")), F.lit(0)).alias(f"f{i}"),
                 F.round(F.avg(p), 4).alias(f"a{i}")]
    one = scored.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(n).alias("name"), F.col(f"f{i}").alias("flagged"),
                              F.col(f"a{i}").alias("avg_prob")) for i, n in enumerate(names)])
    return one.select(F.inline(rows))


def first_rows(scored: DataFrame, n: int = FIRST_ROWS, order_col: str = "row_id") -> DataFrame:
    """First n rows in input order with the detail columns.

    ``orderBy().limit()`` plans as a per-partition top-n merged once.
    """
    top = scored.orderBy(order_col).limit(n)
    w = Window.orderBy(order_col)
    return top.select(
        (F.row_number().over(w) - 1).alias("index"),
        F.col(order_col),
        F.round("prob", 6).alias("probability"),
        "verdict",
        "top_model",
        F.round("top_model_conf", 6).alias("top_model_conf"),
        "variant",
        F.when(F.col("pred") == 1, F.round("variant_confidence", 4)).otherwise(F.lit(0.0))
         .alias("variant_confidence"),
    )


def first_per_verdict(scored: DataFrame, n: int = DIST_ROWS_PER_VERDICT,
                      order_col: str = "row_id") -> DataFrame:
    """First n probabilities per verdict (the page's capped distribution).

    Found in two levels (``first_n``): no task merges the first rows of all
    partitions.
    """
    w = Window.partitionBy("verdict").orderBy(order_col)
    return (first_n(scored.select("verdict", order_col, "prob"), n, order_col, by=("verdict",))
            .withColumn("pos", F.row_number().over(w))
            .select("verdict", "pos", order_col, F.round("prob", 4).alias("prob")))


def verdict_export(scored: DataFrame, which: str) -> DataFrame:
    """The allowed (benign) or dropped (malicious) rows for export.

    Rows are picked as elements of an array of at most one: a plain filter on the
    verdict would be pushed below the scoring projection, and stage 1 evaluated
    again for the rows that pass.
    """
    if which == "allowed":
        verdict, columns = BENIGN, ["row_id", "verdict", F.round("prob", 6).alias("probability"),
                                    F.round("top_model_conf", 6).alias("confidence"), "top_model"]
    elif which == "dropped":
        verdict, columns = MALICIOUS, ["row_id", "verdict", F.round("prob", 6).alias("probability"), "variant",
                                       F.round("variant_confidence", 4).alias("variant_confidence"), "top_model"]
    else:
        raise ValueError("which must be 'allowed' or 'dropped'")
    return scored.select(F.inline(F.when(F.col("verdict") == verdict, F.array(F.struct(*columns)))))


def histogram(df: DataFrame, value_col: str, bins: int = 20, by=()) -> DataFrame:
    """Fixed-width bins on [0, 1], 1.0 in the last bin, empty bins as 0;
    null values are in no bin.

    One partial aggregate to (group, bin) counts; each group's counts (at most
    ``bins``) become a map and the bins are generated by ``sequence``, so the
    input is read once and nothing is joined.
    """
    v = F.col(value_col)
    b = F.when(v.isNotNull(), F.least(F.floor(v * bins), F.lit(bins - 1))).cast("int")
    counts = df.groupBy(*by, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    per = counts.groupBy(*by).agg(F.map_from_entries(F.collect_list(
        F.when(F.col("bin").isNotNull(), F.struct("bin", "n")))).alias("_m"))
    if not by:
        # a global aggregate yields its row even for empty input: all bins 0
        per = counts.agg(F.map_from_entries(F.collect_list(
            F.when(F.col("bin").isNotNull(), F.struct("bin", "n")))).alias("_m"))
    grid = per.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return grid.select(*by, "bin",
                       (F.col("bin") / F.lit(float(bins))).alias("lo"),
                       ((F.col("bin") + 1) / F.lit(float(bins))).alias("hi"),
                       F.coalesce(F.try_element_at("_m", F.col("bin")), F.lit(0).cast("long")).alias("n"))
