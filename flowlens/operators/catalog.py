"""Dataset catalog and cross-dataset report tables (A18-A25, J1, J2, J3, J7, M10,
M12, D4, D5, P21, O7, O8, U2, U4).

Inputs are per-row scored frames; everything here first reduces them to one
row per dataset, so every join below is between small, already-aggregated
tables (AQE broadcasts them by measured size). Membership sets are literal
tables of a fixed size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.constants import (AUC_SELECTION_LIMIT, BENIGN_LABEL, SELECTED_BINARY,
                                SELECTED_MULTI, VARIANT_DISPLAY)
from flowlens.operators import metrics_binary as MB
from flowlens.operators import metrics_multi as MM


def names_table(spark: SparkSession, names, col: str = "dataset") -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], f"{col} string")


def display_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(VARIANT_DISPLAY.items()), "variant string, display string")


def flag(df: DataFrame, members: DataFrame, name: str, key: str = "dataset") -> DataFrame:
    """J2 flag form: left join against a membership table + isNotNull."""
    m = members.select(F.col(key), F.lit(True).alias(name))
    return df.join(F.broadcast(m), on=key, how="left").withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def dataset_catalog(scored: DataFrame, prob: str = "prob", pred: str = "pred",
                    label: str = "y_binary") -> DataFrame:
    """One row per dataset: split sizes, train class counts, status (D4/M13),
    test ROC-AUC / PR-AUC and test accuracy at the verdict threshold."""
    y = F.col(label)
    split = F.col("split")

    def cnt(c):
        return F.sum(c.cast("long"))

    counts = scored.groupBy("dataset").agg(
        cnt(split == "train").alias("train_rows"), cnt(split == "val").alias("val_rows"),
        cnt(split == "test").alias("test_rows"),
        cnt((split == "train") & (y == 0)).alias("train_neg"),
        cnt((split == "train") & (y == 1)).alias("train_pos"),
        F.avg(F.when(split == "test", (F.col(pred) == y).cast("double"))).alias("_acc"))
    test = scored.where(split == "test")
    ranked = MB.binary_report(test, ["dataset"], prob, label).select(
        "dataset", F.col("roc_auc").alias("test_roc_auc"), F.col("pr_auc").alias("test_pr_auc"))
    status = F.when((F.col("train_neg") > 0) & (F.col("train_pos") > 0), F.lit("trained")) \
              .when(F.col("train_rows") > 0, F.lit("single_class_train")).otherwise(F.lit("no_rows"))
    return (counts.join(ranked, on="dataset", how="left")
            .select("dataset", status.alias("status"), "train_rows", "val_rows", "test_rows",
                    "train_neg", "train_pos", "test_roc_auc", "test_pr_auc",
                    F.round("_acc", 6).alias("test_acc")))


def multiclass_stats(scored: DataFrame, labels, label: str = "y_multiclass",
                     pred: str = "mpred") -> DataFrame:
    """One row per dataset: test accuracy / F1 of the multiclass model, classes
    in train and test, and the train label names (``variants``)."""
    split = F.col("split")
    names = F.array(*[F.lit(x) for x in labels])
    cls = scored.groupBy("dataset").agg(
        F.countDistinct(F.when(split == "train", F.col(label))).alias("classes"),
        F.countDistinct(F.when(split == "test", F.col(label))).alias("test_classes"),
        F.array_sort(F.collect_set(F.when(split == "train", F.col(label)))).alias("_cls"))
    cls = cls.withColumn("variants", F.transform("_cls", lambda c: F.coalesce(
        F.try_element_at(names, (c + 1).cast("int")), F.concat(F.lit("Variant-"), c.cast("string"))))).drop("_cls")
    af = MM.accuracy_f1(scored.where(split == "test"), ["dataset"], label, pred)
    return cls.join(af.drop("n", "majority_class_share"), on="dataset", how="left")


def _one(df: DataFrame) -> DataFrame:
    return df.withColumn("_k", F.lit(0))


def catalog_summary(spark: SparkSession, catalog: DataFrame, stats: DataFrame,
                    selected_binary=SELECTED_BINARY, selected_multi=SELECTED_MULTI) -> DataFrame:
    """One summary row over the catalog."""
    c = flag(catalog, names_table(spark, selected_binary), "sel_bin")
    trained = F.col("status") == "trained"
    auc_ok = trained & F.col("sel_bin") & F.coalesce(F.col("test_roc_auc") != 0, F.lit(False))
    rows = F.coalesce(F.col("train_rows"), F.lit(0)) + F.coalesce(F.col("val_rows"), F.lit(0)) + \
        F.coalesce(F.col("test_rows"), F.lit(0))
    a = c.agg(F.count(F.lit(1)).alias("n_datasets"),
              F.sum(trained.cast("long")).alias("trained"),
              F.sum(rows).alias("total_rows"),
              F.sum(auc_ok.cast("long")).alias("selected_binary"),
              F.coalesce(F.round(F.avg(F.when(auc_ok, F.col("test_roc_auc"))), 4), F.lit(0.0)).alias("avg_auc_selected"),
              F.round(F.greatest(F.coalesce(F.max(F.when(trained, F.coalesce("test_acc", F.lit(0.0)))), F.lit(0.0)),
                                 F.lit(0.0)), 4).alias("best_acc"))
    a = a.withColumn("rows_label", F.concat(F.round(F.col("total_rows") / F.lit(1e6), 0).cast("long").cast("string"),
                                            F.lit("M")))
    sel = stats.join(F.broadcast(names_table(spark, selected_multi)), on="dataset", how="left_semi")
    v = sel.select(F.explode("variants").alias("v")).where(F.col("v") != BENIGN_LABEL) \
           .agg(F.countDistinct("v").alias("n_variants"))
    m = sel.agg(F.count(F.lit(1)).alias("multi_selected"))
    return _one(a).join(_one(v), "_k").join(_one(m), "_k").drop("_k")


def performance_table(spark: SparkSession, catalog: DataFrame, stats: DataFrame,
                      selected_binary=SELECTED_BINARY, selected_multi=SELECTED_MULTI) -> DataFrame:
    """One row per dataset, in name order."""
    c = flag(flag(catalog, names_table(spark, selected_binary), "used_binary"),
             names_table(spark, selected_multi), "used_multi")
    t = c.join(stats, on="dataset", how="left")
    auc = F.col("test_roc_auc")
    acc = F.col("accuracy")
    tot = F.col("train_neg") + F.col("train_pos")
    used = (F.when(F.col("used_binary") & F.col("used_multi"), F.lit("Both"))
            .when(F.col("used_binary"), F.lit("Binary"))
            .when(F.col("used_multi"), F.lit("Multi")).otherwise(F.lit("Excluded")))
    mal_pct = F.when(F.col("train_pos") > 0, F.round(F.col("train_pos") / tot * 100.0, 1)).otherwise(F.lit(0.0))
    return t.select(
        "dataset", "status", "train_rows",
        F.format_number(F.col("train_rows"), 0).alias("train_rows_fmt"),
        mal_pct.alias("mal_pct"),
        F.concat(mal_pct.cast("string"), F.lit("%")).alias("mal_pct_label"),
        F.round(auc, 4).alias("binary_auc"),
        F.when(auc.isNull(), F.lit(None)).when(auc >= AUC_SELECTION_LIMIT, F.lit("green"))
         .when(auc > 0.5, F.lit("amber")).otherwise(F.lit("red")).alias("auc_band"),
        F.round(acc, 4).alias("multi_accuracy"),
        F.round("f1_weighted", 4).alias("multi_f1_weighted"),
        F.when(acc.isNull(), F.lit(None)).when(acc >= 0.9, F.lit("green"))
         .when(acc >= 0.5, F.lit("amber")).otherwise(F.lit("red")).alias("acc_band"),
        used.alias("used"),
        F.size(F.filter(F.coalesce("variants", F.array().cast("array<string>")),
                        lambda v: v != BENIGN_LABEL)).alias("n_variants"),
    ).orderBy("dataset")


def models_per_variant(spark: SparkSession, stats: DataFrame, selected_multi=SELECTED_MULTI) -> DataFrame:
    """Selected multiclass models per non-benign variant, with display name."""
    sel = stats.join(F.broadcast(names_table(spark, selected_multi)), on="dataset", how="left_semi")
    per = (sel.select(F.explode("variants").alias("variant")).where(F.col("variant") != BENIGN_LABEL)
           .groupBy("variant").agg(F.count(F.lit(1)).alias("n_models")))
    return (per.join(F.broadcast(display_table(spark)), on="variant", how="left")
            .select("variant", F.coalesce("display", "variant").alias("display"), "n_models"))


def model_ranking(stats: DataFrame, by: str = "flagged") -> DataFrame:
    """Models ordered by a per-model figure (largest first, name on ties)
    with their rank. The input holds one row per model."""
    from pyspark.sql import Window
    w = Window.orderBy(F.desc(by), "name")
    return stats.withColumn("rank", F.row_number().over(w)).orderBy("rank")


#: Failures of an evaluation, in the order in which they are looked for.
FAILURES = ("missing_model", "missing_feature_list", "missing_test_parquet", "evaluation_failed")


def multiclass_master(registry: DataFrame, rows: DataFrame, summary: DataFrame) -> DataFrame:
    """M10, D5 for multiclass models: one row for every entry of the registry.

    ``registry`` has dataset, has_model and has_features; ``rows`` the test and
    labelled rows of each dataset (dataset, test_rows, labelled); ``summary``
    the evaluation of labelled test rows. The first check that fails names the
    error, and its row has no figures. All tables have one row a dataset.
    """
    t = registry.join(rows, "dataset", "left").join(summary.withColumnRenamed("dataset", "_ds"),
                                                    F.col("dataset") == F.col("_ds"), "left")
    found = [~F.col("has_model"), ~F.col("has_features"), F.col("test_rows").isNull(),
             F.coalesce(F.col("labelled"), F.lit(0)) == 0]
    error = F.coalesce(*[F.when(c, F.lit(name)) for c, name in zip(found, FAILURES)])
    figures = ("test_rows", "accuracy", "f1_macro", "f1_weighted", "logloss", "probs_mean")
    return t.withColumn("error", error).select(
        "dataset", "error", *[F.when(F.col("error").isNull(), F.col(c)).alias(c) for c in figures])


def model_selection(spark: SparkSession, catalog: DataFrame, limit: float = AUC_SELECTION_LIMIT,
                    published=SELECTED_BINARY) -> DataFrame:
    """The selection rule as a query over the metric table, beside the
    published list."""
    c = flag(catalog, names_table(spark, published), "in_published")
    return c.select("dataset", F.round("test_roc_auc", 6).alias("test_roc_auc"),
                    F.coalesce(F.col("test_roc_auc") > F.lit(limit), F.lit(False)).alias("selected_by_rule"),
                    "in_published")
