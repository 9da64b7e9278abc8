"""Training and evaluation reports in which every dataset has its own classes
(A10-A17, M11, M13, D4).

The number of classes K is a column: it comes from each dataset's training rows,
or from its model. Probabilities are cut to the K classes and normalised for each
row; scored rows then become (dataset, split, label, prediction) cells in one
aggregate, and all figures, matrices and statuses follow from those. Datasets come
from a registry, so that one without rows has a report too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.constants import LOGLOSS_EPS

SPLITS = {"train": "train", "validation": "val", "test": "test"}
_EMPTY = "map<string,bigint>"


def class_counts(rows: DataFrame, registry: DataFrame, label: str = "y_multiclass") -> DataFrame:
    """One row per dataset of ``registry``: rows and a map of class counts for each
    split (zero and empty without rows), training classes and num_class."""
    cells = rows.groupBy("dataset", "split", F.col(label).cast("int").alias("y")).agg(F.count(F.lit(1)).alias("n"))
    per = []
    for s in SPLITS.values():
        mine = F.col("split") == s
        per += [F.sum(F.when(mine, F.col("n"))).alias(f"{s}_rows"),
                F.map_from_entries(F.array_sort(F.collect_list(F.when(mine & F.col("y").isNotNull(), F.struct("y", "n"))))).alias(f"_{s}")]
    wide = registry.join(cells.groupBy(F.col("dataset").alias("_ds")).agg(*per), F.col("dataset").eqNullSafe(F.col("_ds")), "left")
    classes = F.coalesce(F.array_sort(F.map_keys("_train")), F.array().cast("array<int>"))

    def named(s: str) -> Column:
        return F.coalesce(F.transform_keys(f"_{s}", lambda k, _: k.cast("string")), F.create_map().cast(_EMPTY))

    wide = wide.withColumn("train_classes", classes)
    return wide.select(
        "dataset", *[F.coalesce(f"{s}_rows", F.lit(0)).cast("long").alias(f"{s}_rows") for s in SPLITS.values()],
        *[named(s).alias(f"class_counts_{s}") for s in SPLITS.values()], "train_classes",
        F.coalesce(F.array_max("train_classes") + 1, F.lit(1)).alias("num_class"))


def class_cells(scored: DataFrame, by, probs: str, label: str, k: str) -> DataFrame:
    """(by, k, y, pred) cells: rows n, those with a label in 0..K-1 (inside), their log
    loss ll and mean probability pm. One class predicts 0; rows without a label are
    not evaluated."""
    own = F.slice(F.col(probs), 1, F.greatest(F.col(k), F.lit(1)))
    rows = scored.where(F.col(label).isNotNull()).select(*by, F.col(k).alias("k"), F.col(label).cast("int").alias("y"), own.alias("_own"))
    rows = rows.withColumn("_sum", F.aggregate("_own", F.lit(0.0), lambda a, x: a + x))
    pred = F.when(F.col("k") > 1, F.array_position("_own", F.array_max("_own")) - 1).otherwise(0).cast("int")
    true = F.when((F.col("y") >= 0) & (F.col("y") < F.col("k")), F.try_element_at("_own", F.col("y") + 1) / F.col("_sum"))
    loss = F.when(true.isNotNull(), -F.log(F.least(F.greatest(true, F.lit(LOGLOSS_EPS)), F.lit(1.0 - LOGLOSS_EPS))))
    return rows.groupBy(*by, "k", "y", pred.alias("pred")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(loss).alias("ll"), F.count(loss).alias("inside"),
        F.sum(F.when(F.col("_sum") > 0, 1.0 / F.col("k"))).alias("pm"))


def split_metrics(cells: DataFrame, by) -> DataFrame:
    """One row per group of ``by`` from its cells, by the group's own K: n,
    class_counts, accuracy, f1_macro, f1_weighted, logloss, confusion_matrix,
    probs_mean and note.

    One class (K <= 1): F1 is null, the log loss 0, the matrix over the labels seen,
    the note ``degenerate_num_class_1``. A label outside 0..K-1 leaves the log loss
    null and the matrix, not accuracy and F1.
    """
    zero = F.lit(0).cast("long")
    roles = F.array(
        F.struct(F.col("y").alias("cls"), F.col("n").alias("support"), zero.alias("predicted"),
                 F.when(F.col("y") == F.col("pred"), F.col("n")).otherwise(zero).alias("tp")),
        F.struct(F.col("pred").alias("cls"), zero.alias("support"), F.col("n").alias("predicted"), zero.alias("tp")))
    per = cells.select(*by, F.inline(roles)).groupBy(*by, "cls").agg(
        F.sum("tp").alias("tp"), F.sum("support").alias("support"), F.sum("predicted").alias("predicted"))
    f1 = 2.0 * F.col("tp") / (F.col("support") + F.col("predicted"))
    scores = per.groupBy(*by).agg(
        F.sum("tp").alias("_tp"), F.avg(f1).alias("_macro"), F.sum(f1 * F.col("support")).alias("_weighted"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("support") > 0, F.struct("cls", "support"))))).alias("_counts"),
        F.array_sort(F.collect_set("cls")).alias("_seen"))
    cell = F.struct(F.concat_ws(":", "y", "pred").alias("at"), F.col("n"))
    sums = cells.groupBy(*by).agg(
        F.max("k").alias("k"), F.sum("n").alias("n"), F.sum("ll").alias("_ll"), F.sum("inside").alias("_in"),
        F.sum("pm").alias("_pm"), F.map_from_entries(F.collect_list(cell)).alias("_cells"))
    joined = sums.join(scores.select(*[F.col(b).alias(f"_b{i}") for i, b in enumerate(by)], "_tp", "_macro", "_weighted", "_counts", "_seen"),
                       on=[F.col(b).eqNullSafe(F.col(f"_b{i}")) for i, b in enumerate(by)])
    many = F.col("k") > 1
    labels = F.when(many, F.sequence(F.lit(0), F.col("k") - 1)).otherwise(F.col("_seen"))
    matrix = F.transform(labels, lambda a: F.transform(labels, lambda b: F.coalesce(
        F.try_element_at("_cells", F.concat_ws(":", a, b)), zero)))
    return joined.select(
        *by, "k", "n", F.transform_keys("_counts", lambda c, _: c.cast("string")).alias("class_counts"),
        F.round(F.col("_tp") / F.col("n"), 6).alias("accuracy"),
        F.when(many, F.round("_macro", 6)).alias("f1_macro"), F.when(many, F.round(F.col("_weighted") / F.col("n"), 6)).alias("f1_weighted"),
        F.when(~many, F.lit(0.0)).when(F.col("_in") == F.col("n"), F.round(F.col("_ll") / F.col("n"), 6)).alias("logloss"),
        matrix.alias("confusion_matrix"), F.round(F.col("_pm") / F.col("n"), 6).alias("probs_mean"),
        F.when(~many, F.lit("degenerate_num_class_1")).alias("note"))


def dataset_metrics(scored: DataFrame, registry: DataFrame, probs: str, label: str, k: str) -> DataFrame:
    """``split_metrics`` per dataset of the registry (dataset, num_class); one without
    rows has n = 0 and the note ``no_rows``."""
    found = split_metrics(class_cells(scored, ["dataset"], probs, label, k), ["dataset"]).withColumnRenamed("dataset", "_ds").drop("k")
    out = registry.join(found, F.col("dataset").eqNullSafe(F.col("_ds")), "left").drop("_ds")
    return out.withColumns({"note": F.when(F.col("n").isNull(), "no_rows").otherwise(F.col("note")),
                            "n": F.coalesce("n", F.lit(0).cast("long"))})


def training_reports(counts: DataFrame, metrics: DataFrame, feature_count: int) -> DataFrame:
    """(dataset, report): meta with rows, classes, counts and status, and the metrics of
    the three splits (null unless a model was trained).

    ``counts`` comes from ``class_counts``, ``metrics`` from ``split_metrics`` by
    dataset and split.
    """
    status = (F.when(F.col("train_rows") == 0, "no_train_rows")
              .when((F.size("train_classes") <= 1) | (F.col("num_class") <= 1), "single_class_train").otherwise("trained"))
    counts = counts.withColumn("status", status)
    fields = [c for c in metrics.columns if c not in ("dataset", "split", "k")]
    wide = metrics.groupBy(F.col("dataset").alias("_ds")).agg(*[
        F.first(F.when(F.col("split") == s, F.struct(*fields)), ignorenulls=True).alias(name) for name, s in SPLITS.items()])
    both = counts.join(wide, F.col("dataset").eqNullSafe(F.col("_ds")), "left")
    meta = F.struct(
        "dataset", F.lit("multiclass_variant_detection").alias("task"), F.lit(feature_count).alias("feature_count"),
        "train_rows", "val_rows", "test_rows", "train_classes", "num_class",
        F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
        "class_counts_train", "class_counts_val", "class_counts_test", "status")
    trained = F.col("status") == "trained"
    return both.select("dataset", F.struct(meta.alias("meta"), F.when(trained, F.struct(*SPLITS)).alias("metrics")).alias("report"))
