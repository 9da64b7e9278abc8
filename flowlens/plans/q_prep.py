"""Registered queries: column selection, labels, scaling, split, sample, feature scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.functions.clean import coerce_numeric, col
from flowlens.functions.encode import apply_minmax, fit_minmax, label_index, one_hot
from flowlens.operators import split as SP
from flowlens.operators import stats as ST
from flowlens.plans import sqltext as S
from flowlens.plans.registry import query
from flowlens.sources.views import flows_e, flows_l, table


# ------------------------------------------------------------ P2, P3, P7, P11, U3
def _selectable(spark, sf) -> DataFrame:
    df = one_hot(flows_e(spark, sf))
    return coerce_numeric(df, ["orig_bytes", "resp_bytes"])


# The frame order of _selectable: raw view columns, then one-hot columns.
SELECT_FEATS = ["duration", "orig_bytes", "resp_bytes", "proto_tcp", "proto_udp", "proto_icmp",
                "service_dns", "service_http", "service_-", "service_ssl", "service_ssh",
                "service_irc", "service_dhcp"]
SELECT_SQL = S.with_(S.FLOWS_E) + "SELECT row_id, " + ", ".join(
    f"{S.feature_expr(f, S.E_TYPES)} AS {S.q(f)}" for f in SELECT_FEATS) + " FROM flows_e"


@query("leak_and_numeric_select", SELECT_SQL)
def leak_and_numeric_select(spark: SparkSession, sf: str) -> DataFrame:
    """Leak columns (ts, conn_state_*), labels, key and non-numeric columns
    (booleans, text) are left out; the rest keeps frame order."""
    df = _selectable(spark, sf)
    feats = ST.feature_columns(df, keys=("row_id",))
    return df.select("row_id", *[col(f) for f in feats])


# ------------------------------------------------------------ F10, A1, A2, A3
@query("label_encode", """SELECT event_id AS row_id, event_type,
    CAST(dense_rank() OVER (ORDER BY event_type) - 1 AS INTEGER) AS label_index FROM events""")
def label_encode(spark: SparkSession, sf: str) -> DataFrame:
    """alphabetical label index (0-based) of the text label."""
    ev = table(spark, sf, "events").select(F.col("event_id").alias("row_id"), "event_type")
    return label_index(ev, "event_type")


@query("class_counts", S.with_(S.FLOWS_E) +
       f"SELECT dataset, y_multiclass, {S.B('count(*)')} AS n FROM flows_e GROUP BY ALL")
def class_counts(spark: SparkSession, sf: str) -> DataFrame:
    """A3: rows per (dataset, class)."""
    return ST.class_counts(flows_e(spark, sf), "y_multiclass", by=("dataset",))


@query("num_class", S.with_(S.FLOWS_E) + """SELECT dataset,
    array_to_string(list_sort(list_distinct(list(y_multiclass))), ',') AS labels,
    coalesce(max(y_multiclass) + 1, 1) AS num_class FROM flows_e GROUP BY dataset""")
def num_class(spark: SparkSession, sf: str) -> DataFrame:
    """A1, A2: sorted distinct labels and class count per dataset."""
    return ST.distinct_labels(flows_e(spark, sf), "y_multiclass", by=("dataset",))


# ------------------------------------------------------------ W4, M1, M2, A39
SPLIT_CTE = """sp AS (SELECT *, CASE
    WHEN pos < floor(n * 7000 / 10000) THEN 'train'
    WHEN pos < floor(n * 7000 / 10000) + floor(n * 1500 / 10000) THEN 'val' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY dataset, y_multiclass
                                     ORDER BY md5(CAST(row_id AS VARCHAR))) - 1 AS pos,
               count(*) OVER (PARTITION BY dataset, y_multiclass) AS n FROM flows_e))"""


def split_e(spark: SparkSession, sf: str) -> DataFrame:
    """flows_e with a 70/15/15 split stratified by (dataset, y_multiclass)."""
    return SP.stratified_split(flows_e(spark, sf), ["dataset", "y_multiclass"], "row_id")


@query("stratified_split", S.with_(S.FLOWS_E, SPLIT_CTE) +
       "SELECT row_id, dataset, y_multiclass, split FROM sp")
def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    """Exact 70/15/15 cut per (dataset, label) by hash order."""
    return split_e(spark, sf).select("row_id", "dataset", "y_multiclass", "split")


@query("split_counts", S.with_(S.FLOWS_E, SPLIT_CTE) +
       f"SELECT dataset, split, y_binary, {S.B('count(*)')} AS n FROM sp GROUP BY ALL")
def split_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per (dataset, split, y_binary)."""
    return SP.split_counts(split_e(spark, sf))


HOLDOUT_CTE = """ho AS (SELECT *, CASE WHEN pos < floor(n * 8000 / 10000) THEN 'train' ELSE 'holdout' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY y_binary ORDER BY md5('42:' || CAST(row_id AS VARCHAR))) - 1 AS pos,
               count(*) OVER (PARTITION BY y_binary) AS n FROM flows_e))"""


@query("holdout_split", S.with_(S.FLOWS_E, HOLDOUT_CTE) +
       f"SELECT split, y_binary, {S.B('count(*)')} AS n FROM ho GROUP BY ALL")
def holdout_split(spark: SparkSession, sf: str) -> DataFrame:
    """M1: stratified 80/20 hold-out on y_binary with seed 42."""
    df = SP.stratified_split(flows_e(spark, sf), ["y_binary"], "row_id", fractions=(0.8,),
                             names=("train", "holdout"), seed="42")
    return SP.split_counts(df, by=("split",))


# ------------------------------------------------------------ O3
@query("sample_rows", S.with_(S.FLOWS_E) + """SELECT row_id, dataset, y_binary FROM flows_e
    ORDER BY md5('42:' || CAST(row_id AS VARCHAR)), row_id LIMIT 1000""")
def sample_rows(spark: SparkSession, sf: str) -> DataFrame:
    """O3: 1,000 rows by seeded hash order."""
    return SP.sample_rows(flows_e(spark, sf), 1000, "row_id", seed=42).select("row_id", "dataset", "y_binary")


# ------------------------------------------------------------ F11
MM_FEATS = ["duration", "orig_bytes", "resp_bytes"]


def _mm_sql() -> str:
    feats = S.feats_cte("fe", "sp", MM_FEATS, ["row_id", "split"], S.E_TYPES)
    rng = ", ".join(f"min({S.q(f)}) AS mn_{i}, max({S.q(f)}) AS mx_{i}" for i, f in enumerate(MM_FEATS))
    cols = ", ".join(
        f"round(({S.q(f)} - mn_{i}) / CASE WHEN mx_{i} - mn_{i} = 0 THEN 1 ELSE mx_{i} - mn_{i} END, 6) AS {S.q(f)}"
        for i, f in enumerate(MM_FEATS))
    return S.with_(S.FLOWS_E, SPLIT_CTE, feats, f"r AS (SELECT {rng} FROM fe WHERE split = 'train')") + \
        f"SELECT row_id, split, {cols} FROM fe, r"


@query("minmax_scale", _mm_sql())
def minmax_scale(spark: SparkSession, sf: str) -> DataFrame:
    """min-max scaling with ranges from the train split only."""
    from flowlens.functions.encode import prepare_features
    df = prepare_features(split_e(spark, sf), MM_FEATS, keep=("row_id", "split"))
    ranges = fit_minmax(df.where(F.col("split") == "train"), MM_FEATS)
    out = apply_minmax(df, ranges)
    return out.select("row_id", "split", *[F.round(col(f), 6).alias(f) for f in MM_FEATS])


# ------------------------------------------------------------ A4, O2
PB_FEATS = ["duration", "orig_bytes", "resp_bytes", "missed_bytes", "zero"]


def _pb_sql() -> str:
    sums = ", ".join(f"sum({S.q(f)}) AS sx{i}, sum({S.q(f)} * {S.q(f)}) AS sxx{i}, sum({S.q(f)} * y) AS sxy{i}"
                     for i, f in enumerate(PB_FEATS))
    parts = []
    for i, f in enumerate(PB_FEATS):
        mx, vx = f"(sx{i} / n)", f"(sxx{i} / n - (sx{i} / n) * (sx{i} / n))"
        cov = f"(sxy{i} / n - {mx} * (sy / n))"
        vy = "(syy / n - (sy / n) * (sy / n))"
        parts.append(f"SELECT {S.lit(f)} AS feature, round(CASE WHEN {vx} > 0 AND {vy} > 0 "
                     f"THEN abs({cov} / sqrt({vx} * {vy})) ELSE 0.0 END, 6) AS score FROM m WHERE n > 0")
    return [S.FLOWS_L,
            "fl AS (SELECT *, CAST(y_binary AS DOUBLE) AS y FROM flows_l)",
            f"m AS (SELECT CAST(count(*) AS DOUBLE) AS n, sum(y) AS sy, sum(y * y) AS syy, {sums} FROM fl)",
            "pb AS (" + " UNION ALL ".join(parts) + ")"]


PB_CTES = _pb_sql()
PB_SQL = S.with_(*PB_CTES) + "SELECT feature, score FROM pb"


@query("point_biserial", PB_SQL)
def point_biserial(spark: SparkSession, sf: str) -> DataFrame:
    """A4: guarded |point-biserial r| for every numeric non-leak feature (one pass)."""
    df = flows_l(spark, sf)
    feats = ST.feature_columns(df, keys=())
    return ST.point_biserial(df, feats, "y_binary")


@query("topk_features", S.with_(*PB_CTES) + """SELECT feature, score,
    CAST(row_number() OVER (ORDER BY score DESC, feature) AS INTEGER) AS rank
FROM pb ORDER BY score DESC, feature LIMIT 3""")
def topk_features(spark: SparkSession, sf: str) -> DataFrame:
    """O2: the 3 best features by score, name order on ties."""
    return ST.top_k(point_biserial(spark, sf), 3)
