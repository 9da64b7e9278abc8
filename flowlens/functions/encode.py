"""Encoding: one-hot of protocol/service, feature preparation, label index, scaling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlens.constants import (LABEL_COLS, PROTO_CATEGORIES, SERVICE_CATEGORIES,
                                SERVICE_CATEGORIES_COMPAT)
from flowlens.functions.clean import col, to_double


def one_hot(df: DataFrame, proto=PROTO_CATEGORIES, service=SERVICE_CATEGORIES) -> DataFrame:
    """Case-folded one-hot; null matches nothing (all zeros).

    When the raw column exists its one-hot columns are (re)written, else any
    existing ``proto_*`` / ``service_*`` columns are kept as they are.
    """
    out = {}
    if "proto" in df.columns:
        p = F.lower(F.col("proto"))
        out.update({f"proto_{v}": F.coalesce(p == v, F.lit(False)).cast("double") for v in proto})
    if "service" in df.columns:
        s = F.lower(F.col("service"))
        out.update({f"service_{v}": F.coalesce(s == v, F.lit(False)).cast("double") for v in service})
    return df.withColumns(out) if out else df


def feature_union(feature_lists) -> list[str]:
    """Union of several ordered feature lists, first-seen order."""
    seen: dict[str, None] = {}
    for fl in feature_lists:
        for f in fl:
            seen.setdefault(f, None)
    return list(seen)


def prepare_features(df: DataFrame, features, keep=(), compat: bool = False) -> DataFrame:
    """Labels dropped, one-hot, absent -> 0.0, numeric coercion, feature order.

    ``keep`` columns (keys, labels for evaluation) are passed through untouched.
    With ``compat`` only the service categories the original service derived
    are encoded; other ``service_*`` features stay 0.0 unless present.
    """
    features = list(features)
    wanted_proto = [f[len("proto_"):] for f in features if f.startswith("proto_")]
    wanted_service = [f[len("service_"):] for f in features if f.startswith("service_")]
    if compat:
        wanted_service = [s for s in wanted_service if s in SERVICE_CATEGORIES_COMPAT]
    base = df.drop(*[c for c in LABEL_COLS if c not in keep])
    enc = one_hot(base, proto=wanted_proto, service=wanted_service)
    types = {f.name: f.dataType for f in enc.schema.fields}
    exprs = [col(k) for k in keep]
    for f in features:
        if f in types:
            exprs.append(to_double(col(f), types[f]).alias(f))
        else:
            exprs.append(F.lit(0.0).alias(f))
    return enc.select(*exprs)


def label_index(df: DataFrame, label: str, out: str = "label_index") -> DataFrame:
    """alphabetical index of a text label (0-based), as a lazy plan.

    The distinct label set is small; the join back is left to AQE, which
    broadcasts it at run time only when its measured size allows.
    """
    labels = df.select(label).distinct().where(F.col(label).isNotNull())
    idx = labels.withColumn(out, F.row_number().over(Window.orderBy(label)) - 1)
    return df.join(idx, on=label, how="left")


def fit_minmax(df: DataFrame, columns) -> dict[str, tuple[float, float]]:
    """F11 fit: one global aggregate (partial per partition); a row of 2 x n values."""
    aggs = []
    for c in columns:
        aggs += [F.min(col(c)).alias(f"mn_{c}"), F.max(col(c)).alias(f"mx_{c}")]
    row = df.agg(*aggs).first()
    return {c: (row[f"mn_{c}"], row[f"mx_{c}"]) for c in columns}


def apply_minmax(df: DataFrame, ranges: dict) -> DataFrame:
    """F11 apply: (x - min) / (max - min); a zero range divides by 1."""
    out = {}
    for c, (mn, mx) in ranges.items():
        if mn is None:
            out[c] = F.lit(None).cast("double")
            continue
        rng = float(mx) - float(mn)
        out[c] = (col(c) - F.lit(float(mn))) / F.lit(rng if rng != 0 else 1.0)
    return df.withColumns(out)
