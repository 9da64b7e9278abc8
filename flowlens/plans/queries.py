"""All registered queries; importing the modules fills the registry."""

from __future__ import annotations

from flowlens.plans import (q_catalog, q_metrics_binary, q_metrics_multi, q_models,  # noqa: F401
                            q_prep, q_report, q_reports, q_scoring, q_stream)
from flowlens.plans.registry import ORACLE, QUERIES


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict:
    return {k: v for k, v in ORACLE.items() if k in QUERIES}
