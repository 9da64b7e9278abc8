"""Plan-shape checks behind the scale claims in the README."""

from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_stage1_scoring_has_no_shuffle(spark):
    import __spark_entry__ as E
    p = _plan(E.queries()["ensemble_mean"](spark, SF_SMALL))
    assert "Exchange" not in p


def test_scan_reads_only_referenced_columns(spark):
    import __spark_entry__ as E
    p = _plan(E.queries()["threat_summary"](spark, SF_SMALL))
    schema = [line for line in p.splitlines() if "ReadSchema" in line or "FileScan" in line]
    assert schema and all("ts:" not in line and "ts#" not in line for line in schema)


def test_first_per_verdict_uses_partial_group_limit(spark):
    import __spark_entry__ as E
    p = _plan(E.queries()["first_per_verdict"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p


def test_ranked_metrics_partition_by_chunk(spark):
    import re
    import __spark_entry__ as E
    df = E.queries()["binary_auc"](spark, SF_SMALL)
    df.collect()
    p = _plan(df)
    assert re.search(r"hashpartitioning\(dataset#\d+, model#\d+, _chunk#\d+", p)
