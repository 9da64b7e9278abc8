"""The report in one pass, and tables that readers find whole at any time."""

import os

import pytest
from pyspark.sql import functions as F

from flowlens.operators import report
from flowlens.operators.scoring_report import report_lines, scoring_report
from flowlens.plans.q_scoring import BIN, MUL, scored_e
from flowlens.sinks.snapshots import current_version, publish, read_published

SF = "/root/testdata/sf0.001"
NAMES = [m.name for m in BIN]


def test_report_equals_its_single_parts(spark):
    scored = scored_e(spark, SF)
    one = scoring_report(scored, NAMES, n_multi=len(MUL)).first()
    totals = report.threat_summary(scored).first()
    assert [one[c] for c in totals.asDict()] == list(totals)
    assert one["variant_counts"] == {r["variant"]: r["n"] for r in report.variant_counts(scored).collect()}
    stats = {r["name"]: (r["flagged"], r["avg_prob"]) for r in report.model_stats(scored, NAMES).collect()}
    assert {m["name"]: (m["flagged"], m["avg_prob"]) for m in one["model_stats"]} == stats
    rows = [r.asDict() for r in report.first_rows(scored).collect()]
    assert [r.asDict() for r in one["results"]] == rows
    for verdict, shown in (("BENIGN", "benign"), ("MALICIOUS", "malicious")):
        first = [r["prob"] for r in report.first_per_verdict(scored).where(F.col("verdict") == verdict).orderBy("pos").collect()]
        assert one["prob_distribution"][shown] == first
    bins = {(r["verdict"], r["bin"]): r["n"] for r in report.histogram(scored, "prob", by=("verdict",)).collect() if r["n"]}
    assert {(h["key"]["verdict"], h["key"]["bin"]): h["n"] for h in one["histogram"]} == bins


def test_report_scans_once_and_merges(spark):
    scored = scored_e(spark, SF)
    lines = report_lines(scoring_report(scored, NAMES))
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("FileScan") == 1
    # many partitions, equal rows, and small buffers
    many = scored.unionByName(scored).repartition(13, "row_id")
    a = scoring_report(many, NAMES, first=7, per_verdict=5).first()
    b = scoring_report(many.coalesce(1), NAMES, first=7, per_verdict=5).first()
    assert a["results"] == b["results"] and a["prob_distribution"] == b["prob_distribution"]
    assert [r["row_id"] for r in a["results"]] == [0, 0, 1, 1, 2, 2, 3]
    empty = scoring_report(scored.where("1 = 0"), NAMES).first()
    assert empty["total"] == 0 and empty["threat_pct"] == 0.0 and empty["results"] == [] and empty["variant_counts"] == {}
    odd = scored.withColumn("prob", F.when(F.col("row_id") > 5, F.col("prob")))
    assert sum(h["n"] for h in scoring_report(odd, NAMES).first()["histogram"]) == scored.count() - 6


def test_published_tables_are_never_missing(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "t")
    assert current_version(spark, root) is None
    with pytest.raises(FileNotFoundError):
        read_published(spark, root)
    assert publish(spark.range(3), root, 0)
    held = read_published(spark, root)
    assert publish(spark.range(10), root, 1) and current_version(spark, root) == 1
    # a reader that found the older snapshot goes on reading it while the next one is published
    assert held.count() == 3 and read_published(spark, root).count() == 10
    # a batch that is delivered again, or late, changes nothing
    assert not publish(spark.range(99), root, 1) and not publish(spark.range(99), root, 0)
    assert read_published(spark, root).count() == 10
    # a writer that dies before the pointer moves leaves the old table
    spark.range(5).write.parquet(f"{root}/data/{2:020d}-dead")
    assert read_published(spark, root).count() == 10
    for v in range(2, 8):
        assert publish(spark.range(v), root, v, partition_by=())
    assert read_published(spark, root).count() == 7 and len(os.listdir(f"{root}/data")) == 3
    assert publish(spark.range(0), root, 8) and read_published(spark, root).columns == ["id"]
