"""No row may be lost: null groups, null keys, hot score ranges, table folders."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from flowlens.operators import metrics_binary as MB
from flowlens.operators import metrics_multi as MM
from flowlens.operators import report
from flowlens.operators.ordered import score_chunk
from flowlens.operators.split import sample_rows, stratified_split
from flowlens.sources.views import flows_e
from flowlens.streaming import scoring as R
from tests.conftest import SF_SMALL


def test_split_keeps_null_strata_and_null_keys(spark):
    df = flows_e(spark, SF_SMALL)
    out = stratified_split(df, ["proto"], "row_id")
    assert out.count() == df.count()
    by = Counter((r["proto"], r["split"]) for r in out.select("proto", "split").collect())
    n = Counter(r["proto"] for r in df.select("proto").collect())
    assert n[None] > 0 and all(by[p, "train"] == n[p] * 7 // 10 for p in n)
    odd = spark.createDataFrame([(1, "a"), (None, "a"), (2, "a"), (2, "b"), (None, None)], "k long, s string")
    assert stratified_split(odd, ["s"], "k").count() == 5
    assert sample_rows(odd, 10, "k").count() == 5


def test_repeated_keys_split_alike_in_any_order(spark):
    df = spark.createDataFrame([(i % 3, i) for i in range(60)], "k long, v long")
    runs = [sorted(map(tuple, stratified_split(d, [], "k").select("v", "split").collect()))
            for d in (df, df.orderBy(F.desc("v")).repartition(5))]
    assert runs[0] == runs[1]


def test_ranked_metrics_keep_the_null_group(spark):
    df = spark.createDataFrame([(g, s / 10, int(s > 4)) for g in ("a", None) for s in range(10)],
                               "dataset string, s double, y int")
    got = {r["dataset"]: r["roc_auc"] for r in MB.binary_report(df, ["dataset"], "s", "y").collect()}
    assert got == {"a": 1.0, None: 1.0}


def test_chunks_are_monotone_and_even_for_any_shape(spark):
    base = spark.range(20_000).select((F.rand(3) - 0.5).alias("u"))
    margin = F.col("u") * 4 - 14
    shapes = {"saturated_low": 1 / (1 + F.exp(-margin)), "saturated_high": 1 / (1 + F.exp(margin)),
              "margins": margin, "uniform": F.col("u") + 0.5}
    for name, s in shapes.items():
        rows = base.select(s.alias("s")).select("s", score_chunk(F.col("s")).alias("c")).orderBy("s").collect()
        chunks = [r["c"] for r in rows]
        assert chunks == sorted(chunks), name
        assert max(Counter(chunks).values()) < len(chunks) / 20, name


@pytest.mark.parametrize("values", [[0.0, 5e-324, 1e-300, 0.25, 0.5, 0.75, 1 - 1e-16, 1.0, 1.5, 1e300, -1e-300, -3.0]])
def test_chunk_order_of_extremes(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s double")
    got = [r["c"] for r in df.select("s", score_chunk(F.col("s")).alias("c")).orderBy("s").collect()]
    assert got == sorted(got)


def test_confusion_matrix_of_many_classes(spark):
    df = spark.createDataFrame([("a", 39, 39), ("b", 99, 0)], "g string, y int, pred int")
    got = {(r["g"], r["y"], r["pred"]): r["n"] for r in MM.confusion_matrix(df, ["g"], "y", 40).collect()}
    assert len(got) == 2 * 40 * 40 and got["a", 39, 39] == 1 and sum(got.values()) == 1


def test_histogram_leaves_nulls_out(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", None), ("y", None)], "g string, p double")
    got = report.histogram(df, "p", bins=4, by=("g",)).collect()
    assert len(got) == 8 and sum(r["n"] for r in got) == 1


def test_stream_reads_a_table_folder_and_no_rows(spark, tmpdir_path):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    for name, table in (("full", events.repartition(4)), ("empty", events.where("1 = 0"))):
        table.write.parquet(f"{tmpdir_path}/{name}/events.parquet")
        flows = R.event_stream(spark, f"{tmpdir_path}/{name}").select("row_id")
        R.run_scoring(flows, f"{tmpdir_path}/{name}-out", f"{tmpdir_path}/{name}-ckpt")
        schema = "row_id long"
        assert spark.read.schema(schema).parquet(f"{tmpdir_path}/{name}-out").count() == table.count()
