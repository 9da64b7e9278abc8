from collections import defaultdict

import pytest

import corpus_pipeline
from flowlens.llm.common import written

from . import brute


def test_stages_follow_each_other(docs, rows):
    """Each stage against brute force over what its predecessor kept."""
    spark, sf = docs.sparkSession, "/root/testdata/sf0.001"
    table, kept = docs, None
    out = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        table = written(stage(spark, table, sf))
        assert table.columns == docs.columns
        out[name] = table.collect()
    ids = {n: [r["doc_id"] for r in t] for n, t in out.items()}
    text = {i: t for i, t, *_ in rows}
    clean = [i for i, t, *_ in rows if t and any(c.isalpha() for c in t)]
    assert set(ids["language_id"]) <= set(clean) and len(ids["language_id"]) >= 0.98 * len(clean)
    first = brute.exact([(i, text[i]) for i in ids["language_id"]])
    assert sorted(ids["exact_dedup"]) == sorted(i for i, r in first.items() if r[2])
    near = brute.near([(i, text[i]) for i in ids["exact_dedup"]], 5, 80)
    assert sorted(ids["near_dedup"]) == sorted(i for i, r in near.items() if r[1] == i)
    copies = defaultdict(int)
    for i in ids["source_mix"]:
        copies[i] += 1
    assert set(copies) <= set(ids["near_dedup"]) and max(copies.values()) <= 2
    packed = corpus_pipeline.STAGES[-1][1](spark, table, sf).collect()
    pieces = defaultdict(int)
    for r in packed:
        if r["piece"] == 0:
            pieces[r["doc_id"]] += 1
    assert pieces == copies


def test_run_and_empty_table(docs, tmp_path):
    spark = docs.sparkSession
    docs.where("1 = 0").write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and sum(n.startswith("op") and "_" in n for n in names) >= 10
    assert set(entry.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", ["op3_minhash_neardup", "op5_exact_dedup", "op6_line_frequency", "op13_spelling_variants"])
def test_sql_forms(docs, name):
    import duckdb

    from flowlens.llm import queries

    got = queries.QUERIES[name](docs.sparkSession, "/root/testdata/sf0.001")
    con = duckdb.connect()
    con.sql("create view documents as from '/root/testdata/sf0.001/documents.parquet'")
    want = con.sql(queries.ORACLES[name])
    order = sorted(want.columns)
    assert sorted(got.columns) == order
    key = lambda rows: sorted(map(str, rows))
    assert key(tuple(r[c] for c in order) for r in got.collect()) == key(want.select(*order).fetchall())
