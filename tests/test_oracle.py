"""Every registered query against its DuckDB oracle (sf0.001 for speed; the
driver repeats this at sf0.01). Queries without an oracle must still run."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from flowlens.plans import queries as Q
from flowlens.sources.views import TABLES
from tests.conftest import SF_SMALL

# the training-data operators have tests of their own
KEYS = list(Q.queries())
ORACLE = Q.oracle_sql()
SLOW = {"select_gain", "train_binary", "feature_importance", "train_multiclass", "train_report"}
# two fits to their stop (tests/test_boosting.py has the rule on small rows)
LONG = {"training_rounds", "train_checks"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return ("nan",) if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(x)) for x in row)


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["total", "benign", "malicious", "threat_pct"]
    assert df.count() == 1


@pytest.mark.parametrize("key", [k for k in KEYS if k not in SLOW | LONG])
def test_query_matches_oracle(spark, con, key):
    sdf = E.queries()[key](spark, SF_SMALL)
    srows = sdf.collect()
    if key not in ORACLE:
        assert len(srows) >= 0
        return
    res = con.sql(ORACLE[key])
    assert sorted(sdf.columns) == sorted(res.columns)
    drows = res.fetchall()
    cols = sorted(sdf.columns)
    si = [sdf.columns.index(c) for c in cols]
    di = [res.columns.index(c) for c in cols]
    a = sorted((tuple(_norm(r[i]) for i in si) for r in srows), key=_key)
    b = sorted((tuple(_norm(r[i]) for i in di) for r in drows), key=_key)
    assert len(a) == len(b)
    for x, y in zip(a, b):
        for u, v in zip(x, y):
            if isinstance(u, float) or isinstance(v, float):
                assert u == pytest.approx(v, rel=1e-9, abs=1e-9), (key, x, y)
            else:
                assert u == v, (key, x, y)


def test_every_key_has_oracle_or_is_model_fit():
    assert set(KEYS) - set(ORACLE) <= SLOW | {"report_json"}
