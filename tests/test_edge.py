"""Edge cases of cleaning, encoding and the two stages (FIXTURES.md section 5)."""

import pytest
from pyspark.sql import functions as F

from flowlens.functions.clean import col, parse_number, to_double
from flowlens.functions.encode import one_hot, prepare_features
from flowlens.operators import report
from flowlens.operators.ensemble import predict_binary
from flowlens.operators.models import Logistic, Softmax, Tree
from flowlens.operators.variants import two_stage


def test_text_numerics(spark):
    vals = ["-", "", " 12 ", "1e3", "inf", "1d", "1_000", "NaN", "abc", None, "1.5f", "-.5"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(to_double(F.col("s"), df.schema["s"].dataType)).collect()]
    assert got == [0.0, 0.0, 12.0, 1000.0, float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, -0.5]
    parsed = [r[0] for r in df.select(parse_number(F.col("s"))).collect()]
    assert parsed[5] is None and parsed[6] is None      # "1d", "1_000" are not numbers


def test_all_null_numeric_and_boolean(spark):
    df = spark.createDataFrame([(None, True), (None, False)], "x double, b boolean")
    out = df.select(to_double(F.col("x"), df.schema["x"].dataType).alias("x"),
                    to_double(F.col("b"), df.schema["b"].dataType).alias("b")).collect()
    assert [(r.x, r.b) for r in out] == [(0.0, 1.0), (0.0, 0.0)]


def test_upper_case_proto_and_existing_onehot(spark):
    df = spark.createDataFrame([("TCP", 5.0, "DNS"), (None, 1.0, None)], "proto string, proto_tcp double, service string")
    out = one_hot(df).select("proto_tcp", "proto_udp", "service_dns", "service_-").collect()
    assert (out[0].proto_tcp, out[0].service_dns) == (1.0, 1.0)      # raw column wins over existing
    assert (out[1].proto_tcp, out[1].service_dns, out[1]["service_-"]) == (0.0, 0.0, 0.0)
    kept = spark.createDataFrame([(5.0,)], "proto_tcp double")
    assert one_hot(kept).first().proto_tcp == 5.0                    # no raw column: kept


def test_missing_feature_and_compat(spark):
    df = spark.createDataFrame([(1, "ssl")], "row_id int, service string")
    full = prepare_features(df, ["service_ssl", "orig_pkts"], keep=("row_id",)).first()
    assert (full.service_ssl, full.orig_pkts) == (1.0, 0.0)
    compat = prepare_features(df, ["service_ssl"], keep=("row_id",), compat=True).first()
    assert compat.service_ssl == 0.0


def test_threshold_is_inclusive_and_combine_rules(spark):
    df = spark.createDataFrame([(1, 0.0)], "row_id long, x double")
    m = Tree("m1", ("x",), 0.5)
    s = predict_binary(df, [m], threshold=0.5).first()
    assert s.pred == 1 and s.verdict == "MALICIOUS"
    with pytest.raises(ValueError):
        predict_binary(df, [m], combine_rule="median")


def test_top_model_first_on_ties(spark):
    df = spark.createDataFrame([(1, 0.0)], "row_id long, x double")
    a, b = Tree("b_model", ("x",), 0.7), Tree("a_model", ("x",), 0.7)
    assert predict_binary(df, [a, b]).first().top_model == "a_model"


def _multi(name, bias, labels=()):
    return Softmax(name, ("x",), tuple((0.0,) for _ in bias), tuple(bias), labels=labels)


def test_stage2_rules(spark):
    df = spark.createDataFrame([(1, 0.0)], "row_id long, x double")
    hi = Tree("h", ("x",), 0.9)
    lo = Tree("l", ("x",), 0.1)
    # only benign votes -> Unknown Malware, 0.0
    benign = _multi("m1", (2.0, 0.0), labels=("-", "C&C"))
    r = two_stage(df, [hi], [benign]).first()
    assert (r.variant, r.variant_confidence) == ("Unknown Malware", 0.0)
    # equal confidence in two models -> first in name order
    m_a = _multi("ma", (0.0, 1.0), labels=("-", "DDoS"))
    m_b = _multi("mb", (0.0, 1.0), labels=("-", "Okiru"))
    r = two_stage(df, [hi], [m_b, m_a]).first()
    assert r.variant == "DDoS Attack" and r.variant_model == "ma"
    # class beyond the label list -> Variant-i, no display name
    m_v = _multi("mv", (0.0, 0.0, 3.0), labels=("-", "C&C"))
    assert two_stage(df, [hi], [m_v]).first().variant == "Variant-2"
    # one-class models are skipped; benign rows get N/A
    one = _multi("m0", (0.0,))
    r = two_stage(df, [lo], [one, m_a]).first()
    assert (r.variant, r.variant_confidence) == ("N/A", 0.0)


def test_empty_frame_summary(spark):
    df = spark.createDataFrame([], "row_id long, x double")
    s = predict_binary(df, [Tree("m", ("x",), 0.9)])
    r = report.threat_summary(s).first()
    assert (r.total, r.benign, r.malicious, r.threat_pct) == (0, 0, 0, 0.0)


def test_histogram_top_edge(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (0.55,)], "p double")
    h = {r.bin: r.n for r in report.histogram(df, "p", bins=10).collect()}
    assert h[9] == 1 and h[0] == 1 and h[5] == 1 and sum(h.values()) == 3 and len(h) == 10


def test_logistic_matches_formula(spark):
    import math
    df = spark.createDataFrame([(2.0, 1.0)], "a double, b double")
    m = Logistic("m", ("a", "b"), (0.5, -1.0), 0.25)
    p = df.select(m.expr().alias("p")).first().p
    assert p == pytest.approx(1 / (1 + math.exp(-(0.25 + 1.0 - 1.0))))


def test_column_names_with_dashes(spark):
    df = spark.createDataFrame([("-",)], "service string")
    assert prepare_features(df, ["service_-"]).select(col("service_-")).first()[0] == 1.0
