"""DuckDB SQL text for the oracle: flow views, feature preparation and the
fixed models restated as SQL expressions (rendered from the same model data).
"""

from __future__ import annotations

from flowlens.constants import VARIANT_DISPLAY
from flowlens.functions.clean import NUMERIC_TEXT
from flowlens.operators.models import Logistic, Softmax, Tree


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def num(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


FLOWS_E = """flows_e AS (
  SELECT event_id AS row_id, ts,
    'dataset' || CAST(user_id % 23 + 1 AS VARCHAR) AS dataset,
    CASE user_id % 4 WHEN 0 THEN 'TCP' WHEN 1 THEN 'udp' WHEN 2 THEN 'Icmp' END AS proto,
    CASE event_type WHEN 'click' THEN 'dns' WHEN 'view' THEN 'HTTP' WHEN 'purchase' THEN '-'
                    WHEN 'signup' THEN 'ssl' END AS service,
    value AS duration,
    CASE event_id % 10 WHEN 0 THEN '-' WHEN 1 THEN '' ELSE CAST(value AS VARCHAR) END AS orig_bytes,
    regexp_extract(props, '[0-9]+', 0) AS resp_bytes,
    user_id % 2 = 0 AS local_orig,
    CAST(event_id % 3 = 0 AS INTEGER) AS conn_state_SF,
    CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2
                    WHEN 'signup' THEN 3 WHEN 'view' THEN 4 END AS y_multiclass,
    CAST(CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2
                    WHEN 'signup' THEN 3 WHEN 'view' THEN 4 END > 0 AS INTEGER) AS y_binary
  FROM events)"""

FLOWS_L = """flows_l AS (
  SELECT 'dataset' || CAST(l_suppkey % 23 + 1 AS VARCHAR) AS dataset,
    CASE l_returnflag WHEN 'A' THEN 'tcp' WHEN 'N' THEN 'udp' WHEN 'R' THEN 'icmp' END AS proto,
    CASE l_linestatus WHEN 'F' THEN 'dns' WHEN 'O' THEN '-' END AS service,
    l_tax AS duration, l_extendedprice AS orig_bytes, l_quantity AS resp_bytes,
    l_discount AS missed_bytes,
    CAST(l_discount >= 0.05 AND l_quantity > 25 AS INTEGER) AS y_binary,
    CAST(0.0 AS DOUBLE) AS zero
  FROM lineitem)"""

# column types of the views, for feature coercion
E_TYPES = {"duration": "double", "orig_bytes": "text", "resp_bytes": "text", "local_orig": "bool",
           "conn_state_SF": "int", "y_multiclass": "int", "y_binary": "int", "row_id": "int"}
L_TYPES = {"duration": "double", "orig_bytes": "double", "resp_bytes": "double",
           "missed_bytes": "double", "y_binary": "int", "zero": "double"}


def parse_number(e: str) -> str:
    t = f"lower(trim({e}))"
    return f"CASE WHEN regexp_matches({t}, '{NUMERIC_TEXT}') THEN TRY_CAST({t} AS DOUBLE) END"


def to_double(name: str, kind: str) -> str:
    e = q(name)
    if kind == "text":
        v = parse_number(e)
    else:
        v = f"CAST({e} AS DOUBLE)"
    return f"coalesce(CASE WHEN isnan({v}) THEN CAST(0 AS DOUBLE) ELSE {v} END, CAST(0 AS DOUBLE))"


def feature_expr(f: str, types: dict) -> str:
    if f.startswith("proto_"):
        return f"CAST(coalesce(lower(proto) = {lit(f[6:])}, false) AS DOUBLE)"
    if f.startswith("service_"):
        return f"CAST(coalesce(lower(service) = {lit(f[8:])}, false) AS DOUBLE)"
    if f in types:
        return to_double(f, types[f])
    return "CAST(0.0 AS DOUBLE)"


def feats_cte(name: str, source: str, features, keep, types: dict) -> str:
    cols = [q(k) for k in keep] + [f"{feature_expr(f, types)} AS {q(f)}" for f in features]
    return f"{name} AS (SELECT {', '.join(cols)} FROM {source})"


def linear(features, weights, bias) -> str:
    z = num(bias)
    for f, w in zip(features, weights):
        z = f"{z} + {num(w)} * {q(f)}"
    return z


def model_expr(m) -> str:
    if isinstance(m, Logistic):
        p = f"(CAST(1.0 AS DOUBLE) / (CAST(1.0 AS DOUBLE) + exp(-({linear(m.features, m.weights, m.bias)}))))"
        return p if m.digits is None else f"round({p}, {m.digits})"
    if isinstance(m, Tree):
        def node(n):
            if not isinstance(n, tuple):
                return num(n)
            f, t, left, right = n
            return f"(CASE WHEN {q(f)} <= {num(t)} THEN {node(left)} ELSE {node(right)} END)"
        return node(m.root)
    raise TypeError(m)


def probs_expr(m: Softmax) -> str:
    ez = [f"exp({linear(m.features, ws, b)})" for b, ws in zip(m.bias, m.weights)]
    total = " + ".join(ez)
    return "[" + ", ".join(f"{e} / ({total})" for e in ez) + "]"


def argmax0(arr: str) -> str:
    return f"(list_position({arr}, list_max({arr})) - 1)"


def display_case(e: str) -> str:
    whens = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in VARIANT_DISPLAY.items())
    return f"coalesce(CASE {e} {whens} END, {e})"


def labels_case(labels, cls: str) -> str:
    whens = " ".join(f"WHEN {i} THEN {lit(v)}" for i, v in enumerate(labels))
    body = f"CASE {cls} {whens} END" if labels else "NULL"
    return f"coalesce({body}, 'Variant-' || CAST({cls} AS VARCHAR))"


def D(e: str) -> str:
    return f"CAST({e} AS DOUBLE)"


def B(e: str) -> str:
    return f"CAST({e} AS BIGINT)"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def ranked_sql(src: str, group: list[str], score: str, label: str, p: str) -> list[str]:
    """CTEs ending in ``{p}m``: per group n_pos, n_neg, roc_auc, pr_auc, best_f1,
    best_threshold (``exact_threshold``: not rounded), recall_at_fpr_01/005/001 (plain windows per group)."""
    g = ", ".join(group)
    return [
        f"{p}g AS (SELECT {g}, {score} AS s, {B(f'sum({label})')} AS pos, {B(f'sum(1 - {label})')} AS neg "
        f"FROM {src} GROUP BY ALL)",
        f"""{p}c AS (SELECT *, {B('sum(pos) OVER w')} AS tp, {B('sum(neg) OVER w')} AS fp,
           {B(f'sum(pos) OVER (PARTITION BY {g})')} AS P, {B(f'sum(neg) OVER (PARTITION BY {g})')} AS N
         FROM {p}g WINDOW w AS (PARTITION BY {g} ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
        f"{p}r AS (SELECT *, {D('tp')} / (tp + fp) AS prec, {D('tp')} / P AS rec, {D('fp')} / N AS fpr FROM {p}c)",
        f"""{p}m AS (SELECT {g}, P AS n_pos, N AS n_neg,
          CASE WHEN P > 0 AND N > 0 THEN round(sum(pos * (N - fp + 0.5 * neg)) / ({D('P')} * N), 6) END AS roc_auc,
          CASE WHEN P > 0 THEN round(sum({D('pos')} / P * prec), 6) END AS pr_auc,
          CASE WHEN P > 0 THEN round(max(2.0 * prec * rec / (prec + rec + 1e-12)), 6) END AS best_f1,
          CASE WHEN P > 0 THEN round(first(s ORDER BY 2.0 * prec * rec / (prec + rec + 1e-12) DESC, s ASC), 6) END
              AS best_threshold,
          CASE WHEN P > 0 THEN first(s ORDER BY 2.0 * prec * rec / (prec + rec + 1e-12) DESC, s ASC) END
              AS exact_threshold,
          CASE WHEN N > 0 THEN round(coalesce(max(CASE WHEN fpr <= 0.01 THEN rec END), 0), 6) END AS recall_at_fpr_01,
          CASE WHEN N > 0 THEN round(coalesce(max(CASE WHEN fpr <= 0.005 THEN rec END), 0), 6) END AS recall_at_fpr_005,
          CASE WHEN N > 0 THEN round(coalesce(max(CASE WHEN fpr <= 0.001 THEN rec END), 0), 6) END AS recall_at_fpr_001
        FROM {p}r GROUP BY {g}, P, N)""",
    ]


def values_table(name: str, col: str, values) -> str:
    rows = ", ".join(f"({lit(v)})" for v in values)
    return f"{name} AS (SELECT * FROM (VALUES {rows}) t({col}))"
