"""Hand-written models used by the registered queries.

The shipped detector's model files are not available, so the query suite
scores with small fixed models whose outputs can be restated in SQL: two
logistic models and a depth-2 tree in stage 1, softmax models in stage 2 (one
with more classes than labels, one with a single class that must be skipped),
a 6-class evaluation model and two models for the binary metric suite.
"""

from __future__ import annotations

from flowlens.constants import DATASET_VARIANTS, SELECTED_BINARY, SELECTED_MULTI
from flowlens.operators.models import Logistic, Softmax, Tree

BINARY = (
    Logistic("dataset10", ("duration", "resp_bytes", "proto_tcp", "service_dns"),
             (0.004, -0.01, 0.6, -2.5), 1.2),
    Tree("dataset4", ("service_dns", "duration", "local_orig"),
         ("service_dns", 0.5, ("duration", 30.0, 0.62, 0.81), ("local_orig", 0.5, 0.35, 0.18))),
    Logistic("dataset9", ("orig_bytes", "service_http", "proto_udp", "local_orig", "service_ssl"),
             (0.003, 0.9, -0.4, 0.3, 0.7), -0.2),
)

MULTI = (
    Softmax("dataset12", ("duration", "service_http", "service_ssl", "proto_tcp"),
            ((0.0, 0.0, 0.0, 0.0), (0.004, 1.2, -0.3, 0.2), (-0.002, -0.5, 1.5, 0.4),
             (0.006, 0.3, 0.2, -0.6)),
            (0.5, 0.0, 0.1, -0.4)),
    # three classes, two known labels: class 2 is reported as Variant-2
    Softmax("dataset16", ("resp_bytes", "local_orig", "service_-"),
            ((0.0, 0.0, 0.0), (0.01, 0.5, -0.8), (-0.008, -0.4, 1.6)),
            (0.2, -0.3, 0.0)),
    Softmax("dataset20", ("duration", "proto_icmp"),
            ((0.0, 0.0), (0.003, 1.1)),
            (0.0, -0.5)),
    # one class: never used for stage 2
    Softmax("dataset1", ("duration",), ((0.0,),), (0.0,)),
)

# 6 classes over labels 0..4 of flows_e: class 5 is never true (absent class)
EVAL_MULTI = Softmax(
    "dataset8",
    ("service_dns", "service_http", "service_-", "service_ssl", "duration", "local_orig"),
    ((2.2, 0.0, 0.0, 0.0, 0.0, 0.0),
     (-1.0, -1.0, -1.0, -1.0, 0.002, 0.0),
     (0.0, 0.0, 2.0, 0.0, 0.0, 0.4),
     (0.0, 0.0, 0.0, 1.9, -0.003, 0.0),
     (0.0, 2.1, 0.0, 0.0, 0.0, -0.5),
     (0.0, 0.0, 0.0, 0.0, 0.0, 0.0)),
    (0.0, 0.3, 0.0, 0.0, 0.0, -3.0),
    labels=("click", "error", "purchase", "signup", "view"),
)

# binary metric suite over flows_l
METRIC_MODELS = (
    Logistic("dataset5", ("resp_bytes", "missed_bytes", "duration"), (0.12, 30.0, 4.0), -5.5,
             digits=9),
    Tree("dataset13", ("missed_bytes", "resp_bytes"),
         ("missed_bytes", 0.045, ("resp_bytes", 30.0, 0.1, 0.3), ("resp_bytes", 25.5, 0.4, 0.9))),
)

# ---- the whole ensemble: 8 binary and 20 multiclass models, weights by a rule ----
_SCALES = {"duration": 200.0, "orig_bytes": 200.0, "resp_bytes": 200.0, "local_orig": 2.0, "proto_tcp": 2.0, "proto_udp": 2.0,
           "proto_icmp": 2.0, "service_dns": 2.0, "service_http": 2.0, "service_-": 2.0, "service_ssl": 2.0}


def _weights(i: int, k: int, features) -> tuple:
    """Between -5 and 5 over the feature's scale, different for each model and class."""
    return tuple(((7 * i + 5 * k + 3 * j) % 11 - 5) / _SCALES[f] for j, f in enumerate(features))


def full_ensemble() -> tuple[list, list]:
    """(8 binary models, 20 multiclass models) under the selected names, with each
    dataset's own classes."""
    names = list(_SCALES)
    binary = []
    for i, name in enumerate(SELECTED_BINARY):
        own = tuple(names[(i + j * 3) % len(names)] for j in range(3))
        binary.append(Logistic(name, own, _weights(i, 0, own), ((i * 5) % 7 - 2) / 4))
    multi = []
    for i, name in enumerate(SELECTED_MULTI):
        own = tuple(names[(i + j * 2) % len(names)] for j in range(4))
        classes = range(len(DATASET_VARIANTS[name]))
        multi.append(Softmax(name, own, tuple(_weights(i, k, own) for k in classes), tuple(((i + 3 * k) % 5 - 2) / 4 for k in classes)))
    return binary, multi
