"""The whole scoring report of an upload in one pass over its scored rows (M9).

Every part of the report follows from three small things: a cube of cells
(verdict, variant, score bin) with their counts, per model the sum of its
probabilities and the rows that it flags, and the first rows of each verdict in
input order. Counts merge by adding, first rows by keeping the first again. No
built-in aggregate has a bounded buffer of rows, so each partition reduces its
scored rows to these three as Arrow batches; a partition sends at most its cells
and ``first`` rows for each verdict, whatever its size, and the merge is plain
grouping. Scoring itself stays inside generated code.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.constants import (BENIGN, DEFAULT_THRESHOLD, DIST_ROWS_PER_VERDICT, FIRST_ROWS, MALICIOUS)
from flowlens.operators.ensemble import prob_col
from flowlens.session import ship_package

BINS = 20
#: Groups that the rows kept by partitions are dealt to before one task sees them.
GROUPS = 64

_ROW = "index_key long, prob double, pred int, top_model string, top_model_conf double, variant string, variant_confidence double"
_PARTIAL = f"kind string, name string, bin int, n long, flagged long, total double, {_ROW}"


def _firsts(kept: pa.Table | None, batch: pa.Table, n: int) -> pa.Table:
    """The first ``n`` rows of each verdict of both tables, by ``index_key``."""
    both = batch if kept is None else pa.concat_tables([kept, batch])
    parts = []
    for verdict in (0, 1):
        own = both.filter(pc.equal(both["pred"], verdict))
        if own.num_rows > n:
            own = own.take(pc.select_k_unstable(own, n, [("index_key", "ascending"), ("prob", "ascending")]))
        parts.append(own)
    return pa.concat_tables(parts)


def _reduced(batches: Iterator[pa.RecordBatch], names: list[str], threshold: float, bins: int, first: int) -> Iterator[pa.RecordBatch]:
    cells: Counter = Counter()
    flagged, totals, rows = np.zeros(len(names), np.int64), np.zeros(len(names)), np.zeros(len(names), np.int64)
    kept = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        pred = table["pred"].to_numpy()
        prob = table["prob"].to_numpy(zero_copy_only=False)
        place = np.where(np.isnan(prob), -1, np.minimum(np.floor(np.nan_to_num(prob) * bins), bins - 1)).astype(np.int64)
        variant = table["variant"].combine_chunks().dictionary_encode()
        words = variant.dictionary.to_pylist()
        code = (variant.indices.to_numpy().astype(np.int64) * 2 + pred) * (bins + 1) + place + 1
        for c, n in zip(*(x.tolist() for x in np.unique(code, return_counts=True))):
            rest, b = divmod(c, bins + 1)
            cells[rest % 2, words[rest // 2], b - 1] += n
        for i, name in enumerate(names):
            p = table[prob_col(name)].drop_null().to_numpy()
            flagged[i] += int((p >= threshold).sum())
            totals[i] += float(p.sum())
            rows[i] += len(p)
        kept = _firsts(kept, table.drop_columns([prob_col(n) for n in names]), first)
    out = [{"kind": "cell", "pred": v, "variant": w, "bin": b, "n": n} for (v, w, b), n in sorted(cells.items())]
    out += [{"kind": "model", "name": m, "n": int(rows[i]), "flagged": int(flagged[i]), "total": float(totals[i])}
            for i, m in enumerate(names)]
    out += [{"kind": "row", **r} for r in (kept.to_pylist() if kept is not None else [])]
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64()}
    schema = pa.schema([(n, kinds[k]) for n, k in (c.split() for c in _PARTIAL.split(", "))])
    yield pa.RecordBatch.from_pylist(out, schema=schema)


def partial_reports(scored: DataFrame, model_names, threshold: float = DEFAULT_THRESHOLD, bins: int = BINS,
                    first: int = FIRST_ROWS, order_col: str = "row_id") -> DataFrame:
    """Cells, model sums and first rows of every partition of ``scored``."""
    ship_package(scored.sparkSession)
    names = sorted(model_names)
    narrow = scored.select(
        F.col(order_col).cast("long").alias("index_key"), "prob", F.col("pred").cast("int").alias("pred"),
        "top_model", "top_model_conf", "variant", F.col("variant_confidence").cast("double").alias("variant_confidence"),
        *[F.col(prob_col(n)) for n in names])
    return narrow.mapInArrow(lambda b: _reduced(b, names, threshold, bins, first), _PARTIAL)


def scoring_report(scored: DataFrame, model_names, threshold: float = DEFAULT_THRESHOLD, n_multi: int = 0,
                   bins: int = BINS, first: int = FIRST_ROWS, per_verdict: int = DIST_ROWS_PER_VERDICT,
                   order_col: str = "row_id") -> DataFrame:
    """One nested row: the report of all rows of ``scored`` from one scan.

    Columns: total, benign, malicious, threat_pct (2 digits, 0 without rows),
    results (the first ``first`` rows in the order of ``order_col``),
    model_stats (name, flagged, avg_prob with 4 digits, null without rows),
    variant_counts (map over all malicious rows), histogram (verdict, bin, n;
    bins with rows, scores that are null in none), prob_distribution (the first
    ``per_verdict`` scores of each verdict, 4 digits) and
    multiclass_models_used. ``per_verdict`` is at most ``first``. An empty input
    gives a row of zeros and empty lists.
    """
    if per_verdict > first:
        raise ValueError("per_verdict must not exceed first")
    parts = partial_reports(scored, model_names, threshold, bins, first, order_col)
    row = F.col("kind") == "row"
    # cells and model sums add up; each kept row is a group of its own
    merged = parts.groupBy("kind", "name", "bin", *[c.split()[0] for c in _ROW.split(", ")]).agg(
        F.sum("n").alias("n"), F.sum("flagged").alias("flagged"), F.sum("total").alias("total"), F.count(F.lit(1)).alias("times"))
    # rows that agree in everything were one group: as many rows again
    rows = merged.withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(row, F.least("times", F.lit(first))).otherwise(1).cast("int"))))
    order = ["index_key", "prob", "copy"]
    for keys in (["kind", "pred", F.pmod(F.xxhash64("index_key"), F.lit(GROUPS))], ["kind", "pred"]):
        rows = rows.withColumn("pos", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(
            ~row | (F.col("pos") <= first))
    cell, model = F.col("kind") == "cell", F.col("kind") == "model"

    def gathered(which: Column, *fields) -> Column:
        return F.sort_array(F.collect_list(F.when(which, F.struct(*fields))))

    verdict = F.when(F.col("pred") == 1, MALICIOUS).otherwise(BENIGN)
    one = rows.agg(
        F.coalesce(F.sum(F.when(cell, F.col("n"))), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(cell & (F.col("pred") == 1), F.col("n"))), F.lit(0)).alias("malicious"),
        gathered(row, "index_key", "prob", "pred", verdict.alias("verdict"), "top_model", "top_model_conf", "variant",
                 "variant_confidence").alias("rows"),
        gathered(model, "name", "flagged", F.round(F.try_divide("total", "n"), 4).alias("avg_prob")).alias("model_stats"),
        gathered(cell, "variant", "pred", verdict.alias("verdict"), "bin", "n").alias("cells"))
    pct = F.coalesce(F.round(F.try_divide(F.col("malicious").cast("double"), F.col("total")) * 100.0, 2), F.lit(0.0))
    results = F.transform(F.slice("rows", 1, first), lambda r, i: F.struct(
        i.cast("long").alias("index"), r["index_key"].alias("row_id"), F.round(r["prob"], 6).alias("probability"), r["verdict"].alias("verdict"),
        r["top_model"].alias("top_model"), F.round(r["top_model_conf"], 6).alias("top_model_conf"), r["variant"].alias("variant"),
        F.when(r["pred"] == 1, F.round(r["variant_confidence"], 4)).otherwise(F.lit(0.0)).alias("variant_confidence")))

    def firsts(pred: int) -> Column:
        return F.transform(F.slice(F.filter("rows", lambda r: r["pred"] == pred), 1, per_verdict), lambda r: F.round(r["prob"], 4))

    def by_key(cells: Column, key) -> Column:
        """Cells summed by a key, as entries; at most a few hundred cells."""
        keys = F.array_distinct(F.transform(cells, key))
        return F.transform(keys, lambda k: F.struct(k.alias("key"), F.aggregate(
            F.filter(cells, lambda c: key(c) == k), F.lit(0).cast("long"), lambda a, c: a + c["n"]).alias("n")))

    bad = F.filter("cells", lambda c: c["pred"] == 1)
    binned = F.filter("cells", lambda c: c["bin"] >= 0)
    return one.select(
        "total", (F.col("total") - F.col("malicious")).alias("benign"), "malicious", pct.alias("threat_pct"),
        results.alias("results"), "model_stats", F.map_from_entries(by_key(bad, lambda c: c["variant"])).alias("variant_counts"),
        by_key(binned, lambda c: F.struct(c["verdict"].alias("verdict"), c["bin"].alias("bin"))).alias("histogram"),
        F.struct(firsts(0).alias("benign"), firsts(1).alias("malicious")).alias("prob_distribution"),
        F.lit(n_multi).alias("multiclass_models_used"))


def report_lines(report: DataFrame) -> DataFrame:
    """The report as plain rows: part, name, pos, n, value and, for the first
    rows, top_model, top_model_conf, variant and variant_confidence."""
    none_s, none_d, none_l = F.lit(None).cast("string"), F.lit(None).cast("double"), F.lit(None).cast("long")

    def line(part, name=none_s, pos=none_l, n=none_l, value=none_d, top=none_s, conf=none_d, variant=none_s, vconf=none_d) -> Column:
        return F.struct(F.lit(part).alias("part"), name.alias("name"), pos.cast("long").alias("pos"), n.cast("long").alias("n"),
                        value.cast("double").alias("value"), top.alias("top_model"), conf.alias("top_model_conf"),
                        variant.alias("variant"), vconf.alias("variant_confidence"))

    totals = F.array(*[line("totals", F.lit(c), n=F.col(c)) for c in ("total", "benign", "malicious", "multiclass_models_used")],
                     line("totals", F.lit("threat_pct"), value=F.col("threat_pct")))
    def shares(verdict: str) -> Column:
        return F.transform(F.col(f"prob_distribution.{verdict.lower()}"),
                           lambda p, i: line("distribution", F.lit(verdict), i + 1, value=p))

    return report.select(F.inline(F.concat(
        totals,
        F.transform("model_stats", lambda m: line("model_stats", m["name"], n=m["flagged"], value=m["avg_prob"])),
        F.transform(F.map_entries("variant_counts"), lambda e: line("variant_counts", e["key"], n=e["value"])),
        F.transform("histogram", lambda h: line("histogram", h["key"]["verdict"], h["key"]["bin"], n=h["n"])),
        F.transform("results", lambda r: line("results", r["verdict"], r["index"], r["row_id"], r["probability"], r["top_model"],
                                              r["top_model_conf"], r["variant"], r["variant_confidence"])),
        shares(BENIGN), shares(MALICIOUS))))
