"""Mixing sources to target weights by entropy balancing (DataFrame functions only).

Each source has a target number of words. A document's rate (expected copies)
is its prior rate 1 tilted exponentially, ``min(cap, exp(lambda * ln(1 + size)))``,
with one multiplier per source: the solution of the entropy-balancing programme
that stays closest to the prior and meets the source's word constraint. The
convex dual is one-dimensional for each source; Newton steps (guarded by a
bracket) run for all sources in parallel on a histogram of document sizes.
Rates are rounded into whole copies by sequential Poisson sampling: every
document gets the integer part, and in the order of (hash / fraction) further
single copies until the source's target is reached, so that a source misses its
target by half a document at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BUCKETS, free_name, prefix_sums, quoted, row_hash, with_decisions, word_count, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
NEWTON_STEPS = 60
#: Histogram bins per doubling of the size: at most 31 * 8 bins for a source.
BINS = 8
SEED = "mix-1"


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """Targets per source from a table (source, source_size) with a row per source.

    Sources in code-point order, null last, take the weights in turn. A target
    stops at ``cap`` times its source's size; the excess goes to the others by
    weight until none is above. That fixed point is a water level: sources
    sorted by (cap * size / weight) are full up to the level, the rest get
    weight * level. The window sorts one row per source.
    """
    turn = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    w = sizes.withColumn("__i", (F.row_number().over(turn) - 1) % len(weights))
    w = (w.withColumn("__w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.col("__i") + 1))
         .withColumn("__goal", F.sum("source_size").over(everything) * F.lit(float(share)))
         .withColumn("__full", (F.col("source_size") * cap).cast("double")))
    fill = Window.orderBy(F.col("__full") / F.col("__w"), F.col("source").asc_nulls_last())
    upto = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # level if all sources before this one are full and this one and later ones are not
    w = w.withColumn("__level", (F.col("__goal") - F.coalesce(F.sum("__full").over(upto), F.lit(0.0)))
                     / F.sum("__w").over(after))
    # sources stay full while their own level is above their ceiling
    w = w.withColumn("__open", F.col("__level") * F.col("__w") < F.col("__full"))
    level = F.min(F.when(F.col("__open"), F.struct(F.col("__full") / F.col("__w"), F.col("__level")))).over(everything)
    w = w.withColumn("__water", level.getField("__level"))
    return w.select("source", "source_size", F.when(
        F.col("__water").isNull(), F.col("__full")).otherwise(
        F.least(F.col("__full"), F.col("__w") * F.col("__water"))).alias("target"))


def _dual_newton(bins: Column, target: Column, cap: int) -> Column:
    """The multiplier of one source from its bins (z, words).

    Finds ``sum(words * min(cap, exp(x * z))) = target``, the stationary point
    of the concave dual; a step that leaves the bracket is replaced by its middle.
    """
    def step(state, _):
        x, lo, hi = state.getField("x"), state.getField("lo"), state.getField("hi")

        def moments(acc, b):
            rate = F.least(F.lit(float(cap)), F.exp(x * b.getField("z")))
            free = rate < cap
            return F.struct((acc.getField("f") + b.getField("words") * rate).alias("f"),
                            (acc.getField("g") + F.when(free, b.getField("words") * b.getField("z") * rate)
                             .otherwise(F.lit(0.0))).alias("g"))

        zero = F.struct(F.lit(0.0).alias("f"), F.lit(0.0).alias("g"))
        m = F.aggregate(bins, zero, moments, lambda m: F.struct(
            m.getField("f").alias("f"), m.getField("g").alias("g"), x.alias("x"), lo.alias("lo"), hi.alias("hi")))
        return F.element_at(F.transform(F.array(m), lambda m: _advance(m, target)), 1)

    start = F.struct(F.lit(0.0).alias("x"), F.lit(-60.0).alias("lo"), F.lit(60.0).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(NEWTON_STEPS)), start, step, lambda s: s.getField("x"))


def _advance(m: Column, target: Column) -> Column:
    x, f, g = m.getField("x"), m.getField("f"), m.getField("g")
    lo = F.when(f < target, x).otherwise(m.getField("lo"))
    hi = F.when(f < target, m.getField("hi")).otherwise(x)
    newton = x - (f - target) / F.when(g > 0, g)
    return F.struct(F.when((newton > lo) & (newton < hi), newton).otherwise((lo + hi) / 2).alias("x"),
                    lo.alias("lo"), hi.alias("hi"))


def mix_sources(df: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
                weights=WEIGHTS, share: float = SHARE, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """One row per row of ``df``: doc_id, size, source_size, target, taken, source, copies, rate.

    ``size`` counts words (null text: 0); null is a source of its own, last in
    order. ``copies`` is between 0 and ``cap`` and ``taken = copies * size``.
    Documents without words have rate 1 and are kept once (they take no words).
    A source without words has target 0. Repeated ids are ordered by size and
    otherwise interchangeable; equal rows get single positions. The result
    depends on ids and sizes only, so reruns agree. An empty table gives an
    empty result. The text is read once and never shuffled; sources of any size
    are spread over (source, bucket) tasks.
    """
    rows = written(df.select(
        F.col(id_col).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size")))
    octave = F.floor(F.log2(F.col("size") + 1.0) * BINS).cast("int")
    binned = (rows.groupBy("source", octave.alias("__bin"))
              .agg(F.sum("size").alias("__words"), F.count(F.lit(1)).alias("__n")))
    per_bin = F.struct(F.col("__bin").alias("bin"),
                       F.log(1.0 + F.col("__words") / F.col("__n")).alias("z"),
                       F.col("__words").cast("double").alias("words"))
    # at most 31 * BINS entries for a source, whatever its number of documents
    sources = binned.groupBy("source").agg(
        F.sum("__words").alias("source_size"), F.sort_array(F.collect_list(per_bin)).alias("__bins"))
    targets = source_targets(sources.select("source", "source_size"), weights, share, cap)
    joined = sources.withColumnRenamed("source", "__s").drop("source_size").join(
        targets, F.col("__s").eqNullSafe(F.col("source")))
    full = F.col("target") >= cap * F.col("source_size") * (1 - 1e-12)
    solved = written(joined.select(
        F.col("source").alias("__s"), "source_size", "target", "__bins",
        F.when(~full, _dual_newton(F.col("__bins"), F.col("target"), cap)).alias("multiplier")))
    rates = solved.select("__s", "source_size", "target", "multiplier", F.explode("__bins").alias("__b")).select(
        "__s", "source_size", "target", F.col("__b.bin").alias("__rbin"),
        F.when(F.col("__b.words") == 0, F.lit(1.0))
        .when(F.col("multiplier").isNull(), F.lit(float(cap)))
        .otherwise(F.least(F.lit(float(cap)), F.exp(F.col("multiplier") * F.col("__b.z")))).alias("rate"))
    d = rows.withColumn("__bin", octave).join(
        rates, F.col("source").eqNullSafe(F.col("__s")) & (F.col("__bin") == F.col("__rbin"))).drop("__s", "__rbin", "__bin")
    h = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    u = (F.conv(F.substring(h, 1, 12), 16, 10).cast("double") + 0.5) / float(16 ** 12)
    whole = F.floor(F.col("rate"))
    part = F.col("rate") - whole
    d = (d.withColumn("__whole", whole.cast("int"))
         .withColumn("__xi", F.when(part > 0, u / part))
         .withColumn("__base", F.col("__whole") * F.col("size")))
    # words still wanted beyond the whole copies, per source
    base = d.groupBy(F.col("source").alias("__s")).agg(F.sum("__base").alias("__sure"))
    open_rows = d.where(F.col("__xi").isNotNull())
    slot = F.floor(F.col("__xi") / (1 + F.col("__xi")) * BUCKETS).cast("int")
    run = prefix_sums(open_rows.withColumn("__at", slot), ["source"], "__at",
                      [F.col("__xi"), F.col("doc_id"), F.col("size")], {"__cum": "size"}).drop("__at", "__pos")
    shut = d.where(F.col("__xi").isNull()).withColumn("__cum", F.lit(None).cast("long"))
    both = run.unionByName(shut).join(base, F.col("source").eqNullSafe(F.col("__s")))
    want = F.col("target") - F.col("__sure")
    # taken while less than half of the document lies beyond the target
    extra = F.when(F.col("__cum") - F.col("size") / 2 <= want, 1).otherwise(0)
    copies = (F.col("__whole") + F.coalesce(F.when(F.col("__cum").isNotNull(), extra), F.lit(0))).cast("int")
    return both.select("doc_id", "size", "source_size", "target", (copies * F.col("size")).cast("long").alias("taken"),
                       "source", copies.alias("copies"), "rate")


def mixed_documents(df: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
                    **options) -> DataFrame:
    """The mix itself: rows of ``df`` repeated by their copies, with all columns of ``df``.

    Rows of the same id, source and size are interchangeable: they share the
    copies that they got together evenly, and where that leaves a rest, the first
    in the order of a hash of the whole row take one more. Columns may have any
    type and any name.
    """
    taken = written(mix_sources(df, id_col, text, source, **options)
                    .groupBy("doc_id", "source", "size")
                    .agg(F.sum("copies").alias("all"), F.count(F.lit(1)).alias("rows")).where("all > 0"))
    joined, names = with_decisions(df, taken, (F.col(id_col), "doc_id"), (F.col(source), "source"),
                                   (word_count(F.col(text)), "size"))
    key, (wanted, rows) = names[:3], names[3:]
    columns = [F.col(quoted(c)) for c in df.columns]
    row, same, h, at, upto, many = (free_name(joined, f"__{c}") for c in ("row", "same", "hash", "at", "upto", "copies"))
    rest, each = F.col(wanted) % F.col(rows), F.expr(f"{wanted} div {rows}")
    even = joined.where(rest == 0).select(*columns, each.cast("int").alias(many))
    # equal rows are counted, not numbered: a key of many rows needs no task of its own
    uneven = joined.where(rest != 0).groupBy(*key, wanted, rows, row_hash(df).alias(h)).agg(
        F.any_value(F.struct(*columns)).alias(row), F.count(F.lit(1)).alias(same))
    run = prefix_sums(written(uneven).withColumn(at, F.pmod(h, F.lit(BUCKETS)).cast("int")), key, at, [F.col(h)], {upto: same})
    more = F.greatest(F.lit(0), F.least(F.col(same), rest - (F.col(upto) - F.col(same))))
    shared = run.select(*[F.col(row).getField(c).alias(c) for c in df.columns], (each * F.col(same) + more).cast("int").alias(many))
    # a copy of a row for each element: the array is of numbers, the text stands once
    return even.unionByName(shared).where(F.col(many) > 0).withColumn(at, F.explode(F.sequence(F.lit(1), F.col(many)))).select(*columns)
