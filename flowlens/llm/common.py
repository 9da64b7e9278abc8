"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word: a run of characters other than space and the ASCII controls 9-13.
WORD = r"[^\x20\x09-\x0D]+"
#: Buckets of one ordered scan (see ``prefix_sums``).
BUCKETS = 4096
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only for a local
    session that names none. On a cluster that would be lost to the other machines."""
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        base = tempfile.mkdtemp(prefix="flowlens-shared-")
        context.setCheckpointDir(base)
    return base.rstrip("/")


def ship(spark: SparkSession) -> SparkSession:
    """Send this package's modules to the Python workers, once for a context, and
    text to them in batches that stay small where documents are long."""
    context = spark.sparkContext
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, "1024")
    if not getattr(context, "_flowlens_shipped", False):
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        target = os.path.join(tempfile.mkdtemp(prefix="flowlens-modules-"), "flowlens.zip")
        with zipfile.ZipFile(target, "w") as z:
            for folder, _, names in os.walk(package):
                for name in (n for n in names if n.endswith(".py")):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
        context.addPyFile(target)
        context._flowlens_shipped = True
    return spark


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` as a table in the shared folder, read it back.

    The table is columnar and compressed, later reads keep column pruning, and
    it survives lost executors.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def quoted(name: str) -> str:
    """A column name as it is written in an expression."""
    return "`" + name.replace("`", "``") + "`"


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns of a row, of any types."""
    return F.xxhash64(F.to_json(F.struct(*[F.col(quoted(c)) for c in df.columns])))


def with_decisions(df: DataFrame, decisions: DataFrame, *keys: tuple[Column, str]) -> tuple[DataFrame, list[str]]:
    """``df`` with the columns of ``decisions`` under names of their own, and those names.

    ``keys`` are pairs of an expression over ``df`` and the column of ``decisions``
    that it equals (null equals null); rows without a decision go. ``decisions``
    is narrow and has one row for each key. It is the side that is held in a hash
    map, partition by partition, and never more than its part of the texts; these
    are shuffled once, streamed, and neither sorted nor gathered.
    """
    names = [free_name(df, f"__{c}") for c in decisions.columns]
    named = decisions.toDF(*names).hint("shuffle_hash")
    on = None
    for value, column in keys:
        same = value.eqNullSafe(F.col(names[decisions.columns.index(column)]))
        on = same if on is None else on & same
    return df.join(named, on), names


def one_of_each(df: DataFrame, kept: DataFrame, *keys: tuple[Column, str]) -> DataFrame:
    """One row of ``df`` for each row of ``kept``, with all columns of ``df``.

    ``keys`` as in ``with_decisions``; ``kept`` has also ``n``, the rows of ``df``
    with that key. Of several the one with the lowest hash of all columns stays;
    they are pre-aggregated, so a key that a third of all rows hold is a row for
    each task. Columns may have any type and any name.
    """
    joined, names = with_decisions(df, written(kept), *keys)
    n = F.col(names[kept.columns.index("n")])
    columns = [F.col(quoted(c)) for c in df.columns]
    row = free_name(df, "__row")
    several = joined.where(n > 1).groupBy(*[names[kept.columns.index(k)] for _, k in keys]).agg(
        F.min_by(F.struct(*columns), row_hash(df)).alias(row))
    return joined.where(n == 1).select(*columns).unionByName(
        several.select(*[F.col(row).getField(c).alias(c) for c in df.columns]))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A lambda variable is bound to the value, so that neither the optimizer nor
    an inner lambda evaluates the expression again.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does the same for pure ASCII and is faster."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def word_count(text: Column) -> Column:
    """Words of a text as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def prefix_sums(df: DataFrame, groups: list[str], bucket: str, order: list[Column],
                sums: dict[str, str]) -> DataFrame:
    """Running position and running sums in an order, with no task per group.

    ``bucket`` is an integer column that never decreases along ``order`` and has
    a bounded number of values. Bucket totals are summed on that small table;
    only rows of one (group, bucket) meet in a task. Adds ``__pos`` (from 1, in
    the group) and, for each (name, column) of ``sums``, the running sum up to
    and including the row. Nulls are an ordinary group.
    """
    keys = [*groups, bucket]
    totals = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"),
                                   *[F.sum(c).alias(f"__t_{n}") for n, c in sums.items()])
    before = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    base = totals.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        F.coalesce(F.sum("__n").over(before), zero).alias("__before"),
        *[F.coalesce(F.sum(f"__t_{n}").over(before), zero).alias(f"__before_{n}") for n in sums])
    on = None
    for i, k in enumerate(keys):
        same = F.col(k).eqNullSafe(F.col(f"__k{i}"))
        on = same if on is None else on & same
    inside = Window.partitionBy(*keys).orderBy(*order)
    running = inside.rowsBetween(Window.unboundedPreceding, 0)
    return df.join(base, on).select(
        *df.columns,
        (F.col("__before") + F.row_number().over(inside)).alias("__pos"),
        *[(F.col(f"__before_{n}") + F.sum(c).over(running)).alias(n) for n, c in sums.items()])
