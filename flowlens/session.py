"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale; local tests override the partition count only.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # HotSpot does not JIT methods above 8000 bytes of bytecode; a fused stage
    # bigger than that is better split back into per-operator code.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # no Python call-site capture on every column function (plans are built
    # from generated expressions; the capture costs a stack walk per call)
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # checkpointed tables in the shared folder are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# Runtime SQL settings the plans rely on; applied to a session handed to us.
PLAN_CONF = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply ``PLAN_CONF`` to an existing session (runtime SQL confs only)."""
    for k, v in PLAN_CONF.items():
        spark.conf.set(k, v)
    return spark


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package's modules to the Python workers, once for a context."""
    context = spark.sparkContext
    if not getattr(context, "_flowlens_shipped", False):
        package = os.path.dirname(os.path.abspath(__file__))
        target = os.path.join(tempfile.mkdtemp(prefix="flowlens-modules-"), "flowlens.zip")
        with zipfile.ZipFile(target, "w") as z:
            for folder, _, names in os.walk(package):
                for name in (n for n in names if n.endswith(".py")):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
        context.addPyFile(target)
        context._flowlens_shipped = True
    return spark


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "flowlens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the cluster's shared folder (``spark.checkpoint.dir``).

    Only a local session that names none gets a temporary folder of its own; on
    a cluster that would be lost to the other machines, so it is an error.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        base = tempfile.mkdtemp(prefix="flowlens-ckpt-")
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}" if name else base


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet in the shared folder and read it back."""
    path = shared_dir(df.sparkSession, f"flowlens-table-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
