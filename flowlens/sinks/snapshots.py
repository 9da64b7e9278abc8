"""Published tables: versioned snapshots and a pointer to the current one.

A table under ``root`` is a set of Parquet folders, ``root/data/<version>-<random>``,
and one small file, ``root/current``, that names the one to read. A new snapshot is
written beside the old ones and becomes current by replacing the pointer in one
step, so a reader finds either the old table or the new one, never a part of one
and never none. A version that was published already, or an older one, changes
nothing: a batch that is delivered again is written once.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

POINTER = "current"
#: Snapshots that stay besides the current one, for readers that found them before.
KEPT = 2


class _Folder:
    """A folder through Hadoop's file interface (any storage that Spark reads)."""

    def __init__(self, spark: SparkSession, root: str):
        jvm = spark.sparkContext._jvm
        self.fs_classes = jvm.org.apache.hadoop.fs
        self.root = self.fs_classes.Path(root.rstrip("/"))
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.root.getFileSystem(conf)
        self.context = self.fs_classes.FileContext.getFileContext(self.fs.makeQualified(self.root).toUri(), conf)
        self.gateway = spark.sparkContext._gateway

    def path(self, name: str):
        return self.fs_classes.Path(self.root, name)

    def replace(self, name: str, text: str) -> None:
        """Write a small file aside and move it over the old one in one step."""
        aside = self.path(f".{name}-{uuid.uuid4().hex}")
        out = self.fs.create(aside, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        rename = self.fs_classes.Options.Rename
        how = self.gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        self.context.rename(self.fs.makeQualified(aside), self.fs.makeQualified(self.path(name)), how)

    def read(self, name: str) -> str | None:
        path = self.path(name)
        if not self.fs.exists(path):
            return None
        stream = self.fs.open(path)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def names(self, name: str) -> list[str]:
        path = self.path(name)
        return [s.getPath().getName() for s in self.fs.listStatus(path)] if self.fs.exists(path) else []

    def remove(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def _pointer(folder: _Folder) -> tuple[int, str, str] | None:
    text = folder.read(POINTER)
    if text is None:
        return None
    version, name, schema = text.split("\n", 2)
    return int(version), name, schema


def current_version(spark: SparkSession, root: str) -> int | None:
    """The version that readers get; None where nothing is published."""
    found = _pointer(_Folder(spark, root))
    return None if found is None else found[0]


def publish_folder(spark: SparkSession, root: str, version: int, write, kept: int = KEPT) -> bool:
    """Let ``write(folder)`` fill a new folder and make it current.

    ``write`` returns the schema of the table that ``read_published`` is to read
    there, or None. False, and nothing changes, where that version or a later one
    is current: a batch that is delivered again does not count twice. A writer that
    dies leaves the old folder current; its own goes with a later version.
    """
    folder = _Folder(spark, root)
    before = _pointer(folder)
    if before is not None and before[0] >= version:
        return False
    name = f"{version:020d}-{uuid.uuid4().hex[:12]}"
    schema = write(f"{root.rstrip('/')}/data/{name}")
    folder.replace(POINTER, f"{version}\n{name}\n{schema.json() if schema is not None else ''}")
    old = sorted(n for n in folder.names("data") if n < name)
    for stale in old[:max(0, len(old) - kept)]:
        folder.remove(f"data/{stale}")
    return True


def publish(df: DataFrame, root: str, version: int, partition_by=(), kept: int = KEPT) -> bool:
    """Write ``df`` as version ``version`` of the table under ``root`` (see ``publish_folder``)."""
    def write(folder: str) -> T.StructType:
        df.write.partitionBy(*partition_by).parquet(folder)
        return df.schema

    return publish_folder(df.sparkSession, root, version, write, kept)


def published_folder(spark: SparkSession, root: str) -> str:
    """The folder that is current; an error where nothing was published."""
    found = _pointer(_Folder(spark, root))
    if found is None:
        raise FileNotFoundError(f"nothing is published under {root}")
    return f"{root.rstrip('/')}/data/{found[1]}"


def read_published(spark: SparkSession, root: str) -> DataFrame:
    """The current snapshot; an error where nothing was published."""
    found = _pointer(_Folder(spark, root))
    if found is None:
        raise FileNotFoundError(f"nothing is published under {root}")
    _, name, schema = found
    return spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(f"{root.rstrip('/')}/data/{name}")
