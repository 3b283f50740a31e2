"""Versioned tables in a shared folder: written beside the old ones, published by one small pointer.

``<base>/<layer>/<name>/v-<id>/`` holds one version of a table and
``<base>/<layer>/<name>/_published/<n>`` names the version that counts: the
one with the largest n. A new version is written whole, then a pointer file
appears by a rename; readers follow the pointer. A job that dies while it
writes leaves the old version published, a version without a pointer is
never read, and ``publish`` deletes all but the newest two.

Tables with an ``id`` can be bucketed and sorted by it (``buckets`` > 0): rows
of one id are in one bucket, so unique checks and distinct counts read them
without an exchange. The pointer keeps the number of buckets, so that another
session reads the folder as a bucketed table, too; as plain Parquet it can be
read in any case.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

KEEP = 2


class NotPublished(FileNotFoundError):
    """A table that has no published version."""


@dataclass(frozen=True)
class Version:
    name: str
    buckets: int = 0


class Store:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base

    def folder(self, layer: str, name: str) -> str:
        return os.path.join(self.base, layer, name)

    # --- the folder through Spark's file systems ------------------------------
    def _path(self, *parts: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(*parts))
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        path, fs = self._path(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def _pointers(self, layer: str, name: str) -> list[str]:
        return [n for n in self._names(os.path.join(self.folder(layer, name), "_published")) if n.isdigit()]

    def _pointed(self, layer: str, name: str, pointer: str) -> Version:
        path, fs = self._path(self.folder(layer, name), "_published", pointer)
        stream = fs.open(path)
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        version, _, buckets = text.strip().partition(" ")
        return Version(version, int(buckets or 0))

    # --- writing ----------------------------------------------------------------
    def write(self, df: DataFrame, layer: str, name: str, buckets: int = 0) -> Version:
        """Write one version; nobody reads it before ``publish``."""
        version = Version(f"v-{uuid.uuid4().hex}", buckets if buckets and "id" in df.columns else 0)
        path = os.path.join(self.folder(layer, name), version.name)
        if not version.buckets:
            df.write.parquet(path)
            return version
        table = _table(layer, name, version)
        try:
            # one task a bucket; rows already dealt so (by a bucketed input) are not moved again
            (df.repartition(version.buckets, "id").write.bucketBy(version.buckets, "id").sortBy("id")
             .option("path", path).format("parquet").saveAsTable(table))
        except Exception:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            raise
        return version

    def publish(self, layer: str, name: str, version: Version) -> None:
        """Make ``version`` the one that is read; older ones than the last two are deleted."""
        pointers = self._pointers(layer, name)
        number = f"{int(pointers[-1]) + 1 if pointers else 1:012d}"
        tmp, fs = self._path(self.folder(layer, name), "_published", f"_{uuid.uuid4().hex}")
        out = fs.create(tmp)
        out.write(bytearray(f"{version.name} {version.buckets}".encode()))
        out.close()
        final, _ = self._path(self.folder(layer, name), "_published", number)
        if not fs.rename(tmp, final):
            raise RuntimeError(f"pointer {number} of {layer}/{name} exists: another job publishes this table")
        for old in pointers[:-(KEEP - 1)]:
            gone = self._pointed(layer, name, old)
            for part in (("_published", old), (gone.name,)):
                path, fs = self._path(self.folder(layer, name), *part)
                fs.delete(path, True)
            self.spark.sql(f"DROP TABLE IF EXISTS {_table(layer, name, gone)}")

    def replace(self, df: DataFrame, layer: str, name: str, buckets: int = 0) -> DataFrame:
        """Write, publish and read back."""
        self.publish(layer, name, self.write(df, layer, name, buckets))
        return self.read(layer, name)

    # --- reading ----------------------------------------------------------------
    def current(self, layer: str, name: str) -> Version:
        pointers = self._pointers(layer, name)
        if not pointers:
            raise NotPublished(f"{layer}/{name} has no published version under {self.base}")
        return self._pointed(layer, name, pointers[-1])

    def read(self, layer: str, name: str, version: Version | None = None) -> DataFrame:
        version = version or self.current(layer, name)
        path = os.path.join(self.folder(layer, name), version.name)
        if not version.buckets:
            return self.spark.read.parquet(path)
        table = _table(layer, name, version)
        if not self.spark.catalog.tableExists(table):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spark.read.parquet(path).schema)
            self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (id) SORTED BY (id) "
                           f"INTO {version.buckets} BUCKETS LOCATION '{path}'")
        return self.spark.table(table)


def _table(layer: str, name: str, version: Version) -> str:
    return f"riskloom_{layer}_{name}_{version.name.replace('-', '_')}"
