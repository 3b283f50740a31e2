"""Spark session construction and shared-folder helpers."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(master: str | None = None, app: str = "riskloom",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session with AQE (coalescing + skew-join splitting) and the UI off.

    On a cluster ``master`` stays None so the launcher decides; shuffle
    partitions default to Spark's and AQE coalesces them at runtime.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # checkpoint files are removed once their DataFrame is unreachable
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    ``fallback`` is only for tests and local runs where the setting is unset;
    it is applied to the SparkContext (the config itself is fixed at start).
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isEmpty():
        d = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            if fallback is None:
                raise RuntimeError("spark.checkpoint.dir is not set; pass a shared folder")
            d = fallback
        sc.setCheckpointDir(d)
        current = sc._jsc.sc().getCheckpointDir()
    return current.get()


def materialize(df: DataFrame, label: str = "cut") -> DataFrame:
    """Cut lineage: write ``df`` once as Parquet under the shared checkpoint folder, read it back.

    One computation (a reliable ``checkpoint()`` computes its input twice
    unless persisted), columnar re-reads with pruning, and the table
    survives lost executors. Tables go to
    ``<spark.checkpoint.dir>/riskloom-tables/<label>-<uuid>``.
    """
    import uuid

    spark = df.sparkSession
    base = checkpoint_dir(spark)
    path = os.path.join(base, "riskloom-tables", f"{label}-{uuid.uuid4().hex}")
    for owner in _owners:
        owner.append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


_owners: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Owner of scratch tables: deletes, at the end or on error, all that ``materialize`` wrote inside.

    Use it around a query whose result is consumed inside::

        with scratch(spark):
            queries()["dq_all"](spark, folder).write.parquet(out)
    """
    mine: list[str] = []
    _owners.append(mine)
    try:
        yield mine
    finally:
        _owners.remove(mine)
        sc = spark.sparkContext
        for path in mine:
            at = sc._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def has_checkpoint_dir(spark: SparkSession) -> bool:
    return bool(spark.conf.get("spark.checkpoint.dir", None)
                or spark.sparkContext.getConf().get("spark.checkpoint.dir")
                or not spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty())


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a plan (file sizes x projection), no job run."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - estimate unavailable
        return None


def broadcast_if_small(df: DataFrame, max_bytes: int = 64 << 20, max_rows: int = 1_000_000) -> DataFrame:
    """Broadcast hint only behind a size check; otherwise Spark picks the join.

    The check is Catalyst's size estimate; when no estimate exists, a bounded
    row count (at most ``max_rows + 1`` rows read). Beyond the bound the join
    stays a shuffle join (sort-merge, with AQE skew splitting).
    """
    size = estimated_bytes(df)
    if size is not None:
        return F.broadcast(df) if size <= max_bytes else df
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def size_shuffle_partitions(spark: SparkSession, inputs, target_bytes: int = 256 << 20,
                            max_partitions: int = 200_000) -> int:
    """Initial shuffle partitions from the inputs' estimated size (~``target_bytes`` each).

    AQE coalesces partitions that turn out small but does not split large
    ones (apart from skewed joins), so the initial count must cover the
    largest shuffle: about total input bytes / target, never below the
    cluster's parallelism. Applied only while the setting is Spark's default
    or was made here before; it then only grows.
    """
    import math

    now = spark.conf.get("spark.sql.shuffle.partitions")
    own = _sized.get(spark.sparkContext.applicationId)
    if "spark.sql.shuffle.partitions" in dict(spark.sparkContext.getConf().getAll()) or now not in ("200", own):
        return int(now)
    total = sum(estimated_bytes(df) or 0 for df in inputs)
    n = min(max(spark.sparkContext.defaultParallelism, math.ceil(total / target_bytes)), max_partitions)
    if own is None or n > int(own):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        _sized[spark.sparkContext.applicationId] = str(n)
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: shuffle partitions set by ``size_shuffle_partitions``, by application
_sized: dict[str, str] = {}


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
