"""Session-level helpers: scratch space and scan width."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def local_session(cpus: int | str = "*", app: str = "pressmill", **conf: str) -> SparkSession:
    """A session for tests and the bench. On a cluster, use the one you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers of an application, once.

    Functions that run in workers are sent by name. Workers of a driver that found the package by its own
    path only, as one started from another folder, would not find it.
    """
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = os.path.dirname(os.path.abspath(__file__))
        target = os.path.join(tempfile.mkdtemp(prefix="pressmill-"), "pressmill")
        archive = shutil.make_archive(target, "zip", os.path.dirname(package), os.path.basename(package))
        context.addPyFile(archive)
        _SHIPPED.add(context.applicationId)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may
    fall back to a folder of this machine, because there every task runs here.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="pressmill-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the scratch root."""
    return f"{scratch_root(spark)}/pressmill/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` to scratch and read it back.

    Cuts the lineage at files that outlive any executor, and gives the
    following steps a columnar table of which they read only what they need.
    ``codec`` takes the place of the session's compression.
    """
    return stored(df.sparkSession, df, name, codec)


def stored(spark: SparkSession, df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """``df`` written to scratch and read back in ``spark``, which may not be its own session."""
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


BROADCAST_ROWS = 1 << 18


def broadcast_if_small(table: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A stored table of short rows with a broadcast hint if it has few of them.

    Beyond the bound it is returned as it is, and Spark joins by shuffling.
    """
    return F.broadcast(table) if table.count() <= most else table


def spread(scan: DataFrame, *keys: str) -> DataFrame:
    """Widen a bare scan that has fewer tasks than the cluster has cores.

    One file with one row group is one task, however many cores wait for the
    text work that follows. A scan that is already wide enough is returned as
    it is, so at scale this adds no shuffle. ``keys`` should be unique: hashing
    them spreads evenly and gives the same placement when a task is retried.
    """
    width = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= width:
        return scan
    return scan.repartition(width, *keys)


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a costly column that later filters cannot recompute.

    A filter on a plain column is pushed below the projection that computes it, below
    joins and repartitioning too, and the expression is then evaluated there and again
    above. Filters do not pass a generator, and a one-element array makes one row.
    """
    others = [F.col(c) for c in df.columns if c != name]
    return df.select(*others, F.explode(F.array(value)).alias(name))
