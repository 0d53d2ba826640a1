"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from fieldlake.errors import SourceError

#: The setting that names the folder of the present run.
SCRATCH = "fieldlake.scratch"
#: Whether the shuffle files of a query go when it has ended; else they stay until the driver collects its garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(
    app_name: str = "fieldlake", master: str | None = None, shuffle_partitions: int | None = None
) -> SparkSession:
    """A session with the settings the library is tuned for; cluster settings win elsewhere."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Dates are cut from timestamps in the session zone, so every run uses the same one."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder every executor can reach, for tables and checkpoints of one run.

    It lies in the folder named by ``spark.checkpoint.dir``, within ``scratch_run`` in that run's. Only a local session may do without
    that setting; a machine's own temporary folder is of no use to a cluster.
    """
    root = spark.conf.get(SCRATCH, None) or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise SourceError("spark.checkpoint.dir must name a folder all executors share")
        root = tempfile.mkdtemp(prefix="fieldlake-")
    return os.path.join(root, f"{label}-{uuid.uuid4().hex}")


@contextmanager
def scratch_run(spark: SparkSession, label: str = "run") -> Iterator[str]:
    """One folder for all scratch tables of what runs inside, removed at the end; write the results before it."""
    folder, before = scratch_folder(spark, label), spark.conf.get(SCRATCH, None)
    spark.conf.set(SCRATCH, folder)
    try:
        yield folder
    finally:
        if before is None:
            spark.conf.unset(SCRATCH)
        else:
            spark.conf.set(SCRATCH, before)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Each query that runs inside removes its shuffle files at its end; what it has written stays."""
    before = spark.conf.get(SHUFFLES_GO, "false")
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES_GO, before)
