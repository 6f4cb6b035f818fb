"""The shared folder that checkpoints and scratch tables live in."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Spark's own switch, since 4.1; earlier versions pass over it.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local-mode session may go without that setting (tests); there a
    temporary folder is as shared as the single machine itself.  Anywhere else
    a machine-local folder would be lost with its executor, so it is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_folder()


@cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="earshot-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def ensure_checkpoint_dir(spark: SparkSession, folder: str | None = None) -> None:
    """Make ``DataFrame.checkpoint`` and ALS's own checkpoints land in the shared folder.

    ``folder`` serves where the session names none: jobs give one below their storage root.
    """
    if spark.sparkContext.getCheckpointDir() is None:
        if folder is None or spark.conf.get("spark.checkpoint.dir", None):
            folder = shared_folder(spark)
        spark.sparkContext.setCheckpointDir(folder)


def scratch_root(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one."""
    return f"{shared_folder(spark)}/earshot/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query run within go when it ends.

    Otherwise they lie on the executors' disks until the driver happens to collect its garbage.
    """
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def drop_shuffles(held: DataFrame) -> None:
    """Remove the shuffle files behind a table that the executors hold, in memory or on disk.

    Spark keeps them as long as the table.  Partitions lost later are made anew from the
    source, as they would be where an executor is lost with its files.
    """
    behind = held._jdf.queryExecution().toRdd().getNarrowAncestors()
    for i in range(behind.size()):
        behind.apply(i).cleanShuffleDependencies(False)
