"""Tables that a load replaces."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from earshot.workspace import shuffles_dropped

# A table on its way in or out stands beside its place under a name that readers of the
# parent folder pass over.
NEW, OLD = ".new-", ".old-"


def overwrite_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), **options: str
) -> int:
    """Replace the whole table, creating it when missing; returns its number of rows.

    The rows are written beside it, counted in what was stored, and put in its place by
    renaming, so a load that fails leaves the table as it was, and one may read the table that it
    replaces.  Loads of one table are not meant to run at the same time.
    """
    spark = df.sparkSession
    recover_table(spark, path)
    fresh = _beside(path, NEW)
    try:
        written = _write_counted(df, fresh, partition_by, options)
        stored = spark.read.parquet(fresh).count() if written else 0
        if stored != written:
            raise RuntimeError(f"{path}: {stored} rows stored of {written}")
        put_in_place(spark, fresh, path)
    except BaseException:
        Folder.at(spark, fresh).delete()
        raise
    spark.catalog.refreshByPath(path)
    return written


def _write_counted(
    df: DataFrame, path: str, partition_by: Sequence[str], options: dict[str, str]
) -> int:
    """Write and count in one pass.  Only tasks that were committed have their rows counted."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("n"))
    with shuffles_dropped(df.sparkSession):
        counted.write.options(**options).partitionBy(*partition_by).parquet(path)
    return seen.get.get("n", 0)


def put_in_place(spark: SparkSession, fresh: str, path: str) -> None:
    """Rename ``fresh`` to ``path``; what was there goes, or comes back if that fails."""
    place, old = Folder.at(spark, path), Folder.at(spark, _beside(path, OLD))
    before = place.exists()
    if before:
        place.rename(old)
    else:
        place.make_parent()
    try:
        Folder.at(spark, fresh).rename(place)
    except BaseException:
        if before:
            old.rename(place)
        raise
    if before:
        old.delete()


def recover_table(spark: SparkSession, path: str) -> bool:
    """Clear up after a load that was cut off; whether the table had to be put back.

    Between the two renames of a switch the former table stands beside its empty place.
    """
    place = Folder.at(spark, path)
    back = False
    for left in place.siblings(OLD):
        if place.exists():
            left.delete()
        else:
            left.rename(place)
            back = True
    for left in place.siblings(NEW):
        left.delete()
    return back


def overwrite_dates(df: DataFrame, path: str, date_column: str = "dt", *further: str) -> None:
    """Replace only the dates present in ``df``; other dates stay.

    Dates may be cut ``further``; then the parts present in ``df`` are replaced.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        date_column, *further
    ).parquet(path)


def preview(df: DataFrame, *keys: str, n: int = 20) -> DataFrame:
    """The first rows in key order, so that two previews of one table agree."""
    return df.orderBy(*keys).limit(n)


def _beside(path: str, mark: str) -> str:
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/.{name}{mark}{uuid.uuid4().hex}"


class Folder:
    """A folder of whatever file system its path names."""

    @classmethod
    def at(cls, spark: SparkSession, path: str) -> Folder:
        return cls(spark, spark._jvm.org.apache.hadoop.fs.Path(path))

    def __init__(self, spark: SparkSession, path) -> None:
        self.spark, self.path = spark, path
        self.fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def exists(self) -> bool:
        return self.fs.exists(self.path)

    def delete(self) -> None:
        self.fs.delete(self.path, True)

    def make(self) -> None:
        self.fs.mkdirs(self.path)

    def make_parent(self) -> None:
        self.fs.mkdirs(self.path.getParent())

    def rename(self, to: Folder) -> None:
        if not self.fs.rename(self.path, to.path):
            raise OSError(f"{self.path} could not be renamed to {to.path}")

    def siblings(self, mark: str) -> list[Folder]:
        """Folders beside this one that bear its name and ``mark``."""
        parent = self.path.getParent()
        if not self.fs.exists(parent):
            return []
        prefix = f".{self.path.getName()}{mark}"
        return [
            Folder(self.spark, status.getPath())
            for status in self.fs.listStatus(parent)
            if status.getPath().getName().startswith(prefix)
        ]

    def has_parts(self) -> bool:
        return any(s.getPath().getName().startswith("part-") for s in self.fs.listStatus(self.path))

    def names(self) -> list[str]:
        """Folders within this one."""
        if not self.exists():
            return []
        statuses = self.fs.listStatus(self.path)
        return sorted(s.getPath().getName() for s in statuses if s.isDirectory())
