"""A stored table of cells that loads are merged into, and looked up by row key.

``rowkey, family, qualifier, value, day``: a cell's day is what its write is ordered by.
Cells lie in hash buckets of their row key, sorted within each, so a load rewrites only the
buckets it touches and a lookup opens one bucket and, by statistics and bloom filters, few row groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.sinks.tables import OLD, Folder, overwrite_table, put_in_place
from earshot.workspace import ensure_checkpoint_dir

CELL = ["rowkey", "family", "qualifier"]
SCHEMA = "rowkey string, family string, qualifier string, value string, day string, bucket int"
BUCKETS = 1_024
# Within the table, under names that its readers pass over.
MERGE, MADE_WITH = ".merge", ".buckets-"
# A row group holds about a megabyte of cells, some ten thousand.
ROW_GROUP_BYTES = 1 << 20
STORED = {
    "parquet.block.size": str(ROW_GROUP_BYTES),
    "parquet.bloom.filter.enabled#rowkey": "true",
    "parquet.bloom.filter.expected.ndv#rowkey": "10000",
    # Sizes are looked at often enough to close a group in time.
    "parquet.page.size.row.check.min": "100",
    "parquet.block.size.row.check.min": "100",
}


def bucket_of(rowkey: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(rowkey), F.lit(buckets)).cast("int")


def merge_cells(cells: DataFrame, path: str, buckets: int = BUCKETS) -> list[int]:
    """Merge ``rowkey, family, qualifier, value, day`` into the table; the buckets rewritten.

    The cell of the latest day stays; on the same day the load at hand wins over what is
    stored, and of several in it the largest text.  So merging a load again changes nothing,
    and loads of different days may come in any order.  Buckets are written beside the table,
    counted, then put in place one by one; those without new cells keep their files.  A merge that
    is cut off leaves each bucket whole, old or new, and is finished by merging again.  A table keeps
    the number of buckets it was made with; another raises.
    """
    spark = cells.sparkSession
    ensure_checkpoint_dir(spark)
    _made_with(spark, path, buckets)
    recover_buckets(spark, path)
    new = (
        cells.select(*CELL, "value", F.col("day").cast("string").alias("day"))
        .withColumn("bucket", bucket_of(F.col("rowkey"), buckets))
        .withColumn("load", F.lit(1))
        .checkpoint()
    )
    touched = sorted(  # at most ``buckets`` rows
        row["bucket"] for row in new.select("bucket").distinct().collect()
    )
    if not touched:
        return []
    stored = read_cells(spark, path).where(F.col("bucket").isin(touched))
    last = F.max(F.struct("day", "load", "value"))
    merged = (
        new.unionByName(stored.withColumn("load", F.lit(0)))
        .groupBy("bucket", *CELL)
        .agg(last.alias("last"))
        .select(*CELL, F.col("last.value").alias("value"), F.col("last.day").alias("day"), "bucket")
    )
    fresh = f"{path}/{MERGE}"
    overwrite_table(in_buckets(merged), fresh, ["bucket"], **STORED)
    for bucket in touched:
        put_in_place(spark, f"{fresh}/bucket={bucket}", f"{path}/bucket={bucket}")
    Folder.at(spark, fresh).delete()
    spark.catalog.refreshByPath(path)
    return touched


def _made_with(spark: SparkSession, path: str, buckets: int) -> None:
    """Note the number of buckets of a new table; raise if an old one has another."""
    known = [n for n in Folder.at(spark, path).names() if n.startswith(MADE_WITH)]
    if not known:
        Folder.at(spark, f"{path}/{MADE_WITH}{buckets}").make()
    elif known != [f"{MADE_WITH}{buckets}"]:
        raise ValueError(f"{path} has {known[0].removeprefix(MADE_WITH)} buckets, not {buckets}")


def recover_buckets(spark: SparkSession, path: str) -> None:
    """Put back buckets that a cut-off merge had set aside."""
    names = Folder.at(spark, path).names()
    for name in names:
        if name.startswith(".bucket=") and OLD in name:
            aside, place = Folder.at(spark, f"{path}/{name}"), name[1:].split(OLD)[0]
            if place in names:
                aside.delete()
            else:
                aside.rename(Folder.at(spark, f"{path}/{place}"))


def in_buckets(cells: DataFrame) -> DataFrame:
    """Cells in ranges of bucket, row key and qualifier: a busy user's spread over files."""
    order = ["bucket", "rowkey", "qualifier"]
    return cells.repartitionByRange(*order).sortWithinPartitions(*order)


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """``rowkey, family, qualifier, value, day, bucket``; nothing where no table is."""
    names = [n for n in Folder.at(spark, path).names() if n.startswith("bucket=")]
    if not names:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(path)


def lookup(
    spark: SparkSession, path: str, rowkeys: Sequence[str], buckets: int = BUCKETS
) -> DataFrame:
    """All cells of a few row keys, read from their buckets alone."""
    _made_with(spark, path, buckets)
    asked = [bucket_of(F.lit(key), buckets) for key in rowkeys]
    wanted = set(spark.range(1).select(F.array(*asked).alias("buckets")).first()["buckets"])
    return (
        read_cells(spark, path)
        .where(F.col("bucket").isin(sorted(wanted)) & F.col("rowkey").isin(list(rowkeys)))
        .drop("bucket")
    )
