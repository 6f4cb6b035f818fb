"""Dated folders and the ledger of those that were loaded."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.sinks.tables import Folder, overwrite_table

# Fixed value: the name of a day's folder.
DAY_FOLDER = re.compile(r"(\d{4}-\d{2}-\d{2})\.dat")
LEDGER = "day string, good_lines bigint, bad_lines bigint"


def day_folders(spark: SparkSession, folder: str) -> DataFrame:
    """``day, path`` of the dated folders that have ``part-*`` files; others are passed over.

    One row per day: the listing of one folder, whatever the days hold.
    """
    found = [
        (match[1], f"{folder.rstrip('/')}/{match[0]}")
        for match in map(DAY_FOLDER.fullmatch, Folder.at(spark, folder).names())
        if match and Folder.at(spark, f"{folder}/{match[0]}").has_parts()
    ]
    return spark.createDataFrame(found, "day string, path string")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """``day, good_lines, bad_lines`` of the days loaded so far, each once."""
    if not Folder.at(spark, path).exists():
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def days_to_load(spark: SparkSession, folder: str, ledger: str) -> DataFrame:
    """``day, path`` of the folders that the ledger does not have."""
    return day_folders(spark, folder).join(read_ledger(spark, ledger), "day", "left_anti")


def enter(days: DataFrame, path: str) -> None:
    """Add ``day, good_lines, bad_lines`` to the ledger; a day that is there is replaced.

    The ledger has a row per day and is replaced as a whole, so it is never seen half written.
    """
    spark = days.sparkSession
    before = read_ledger(spark, path).join(days, "day", "left_anti")
    columns = [F.col("day"), F.col("good_lines").cast("long"), F.col("bad_lines").cast("long")]
    overwrite_table(before.unionByName(days.select(*columns)).coalesce(1), path)
