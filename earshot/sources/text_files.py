"""Scans of dated text folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.sources.ledger import DAY_FOLDER


def scan_days(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """``value, day`` of the ``part-*`` files of several days' folders, in one scan."""
    rows = spark.read.text([f"{folder.rstrip('/')}/part-*" for folder in folders.values()])
    day = F.regexp_extract(F.col("_metadata.file_path"), DAY_FOLDER.pattern + "/[^/]*$", 1)
    return rows.select("value", day.alias("day"))


def scan_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every line of the folder's ``part-*`` files, as ``value string``.

    Plain text rather than CSV: the CSV reader drops blank lines and marks lines
    with extra fields as corrupt, and both have to be told apart here.
    """
    return spark.read.text(folder.rstrip("/") + "/part-*")
