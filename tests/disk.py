"""Shuffle files on the disk of a local session."""

from __future__ import annotations

import contextlib
import os
import re
import time

from pyspark.sql import SparkSession


def local_folders(spark: SparkSession) -> list[str]:
    env = spark._jvm.org.apache.spark.SparkEnv.get()
    return list(env.blockManager().diskBlockManager().localDirsString())


def shuffles_in(folders: list[str]) -> set[int]:
    """The numbers of the shuffles that have files of any size; those of a few counts have not."""
    found = set()
    for folder, _, files in (step for top in folders for step in os.walk(top)):
        for name in files:
            shuffle = re.match(r"shuffle_(\d+)_.*\.data$", name)
            with contextlib.suppress(FileNotFoundError):
                if shuffle and os.path.getsize(os.path.join(folder, name)) > 1000:
                    found.add(int(shuffle[1]))
    return found


def shuffles_left(spark: SparkSession, before: set[int], seconds: float = 10) -> set[int]:
    """Shuffles since ``before`` that still have files; they go in the background."""
    folders, until = local_folders(spark), time.time() + seconds
    while (left := shuffles_in(folders) - before) and time.time() < until:
        time.sleep(0.1)
    return left
