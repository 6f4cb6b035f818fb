"""Scores for given pairs from plain factor tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.functions.vectors import dot


def score_pairs(
    pairs: DataFrame, user_factors: DataFrame, item_factors: DataFrame, rank: int
) -> DataFrame:
    """``pairs`` plus ``prediction float``; NaN when either side is unknown.

    Two left equi-joins against tables that hold each id once.  No broadcast is
    forced: Spark broadcasts a factor table when its size allows, and otherwise
    AQE splits the partitions of a busy user or item.
    """
    users = user_factors.select(
        F.col("id").alias("userId"), F.col("features").alias("user_features")
    )
    items = item_factors.select(
        F.col("id").alias("sourceId"), F.col("features").alias("item_features")
    )
    left, right = F.col("user_features"), F.col("item_features")
    known = left.isNotNull() & right.isNotNull()
    score = dot(left, right, rank).cast("float")
    prediction = F.when(known, score).otherwise(F.lit(float("nan")).cast("float"))
    # A plain projection would be repeated below every filter on its outcome; a generator
    # is evaluated once per pair.
    return (
        pairs.join(users, "userId", "left")
        .join(items, "sourceId", "left")
        .select(*pairs.columns, F.inline(F.array(F.struct(prediction.alias("prediction")))))
    )
