"""Baseline ratings from user and item biases: an answer for pairs that the factors do not know.

``rating ~ mean + user bias + item bias``, both biases shrunk toward zero as if ``shrink`` more
ratings had been at the baseline.  Each side is the other's leftover mean, in turn, until
neither moves: grouped sums and equi-joins only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.workspace import ensure_checkpoint_dir

SHRINK = 5.0
MOST_ROUNDS = 50
TOLERANCE = 1e-6


@dataclass(frozen=True)
class Biases:
    """``users`` is ``userId, user_bias``, ``items`` is ``sourceId, item_bias``; both stored."""

    mean: float
    users: DataFrame
    items: DataFrame
    rounds: int


def fit_biases(
    ratings: DataFrame,
    shrink: float = SHRINK,
    most_rounds: int = MOST_ROUNDS,
    tolerance: float = TOLERANCE,
) -> Biases:
    """Biases of stored ``userId, sourceId, rating``; rows with a null or NaN in them do not count.

    Items first, then users; ends when no user's bias moves by more than ``tolerance``, or after
    ``most_rounds``.  No ratings give a mean of zero and no biases.
    """
    if shrink < 0 or most_rounds < 1:
        raise ValueError(f"shrink from 0 and at least one round, got {shrink}, {most_rounds}")
    ensure_checkpoint_dir(ratings.sparkSession)
    rows = ratings.select(
        "userId", "sourceId", F.col("rating").cast("double").alias("rating")
    ).na.drop()
    mean = rows.agg(F.avg("rating")).first()[0] or 0.0
    # Copies of a pair add up, so a pair is one row whatever its copies.
    pairs = (
        rows.groupBy("userId", "sourceId")
        .agg(F.sum(F.col("rating") - mean).alias("over"), F.count(F.lit(1)).alias("n"))
        .checkpoint()
    )
    users = pairs.groupBy("userId").agg(F.lit(0.0).alias("user_bias")).checkpoint()
    for done in range(1, most_rounds + 1):
        items = _leftover(pairs, users, "userId", "sourceId", "item_bias", shrink).checkpoint()
        fresh = _leftover(pairs, items, "sourceId", "userId", "user_bias", shrink).checkpoint()
        moved = (
            fresh.join(users.withColumnRenamed("user_bias", "was"), "userId")
            .agg(F.max(F.abs(F.col("user_bias") - F.col("was"))))
            .first()[0]
        )
        users = fresh
        if moved is None or moved <= tolerance:
            break
    return Biases(mean, users, items, done)


def _leftover(
    pairs: DataFrame, known: DataFrame, by: str, of: str, name: str, shrink: float
) -> DataFrame:
    """The biases of one side, given the other's."""
    other = F.col("user_bias" if by == "userId" else "item_bias")
    met = pairs.join(known, by)
    total = F.sum(F.col("over") - F.col("n") * other)
    return met.groupBy(of).agg((total / (F.sum("n") + shrink)).alias(name))


def baseline(biases: Biases, pairs: DataFrame) -> DataFrame:
    """``pairs`` with ``baseline double``: unknown users and items count as average; never null."""
    none = F.lit(0.0)
    return (
        pairs.join(biases.users, "userId", "left")
        .join(biases.items, "sourceId", "left")
        .withColumn(
            "baseline",
            F.lit(biases.mean) + F.coalesce("user_bias", none) + F.coalesce("item_bias", none),
        )
        .select(*pairs.columns, "baseline")
    )


def fill_cold(biases: Biases, predictions: DataFrame) -> DataFrame:
    """``predictions`` with the baseline where ``prediction`` is null or NaN, and ``cold boolean``."""
    cold = F.col("prediction").isNull() | F.isnan("prediction")
    kept: list[Column] = [F.col(c) for c in predictions.columns if c != "prediction"]
    return baseline(biases, predictions).select(
        *kept,
        F.when(cold, F.col("baseline")).otherwise(F.col("prediction")).cast("float").alias("prediction"),
        cold.alias("cold"),
    )
