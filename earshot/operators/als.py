"""Fit, apply, save and reload the factorisation (MLlib's ALS)."""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.params import AlsParams
from earshot.workspace import drop_shuffles, ensure_checkpoint_dir

MIN_BLOCKS = 10
# MLlib drops the factors exchanged so far when it stores those of the items.  It would do so every
# ten iterations; until then each half step leaves a copy of a side's factors per block it meets.
CHECKPOINT_EVERY = 1


def block_count(n_ratings: int, ratings_per_block: int) -> int:
    """Blocks for a training set; blocks are ALS's unit of parallelism.

    Every user block exchanges factors with every item block, so ``ratings_per_block``
    should grow with the memory of an executor.
    """
    return max(MIN_BLOCKS, math.ceil(n_ratings / ratings_per_block))


def pin_layout(ratings: DataFrame, partitions: int) -> DataFrame:
    """The same rows in the same partitions and order, whatever the input layout.

    Keyed on the pair, not the user, so that one busy user spreads over all
    partitions, and on the number of the copy, so that a repeated row does too.
    """
    copies = ratings.groupBy("userId", "sourceId", "rating").agg(F.count(F.lit(1)).alias("n"))
    numbered = copies.select(
        "userId", "sourceId", "rating", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy")
    )
    return (
        numbered.repartition(partitions, "userId", "sourceId", "rating", "copy")
        .sortWithinPartitions("userId", "sourceId", "rating")
        .drop("copy")
    )


def fit(ratings: DataFrame, params: AlsParams, n_ratings: int) -> ALSModel:
    """Train on ``userId, sourceId, rating``.

    Repeated (user, item) pairs stay separate observations.  ``n_ratings`` sizes
    the blocks that ``params`` leave open; callers have it from the split counts.  Blocks
    and layout follow from the ratings alone, so equal seeds give equal factors.

    MLlib asks for its input's partitions before it reads them, and would run the shuffles of the
    layout each time: the rows laid out stay on the executors' disks during the fit.  The shuffles
    behind them, and those behind the factors afterwards, do not.
    """
    if n_ratings == 0:
        raise ValueError("no training rows")
    ensure_checkpoint_dir(ratings.sparkSession)
    blocks = block_count(n_ratings, params.ratings_per_block)
    als = ALS(
        rank=params.rank,
        maxIter=params.max_iter,
        regParam=params.reg,
        nonnegative=params.nonnegative,
        seed=params.seed,
        numUserBlocks=params.user_blocks or blocks,
        numItemBlocks=params.item_blocks or blocks,
        checkpointInterval=CHECKPOINT_EVERY,
        userCol="userId",
        itemCol="sourceId",
        ratingCol="rating",
    )
    if not params.pin_layout:
        return _without_shuffles(als.fit(ratings))
    pinned = pin_layout(ratings, blocks).persist(StorageLevel.DISK_ONLY)
    try:
        pinned.count()
        drop_shuffles(pinned)
        return _without_shuffles(als.fit(pinned))
    finally:
        pinned.unpersist()


def _without_shuffles(model: ALSModel) -> ALSModel:
    """The model, whose factors the executors hold, without the shuffle files of the fit."""
    drop_shuffles(model.userFactors)
    drop_shuffles(model.itemFactors)
    return model


def predict(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """``prediction`` for each pair, NaN where the user or the item is unknown."""
    return model.transform(pairs)


def save(model: ALSModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> ALSModel:
    return ALSModel.load(path)
