"""Choosing a fit by its error on the validation split."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.functions.vectors import dot
from earshot.operators import als
from earshot.params import AlsParams
from earshot.workspace import ensure_checkpoint_dir


@dataclass(frozen=True)
class Trial:
    """A fit and its error; ``rmse`` is None when no validation row was usable."""

    params: AlsParams
    n_eval: int
    rmse: float | None


@dataclass(frozen=True)
class Choice:
    """The best fit (the first one among equals, or if none could be judged) and all trials."""

    model: ALSModel
    best: int
    trials: list[Trial]

    @property
    def params(self) -> AlsParams:
        return self.trials[self.best].params


def choose(
    train: DataFrame, validation: DataFrame, grid: Sequence[AlsParams], n_train: int
) -> Choice:
    """Fit every setting of ``grid`` on ``train`` and keep the one with the least validation error.

    The training rows are laid out and stored once for all fits; the validation rows are
    scored by all models in one pass.
    """
    if not grid:
        raise ValueError("no settings to choose from")
    if not n_train:
        raise ValueError("no training rows")
    ensure_checkpoint_dir(train.sparkSession)
    blocks = max(als.block_count(n_train, params.ratings_per_block) for params in grid)
    laid = als.pin_layout(train, blocks).checkpoint()
    models = [
        als.fit(
            laid,
            replace(
                params,
                pin_layout=False,
                user_blocks=params.user_blocks or blocks,
                item_blocks=params.item_blocks or blocks,
            ),
            n_train,
        )
        for params in grid
    ]
    errors = score_together(validation, models).first()
    trials = [
        Trial(params, errors[f"n{i}"], errors[f"rmse{i}"]) for i, params in enumerate(grid)
    ]
    best = min(
        range(len(trials)),
        key=lambda i: math.inf if trials[i].rmse is None else trials[i].rmse,
    )
    return Choice(models[best], best, trials)


def score_together(pairs: DataFrame, models: Sequence[ALSModel]) -> DataFrame:
    """One row ``n0, rmse0, n1, rmse1, ...``: every model's error on ``userId, sourceId, rating``.

    The models' factors are laid side by side by id first, so the pairs are joined twice
    whatever the number of models.
    """
    users = _side_by_side([m.userFactors for m in models], "userId", "u")
    items = _side_by_side([m.itemFactors for m in models], "sourceId", "i")
    met = pairs.join(users, "userId", "left").join(items, "sourceId", "left")
    label = F.col("rating").cast("double")
    errors = [
        # As the models themselves have it, scores are floats.
        (label - dot(F.col(f"u{i}"), F.col(f"i{i}"), model.rank).cast("float").cast("double")).alias(
            f"error{i}"
        )
        for i, model in enumerate(models)
    ]
    # Evaluated once per pair, not once per aggregate.
    scored = met.select(F.inline(F.array(F.struct(*errors))))
    found = []
    for i in range(len(models)):
        error = F.nanvl(f"error{i}", F.lit(None).cast("double"))
        found += [F.count(error).alias(f"n{i}"), F.sqrt(F.avg(error * error)).alias(f"rmse{i}")]
    return scored.agg(*found)


def _side_by_side(factors: Sequence[DataFrame], key: str, mark: str) -> DataFrame:
    """``key`` and each model's vector, null where a model does not have the id."""
    wide = factors[0].select(F.col("id").alias(key), F.col("features").alias(f"{mark}0"))
    for i, more in enumerate(factors[1:], 1):
        right = more.select(F.col("id").alias(key), F.col("features").alias(f"{mark}{i}"))
        wide = wide.join(right, key, "full")
    return wide
