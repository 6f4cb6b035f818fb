"""The k best items for every user, exactly, without scoring every pair.

``score(user, item) <= |user| * |item|``, so items are cut into shards by falling
norm.  Every user meets the first shard, which gives a k-th best score to beat;
after that a user only meets the shards whose largest norm could still beat it.
Users and shards come together in equi-joined groups of bounded size on both
sides, and a group emits at most k rows per user.

Nothing is broadcast and nothing grows with the data on the driver except one
(count, norm) row per shard.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.functions.vectors import norm
from earshot.operators import topk_kernel
from earshot.schemas import RECOMMENDATIONS
from earshot.workspace import ensure_checkpoint_dir, shuffles_dropped

# What one group may hold: factor values of items and of users, and result rows.
SHARD_VALUES = 4_000_000
GROUP_VALUES = 4_000_000
GROUP_RESULTS = 1_000_000
MIN_GROUP_USERS = 64
BLOCK_ITEMS = 4_096
MAX_PARTITIONS = 20_000
# Scores are compared as floats; the bound gets this much slack for rounding.
SLACK = 1.0 + 1e-6

_FOUND = "id int, recommendations array<struct<sourceId:int,rating:float>>"
_CARRIED = f"{_FOUND}, features array<float>, kth_key bigint"


def recommend_for_all_users(
    model: ALSModel, k: int, rated: DataFrame | None = None, **sizes: int
) -> DataFrame:
    """``userId, recommendations``: the k best items of each user in the model.

    Items a user has already rated are kept in unless ``rated`` names them.
    """
    return top_k_items(model.userFactors, model.itemFactors, k, rated=rated, **sizes)


def top_k_items(
    users: DataFrame,
    items: DataFrame,
    k: int,
    shard_items: int | None = None,
    group_users: int | None = None,
    rated: DataFrame | None = None,
) -> DataFrame:
    """``userId, recommendations`` from two ``(id int, features array<float>)`` tables.

    Both tables are scanned several times, so pass stored ones (a saved model's).
    Each array runs from the highest score down, ties by lower item id, and holds
    ``min(k, number of items)`` entries, of the items that ``rated`` (``userId, sourceId``,
    repeats allowed) does not name for the user.  Scores to beat are those of what is left, so the
    bounds stay exact; a user who has rated everything gets an empty array.
    """
    if k < 1:
        raise ValueError(f"k must be at least 1, got {k}")
    spark = users.sparkSession
    n_users, n_items = users.count(), items.count()
    if n_users == 0 or n_items == 0:
        return spark.createDataFrame([], RECOMMENDATIONS)

    rank = max(1, items.select(F.size("features")).first()[0])
    shard_items = shard_items or max(1, SHARD_VALUES // rank)
    group_users = group_users or max(
        MIN_GROUP_USERS, min(GROUP_VALUES // rank, GROUP_RESULTS // k)
    )
    # Small inputs still get enough groups to keep every core busy.
    cores = spark.sparkContext.defaultParallelism
    spread = min(4 * cores, math.ceil(n_users / MIN_GROUP_USERS))
    group_users = min(group_users, math.ceil(n_users / spread))

    shards = _Shards.plan(items, n_items, k, shard_items)
    blocks = _item_blocks(shards.assign(items), min(shard_items, n_items))
    everyone = users.select(
        F.col("id").cast("int").alias("id"),
        F.col("features").cast("array<float>").alias("features"),
        F.lit(None).cast("bigint").alias("floor_key"),
        F.lit(0).alias("shard"),
    )
    single = len(shards.top_norms) == 1
    if rated is not None:
        ensure_checkpoint_dir(spark)
        with shuffles_dropped(spark):
            rated = _rated_by_shard(rated, shards.assign(items)).checkpoint()
    first = _meet(everyone, blocks, {0: n_users}, group_users, k, not single, rated)
    if single:
        return first.select(F.col("id").alias("userId"), "recommendations")

    ensure_checkpoint_dir(spark)
    return _next_rounds(first, shards, blocks, group_users, k, rated)


def _rated_by_shard(rated: DataFrame, sharded: DataFrame) -> DataFrame:
    """``id, shard, rated``: per user and shard the ids to leave out, no longer than a shard.

    Items the model does not have need no leaving out.  Repeats go in the grouping, which takes
    them out map-side too, so that pairs are not shuffled once more for that.
    """
    pairs = rated.select(
        F.col("userId").cast("int").alias("id"), F.col("sourceId").cast("int").alias("item")
    )
    known = sharded.select(F.col("id").alias("item"), "shard")
    return (
        pairs.join(known, "item")
        .groupBy("id", "shard")
        .agg(F.sort_array(F.collect_set("item")).alias("rated"))
    )


def _next_rounds(
    state: DataFrame,
    shards: _Shards,
    blocks: DataFrame,
    group_users: int,
    k: int,
    rated: DataFrame | None,
) -> DataFrame:
    """Further shards by batches of 1, 2, 4, ...; a user leaves when none left can matter.

    Norms fall from shard to shard, so a user whom the next shard cannot serve is done.
    Each round raises the scores to beat, and at most a batch of rows waits per user.
    """
    done, n_shards = [], len(shards.top_norms)
    low, batch = 1, 1
    while low < n_shards:
        high = min(low + batch, n_shards)
        possible = shards.still_possible(k, low, high, lowest_first=rated is None)
        with shuffles_dropped(state.sparkSession):
            state = state.withColumn("shards", possible).checkpoint()
        left = state.where(F.size("shards") > 0)
        done.append(state.where(F.size("shards") == 0))
        pending = left.select(
            "id", "features", F.col("kth_key").alias("floor_key"), F.explode("shards").alias("shard")
        )
        # One row per shard of the batch.
        waiting = {r["shard"]: r["count"] for r in pending.groupBy("shard").count().collect()}
        if not waiting:
            break
        found = _meet(pending, blocks, waiting, group_users, k, False, rated)
        best = _merge(left.select("id", "recommendations").unionByName(found), k)
        carried = left.select(F.col("id").alias("userId"), "features", "kth_key")
        # A user for whom all items so far were left out has none yet.
        none = F.array().cast(RECOMMENDATIONS["recommendations"].dataType)
        state = (
            carried.join(best, "userId", "left")
            .withColumn("recommendations", F.coalesce("recommendations", none))
            .withColumnRenamed("userId", "id")
        )
        low, batch = high, 2 * batch
    else:
        done.append(state)
    return reduce(
        DataFrame.unionByName,
        [part.select(F.col("id").alias("userId"), "recommendations") for part in done],
    )


def flatten(recommendations: DataFrame) -> DataFrame:
    """``userId, sourceId, rating``: one row per recommended item."""
    return recommendations.select("userId", F.inline("recommendations"))


def item_ids(recommendations: DataFrame) -> DataFrame:
    """``userId, itemIds``: only the item ids, as strings, best first."""
    return recommendations.select(
        "userId", F.col("recommendations.sourceId").cast("array<string>").alias("itemIds")
    )


@dataclass(frozen=True)
class _Shards:
    """How items fall into shards: norm bins, the fuller ones cut further by id."""

    edges: list[float]  # falling norms between bins
    first_shard: list[int]  # per bin
    pieces: list[int]  # per bin
    top_norms: list[float]  # per shard, falling
    lowest_ids_up_to: int | None

    @classmethod
    def plan(cls, items: DataFrame, n_items: int, k: int, shard_items: int) -> _Shards:
        wanted = math.ceil(n_items / shard_items)
        if wanted == 1:
            return cls([], [0], [1], [math.inf], None)
        shares = [i / wanted for i in range(1, wanted)]
        norms = items.select(norm(F.col("features")).alias("norm"))
        edges = norms.agg(F.percentile_approx("norm", shares, F.lit(10_000))).first()[0]
        edges = sorted(set(edges), reverse=True)
        # One row per bin, so at most ``wanted`` rows.
        bins = {
            row["bin"]: row
            for row in norms.groupBy(_bin(F.col("norm"), edges).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("top"))
            .collect()
        }
        first_shard, pieces, top_norms = [], [], []
        for number in range(len(edges) + 1):
            row = bins.get(number)
            # Quantiles are not exact: a bin somewhat over the size stays whole.
            n_pieces = max(1, round(row["n"] / shard_items)) if row else 1
            first_shard.append(len(top_norms))
            pieces.append(n_pieces)
            top_norms += [row["top"] if row else 0.0] * n_pieces
        # A bin without items must not look like the end to those who wait for the next.
        for shard in range(len(top_norms) - 2, -1, -1):
            top_norms[shard] = max(top_norms[shard], top_norms[shard + 1])
        # A user whose factors are all zero ties on every item and gets the k
        # lowest ids; with those in the first shard such a user is done there.
        lowest = items.select("id").orderBy("id").limit(k).agg(F.max("id")).first()[0]
        return cls(edges, first_shard, pieces, top_norms, lowest)

    def assign(self, items: DataFrame) -> DataFrame:
        columns = [
            F.col("id").cast("int").alias("id"),
            F.col("features").cast("array<float>").alias("features"),
        ]
        if len(self.top_norms) == 1:
            return items.select(*columns, F.lit(0).alias("shard"))
        bin_ = F.col("bin")
        piece = F.pmod(F.xxhash64("id"), _at(self.pieces, bin_)).cast("int")
        binned = items.select(*columns, _bin(norm(F.col("features")), self.edges).alias("bin"))
        return binned.select(
            "id",
            "features",
            F.when(F.col("id") <= self.lowest_ids_up_to, 0)
            .otherwise(_at(self.first_shard, bin_) + piece)
            .alias("shard"),
        )

    def still_possible(self, k: int, low: int, high: int, lowest_first: bool) -> Column:
        """Shards from ``low`` up to ``high`` that could hold one of the user's k best items.

        A user whose factors are all zero is done with the first shard if it holds the k
        lowest ids that such a user gets.
        """
        bound = norm(F.col("features")) * SLACK
        kth = F.get(F.col("recommendations.rating"), F.lit(k - 1)).cast("double")
        tops = F.array(*[F.lit(float(top)) for top in self.top_norms])
        return F.filter(
            F.sequence(F.lit(low), F.lit(high - 1)),
            lambda shard: kth.isNull()
            | (
                (bound > 0 if lowest_first else F.lit(True))
                & (bound * F.element_at(tops, shard + 1) >= kth)
            ),
        )


def _bin(norm_: Column, edges: list[float]) -> Column:
    """How many edges lie above the norm: 0 for the largest norms."""
    if not edges:
        return F.lit(0)
    return F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda edge: edge > norm_))


def _at(values: list[int], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index + 1)


def _item_blocks(sharded: DataFrame, per_shard: int) -> DataFrame:
    """``shard, ids, flat``: items packed so that copies of a shard are a few rows."""
    n_blocks = math.ceil(per_shard / BLOCK_ITEMS)
    block = F.pmod(F.xxhash64("id", F.lit("block")), F.lit(n_blocks)).alias("block")
    packed = sharded.groupBy("shard", block).agg(
        F.collect_list(F.struct("id", "features")).alias("rows")
    )
    return packed.select(
        "shard", F.col("rows.id").alias("ids"), F.flatten("rows.features").alias("flat")
    )


def _meet(
    users: DataFrame,
    blocks: DataFrame,
    waiting: dict[int, int],
    group_users: int,
    k: int,
    carry: bool,
    rated: DataFrame | None,
) -> DataFrame:
    """Bring groups of users together with the shard each of their rows names.

    ``waiting`` is the number of users per shard; a shard is copied once per group
    of ``group_users`` of them.  ``carry`` adds what another round needs.

    The partition counts are explicit because the work is in the arithmetic: by
    bytes alone AQE would merge the groups into too few tasks.
    """
    groups = [math.ceil(waiting.get(s, 0) / group_users) for s in range(max(waiting) + 1)]
    total = sum(groups)
    cores = users.sparkSession.sparkContext.defaultParallelism
    partitions = max(min(total, cores), min(math.ceil(total / 8), MAX_PARTITIONS))

    group = F.pmod(F.xxhash64("id"), _at(groups, F.col("shard"))).cast("int")
    if rated is not None:
        users = users.join(rated, ["id", "shard"], "left")
    left = users.withColumn("group", group).repartition(partitions, "shard", "group")
    copies = blocks.where(F.col("shard").isin([s for s, n in enumerate(groups) if n])).select(
        F.col("shard").alias("item_shard"),
        F.explode(F.sequence(F.lit(0), _at(groups, F.col("shard")) - 1)).alias("item_group"),
        "ids",
        "flat",
    )
    right = copies.repartition(partitions, "item_shard", "item_group")
    return (
        left.groupBy("shard", "group")
        .cogroup(right.groupBy("item_shard", "item_group"))
        .applyInArrow(
            partial(topk_kernel.best_items, k=k, carry=carry),
            schema=_CARRIED if carry else _FOUND,
        )
    )


def _merge(found: DataFrame, k: int) -> DataFrame:
    """The k best of what the shards found; at most k rows per user and shard."""
    rows = found.select("id", F.inline("recommendations"))
    best = Window.partitionBy("id").orderBy(F.desc("rating"), "sourceId")
    return (
        rows.withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= k)
        .groupBy(F.col("id").alias("userId"))
        .agg(F.array_sort(F.collect_list(F.struct("place", "sourceId", "rating"))).alias("found"))
        .select(
            "userId",
            F.transform("found", lambda e: F.struct(e["sourceId"], e["rating"]))
            .cast(RECOMMENDATIONS["recommendations"].dataType)
            .alias("recommendations"),
        )
    )
