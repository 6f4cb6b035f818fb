"""What each registered name computes in Spark."""

from __future__ import annotations

import math
from collections.abc import Callable
from datetime import date

from pyspark.errors import PySparkException
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.functions.dates import input_name
from earshot.functions.text import row_key_text
from earshot.functions.vectors import dot
from earshot.operators import als
from earshot.operators.biases import baseline, fill_cold, fit_biases
from earshot.operators.evaluate import drop_cold, metrics, rmse
from earshot.operators.scoring import score_pairs
from earshot.operators.split import hash_split, random_split, split_counts, time_split
from earshot.operators.topk import flatten, item_ids, recommend_for_all_users, top_k_items
from earshot.operators.tuning import choose
from earshot.operators.upsert import last_write
from earshot.params import AlsParams, JobParams
from earshot.plans import jobs
from earshot.registered import standins as given
from earshot.schemas import LISTEN, RATING, RECOMMEND_FAMILY, SING
from earshot.sinks.cell_store import lookup, merge_cells, read_cells
from earshot.sinks.tables import overwrite_dates, overwrite_table, preview
from earshot.sinks.wide_rows import (
    by_row_key,
    count_cells,
    dated_cells,
    recommendation_cells,
    recommendation_rows,
)
from earshot.sources.ledger import read_ledger
from earshot.sources.parse import parse, quarantine
from earshot.workspace import scratch_root

Query = Callable[[SparkSession, str], DataFrame]
K = 5
RUN_DATE = date(2024, 1, 2)
BIAS_ROUNDS = 3
GRID = tuple(AlsParams(rank=rank, reg=reg, max_iter=3) for rank in (4, 8) for reg in (0.01, 0.5))
# Row keys that a lookup asks for.
LOOKED_UP = 20
LATE_DAY = "2024-01-11"


# -- scans and parsing --------------------------------------------------------


def scan_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse(given.scanned_lines(spark, given.ratings(spark, sf_dir)), RATING).select(
        "userId", "sourceId", _round("rating", 4)
    )


def scan_listens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse(given.scanned_lines(spark, given.listens(spark, sf_dir)), LISTEN)


def scan_sings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse(given.scanned_lines(spark, given.sings(spark, sf_dir)), SING)


def parse_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse(given.as_lines(given.order_lines(spark, sf_dir)), RATING)


def parse_listens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse(given.mixed_count_lines(spark, sf_dir), LISTEN)


def parse_sings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse(given.mixed_count_lines(spark, sf_dir), SING)


def parse_mixed_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse(given.mixed_rating_lines(spark, sf_dir), RATING)


def quarantine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = quarantine(given.mixed_count_lines(spark, sf_dir), LISTEN)
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def quarantine_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine(given.mixed_rating_lines(spark, sf_dir), RATING)


def dated_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The input name each order date would use; open orders name none, pending ones a blank."""
    orders = given.table(spark, sf_dir, "orders")
    name = F.when(F.col("o_orderstatus") == "P", "  ").when(
        F.col("o_orderstatus") == "F", F.concat(F.lit(" "), "o_orderpriority", F.lit(".dat "))
    )
    return (
        orders.groupBy(name.alias("name"), F.col("o_orderdate").cast("date").alias("run_date"))
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(input_name(F.col("name"), F.col("run_date")).alias("input_name"))
        .agg(F.sum("n").alias("n"))
    )


# -- split --------------------------------------------------------------------


def split_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_split(given.ratings(spark, sf_dir)).select("userId", "sourceId", "split")


def split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_counts(hash_split(given.ratings(spark, sf_dir)))


def random_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What does not depend on the draw: three parts with rows, and all rows in them."""
    parts = random_split(given.ratings(spark, sf_dir))
    named = [part.select(F.lit(name).alias("split")) for name, part in parts.items()]
    counts = split_counts(named[0].unionByName(named[1]).unionByName(named[2]))
    return counts.agg(F.count(F.lit(1)).alias("n_parts"), F.sum("n").alias("n_rows"))


def random_split_covers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three parts together: every pair once."""
    train, validation, test = random_split(given.ratings(spark, sf_dir)).values()
    return (
        train.unionByName(validation)
        .unionByName(test)
        .groupBy("userId", "sourceId")
        .agg(F.count(F.lit(1)).alias("times"))
        .agg(F.sum("times").alias("n_rows"), F.count(F.lit(1)).alias("n_pairs"))
    )


def split_by_date_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in order of time, exact shares of them."""
    events = given.table(spark, sf_dir, "events").select("event_id", "ts")
    return time_split(events, "ts", ["event_id"]).select("event_id", "split")


def split_by_day_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines in order of their day, which many share; ties go by part, order and line."""
    lines = given.table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("day"), "l_partkey", "l_orderkey", "l_linenumber"
    )
    keys = ["l_partkey", "l_orderkey", "l_linenumber"]
    return time_split(lines, "day", keys, (0.25, 0.25, 0.5)).select(*keys, "split")


# -- score and evaluate -------------------------------------------------------


def _item_mean_predictions(ratings: DataFrame) -> DataFrame:
    """Each test rating next to its item's mean in training; NULL for unseen items."""
    split = hash_split(ratings)
    means = (
        split.where(F.col("split") == "train")
        .groupBy("sourceId")
        .agg(F.avg(F.col("rating").cast("double")).alias("prediction"))
    )
    return (
        split.where(F.col("split") == "test")
        .join(means, "sourceId", "left")
        .select("userId", "sourceId", "rating", "prediction")
    )


def baseline_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    predictions = _item_mean_predictions(given.ratings(spark, sf_dir))
    return predictions.select("userId", "sourceId", _round("rating", 4), _round("prediction", 6))


def rmse_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metric(rmse(_item_mean_predictions(given.event_ratings(spark, sf_dir))))


def _factor_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = given.factors(spark, sf_dir)
    return score_pairs(given.ratings(spark, sf_dir), vectors, vectors, given.FACTOR_RANK)


def score_known_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    prediction = F.col("prediction")
    return _factor_predictions(spark, sf_dir).select(
        "userId",
        "sourceId",
        F.isnan(prediction).alias("cold"),
        F.when(~F.isnan(prediction), F.round(prediction.cast("double"), 5)).alias("prediction"),
    )


def cold_rows_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_cold(_factor_predictions(spark, sf_dir)).select(
        "userId", "sourceId", _round("rating", 4), _round("prediction", 5)
    )


def rmse_scored_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metric(rmse(_factor_predictions(spark, sf_dir)))


def rmse_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the cold rows, so that none is usable."""
    return _metric(rmse(_factor_predictions(spark, sf_dir).where(F.isnan("prediction"))))


def bias_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rating's baseline from biases of the training split, after a few rounds."""
    split = hash_split(given.ratings(spark, sf_dir)).checkpoint()
    train = split.where(F.col("split") == "train")
    biases = fit_biases(train, most_rounds=BIAS_ROUNDS, tolerance=0.0)
    return baseline(biases, split).select(
        "userId", "sourceId", "split", F.round("baseline", 6).alias("baseline")
    )


def cold_pairs_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all pairs; those that the factors do not know get the baseline."""
    ratings = given.stored(given.ratings(spark, sf_dir), "ratings")
    biases = fit_biases(ratings, most_rounds=BIAS_ROUNDS, tolerance=0.0)
    vectors = given.factors(spark, sf_dir)
    filled = fill_cold(biases, score_pairs(ratings, vectors, vectors, given.FACTOR_RANK))
    return filled.select("userId", "sourceId", "cold", _round("prediction", 4))


# -- the model ----------------------------------------------------------------

_models: dict[tuple[str, str], tuple[str, DataFrame]] = {}


def _split_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored: a fit, its row count and its test read it, and the join behind it is dear."""
    return given.stored(hash_split(given.ratings(spark, sf_dir)), "split")


def _part(split: DataFrame, name: str) -> DataFrame:
    return split.where(F.col("split") == name).drop("split")


def _fit(split: DataFrame) -> ALSModel:
    train = _part(split, "train")
    return als.fit(train, AlsParams(), train.count())


def fit_model(spark: SparkSession, sf_dir: str) -> ALSModel:
    return _fit(_split_ratings(spark, sf_dir))


def _model_and_split(spark: SparkSession, sf_dir: str) -> tuple[ALSModel, DataFrame]:
    """The model of these tables, fitted once per session and read back from disk, and its split."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _models:
        path, split = scratch_root(spark, "model"), _split_ratings(spark, sf_dir)
        als.save(_fit(split), path)
        _models[key] = path, split
    path, split = _models[key]
    return als.load(path), split


def _saved_model(spark: SparkSession, sf_dir: str) -> ALSModel:
    return _model_and_split(spark, sf_dir)[0]


def als_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs that the model scores and those that are cold to it."""
    return _als_predictions(spark, sf_dir).select(
        "userId", "sourceId", F.isnan("prediction").alias("cold")
    )


def _als_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, split = _model_and_split(spark, sf_dir)
    return als.predict(model, _part(split, "test"))


def als_predict_agrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MLlib's scores against the pair-by-pair ones of the same factors."""
    model = _saved_model(spark, sf_dir)
    theirs = _als_predictions(spark, sf_dir).withColumnRenamed("prediction", "theirs")
    both = score_pairs(theirs, model.userFactors, model.itemFactors, AlsParams().rank)
    ours, other = F.col("prediction"), F.col("theirs")
    same = F.when(F.isnan(ours) | F.isnan(other), F.isnan(ours) & F.isnan(other)).otherwise(
        F.abs(ours - other) <= 1e-5 * (1 + F.abs(other))
    )
    return both.agg(
        F.count(F.lit(1)).alias("n_pairs"), F.count_if(~same).alias("n_different")
    )


def als_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Our error against MLlib's evaluator on the usable test pairs."""
    scored = given.stored(_als_predictions(spark, sf_dir), "scored")
    usable = drop_cold(scored)
    theirs = RegressionEvaluator(metricName="rmse", labelCol="rating").evaluate(usable)
    gap = F.abs(F.col("rmse") - F.lit(theirs))
    return metrics(scored).select(
        "n", "n_cold", "n_eval", (~(gap <= 1e-9 * F.lit(theirs))).cast("bigint").alias("n_different")
    )


def als_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many test pairs the model knows both sides of."""
    return metrics(_als_predictions(spark, sf_dir)).select("n", "n_cold", "n_eval")


def als_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold for any fit: a factor row per trained id, none negative."""
    model = _saved_model(spark, sf_dir)
    sides = [
        factors.select(F.lit(side).alias("side"), "id", "features")
        for side, factors in (("user", model.userFactors), ("item", model.itemFactors))
    ]
    negative = F.exists("features", lambda x: (x < 0) | F.isnan(x))
    return (
        sides[0]
        .unionByName(sides[1])
        .groupBy("side")
        .agg(
            F.count(F.lit(1)).alias("n_ids"),
            F.count_if(F.size("features") != AlsParams().rank).alias("n_wrong_rank"),
            F.count_if(negative).alias("n_negative"),
        )
    )


def als_optimality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User factors against what the last half step must reach, given the item factors.

    Per user and position the slope of the squared error and its ridge: nowhere falling,
    and level where the factor is above zero, as far as the floats of the fit allow.
    """
    params = AlsParams()
    model, split = _model_and_split(spark, sf_dir)
    train = _part(split, "train")
    users = model.userFactors.select(F.col("id").alias("userId"), F.col("features").alias("x"))
    items = model.itemFactors.select(F.col("id").alias("sourceId"), F.col("features").alias("f"))
    # Users last: a user's pairs, wide by then, lie together for the sums without another shuffle.
    pairs = train.join(items, "sourceId").join(users, "userId")

    def at(vector: str, i: int) -> Column:
        return F.get(vector, F.lit(i)).cast("double")

    error = dot(F.col("x"), F.col("f"), params.rank) - F.col("rating").cast("double")
    sums = pairs.withColumn("error", error).groupBy("userId", "x").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.col("error") * at("f", i)).alias(f"slope{i}") for i in range(params.rank)],
        *[F.sum(F.abs("rating") * F.abs(at("f", i))).alias(f"size{i}") for i in range(params.rank)],
    )
    wrong = F.lit(False)
    for i in range(params.rank):
        slope = F.col(f"slope{i}") + params.reg * F.col("n") * at("x", i)
        slack = 1e-3 * (1 + F.col(f"size{i}"))
        wrong = wrong | (slope < -slack) | ((at("x", i) > 1e-4) & (slope > slack))
    return sums.agg(
        F.count(F.lit(1)).alias("n_users"), F.count_if(wrong).alias("n_different")
    )


def als_grid_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A grid of fits judged together, against each fitted and judged by itself."""
    split = hash_split(given.event_ratings(spark, sf_dir)).checkpoint()
    train = split.where(F.col("split") == "train").drop("split")
    validation = split.where(F.col("split") == "validation").drop("split")
    n_train = train.count()
    choice = choose(train, validation, GRID, n_train)
    alone = [
        metrics(als.predict(als.fit(train, params, n_train), validation)).first() for params in GRID
    ]
    least = min(range(len(GRID)), key=lambda i: alone[i]["rmse"])
    rows = [
        (
            params.rank,
            params.reg,
            trial.n_eval,
            int(trial.n_eval != own["n_eval"] or abs(trial.rmse - own["rmse"]) > 1e-6 * own["rmse"]),
            int((i == choice.best) != (i == least)),
        )
        for i, (params, trial, own) in enumerate(zip(GRID, choice.trials, alone, strict=True))
    ]
    schema = "rank int, reg double, n_eval bigint, n_different bigint, n_wrong_choice bigint"
    return spark.createDataFrame(rows, schema)


def model_save_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test pairs scored by the fitted model and by its saved copy, compared."""
    split = _split_ratings(spark, sf_dir)
    fitted = _fit(split)
    path = scratch_root(spark, "model")
    als.save(fitted, path)
    als.save(fitted, path)  # the second replaces the first
    scored = als.predict(fitted, _part(split, "test")).withColumnRenamed("prediction", "before")
    both = als.predict(als.load(path), scored)
    return both.agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.count_if(~F.col("before").eqNullSafe(F.col("prediction"))).alias("n_different"),
    )


# -- top-k --------------------------------------------------------------------


def _factor_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = given.factors(spark, sf_dir)
    return top_k_items(vectors, vectors, K)


def topk_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _placed(_factor_top_k(spark, sf_dir))


def topk_scores_sharded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the items in eight shards."""
    vectors = given.factors(spark, sf_dir)
    return _placed(top_k_items(vectors, vectors, K, shard_items=math.ceil(vectors.count() / 8)))


def _rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What users have done with items, as often as they did: the pairs to leave out."""
    return given.events(spark, sf_dir).select("userId", F.col("item").alias("sourceId"))


def topk_unrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best items among those a user has not met in the events."""
    vectors = given.factors(spark, sf_dir)
    return _placed(top_k_items(vectors, vectors, K, rated=_rated(spark, sf_dir)))


def topk_unrated_sharded(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = given.factors(spark, sf_dir)
    shard_items = math.ceil(vectors.count() / 8)
    rated = _rated(spark, sf_dir)
    return _placed(top_k_items(vectors, vectors, K, shard_items=shard_items, rated=rated))


def _placed(recommendations: DataFrame) -> DataFrame:
    return recommendations.select(
        "userId", F.posexplode("recommendations").alias("place", "entry")
    ).select(
        "userId",
        "place",
        F.col("entry.sourceId").alias("sourceId"),
        F.round(F.col("entry.rating").cast("double"), 5).alias("rating"),
    )


def recommendations_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten(_factor_top_k(spark, sf_dir)).select(
        "userId", "sourceId", _round("rating", 5)
    )


def recommended_item_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return item_ids(_factor_top_k(spark, sf_dir)).select(
        "userId", F.concat_ws(",", "itemIds").alias("itemIds")
    )


def recommend_all_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every trained user and how many items are recommended."""
    return recommendations(spark, sf_dir).select(
        "userId", F.size("recommendations").alias("n_items")
    )


def recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend_for_all_users(_saved_model(spark, sf_dir), K)


def recommend_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k items for every trained user, none twice, scores falling."""
    found = recommendations(spark, sf_dir)
    scores = F.col("recommendations.rating")
    return found.agg(
        F.count(F.lit(1)).alias("n_users"),
        F.sum(F.size("recommendations")).alias("n_items"),
        F.count_if(F.sort_array(scores, asc=False) != scores).alias("n_out_of_order"),
        F.count_if(
            F.size(F.array_distinct("recommendations.sourceId")) != F.size("recommendations")
        ).alias("n_with_repeats"),
    )


def recommend_scores_agree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recommended scores against the pair-by-pair scores of the same factors."""
    model = _saved_model(spark, sf_dir)
    pairs = flatten(recommend_for_all_users(model, K))
    scored = score_pairs(pairs, model.userFactors, model.itemFactors, AlsParams().rank)
    gap = F.abs(F.col("rating") - F.col("prediction"))
    agrees = gap <= 1e-5 * (1 + F.abs(F.col("prediction")))
    return scored.agg(
        F.count(F.lit(1)).alias("n_scores"),
        F.count_if(F.isnan("prediction") | ~agrees).alias("n_different"),
    )


# -- sinks --------------------------------------------------------------------


def upsert_last_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_write(given.events(spark, sf_dir), ["userId", "item"], "value", "event_id")


def upsert_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last day's value per (user, item); of several on that day the largest."""
    dated = given.events(spark, sf_dir).withColumn("day", F.to_date("ts"))
    return last_write(dated, ["userId", "item"], "value", "day")


def listen_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parse(given.as_lines(given.listens(spark, sf_dir)), LISTEN)
    return count_cells(rows, "userId", "ocId", "count", LISTEN.family)


def sing_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parse(given.as_lines(given.sings(spark, sf_dir)), SING)
    return count_cells(rows, "userId", "sourceId", "count", SING.family)


def _stored(spark: SparkSession, cells: DataFrame) -> DataFrame:
    path = scratch_root(spark, "cells")
    overwrite_table(by_row_key(cells), path)
    return spark.read.parquet(path)


def listen_wide_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells of every user's wide row, stored in row key order and read back."""
    return _stored(spark, listen_cells(spark, sf_dir))


def sing_wide_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sing_cells(spark, sf_dir))


def upsert_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated puts to one cell: the last event wins."""
    events = given.events(spark, sf_dir)
    return count_cells(events, "userId", "item", "event_id", "lastEvent", "event_id")


def upsert_wide_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, upsert_cells(spark, sf_dir))


def recommend_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = recommendation_rows(_factor_top_k(spark, sf_dir))
    rows = recommendation_cells(wide, RECOMMEND_FAMILY)
    number = F.col("value").cast("float").cast("double")
    return rows.select("rowkey", "family", "qualifier", F.round(number, 5).alias("value"))


def overwrite_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listens, then sings written to one table: only the second load is left."""
    path = scratch_root(spark, "table")
    for load in (given.listens, given.sings):
        rows = load(spark, sf_dir).toDF("userId", "item", "count")
        cells = count_cells(rows, "userId", "item", "count", "counts")
        overwrite_table(by_row_key(cells), path)
    return spark.read.parquet(path)


def dated_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts, then the last day reloaded tenfold: the other days stay."""
    path = scratch_root(spark, "dated")
    daily = (
        given.events(spark, sf_dir)
        .groupBy(F.to_date("ts").alias("dt"), "userId")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    overwrite_dates(daily, path)
    last_day = daily.agg(F.max("dt").alias("dt"))
    reloaded = daily.join(F.broadcast(last_day), "dt").withColumn("n", F.col("n") * 10)
    overwrite_dates(reloaded, path)
    return spark.read.parquet(path).select(
        F.col("dt").cast("string").alias("dt"), "userId", "n"
    )


def merged_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads of every third day's events, merged one by one: as one load of them all."""
    path = scratch_root(spark, "cells")
    dated = given.events(spark, sf_dir).withColumn("day", F.to_date("ts").cast("string"))
    for load in (1, 0, 2):  # not in order of time
        days = dated.where(F.dayofmonth("day") % 3 == load)
        cells = dated_cells(days, "userId", "item", "event_id", "lastEvent", "day")
        merge_cells(cells, path, buckets=16)
    return read_cells(spark, path).drop("bucket")


def cells_looked_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells of the users with most events, by row key from the stored table."""
    path = scratch_root(spark, "cells")
    dated = given.events(spark, sf_dir).withColumn("day", F.to_date("ts").cast("string"))
    cells = dated_cells(dated, "userId", "item", "event_id", "lastEvent", "day")
    merge_cells(cells, path, buckets=16)
    busiest = dated.groupBy("userId").count().orderBy(F.desc("count"), "userId").limit(LOOKED_UP)
    users = [row_key_text(row["userId"]) for row in busiest.collect()]
    return lookup(spark, path, users, buckets=16)


def replace_cut_off(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listens, then a load of sings that fails halfway: the listens are still there."""
    path = scratch_root(spark, "table")
    overwrite_table(by_row_key(listen_cells(spark, sf_dir)), path)
    failing = sing_cells(spark, sf_dir).withColumn(
        "value",
        F.when(F.xxhash64("rowkey", "qualifier") % 7 == 0, F.raise_error(F.lit("cut off")))
        .otherwise(F.col("value"))
        .cast("string"),
    )
    try:
        overwrite_table(failing, path)
    except PySparkException:
        return spark.read.parquet(path)
    raise AssertionError("the load did not fail")


def preview_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(given.ratings(spark, sf_dir), "userId", "sourceId").select(
        "userId", "sourceId", _round("rating", 4)
    )


def preview_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = preview(_factor_top_k(spark, sf_dir), "userId")
    return item_ids(rows).select("userId", F.concat_ws(",", "itemIds").alias("itemIds"))


# -- whole jobs ---------------------------------------------------------------


def _job_params(spark: SparkSession) -> JobParams:
    return JobParams(storage_root=scratch_root(spark, "job"), run_date=RUN_DATE)


def _train_on(spark: SparkSession, ratings: DataFrame) -> tuple[JobParams, jobs.TrainReport]:
    params = _job_params(spark)
    given.written_lines(ratings, params.ratings_path)
    return params, jobs.train(spark, params)


def job_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training job; returns the sizes of its parsed parts."""
    params, report = _train_on(spark, given.ratings(spark, sf_dir))
    staged = jobs.read_parsed(spark, params.parsed_path(RATING.name), RATING)
    return split_counts(staged.withColumnRenamed("part", "split")).select(
        "split", "n", F.lit(report.n_eval).cast("bigint").alias("n_eval")
    )


def job_recommend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train, then recommend; per user the cells stored and how many of them are not the model's."""
    params, _ = _train_on(spark, given.ratings(spark, sf_dir))
    stored = recommendation_cells(
        spark.read.parquet(jobs.recommend(spark, params)), RECOMMEND_FAMILY
    )
    model = als.load(params.model_path)
    # The job takes these items in one shard; three shards go through further rounds.
    third = math.ceil(model.itemFactors.count() / 3)
    best = flatten(
        top_k_items(model.userFactors, model.itemFactors, params.k, shard_items=third)
    ).withColumn("rowkey", F.concat(F.lit("userId:"), "userId"))
    lowest = best.groupBy("rowkey").agg(F.min("rating").alias("lowest"))
    # Items that tie for the last place may differ; their scores may not.
    scores = best.withColumn("qualifier", F.col("sourceId").cast("string"))
    value = F.col("value").cast("float")
    close = F.abs(value - F.coalesce("rating", "lowest")) <= 1e-4 * (1 + F.abs(value))
    return (
        stored.join(lowest, "rowkey", "left")
        .join(scores.select("rowkey", "qualifier", "rating"), ["rowkey", "qualifier"], "left")
        .groupBy("rowkey")
        .agg(
            F.count(F.lit(1)).alias("n_cells"),
            F.count_if(~F.coalesce(close, F.lit(False))).alias("n_different"),
        )
    )


def job_load_listens(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = _job_params(spark)
    given.written_lines(given.listens(spark, sf_dir), params.listen_path)
    return spark.read.parquet(jobs.load_listens(spark, params).table_path)


def job_load_sings(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = _job_params(spark)
    given.written_lines(given.sings(spark, sf_dir), params.sing_path)
    return spark.read.parquet(jobs.load_sings(spark, params).table_path)


def job_recommend_unrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recommendations without what a user has rated: how many, and how many of them were rated."""
    # Stored: the job's text and the check read it, and the join behind it is dear.
    ratings = given.stored(given.ratings(spark, sf_dir), "ratings")
    params, _ = _train_on(spark, ratings)
    path = jobs.recommend(spark, params.with_(exclude_rated=True))
    stored = recommendation_cells(spark.read.parquet(path), RECOMMEND_FAMILY)
    # Met as the numbers in the cells' text, which are dealt and sorted faster than the text.
    cells = stored.select(
        "rowkey",
        F.substring_index("rowkey", ":", -1).try_cast("int").alias("userId"),
        F.col("qualifier").try_cast("int").alias("sourceId"),
    )
    rated = ratings.select("userId", "sourceId", F.lit(1).alias("rated"))
    return (
        cells.join(rated, ["userId", "sourceId"], "left")
        .groupBy("rowkey")
        .agg(F.count(F.lit(1)).alias("n_cells"), F.count("rated").alias("n_rated"))
    )


def _day_lines(spark: SparkSession, sf_dir: str, params: JobParams, which: Column) -> None:
    """A folder of listen lines for each day of the events that ``which`` takes."""
    dated = given.events(spark, sf_dir).withColumn("day", F.to_date("ts").cast("string"))
    lines = (
        dated.where((F.col("event_type") == "view") & which)
        .groupBy("day", "userId", "item")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("day", F.concat_ws("|", "userId", "item", "n").alias("value"))
        .checkpoint()
    )
    for row in lines.select("day").distinct().collect():
        folder = f"{params.dated_folder(LISTEN.name)}/{row['day']}.dat"
        lines.where(F.col("day") == row["day"]).select("value").write.text(folder)


def _load_days(spark: SparkSession, sf_dir: str) -> tuple[JobParams, list[jobs.LoadReport]]:
    """All days but one, then nothing new, then the day that came late."""
    params = _job_params(spark)
    late = F.col("day") == LATE_DAY
    _day_lines(spark, sf_dir, params, ~late)
    reports = [jobs.load_new_listens(spark, params) for _ in range(2)]
    _day_lines(spark, sf_dir, params, late)
    return params, [*reports, jobs.load_new_listens(spark, params)]


def job_load_new_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged cells after all days were loaded, the late one last."""
    params, _ = _load_days(spark, sf_dir)
    return read_cells(spark, params.cells_path(params.listen_table)).drop("bucket")


def days_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger, and in which of the three runs each day was loaded."""
    params, reports = _load_days(spark, sf_dir)
    runs = [(day, run) for run, report in enumerate(reports) for day in report.days]
    ledger = read_ledger(spark, params.ledger_path(params.listen_table))
    return ledger.join(spark.createDataFrame(runs, "day string, run int"), "day")


# -- shared shapes ------------------------------------------------------------


def _round(column: str, digits: int) -> Column:
    return F.round(F.col(column).cast("double"), digits).alias(column)


def _metric(row: DataFrame) -> DataFrame:
    return row.select("n_eval", F.round("rmse", 6).alias("rmse"))


QUERIES: dict[str, Query] = {
    "scan_ratings": scan_ratings,
    "scan_listens": scan_listens,
    "scan_sings": scan_sings,
    "parse_ratings": parse_ratings,
    "parse_listens": parse_listens,
    "parse_sings": parse_sings,
    "parse_mixed_ratings": parse_mixed_ratings,
    "quarantine_counts": quarantine_counts,
    "quarantine_ratings": quarantine_ratings,
    "dated_inputs": dated_inputs,
    "split_members": split_members,
    "split_by_date_members": split_by_date_members,
    "split_by_day_members": split_by_day_members,
    "split_counts": split_sizes,
    "random_split_counts": random_split_counts,
    "random_split_covers": random_split_covers,
    "baseline_predictions": baseline_predictions,
    "rmse_baseline": rmse_baseline,
    "score_pairs": score_known_pairs,
    "cold_rows_dropped": cold_rows_dropped,
    "rmse_scored_pairs": rmse_scored_pairs,
    "rmse_empty": rmse_empty,
    "bias_predictions": bias_predictions,
    "cold_pairs_filled": cold_pairs_filled,
    "als_predictions": als_predictions,
    "als_metrics": als_metrics,
    "als_coverage": als_coverage,
    "als_invariants": als_invariants,
    "als_predict_agrees": als_predict_agrees,
    "als_optimality": als_optimality,
    "als_grid_choice": als_grid_choice,
    "model_save_load": model_save_load,
    "topk_scores": topk_scores,
    "topk_scores_sharded": topk_scores_sharded,
    "topk_unrated": topk_unrated,
    "topk_unrated_sharded": topk_unrated_sharded,
    "recommendations_flat": recommendations_flat,
    "recommended_item_ids": recommended_item_ids,
    "recommend_all_users": recommend_all_users,
    "recommend_invariants": recommend_invariants,
    "recommend_scores_agree": recommend_scores_agree,
    "upsert_last_write": upsert_last_write,
    "upsert_ties": upsert_ties,
    "listen_wide_rows": listen_wide_rows,
    "sing_wide_rows": sing_wide_rows,
    "listen_cells": listen_cells,
    "sing_cells": sing_cells,
    "upsert_cells": upsert_cells,
    "upsert_wide_rows": upsert_wide_rows,
    "recommend_cells": recommend_cells,
    "overwrite_reload": overwrite_reload,
    "dated_overwrite": dated_overwrite,
    "merged_loads": merged_loads,
    "cells_looked_up": cells_looked_up,
    "replace_cut_off": replace_cut_off,
    "preview_ratings": preview_ratings,
    "preview_recommendations": preview_recommendations,
    "job_train": job_train,
    "job_recommend": job_recommend,
    "job_load_listens": job_load_listens,
    "job_load_sings": job_load_sings,
    "job_recommend_unrated": job_recommend_unrated,
    "job_load_new_days": job_load_new_days,
    "days_loaded": days_loaded,
}
