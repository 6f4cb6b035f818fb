from __future__ import annotations

import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from earshot.operators import als
from earshot.operators.evaluate import rmse
from earshot.operators.topk import recommend_for_all_users
from earshot.params import AlsParams
from earshot.registered import standins
from tests.disk import local_folders, shuffles_in, shuffles_left


@pytest.fixture(scope="module")
def ratings(spark, sf_dir):
    return standins.event_ratings(spark, sf_dir).checkpoint()


@pytest.fixture(scope="module")
def model(ratings):
    return als.fit(ratings, AlsParams(), ratings.count())


def vectors(frame):
    return {r["id"]: np.array(r["features"]) for r in frame.collect()}


def test_known_pairs_are_finite_and_unknown_ones_nan(spark, ratings, model):
    known = als.predict(model, ratings)
    assert known.where(F.isnan("prediction") | F.col("prediction").isNull()).isEmpty()
    strangers = spark.createDataFrame(
        [(10**6, 1, 1.0), (1, 10**6, 1.0), (10**6, 10**6, 1.0)],
        "userId int, sourceId int, rating float",
    )
    cold = als.predict(model, strangers)
    assert cold.where(F.isnan("prediction")).count() == 3
    metric = rmse(cold).first()
    assert metric["n_eval"] == 0 and metric["rmse"] is None


def test_factors_are_non_negative(model):
    for factors in (model.userFactors, model.itemFactors):
        for vector in vectors(factors).values():
            assert len(vector) == 10 and (vector >= 0).all()


def test_equal_seeds_and_pinned_layout_give_equal_factors(ratings):
    models = [
        als.fit(ratings.repartition(n), AlsParams(), ratings.count()) for n in (1, 3, 11)
    ]
    first = vectors(models[0].userFactors)
    for other in models[1:]:
        again = vectors(other.userFactors)
        assert first.keys() == again.keys()
        assert all((first[i] == again[i]).all() for i in first)


def test_top_k_agrees_with_mllib(model):
    k = 5
    ours = {
        r["userId"]: [e["rating"] for e in r["recommendations"]]
        for r in recommend_for_all_users(model, k).collect()
    }
    theirs = {
        r["userId"]: [e["rating"] for e in r["recommendations"]]
        for r in model.recommendForAllUsers(k).collect()
    }
    assert ours.keys() == theirs.keys()
    for user, scores in theirs.items():
        assert ours[user] == pytest.approx(scores, rel=1e-5)


def test_save_overwrites_and_reload_scores_the_same(tmp_path, ratings, model):
    path = str(tmp_path / "model")
    als.save(model, path)
    als.save(model, path)
    before = {tuple(r) for r in als.predict(model, ratings).collect()}
    after = {tuple(r) for r in als.predict(als.load(path), ratings).collect()}
    assert before == after


def test_no_training_rows_is_an_error(ratings):
    with pytest.raises(ValueError, match="no training rows"):
        als.fit(ratings.where("userId < 0"), AlsParams(), 0)


def test_blocks_grow_with_the_ratings():
    assert als.block_count(1, 4_000_000) == 10
    assert als.block_count(400_000_000, 4_000_000) == 100
    assert als.block_count(10**13, 4_000_000) == 2_500_000


def test_a_repeated_pair_spreads_over_partitions(spark):
    """Its copies are numbered, so that no partition gets them all."""
    copies = spark.range(4000).selectExpr("1 userId", "2 sourceId", "cast(3.0 as float) rating")
    pinned = als.pin_layout(copies, 8)
    assert pinned.columns == ["userId", "sourceId", "rating"]
    sizes = [r["count"] for r in pinned.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 1000


def test_a_busy_user_is_fitted_like_any_other(spark, ratings):
    hot = ratings.limit(1).crossJoin(spark.range(ratings.count() // 2)).drop("id")
    skewed = ratings.unionByName(hot).checkpoint()
    model = als.fit(skewed, AlsParams(user_blocks=7, item_blocks=3), skewed.count())
    assert rmse(als.predict(model, skewed)).first()["rmse"] > 0


def test_the_layout_is_made_once_for_a_fit(spark):
    """MLlib asks for its input's partitions and reads it afterwards: the shuffles run once."""
    read = spark.sparkContext.accumulator(0)

    def counted(rating):
        read.add(1)
        return rating

    pairs = [(u, i, float(u % 5)) for u in range(20) for i in range(10)]
    ratings = spark.createDataFrame(pairs, "userId int, sourceId int, rating float").select(
        "userId", "sourceId", F.udf(counted, "float")("rating").alias("rating")
    )
    cached = spark.sparkContext._jsc.getPersistentRDDs().size()
    model = als.fit(ratings, AlsParams(max_iter=1), len(pairs))
    assert read.value == len(pairs)
    assert model.userFactors.count() == 20
    # What stays is the model's two sides; the laid-out rows do not.
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= cached + 2


def test_a_fit_keeps_few_shuffles_at_a_time_and_none_afterwards(spark, ratings):
    """Twenty half steps exchange factors; what earlier ones wrote is gone by then."""
    folders = local_folders(spark)
    before, most, done = shuffles_in(folders), 0, threading.Event()

    def watch():
        nonlocal most
        while not done.wait(0.02):
            most = max(most, len(shuffles_in(folders) - before))

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        model = als.fit(ratings, AlsParams(), ratings.count())
    finally:
        done.set()
        watcher.join()
    assert 0 < most < 14
    assert not shuffles_left(spark, before)
    assert model.userFactors.count() > 0


def test_factors_that_an_executor_lost_are_fitted_again(spark, ratings):
    """Their shuffle files are gone, so the way back is the whole fit."""
    held = spark.sparkContext._jsc.getPersistentRDDs()
    model = als.fit(ratings, AlsParams(max_iter=2), ratings.count())
    before = [vectors(model.userFactors), vectors(model.itemFactors)]
    fitted = spark.sparkContext._jsc.getPersistentRDDs()
    for number in set(fitted.keySet()) - set(held.keySet()):
        fitted[number].unpersist(True)
    for factors, again in zip(before, (model.userFactors, model.itemFactors), strict=True):
        again = vectors(again)
        assert factors.keys() == again.keys()
        assert all((factors[i] == again[i]).all() for i in factors)
