from __future__ import annotations

import math
import re

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from earshot.operators.evaluate import drop_cold, metrics, rmse
from earshot.operators.scoring import score_pairs
from tests.plans import plan_of

NAN = float("nan")


@pytest.fixture(scope="module")
def predictions(spark):
    return spark.createDataFrame(
        [
            (1, 1, 3.0, 2.5),
            (1, 2, 1.0, NAN),
            (2, 1, None, 1.0),
            (2, 2, 4.0, 4.5),
            (3, 1, 2.0, None),
        ],
        "userId int, sourceId int, rating float, prediction float",
    )


def test_rows_with_null_or_nan_are_dropped(predictions):
    assert {(r["userId"], r["sourceId"]) for r in drop_cold(predictions).collect()} == {
        (1, 1),
        (2, 2),
    }


def test_rmse_skips_cold_rows_and_matches_the_evaluator(predictions):
    row = rmse(predictions).first()
    assert row["n_eval"] == 2 and row["rmse"] == pytest.approx(0.5)
    evaluator = RegressionEvaluator(metricName="rmse", labelCol="rating")
    assert row["rmse"] == pytest.approx(evaluator.evaluate(drop_cold(predictions)))


def test_metrics_count_cold_rows(predictions):
    row = metrics(predictions).first()
    assert (row["n"], row["n_cold"], row["n_eval"]) == (5, 2, 2)


def test_rmse_is_null_without_usable_rows(predictions):
    for none in (predictions.where("false"), predictions.where(F.isnan("prediction"))):
        row = rmse(none).first()
        assert row["n_eval"] == 0 and row["rmse"] is None


def test_scores_are_dot_products_and_nan_when_cold(spark):
    factors = spark.createDataFrame(
        [(1, [1.0, 2.0]), (2, [0.5, -1.0])], "id int, features array<float>"
    )
    pairs = spark.createDataFrame(
        [(1, 1), (1, 2), (2, 2), (9, 1), (1, 9)], "userId int, sourceId int"
    )
    got = {
        (r["userId"], r["sourceId"]): r["prediction"]
        for r in score_pairs(pairs, factors, factors, 2).collect()
    }
    assert got[1, 1] == 5.0 and got[1, 2] == -1.5 and got[2, 2] == 1.25
    assert math.isnan(got[9, 1]) and math.isnan(got[1, 9])


def test_evaluating_does_not_score_twice(spark):
    factors = spark.createDataFrame([(1, [1.0, 2.0])], "id int, features array<float>")
    pairs = spark.createDataFrame([(1, 1, 2.0)], "userId int, sourceId int, rating float")
    plan = plan_of(rmse(score_pairs(pairs, factors, factors, 2)))
    assert len(re.findall(r"user_features#\d+\[", plan)) == 2  # one per position


def test_a_hot_user_is_split_across_tasks(spark):
    """Too large to broadcast, a user with a third of the pairs must not meet in one task."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100000",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        ids = spark.range(600_000)
        pairs = ids.select(
            F.expr("int(if(id % 3 = 0, 7, id % 5003))").alias("userId"),
            F.pmod(F.xxhash64("id"), F.lit(4001)).cast("int").alias("sourceId"),
        )
        factors = spark.range(5003).select(
            F.col("id").cast("int").alias("id"),
            F.array(F.rand(1).cast("float"), F.rand(2).cast("float")).alias("features"),
        )
        execution = score_pairs(pairs, factors, factors, 2)._jdf.queryExecution()
        assert execution.toRdd().count() == 600_000
        assert "SortMergeJoin(skew=true)" in execution.executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
