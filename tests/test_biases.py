from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from earshot.operators.biases import baseline, fill_cold, fit_biases

SCHEMA = "userId int, sourceId int, rating float"


def plain(rows, shrink, rounds):
    mean = sum(r for *_, r in rows) / len(rows)
    users = {u: 0.0 for u, *_ in rows}
    for _ in range(rounds):
        items = {
            i: sum(r - mean - users[u] for u, j, r in rows if j == i)
            / (sum(j == i for _, j, _ in rows) + shrink)
            for _, i, _ in rows
        }
        users = {
            u: sum(r - mean - items[i] for v, i, r in rows if v == u)
            / (sum(v == u for v, *_ in rows) + shrink)
            for u, *_ in rows
        }
    return mean, users, items


@pytest.mark.parametrize("shrink, rounds", [(0.0, 1), (5.0, 4), (2.5, 2)])
def test_biases_are_shrunk_leftover_means(spark, shrink, rounds):
    rows = [(u, i, float((u * 7 + i * 3) % 5 + u / 4)) for u in range(6) for i in range(5) if (u + i) % 3]
    rows += rows[:4]  # repeated pairs are observations of their own
    mean, users, items = plain(rows, shrink, rounds)
    found = fit_biases(spark.createDataFrame(rows, SCHEMA), shrink, rounds, tolerance=0.0)
    assert found.rounds == rounds and found.mean == pytest.approx(mean)
    assert {r[0]: r[1] for r in found.users.collect()} == pytest.approx(users)
    assert {r[0]: r[1] for r in found.items.collect()} == pytest.approx(items)


def test_rounds_end_at_a_fixed_point(spark):
    rows = [(u, i, float(u + 2 * i % 3)) for u in range(5) for i in range(4)]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = fit_biases(frame)
    assert found.rounds < 50
    _, users, _ = plain(rows, 5.0, found.rounds + 20)
    assert {r[0]: r[1] for r in found.users.collect()} == pytest.approx(users, abs=1e-5)


def test_every_pair_gets_a_number(spark):
    rows = [(1, 1, 4.0), (1, 2, 2.0), (2, 1, 5.0), (3, 3, float("nan")), (4, None, 1.0)]
    biases = fit_biases(spark.createDataFrame(rows, SCHEMA))
    pairs = spark.createDataFrame(
        [(1, 1, 0.5), (1, 99, None), (99, 1, float("nan")), (98, 99, None), (None, None, None)],
        "userId int, sourceId int, prediction float",
    )
    filled = {(r["userId"], r["sourceId"]): r for r in fill_cold(biases, pairs).collect()}
    assert len(filled) == 5 and filled[1, 1]["prediction"] == 0.5 and not filled[1, 1]["cold"]
    assert filled[98, 99]["prediction"] == pytest.approx(11 / 3)
    assert all(r["prediction"] is not None and not math.isnan(r["prediction"]) for r in filled.values())
    assert [k for k, r in filled.items() if r["cold"]] and filled[99, 1]["cold"]


def test_no_ratings_and_bad_settings(spark):
    none = spark.createDataFrame([], SCHEMA)
    biases = fit_biases(none)
    assert baseline(biases, spark.createDataFrame([(1, 2)], "userId int, sourceId int")).first()["baseline"] == 0.0
    for settings in ({"shrink": -1.0}, {"most_rounds": 0}):
        with pytest.raises(ValueError):
            fit_biases(none, **settings)


def test_a_busy_user_is_not_gathered(spark):
    from tests.plans import plan_of

    rows = spark.range(1000).select(
        F.lit(1).alias("userId"), F.col("id").cast("int").alias("sourceId"), F.lit(1.0).cast("float").alias("rating")
    )
    biases = fit_biases(rows, most_rounds=1)
    plan = plan_of(baseline(biases, rows))
    assert "collect_list" not in plan and "Python" not in plan
