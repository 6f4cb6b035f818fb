from __future__ import annotations

from datetime import date

import pytest

from earshot.operators import als, tuning
from earshot.operators.evaluate import metrics
from earshot.operators.split import hash_split
from earshot.params import AlsParams, JobParams
from earshot.plans import jobs
from earshot.registered import standins

GRID = [AlsParams(rank=2, max_iter=2), AlsParams(rank=5, max_iter=2, reg=0.3), AlsParams(rank=30, max_iter=1)]


@pytest.fixture(scope="module")
def parts(spark, sf_dir):
    split = hash_split(standins.event_ratings(spark, sf_dir)).checkpoint()
    return [split.where(f"split = '{name}'").drop("split") for name in ("train", "validation")]


def test_the_least_error_wins(parts):
    train, validation = parts
    n = train.count()
    choice = tuning.choose(train, validation, GRID, n)
    alone = [metrics(als.predict(als.fit(train, p, n), validation)).first() for p in GRID]
    assert [t.n_eval for t in choice.trials] == [m["n_eval"] for m in alone]
    assert [t.rmse for t in choice.trials] == pytest.approx([m["rmse"] for m in alone], rel=1e-6)
    assert choice.best == min(range(3), key=lambda i: alone[i]["rmse"])
    assert choice.model.rank == choice.params.rank
    again = tuning.choose(train.repartition(3), validation, GRID, n)
    assert [t.rmse for t in again.trials] == pytest.approx([t.rmse for t in choice.trials], rel=1e-9)


def test_without_usable_validation_rows_the_first_stays(parts):
    train, validation = parts
    choice = tuning.choose(train, validation.where("false"), GRID[:2], train.count())
    assert choice.best == 0 and [t.rmse for t in choice.trials] == [None, None]


def test_nothing_to_choose_from(parts):
    train, validation = parts
    with pytest.raises(ValueError, match="no settings"):
        tuning.choose(train, validation, [], 5)
    with pytest.raises(ValueError, match="no training rows"):
        tuning.choose(train.where("false"), validation, GRID, 0)


def test_grid_in_properties():
    params = JobParams.from_properties(
        {"hdfsUrl": "/x", "als.max_iter": "3", "grid.rank": "4,8", "grid.reg": "0.1,1"}, date(2024, 1, 2)
    )
    assert [(p.rank, p.reg, p.max_iter) for p in params.grid] == [
        (4, 0.1, 3), (4, 1.0, 3), (8, 0.1, 3), (8, 1.0, 3)
    ]
    with pytest.raises(ValueError):
        JobParams.from_properties({"hdfsUrl": "/x", "grid.size": "4"}, date(2024, 1, 2))


def test_training_keeps_the_winner(spark, tmp_path, sf_dir):
    params = JobParams(storage_root=str(tmp_path), run_date=date(2024, 3, 1), grid=tuple(GRID[:2]))
    standins.written_lines(standins.event_ratings(spark, sf_dir), params.ratings_path)
    report = jobs.train(spark, params)
    errors = [t.rmse for t in report.trials]
    assert report.chosen == errors.index(min(errors))
    assert als.load(report.model_path).rank == GRID[report.chosen].rank
    assert report.n_eval == metrics(jobs.score_part(spark, params)).first()["n_eval"]
    filled = jobs.predict_part(spark, params)
    assert filled.count() == report.counts["test"]
    assert filled.where("prediction IS NULL OR isnan(prediction)").isEmpty()
    assert filled.where("cold").count() == report.n_cold
